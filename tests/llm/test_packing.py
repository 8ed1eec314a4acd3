import zlib
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm import packing as K

from .helpers import docs_of, long_text

PATH = P.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


SIGNS = ["a", "B", " ", "\n", "\t", "'s", "'ll", "é", "\u0085", "五", "😀", "1", "99", "--", "%%%", "<|endoftext|>", "the", "ing", " tion"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(SIGNS), max_size=30).map("".join))
def test_ids_are_the_library_s(text):
    assert K.token_ids(text, PATH).tolist() == library_ids(text)
    assert K.token_ids(text, PATH, long_text=3).tolist() == library_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_ids_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert K.token_ids(text, PATH).tolist() == library_ids(text)


def fewest(sizes, capacity):
    """Brute force over which sizes share a bin with the largest."""
    if not sizes:
        return 0
    head, rest = sizes[0], sizes[1:]
    best = len(sizes)
    for n in range(len(rest) + 1):
        for pick in combinations(range(len(rest)), n):
            if head + sum(rest[i] for i in pick) <= capacity:
                best = min(best, 1 + fewest([x for i, x in enumerate(rest) if i not in pick], capacity))
    return best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=0, max_size=8))
def test_as_few_bins_as_possible(sizes):
    found = K.complete_bins(np.array(sizes, np.int64), 20)
    assert sorted(x for b in found for x in b) == sorted(sizes)
    assert all(0 < sum(b) <= 20 for b in found)
    assert len(found) == fewest(sorted(sizes, reverse=True), 20)


def cut_from_full_bins(seed, bins, capacity, most):
    rng = np.random.default_rng(seed)
    sizes = []
    for _ in range(bins):
        cuts = np.sort(rng.choice(np.arange(1, capacity), rng.integers(1, most), replace=False))
        sizes += np.diff([0, *cuts, capacity]).tolist()
    return np.array(sizes, np.int64)


def test_full_bins_are_found_again_with_the_shipped_search():
    missed = sum(len(K.complete_bins(cut_from_full_bins(seed, 6, 60, 5), 60)) > 6 for seed in range(300))
    assert missed == 0


def ways(counts, room, limit):
    sizes = {s: n for s, n in counts.items() if n}
    listed = [sizes.get(s, 0) for s in range(room + 1)]
    held, mirror = sum(1 << s for s in sizes), sum(1 << (60 - s) for s in sizes)
    return list(K.Fillings([*listed, *[counts.get(s, 0) for s in range(room + 1, 61)]], held, mirror, 60, room, limit, 10**6, [10**6]))


def test_fillings_are_all_undominated_ones():
    assert [f for _, f in ways({6: 1, 3: 1, 2: 2}, 10, 10)] == [(6, 2, 2), (6, 3)]
    rng = np.random.default_rng(4)
    for _ in range(60):
        room = int(rng.integers(5, 25))
        counts = {int(s): int(rng.integers(1, 3)) for s in rng.integers(1, room + 4, 5)}
        pool = [s for s, n in counts.items() for _ in range(n)]
        every = {tuple(sorted(c, reverse=True)) for k in range(1, len(pool) + 1) for c in combinations(pool, k) if sum(c) <= room}
        found = [f for _, f in ways(counts, room, room)]
        assert set(found) <= (every or {()})
        assert all(any(K.dominates(f, c) for f in found) for c in every)
        assert [w for w, _ in ways(counts, room, room)] == sorted(room - sum(f) for f in found)
        assert not any(K.dominates(f, g) for f in found for g in found if f != g and sum(f) > 0)


def test_better_than_best_fit_and_near_the_bound():
    sizes = np.random.default_rng(0).integers(600, 760, 5000)
    found = len(K.complete_bins(sizes, 2048))
    assert found < len(K.best_fit(np.bincount(sizes, minlength=2049), 2048))
    assert found <= 1.01 * sizes.sum() / 2048


def test_dominance():
    assert K.dominates((10,), (4, 5)) and K.dominates((6, 4), (5, 4)) and K.dominates((6, 4), (6,))
    assert K.dominates((6, 4), (3, 3, 2, 2)) and K.dominates((9, 5), (5, 5, 4))
    assert not K.dominates((6, 4), (7,)) and not K.dominates((6, 4), (4, 4, 4))


def packed(spark, rows, **more):
    out = K.pack(docs_of(spark, rows), PATH, **more).collect()
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= more.get("capacity", 2048)
    return out, by_sequence


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "no id"), (4, long_text(9_000)), (5, "<|endoftext|> x"), (6, "é" * 10_000)]
    out, _ = packed(spark, rows, capacity=64)
    got = sorted(((str(r.doc), r.piece, r.start, r.length, r.crc) for r in out))
    want = []
    for doc, text in rows:
        ids = [*library_ids(text or ""), 0]
        start = 0
        for piece, end in enumerate(range(len(ids) % 64 or 64, len(ids) + 1, 64)):
            want.append((str(doc), piece, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
            start = end
    assert got == sorted(want)


def test_empty_table(spark):
    assert K.pack(docs_of(spark, []), PATH).collect() == []


@pytest.mark.parametrize("block", [60, 100_000])
def test_blocks_stay_near_the_bound(spark, block):
    rows = [(i, "word " * (1 + (i * 37) % 90)) for i in range(600)]
    out, sequences = packed(spark, rows, capacity=128, block=block)
    blocks = max(1, round(len(out) / block))
    bound = -(-sum(r.length for r in out) // 128)
    assert len(sequences) <= bound + 2 * blocks
    assert len({(r.doc, r.piece) for r in out}) == len(out) == 600


def test_nothing_of_a_text_is_kept_but_numbers(spark):
    plan = K.pack(docs_of(spark, [(1, "x")]), PATH)
    assert plan.columns == ["doc", "piece", "start", "length", "crc", "sequence_id", "offset"]
    assert plan.select(F.max("length")).first()[0] == 2


def test_ids_of_the_given_documents():
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    assert all(K.token_ids(t, PATH).tolist() == library_ids(t) for t in texts)


def test_given_documents_meet_the_bound(spark):
    out = K.pack(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), PATH).collect()
    assert len({r.sequence_id for r in out}) == -(-sum(r.length for r in out) // 2048)
