import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import shards as S

from .helpers import docs_of, long_text


def plain_differencing(sizes, parts):
    """Karmarkar-Karp as written down: full tuples, sorted lists, the two of largest spread first."""
    held = [([size] + [0] * (parts - 1), order) for order, size in enumerate(sizes)]
    order = len(held)
    while len(held) > 1:
        held.sort(key=lambda h: (h[0][-1] - h[0][0], h[1]))
        (one, _), (other, _) = held.pop(0), held.pop(0)
        held.append((sorted((a + b for a, b in zip(one, reversed(other), strict=True)), reverse=True), order))
        order += 1
    return held[0][0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=25), st.integers(1, 6))
def test_differencing_like_the_book(sizes, parts):
    where, sums = S.difference([[(s, i)] for i, s in enumerate(sizes)], parts)
    assert [sum(s for s, w in zip(sizes, where, strict=True) if w == p) for p in range(parts)] == sums.tolist()
    assert sorted(sums.tolist()) == sorted(plain_differencing(sizes, parts))


def test_partial_partitions_stay_apart_and_combine():
    rng = np.random.default_rng(1)
    given_, number = [], 0
    for n in rng.integers(1, 5, 60):
        given_.append([(int(s), number + i) for i, s in enumerate(rng.integers(1, 1000, n))])
        number += n
    where, sums = S.difference(given_, 4)
    for partition in given_:
        assert len({where[i] for _, i in partition}) == len(partition)  # subsets of one never meet
    assert sums.max() - sums.min() <= 1000


def placed(spark, rows, **more):
    out = S.shard_documents(docs_of(spark, rows), **more).collect()
    assert Counter((r.doc, r.size, r.text_crc32) for r in out) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in (r[:2] for r in rows)
    )
    slots, shard_of = defaultdict(list), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        shard_of[r.digest].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())  # groups are whole
    assert all(0 <= s < more.get("shards", 24) for s in slots)
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r.size
    return out, [sizes[s] for s in range(more.get("shards", 24))]


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), (None, "x"), (3, "é五😀"), (4, long_text()), (5, "x"), (6, "y"), (6, "y")]
    out, _ = placed(spark, rows, shards=3)
    assert {bytes(r.digest) for r in out} == {hashlib.sha256((t or "").encode()).digest() for _, t in rows}


def test_empty_table(spark):
    assert S.shard_documents(docs_of(spark, [])).collect() == []


@pytest.mark.parametrize("fine, block", [(1024, 16_384), (4, 16), (2, 5)])
def test_balance_at_every_level(spark, fine, block):
    rng = np.random.default_rng(2)
    rows = [(i, f"{i} " + "w" * int(rng.integers(1, 400))) for i in range(700)]
    rows += [(1000 + i, "a text that many rows repeat") for i in range(300)]
    out, sizes = placed(spark, rows, shards=6, fine=fine, block=block, chunk=4)
    assert max(sizes) - min(sizes) <= max(40, sum(sizes) / (6 * fine))


def test_a_heavy_group_fills_its_shard_and_others_fill_up_around_it(spark):
    rows = [(i, "the same text in a third of all rows") for i in range(300)] + [(1000 + i, f"own {i % 89} " + "z" * (i % 37)) for i in range(600)]
    out, sizes = placed(spark, rows, shards=8, fine=8, block=32)
    top = max(sizes)
    assert top == 300 * 44 or top - min(sizes) <= 60
    rest = sorted(sizes)[:-1]
    assert rest[-1] - rest[0] <= sum(sizes) / (8 * 8)


def test_two_runs_agree(spark):
    rows = [(i, f"text {i % 50} " + "q" * (i % 13)) for i in range(200)]
    first, second = (sorted((r.doc, r.shard, r.slot) for r in S.shard_documents(docs_of(spark, rows), shards=5, fine=2, block=8).collect()) for _ in range(2))
    assert first == second


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = docs_of(spark, [(i, f"text {i % 9}") for i in range(40)] + [(None, None)])
    done = S.shard_documents(docs, shards=4)
    S.write_shards(docs, done, str(tmp_path / "out"), files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert Counter(r.shard for r in back.collect()) == Counter(r.shard for r in done.collect())
