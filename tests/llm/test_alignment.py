import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablewright.llm import alignment as A
from tablewright.llm.packing import byte_of_char

from .helpers import docs_of, long_text

PATH_A, PATH_B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
LIBRARY_A = Tokenizer.from_file(PATH_A)
LIBRARY_A.encode_special_tokens = True
LIBRARY_B = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
CHARS = byte_of_char()


def side_a(text):
    found = LIBRARY_A.encode(" " + text, add_special_tokens=False)
    return found.ids, [bytes(CHARS[c] for c in LIBRARY_A.id_to_token(i)) for i in found.ids]


def side_b(text):
    ids = LIBRARY_B.encode(text)
    return ids, [bytes.fromhex(p[3:5]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in map(LIBRARY_B.id_to_piece, ids)]


def brute(texts):
    """Byte ranges of all tokens, and every pair of them compared."""
    done, count = [], Counter()
    for text in texts:
        (a, bytes_a), (b, bytes_b) = (side_a(text), side_b(text)) if text else (([], []), ([], []))
        want = (" " + (text or "")).encode()
        if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            done.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links = []
        for i, e in enumerate(ends_a):
            for j, f in enumerate(ends_b):
                if max(e - len(bytes_a[i]), f - len(bytes_b[j])) < min(e, f):
                    links.append((a[i], b[j]))
        groups, at_a, at_b = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[at_a:i])) + "|" + ",".join(map(str, b[at_b:j])))
            at_a, at_b = i, j
        done.append((len(a), len(b), groups, links))
        count.update(set(links))
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    rows = []
    for d in done:
        if d is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        best = sum(count[k] == highest[k[0]] for k in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        rows.append((n_a, n_b, len(groups), len(links), best, sum(count[k] for k in links), digest))
    return rows


SIGNS = ["a", "B", " ", "  ", "\n", "\t", "'s", "é", "五", "😀", "1", "99", "--", "<|endoftext|>", "<s>", "</s>", "<0x41>", "the", "ing", "tion", "\u0000", "▁", " ", "ﬁ", "é"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(SIGNS), max_size=30).map("".join))
def test_ids_are_the_libraries_also_when_cut(text):
    for cut in (2, 65_536):
        assert A.encode_a(" " + text, PATH_A, cut) == LIBRARY_A.encode(" " + text, add_special_tokens=False).ids
        assert A.encode_b(text, PATH_B, cut) == LIBRARY_B.encode(text)


ends = st.lists(st.integers(1, 4), min_size=1, max_size=40)


@settings(max_examples=200, deadline=None)
@given(ends, ends, st.integers(1, 20))
def test_pieces_stitched_are_the_whole(steps_a, steps_b, work):
    gap = sum(steps_a) - sum(steps_b)
    (steps_b if gap > 0 else steps_a).extend([1] * abs(gap))
    ends_a, ends_b = np.cumsum(steps_a), np.cumsum(steps_b)
    a, b = np.arange(len(ends_a)) % 7, np.arange(len(ends_b)) % 5
    whole = A.stitched([A.merge_piece(a, b, ends_a, ends_b, -1, 5)])
    i, j = A.cut_points(ends_a, ends_b, work)
    assert all(x + y <= work for x, y in zip(np.diff(i), np.diff(j), strict=True)) and (i[-1], j[-1]) == (len(a), len(b))
    parts = [
        A.merge_piece(a[i[p] : i[p + 1] + 1], b[j[p] : j[p + 1] + 1], ends_a[i[p] : i[p + 1]], ends_b[j[p] : j[p + 1]], int(ends_a[i[p] - 1]) if i[p] else -1, 5)
        for p in range(len(i) - 1)
    ]
    cut = A.stitched(parts)
    assert cut[0].tolist() == whole[0].tolist() and cut[1].tolist() == whole[1].tolist() and cut[2:] == whole[2:]


ROWS = [
    (1, "The thing and that, with other nation."), (2, None), (3, ""), (3, ""), (4, "▁ sign of the other side"), (5, "<|endoftext|> and <s> are plain"),
    (None, "The thing and that, with other nation."), (6, "éà 五 😀 ñandú\n\n  x \x00"), (7, long_text(400)), (7, long_text(400)), (8, "a"), (9, " "), (10, " ﬁ é"),
    (11, "x" * 300), (12, "五" * 200), (13, "the the the\tthe"),
]


@pytest.mark.parametrize("work, block, cut", [(65_536, 2_000_000, 65_536), (7, 10, 50), (64, 40, 30)])
def test_like_brute_force(spark, work, block, cut):
    done = A.align_tokens(docs_of(spark, ROWS), PATH_A, PATH_B, work=work, block=block, long_text=cut)
    have = sorted((str(r.doc), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in done.collect())
    assert have == sorted((str(d), *v) for (d, _), v in zip(ROWS, brute([t for _, t in ROWS]), strict=True))


def test_empty_table(spark):
    assert A.align_tokens(docs_of(spark, []), PATH_A, PATH_B).collect() == []


def test_given_documents(spark):
    from tablewright.llm import queries as Q

    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in Q.table(spark, folder, "documents").collect()}
    have = {r.doc_id: (r.n_a, r.n_b, r.n_groups) for r in Q.op12_cross_tokenizer_alignment(spark, folder).collect()}
    assert set(have) == set(docs)
    for doc, text in list(docs.items())[:40]:
        ends_a, ends_b = (set(np.cumsum([len(x) for x in side(text)[1]]).tolist()) for side in (side_a, side_b))
        assert have[doc] == (len(ends_a), len(ends_b), len(ends_a & ends_b))


def test_given_texts_have_the_library_s_ids():
    import pyarrow.parquet as pq

    for text in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist():
        assert A.encode_b(text, PATH_B, 500) == LIBRARY_B.encode(text)
