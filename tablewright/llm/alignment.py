"""Aligning the tokens of two tokenizers over the same bytes, by merge-path partitioning."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import write_once

from .frames import col, whole
from .packing import vocabulary
from .tokens import segments

BLANK = "▁"  # how pieces write a space
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
#: A blank after something that is no blank: no piece reaches from before it to behind it.
WORD_END = re.compile(r"(?<=[^ ▁]) ")


# ---- the two tokenizers ----------------------------------------------------------


@functools.lru_cache(maxsize=4)
def byte_level(path: str) -> tuple[list[bytes], np.ndarray]:
    """(bytes, byte lengths) by id of a byte-level vocabulary; specials have none."""
    coder, special = vocabulary(path)
    size = max([coder.max_token_value, *special.values()]) + 1
    held = [b""] * size
    for i in range(size):
        if i not in special.values():
            held[i] = coder.decode_single_token_bytes(i)
    return held, np.array([len(b) for b in held], np.int64)


@dataclass(frozen=True)
class Pieces:
    """A piece model: its encoder, the bytes of each id, and whether texts may be cut at word ends."""

    model: sentencepiece.SentencePieceProcessor
    bytes: list[bytes]
    lengths: np.ndarray
    cut_at_words: bool


@functools.lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    held = [bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(n)) else n.replace(BLANK, " ").encode() for n in names]
    whole_words = not any(BLANK in n.lstrip(BLANK) for n in names)
    return Pieces(model, held, np.array([len(b) for b in held], np.int64), whole_words)


def encode_a(text: str, path: str, long_text: int) -> list[int]:
    coder, _ = vocabulary(path)
    return [i for part in segments(text, long_text) for i in coder.encode_ordinary(part)]


def encode_b(text: str, path: str, long_text: int) -> list[int]:
    """The ids of the whole text. Long texts are cut at blanks after words: the model puts one
    back in front of each part, and no piece reaches over such a place."""
    held = pieces(path)
    ids: list[int] = []
    start = 0
    while held.cut_at_words and len(text) - start > long_text:
        cut = WORD_END.search(text, start + long_text)
        if cut is None or cut.end() == len(text):
            break
        ids += held.model.encode(text[start : cut.start()], num_threads=1)
        start = cut.end()
    return ids + held.model.encode(text[start:], num_threads=1)


def tokens_of(text: str, path_a: str, path_b: str, long_text: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of both sides; none where the bytes of a side are not those of space + text."""
    none = np.zeros(0, np.int64)
    if not text or BLANK in text:  # B spells that sign as a space
        return none, none
    a, b = encode_a(" " + text, path_a, long_text), encode_b(text, path_b, long_text)
    want = b" " + text.encode()
    if b"".join(map(byte_level(path_a)[0].__getitem__, a)) != want or b"".join(map(pieces(path_b).bytes.__getitem__, b)) != want:
        return none, none
    return np.array(a, np.int64), np.array(b, np.int64)


# ---- the merge -------------------------------------------------------------------


def cut_points(ends_a: np.ndarray, ends_b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two sorted lists stands after 0, ``work``, 2 ``work``, … steps.

    On each diagonal of the merge a binary search finds how many steps went to A; of equal
    ends, A's comes first. All diagonals are searched at once and none needs another's result.
    """
    na, nb = len(ends_a), len(ends_b)
    steps = np.append(np.arange(0, na + nb, work), na + nb)
    low, high = np.maximum(0, steps - nb), np.minimum(steps, na)
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        a = ends_a[np.minimum(middle, na - 1)]
        b = ends_b[np.clip(steps - 1 - middle, 0, nb - 1)]
        first = open_ & (a <= b)
        low, high = np.where(first, middle + 1, low), np.where(open_ & ~first, middle, high)
    return low, steps - low


@dataclass
class Merged:
    """What a piece of the merge says: linked ids, and groups with an open end on both sides.

    ``head`` and ``tail`` are the (A, B) ids before the first and after the last common end;
    a piece without a common end is all head. ``middle`` is the text of the groups between.
    """

    pairs: np.ndarray
    counts: np.ndarray
    n_links: int
    n_groups: int
    head: tuple[list[int], list[int]]
    middle: str
    tail: tuple[list[int], list[int]]


def group_text(a: list[int], b: list[int]) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


@functools.lru_cache(maxsize=2)
def _spelled(most: int) -> list[str]:
    """For each number below ``most`` four texts: inside and at the end of A's part and of B's."""
    return [f"{n}{sign}" for n in range(most) for sign in ",|,;"]


def group_texts(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> str:
    """The text of groups that take A's ids up to each of ``ends_a`` and B's up to ``ends_b``.

    Each id's place among all ids of all groups is computed at once.
    """
    if not len(ends_a):
        return ""
    codes = np.empty(len(a) + len(b), np.int64)
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[ends_a - 1] = 1
    last_b[ends_b - 1] = 1
    before = np.concatenate([[0], ends_b[:-1]])  # ids of B in the groups before
    codes[np.arange(len(a)) + np.repeat(before, np.diff(ends_a, prepend=0))] = 4 * a + last_a
    codes[np.arange(len(b)) + np.repeat(ends_a, np.diff(ends_b, prepend=0))] = 4 * b + last_b + 2
    most = 1 << int(max(a.max(), b.max())).bit_length()
    return "".join(map(_spelled(max(most, 1 << 16)).__getitem__, codes.tolist()))[:-1]


def merge_piece(
    a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, before: int, size_b: int
) -> Merged:
    """Links and groups of one piece.

    ``a`` and ``b`` hold the piece's ids and the one after them, if any; ``before`` is the last
    end of A ahead of the piece. Each end in the piece is one link: of the token it ends with
    the token of the other side that is open there. An end of B that is also one of A adds no
    link but closes a group.
    """
    open_b = np.searchsorted(ends_b, ends_a, "left")
    open_a = np.searchsorted(ends_a, ends_b, "right")
    last_a = np.concatenate([[before], ends_a])[open_a]
    common = last_a == ends_b
    alone = ~common
    keys = np.concatenate([a[: len(ends_a)] * size_b + b[open_b], a[open_a[alone]] * size_b + b[: len(ends_b)][alone]])
    pairs, counts = np.unique(keys, return_counts=True)
    cut_a, cut_b = open_a[common], np.flatnonzero(common) + 1
    a, b = a[: len(ends_a)], b[: len(ends_b)]
    if not len(cut_a):
        return Merged(pairs, counts, len(keys), 0, (a.tolist(), b.tolist()), "", ([], []))
    (from_a, to_a), (from_b, to_b) = cut_a[[0, -1]], cut_b[[0, -1]]
    return Merged(
        pairs,
        counts,
        len(keys),
        len(cut_a),
        (a[:from_a].tolist(), b[:from_b].tolist()),
        group_texts(a[from_a:to_a], b[from_b:to_b], cut_a[1:] - from_a, cut_b[1:] - from_b),
        (a[to_a:].tolist(), b[to_b:].tolist()),
    )


def stitched(parts: list[Merged]) -> tuple[np.ndarray, np.ndarray, int, int, str]:
    """(pairs, counts, links, groups, text of all groups) of pieces in order.

    A group that reaches over pieces is the tail of one, whole pieces without a common end,
    and the head of another.
    """
    text: list[str] = []
    open_a: list[int] = []
    open_b: list[int] = []
    for part in parts:
        open_a, open_b = open_a + part.head[0], open_b + part.head[1]
        if part.n_groups:
            text.append(group_text(open_a, open_b))
            if part.middle:
                text.append(part.middle)
            open_a, open_b = part.tail
    if len(parts) == 1:
        pairs, counts = parts[0].pairs, parts[0].counts
    else:
        pairs, at = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, at, np.concatenate([p.counts for p in parts]))
    return pairs, counts, sum(p.n_links for p in parts), sum(p.n_groups for p in parts), ";".join(text)


# ---- Spark -----------------------------------------------------------------------

_RESULT = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, counts array<long>"
_PIECE = "a array<long>, b array<long>, ends_a array<long>, ends_b array<long>, before long"


def _result(at, doc, n_a, n_b, merged) -> dict:
    pairs, counts, n_links, n_groups, text = merged
    digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
    return {
        "at": at, "doc": doc, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
        "groups": digest, "pairs": pairs, "counts": counts,
    }


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def merge_documents(docs: DataFrame, path_a: str, path_b: str, *, work: int, long_text: int) -> DataFrame:
    """Encode and merge: one row per document with its groups' digest and linked id pairs.

    ``docs`` has ``at`` (a number for each row), ``doc`` and ``txt``. A document whose merge is
    one piece of at most ``work`` steps is done where it is read. The pieces of longer ones are
    dealt out as rows of their own, merged independently and stitched per document.
    """
    size_b = len(pieces(path_b).bytes)
    key = T.StructType([T.StructField("at", T.LongType()), T.StructField("doc", docs.schema["doc"].dataType)])
    done_type = T.StructType([*key, *T.StructType.fromDDL(_RESULT)])
    full_type = T.StructType([*done_type, T.StructField("piece", T.IntegerType()), *T.StructType.fromDDL(_PIECE)])
    full = _arrow(full_type)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        len_a, len_b = byte_level(path_a)[1], pieces(path_b).lengths
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for at, doc, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                a, b = tokens_of(text.as_py(), path_a, path_b, long_text)
                ends_a, ends_b = np.cumsum(len_a[a]), np.cumsum(len_b[b])
                cut_a, cut_b = cut_points(ends_a, ends_b, work) if len(a) else ([0, 0], [0, 0])
                if len(cut_a) == 2:
                    merged = stitched([merge_piece(a, b, ends_a, ends_b, -1, size_b)]) if len(a) else ([], [], 0, 0, "")
                    rows.append(_result(at.as_py(), doc.as_py(), len(a), len(b), merged) | {"piece": None})
                    held += len(merged[0])
                else:
                    for number, (i, j, k, m) in enumerate(zip(cut_a, cut_a[1:], cut_b, cut_b[1:], strict=False)):
                        rows.append(
                            {
                                "at": at.as_py(), "doc": doc.as_py(), "piece": number, "n_a": len(a), "n_b": len(b),
                                "a": a[i : j + 1], "b": b[k : m + 1], "ends_a": ends_a[i:j], "ends_b": ends_b[k:m],
                                "before": int(ends_a[i - 1]) if i else -1,
                            }
                        )
                        held += j - i + m - k
                if held > 500_000 or len(rows) >= 2_000:
                    yield _batch(rows, full)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, full)

    encoded = write_once(docs.select("at", "doc", "txt").mapInArrow(encode, full_type), "encoded")

    ends = "array<long>"
    part_type = T.StructType.fromDDL(
        "at long, piece int, n_a long, n_b long, n_groups long, n_links long, pairs array<long>, counts array<long>, "
        f"head_a {ends}, head_b {ends}, middle string, tail_a {ends}, tail_b {ends}"
    )
    part_type = T.StructType([key["doc"], *part_type])
    part = _arrow(part_type)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n] for name in batch.schema.names}
                a, b, ends_a, ends_b = (row[c].values.to_numpy(zero_copy_only=False) for c in ("a", "b", "ends_a", "ends_b"))
                m = merge_piece(a, b, ends_a, ends_b, row["before"].as_py(), size_b)
                out = {c: row[c].as_py() for c in ("at", "doc", "piece", "n_a", "n_b")}
                out |= {"n_groups": m.n_groups, "n_links": m.n_links, "pairs": m.pairs, "counts": m.counts, "middle": m.middle}
                out |= {"head_a": m.head[0], "head_b": m.head[1], "tail_a": m.tail[0], "tail_b": m.tail[1]}
                yield _batch([out], part)

    done_schema = _arrow(done_type)

    def stitch(table: pa.Table) -> pa.Table:
        rows = table.sort_by("piece").to_pylist()
        parts = [
            Merged(
                np.array(r["pairs"], np.int64), np.array(r["counts"], np.int64), r["n_links"], r["n_groups"],
                (r["head_a"], r["head_b"]), r["middle"], (r["tail_a"], r["tail_b"]),
            )
            for r in rows
        ]
        head = rows[0]
        return pa.Table.from_batches([_batch([_result(head["at"], head["doc"], head["n_a"], head["n_b"], stitched(parts))], done_schema)])

    long_ones = encoded.where("piece IS NOT NULL").select("at", "doc", "piece", "n_a", "n_b", "a", "b", "ends_a", "ends_b", "before")
    parts = long_ones.repartition("at", "piece").mapInArrow(merge, part_type)
    joined = write_once(parts.groupBy("at").applyInArrow(stitch, done_type), "stitched")
    return encoded.where("piece IS NULL").select(*joined.columns).unionByName(joined)


def align_tokens(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    work: int = 65_536,
    block: int = 2_000_000,
    long_text: int = 65_536,
) -> DataFrame:
    """Align the tokens of a byte-level vocabulary (A) and a piece model (B) over each text.

    Returns ``doc``, ``n_a``, ``n_b`` (tokens), ``n_groups`` (runs between offsets where both
    end), ``n_links`` (pairs of tokens that overlap), ``n_best`` (links whose id pair is linked
    in as many documents as any pair of its A id), ``count_sum`` (over links: in how many
    documents the id pair is linked) and ``groups`` (SHA-256 of ``a1,a2|b1;a3|b2,b3``).

    * A encodes space + text; special tokens' texts are plain text. B adds the space itself.
    * A text that is null or empty, or that a side's bytes do not spell, has no tokens: zeros
      and an empty ``groups``. Such texts link nothing.
    * Rows that repeat an id or whole rows are documents of their own and count as such. A null
      id takes part. Ties for the highest count are all best.
    * An empty table gives an empty result. Other columns of the input are not read.

    Texts are read and encoded once, whole. The merge of A's and B's ends is cut into pieces of
    ``work`` steps, so a long text is spread over tasks. What stays of a document are its
    distinct id pairs. Documents are dealt into blocks of about ``block`` such pairs; a block
    asks once for the count of each pair it holds, so no pair that many documents share is met
    once per document, and the table of pairs may be of any size.
    """
    marked = docs.select(F.monotonically_increasing_id().alias("at"), col(doc_id).alias("doc"), whole(text).alias("txt"))
    merged = merge_documents(marked, path_a, path_b, work=work, long_text=long_text)
    held = merged.agg(F.sum(F.size("pairs"))).first()[0] or 0
    blocks = max(1, -(-held // block))
    size_b = len(pieces(path_b).bytes)
    dealt = merged.withColumn("block", F.pmod(F.xxhash64("at"), F.lit(blocks)))
    asked = write_once(
        dealt.select("block", F.explode("pairs").alias("pair")).groupBy("block", "pair").agg(F.count("*").alias("n")), "asked_pairs"
    )
    counted = asked.groupBy("pair").agg(F.sum("n").alias("docs")).withColumn("a", F.expr(f"pair div {size_b}"))
    counted = write_once(counted, "pair_counts")
    highest = counted.groupBy("a").agg(F.max("docs").alias("most"))  # at most a row per id of A
    known = counted.join(highest, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    answers = asked.select("block", "pair").join(known, "pair")

    kept = ["doc", "n_a", "n_b", "n_groups", "n_links", "groups"]
    type_of = {f.name: f for f in merged.schema}
    out_type = T.StructType([*[type_of[c] for c in kept], *T.StructType.fromDDL("n_best long, count_sum long")])

    def price(rows: pa.Table, found: pa.Table) -> pa.Table:
        pair, docs_, best = (found[c].to_numpy() for c in ("pair", "docs", "best"))
        order = np.argsort(pair)
        pair, docs_, best = pair[order], docs_[order], best[order].astype(np.int64)
        lists = rows["pairs"].combine_chunks()
        times = rows["counts"].combine_chunks()
        at = np.searchsorted(pair, lists.flatten().to_numpy())
        n = times.flatten().to_numpy()
        ends = np.cumsum(lists.value_lengths().to_numpy())
        sums = {}
        for name, value in (("n_best", best), ("count_sum", docs_)):
            run = np.concatenate([[0], np.cumsum(n * value[at])]) if len(at) else np.zeros(1, np.int64)
            sums[name] = run[ends] - run[ends - lists.value_lengths().to_numpy()]
        return pa.table({**{c: rows[c] for c in kept}, **{c: pa.array(v, pa.int64()) for c, v in sums.items()}})

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(price, out_type)
