"""SimHash near-dedup: fingerprints of word shingles, linked through shared blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import write_once

from .components import stars
from .frames import col, packed, whole

BITS = 64
SEED = 42


def fingerprint(text: str, words: int) -> int:
    """The SimHash of a text as a signed 64-bit number.

    Words are runs without ASCII blanks, A-Z lower-cased; shingles of ``words`` words are joined
    by one blank and counted as often as they occur. A text with fewer words is one shingle, one
    without words has fingerprint zero. A bit is set if it is set in over half the hashes.
    """
    parts = text.encode().lower().split()
    if not parts:
        return 0
    shingles = map(b" ".join, zip(*(parts[at:] for at in range(words)), strict=False))
    hashes = [xxhash.xxh64_intdigest(s, SEED) for s in shingles]
    hashes = hashes or [xxhash.xxh64_intdigest(b" ".join(parts), SEED)]
    counts = np.zeros(BITS, np.int64)
    values = np.array(hashes, np.uint64)
    for at in range(0, len(values), 1 << 16):  # keeps the unpacked bits of long texts small
        block = values[at : at + (1 << 16)].astype("<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_of(text: Column, *, words: int = 3) -> Column:
    """The fingerprint of each text; a null text has none of its words and so is zero."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array((fingerprint(t.as_py() or "", words) for t in texts), pa.int64())

    return simhash(text)


def blocks_shared(distance: int, blocks: int) -> list[tuple[int, ...]]:
    """The choices of blocks of which a pair within ``distance`` bits shares at least one.

    Of ``blocks`` blocks at most ``distance`` differ, so some ``blocks - distance`` are equal.
    """
    return list(combinations(range(blocks), blocks - distance))


def block_mask(chosen: tuple[int, ...], blocks: int) -> int:
    """A signed mask of the bits of the chosen blocks."""
    cuts = [BITS * at // blocks for at in range(blocks + 1)]
    mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in chosen)
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def link_fingerprints(prints: DataFrame, *, distance: int = 2, blocks: int = 4, bucket: int = 64) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints ``print``, enough for the components.

    A print is listed under each choice of shared blocks. In a list of up to ``bucket`` prints
    all pairs are compared. Longer lists never meet pairwise: for ``distance`` 2, two prints are
    close exactly if some value is at most one bit from both, so each print is listed again
    under itself and its one-bit neighbours outside the shared blocks. Such a list holds at most
    65 prints, all close to each other, and each is linked to the least.
    """
    if distance != 2:
        raise ValueError("long lists are resolved through one-bit neighbours, which needs a distance of 2")
    masks = [block_mask(c, blocks) for c in blocks_shared(distance, blocks)]
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("print").bitwiseAND(m).alias("key")) for i, m in enumerate(masks)])
    listed = prints.select("print", F.explode(keys).alias("k")).select("print", "k.choice", "k.key")
    sizes = listed.groupBy("choice", "key").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    shared = write_once(listed.join(sizes, ["choice", "key"]), "shared_blocks")

    short = shared.where(F.col("size") <= bucket).drop("size")
    other = short.withColumnRenamed("print", "other")
    close = F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= distance
    pairs = short.join(other, ["choice", "key"]).where((F.col("print") < F.col("other")) & close)

    flips = [0, *[(1 << b) - (1 << BITS) * (b == BITS - 1) for b in range(BITS)]]
    choice_mask = F.element_at(F.array(*map(F.lit, masks)), F.col("choice") + 1)
    neighbours = (
        shared.where(F.col("size") > bucket)
        .select("print", choice_mask.alias("mask"), F.explode(F.array(*map(F.lit, flips))).alias("flip"))
        .where(F.col("flip").bitwiseAND(F.col("mask")) == 0)
        .select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("near"))
        .groupBy("near")
        .agg(F.collect_set("print").alias("prints"))
        .where(F.size("prints") > 1)
        .select(F.array_min("prints").alias("a"), F.explode("prints").alias("b"))
        .where(F.col("a") != F.col("b"))
    )
    return pairs.select(F.col("print").alias("a"), F.col("other").alias("b")).unionByName(neighbours)


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 3,
    distance: int = 2,
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """The group of each document: (``doc``, ``print``, ``component_id``, ``group``).

    Fingerprints link at ``distance`` or fewer differing bits; ``component_id`` is the smallest
    id reachable by links, ``group`` the smallest fingerprint. Documents with equal fingerprints
    are one node from there on. ``carried`` names further columns to hand through for each row.

    * A text that is null, empty or only blanks has fingerprint zero and links like any other.
    * Rows that repeat an id are judged by their own text and keep their number.
    * A null id takes part; a group of null ids only has a null ``component_id``.
    * An empty table gives an empty result. Other columns of the input are not read.

    Texts are read once and never shuffled. A fingerprint that a third of all rows share is
    combined before the shuffle and hot only in the last join, which adaptive execution splits.
    """
    carried = carried or {}
    marked = write_once(
        packed(docs, doc=col(doc_id), print=fingerprint_of(whole(text), words=words), **carried).drop("row"),
        "fingerprints",
    )
    nodes = write_once(marked.groupBy("print").agg(F.min("doc").alias("least")), "nodes")
    roots = stars(link_fingerprints(nodes.select("print"), distance=distance))
    rooted = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = rooted.join(least, "root").select("print", "component_id", F.col("root").alias("group"))
    return marked.join(groups, "print").select("doc", "print", "component_id", "group", *carried)
