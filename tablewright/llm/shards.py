"""Sharding into byte-balanced shards by Karmarkar-Karp differencing of indivisible groups."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import write_once

from .frames import col, whole

LAW = "bytes"


def difference(partitions: Sequence[Sequence[tuple[int, int]]], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp over partial partitions.

    A partial partition is a list of up to ``parts`` subsets (``size``, ``number``); a lone item
    is a partition of one subset, the others are empty. Numbers run from 0 over all subsets. The
    two partitions of largest spread (largest less smallest subset) are combined again and
    again, the largest subset of one with the smallest of the other, until one is left.

    Returns, per subset number, the part it is in, and the size of each part, largest first.
    Partitions of equal spread are taken in the order given, so the result is a function of it.
    """
    total = sum(map(len, partitions))
    above = np.arange(total)  # per subset, one it shares a part with, up to the representative
    heap = []
    for order, given in enumerate(partitions):
        held = sorted(given, reverse=True)
        spread = held[0][0] - (held[-1][0] if len(held) == parts else 0)
        heap.append((-spread, order, held))
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        one, other = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(one) < len(other):
            one, other = other, one
        free = parts - len(one)  # empty subsets take the largest of the other partition
        met = [*one, *other[:free]]
        for at, (size, number) in enumerate(other[free:]):
            last = len(one) - 1 - at
            mine, into = one[last]
            above[number] = into
            met[last] = (mine + size, into)
        met.sort(reverse=True)
        spread = met[0][0] - (met[-1][0] if len(met) == parts else 0)
        heapq.heappush(heap, (-spread, order, met))
        order += 1
    left = heap[0][2] if heap else []
    where, sizes = np.full(total, -1), np.zeros(parts, np.int64)
    for part, (size, number) in enumerate(left):
        where[number], sizes[part] = part, size
    # Every step up leads to a subset that was joined later or is a representative.
    while (open_ := where < 0).any():
        where[open_] = where[above[open_]]
        above = above[above]
    return where, sizes


def split_blocks(items: DataFrame, parts: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Difference each of ``blocks`` blocks of partial partitions on its own.

    ``items`` has ``node`` (a partition) and ``subsets`` (array of its subset sizes). Returns
    (``node``, ``at``, ``block``, ``part``): where each subset went, and the blocks as partial
    partitions of the next level. Nodes are dealt by hash, so blocks are alike in size.
    """
    dealt = items.withColumn("block", F.pmod(F.xxhash64("node", F.lit(blocks)), F.lit(blocks)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        sizes = table["subsets"].to_pylist()
        numbered, at = [], 0
        for held in sizes:
            numbered.append([(s, at + i) for i, s in enumerate(held)])
            at += len(held)
        where, _ = difference(numbered, parts)
        counts = [len(s) for s in sizes]
        return pa.table(
            {
                "node": pa.array(np.repeat(table["node"].to_numpy(), counts), pa.int64()),
                "at": pa.array([i for n in counts for i in range(n)], pa.int32()),
                "size": pa.array([s for held in sizes for s in held], pa.int64()),
                "block": pa.array(np.repeat(table["block"].to_numpy(), counts), pa.int64()),
                "part": pa.array(where, pa.int32()),
            }
        )

    schema = "node long, at int, size long, block long, part int"
    went = write_once(dealt.groupBy("block").applyInArrow(run, schema), "differenced")
    sums = went.groupBy("block", "part").agg(F.sum("size").alias("size"))
    above = sums.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "size"))).alias("s"))
    return went, above.select(F.col("block").alias("node"), F.col("s.size").alias("subsets"))


def assign_groups(groups: DataFrame, shards: int, *, fine: int = 1024, block: int = 16_384) -> tuple[DataFrame, DataFrame]:
    """The shard of each group: (heavy groups, light groups), both (``digest``, ``shard``).

    ``groups`` is a written table (``digest``, ``bytes``, ``rows``). A group that holds more than
    the ``shards * fine``-th part of all bytes or rows is heavy; there are at most
    ``2 * shards * fine`` of them. Light groups are differenced in blocks of about ``block``,
    their partial partitions again in blocks, level by level, until at most ``fine`` partial
    partitions are left. The subsets of these (at most ``shards * fine``) and the heavy groups
    are then the items of one last differencing, in which small subsets fill up around heavy
    groups. No task ever holds more than a block or that bounded last set.
    """
    spark = groups.sparkSession
    total = groups.agg(F.sum("bytes"), F.sum("rows")).first()
    if not total[0]:
        empty = groups.select("digest", F.lit(0).alias("shard")).where("false")
        return empty, empty
    heavy_if = (F.col("bytes") * shards * fine > total[0]) | (F.col("rows") * shards * fine > total[1])
    heavy = groups.where(heavy_if).select(F.lit(-1).cast("long").alias("node"), F.lit(0).alias("at"), "digest", F.col("bytes").alias("size"))
    light = groups.where(~heavy_if).select(F.xxhash64("digest").alias("key"), "digest", "bytes")
    # Nodes of the lowest level: light groups whose digests share a hash go together.
    nodes = light.groupBy(F.col("key").alias("node")).agg(F.array(F.sum("bytes")).alias("subsets"))
    levels = []
    count = nodes.count()
    while True:
        went, nodes = split_blocks(nodes, shards, max(fine, -(-count // block)))
        levels.append(went)
        nodes = write_once(nodes, "partial_partitions")
        count = nodes.count()
        if count <= fine:
            break
        block = min(block, 4 * fine)  # nodes now hold up to ``shards`` subsets each

    items = nodes.select("node", F.posexplode("subsets").alias("at", "size")).select(
        "node", "at", F.lit(None).cast("binary").alias("digest"), "size"
    )

    def last(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("digest", "ascending"), ("node", "ascending"), ("at", "ascending")])
        where, _ = difference([[(s, i)] for i, s in enumerate(table["size"].to_pylist())], shards)
        return table.drop_columns(["all"]).append_column("shard", pa.array(where, pa.int32()))

    schema = "node long, at int, digest binary, size long, shard int"
    top = write_once(items.unionByName(heavy).withColumn("all", F.lit(0)).groupBy("all").applyInArrow(last, schema), "top")
    heavy_in = top.where("digest IS NOT NULL").select("digest", "shard")
    light_in = top.where("digest IS NULL").select(F.col("node").alias("block"), F.col("at").alias("part"), "shard")
    for went in reversed(levels):
        placed = went.join(light_in, ["block", "part"])
        light_in = placed.select(F.col("node").alias("block"), F.col("at").alias("part"), "shard")
    keyed = light_in.select(F.col("block").alias("key"), "shard")
    return heavy_in, write_once(light.select("key", "digest").join(keyed, "key").select("digest", "shard"), "light")


def size_of(text: Column, extra: int) -> Column:
    """UTF-8 bytes of a text, plus what each row costs besides; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + extra


def shard_documents(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = 24,
    extra: int = 8,
    fine: int = 1024,
    block: int = 16_384,
    chunk: int = 16,
) -> DataFrame:
    """Put every row into one of ``shards`` shards of near equal bytes.

    Returns ``doc``, ``size`` (bytes of the text plus ``extra``), ``text_crc32``, ``digest``
    (SHA-256 of the text), ``shard`` and ``slot`` (gapless from 0 in each shard). Rows of equal
    text are a group that is never divided; a group larger than a shard's share fills its shard
    alone. How groups are placed: ``assign_groups``.

    * A null text counts as empty: it has no bytes and is in one group with empty texts.
    * Rows that repeat an id or whole rows are rows of their own, each with its slot.
    * A null id takes part like any other. Ties of size are broken by digest.
    * An empty table gives an empty result. Other columns of the input are not read.

    Texts are read once and never shuffled. Groups are combined before they are shuffled. The
    heavy ones are a bounded set that may be broadcast, so no hot digest meets in a join. Slots
    are numbered inside chunks of ``2 ** chunk`` rows of a shard and shifted by the chunks before.
    """
    body = whole(text)
    marked = write_once(
        docs.select(
            col(doc_id).alias("doc"),
            size_of(body, extra).alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("at"),  # fixed by being written
        ),
        "sized",
    )
    groups = write_once(marked.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "groups")
    heavy, light = assign_groups(groups, shards, fine=fine, block=block)
    first = marked.join(F.broadcast(heavy.withColumnRenamed("shard", "heavy")), "digest", "left")
    in_light = first.where("heavy IS NULL").drop("heavy").join(light, "digest")
    placed = first.where("heavy IS NOT NULL").withColumnRenamed("heavy", "shard").unionByName(in_light)
    placed = write_once(placed.withColumn("chunk", F.shiftright("at", chunk)), "placed")

    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    starts = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "chunk").orderBy("at")
    return placed.withColumn("inside", F.row_number().over(inside)).join(starts, ["shard", "chunk"]).select(
        "doc", "size", "text_crc32", "digest", "shard", (F.col("start") + F.col("inside") - 1).alias("slot")
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, *, text: str = "text", files: int = 1) -> None:
    """Write the rows of ``docs`` as a folder ``shard=N`` for each shard of ``placed``.

    Each folder has ``files`` files, or more where that takes more: rows are dealt by shard and a
    hash of the whole row. The shard of a row is that of its text's group, found by digest. A
    column named ``shard`` in the input gives way to the folder's.
    """
    digest = F.unhex(F.sha2(whole(text).cast("binary"), 256))
    row = F.struct(*[col(c) for c in docs.columns if c.lower() != "shard"])
    where = placed.groupBy("digest").agg(F.min("shard").alias("shard"))
    keyed = docs.select(row.alias("row"), digest.alias("digest")).join(where, "digest")
    dealt = keyed.withColumn("file", F.pmod(F.xxhash64("row"), F.lit(files))).repartition("shard", "file")
    dealt.select("row.*", "shard").write.partitionBy("shard").parquet(path)
