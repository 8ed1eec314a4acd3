"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import write_once


def stars(edges: DataFrame) -> DataFrame:
    """Turn links (``a``, ``b``) into (``node``, ``root``): every node that has a smaller one in
    its component, with the smallest.

    Each round hangs every node below the least node its neighbours know (large star), then
    joins what hangs together below one node (small star); the number of rounds grows with the
    logarithm of the longest path. A round is written to the shared folder, so plans stay short
    and a lost executor costs one round at most. Least values are combined before they are
    shuffled; the joins on a node that many hang below are plain sort-merge joins, which
    adaptive execution splits.

    Links with a null end, and of a node with itself, count for nothing.
    """
    links = (
        edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("node") > F.col("root")))
        .distinct()
    )
    links, mark = _written(links)
    while mark[0]:
        least = links.groupBy("node").agg(F.min("root").alias("top"))
        large = links.join(least.withColumnRenamed("node", "root"), "root", "left").select(
            "node", F.coalesce("top", "root").alias("root")
        )
        least = large.groupBy("node").agg(F.min("root").alias("top"))
        small = large.join(least, "node").select(
            F.explode(
                F.array(
                    F.struct(F.col("node"), F.col("top").alias("root")),
                    F.struct(F.col("root").alias("node"), F.col("top").alias("root")),
                )
            ).alias("link")
        )
        links, now = _written(small.select("link.*").where(F.col("node") > F.col("root")).distinct())
        if now == mark:
            break
        mark = now
    return links


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a written table, and two numbers that tell one set of links from another."""
    kept = write_once(links, "links")
    # a sum of hashes modulo a prime below 2**31 cannot overflow
    mark = kept.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("node", "root"), F.lit(2_147_483_647)))).first()
    return kept, tuple(mark)
