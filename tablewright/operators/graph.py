"""Closure of a link graph over captured pages, kept so that later links extend it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, write_once


class Closure:
    """What is reached from some seeds, as two tables bucketed by node.

    ``edges`` (``node``, ``next``) holds the links, ``reached`` (``node``, ``depth``) a row for
    each time a node was found nearer than before; its least depth stands. Both only grow, and
    both are read where they lie: a round shuffles what is new, never what is known. The tables
    are entries of the catalog that point to a scratch folder; ``name`` opens them again.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.name = name or f"closure_{uuid.uuid4().hex}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _table(self, kind: str) -> str:
        return f"{self.name}_{kind}"

    def _append(self, rows: DataFrame, kind: str) -> None:
        name = self._table(kind)
        writer = rows.repartition(self.buckets, "node").write.bucketBy(self.buckets, "node").sortBy("node").mode("append")
        if not self.spark.catalog.tableExists(name):
            writer = writer.option("path", scratch_path(self.spark, kind))
        writer.saveAsTable(name)

    def _held(self, kind: str) -> DataFrame | None:
        name = self._table(kind)
        return self.spark.table(name) if self.spark.catalog.tableExists(name) else None

    def nodes(self) -> DataFrame:
        """``node, depth`` of everything reached, with the least depth."""
        return self.spark.table(self._table("reached")).groupBy("node").agg(F.min("depth").alias("depth"))

    def nearer(self, found: DataFrame) -> DataFrame:
        """Of the nodes ``found`` at some depth, those not yet reached or reached later only."""
        known = self._held("reached")
        found = found.where("node IS NOT NULL").groupBy("node").agg(F.min("depth").alias("depth"))
        if known is None:
            return found
        known = known.select("node", F.col("depth").alias("before"))
        return found.join(known, (found["node"] == known["node"]) & (F.col("before") <= F.col("depth")), "left_anti")

    def beyond(self, frontier: DataFrame) -> DataFrame:
        """Where the links of some reached nodes lead, one deeper."""
        links = self._held("edges")
        return frontier.join(links, "node").select(F.col("next").alias("node"), (F.col("depth") + 1).alias("depth"))

    def extend(self, links: DataFrame, seeds: DataFrame | None = None, src: str = "src", dst: str = "dst") -> Closure:
        """Add links, and seeds (``node``), and reach on from what they change.

        Only nodes that the new links or seeds bring nearer are worked on, and what follows from
        them; depths found earlier are corrected where a new way is shorter. Links already there
        are not added again. Null ends count for nothing.
        """
        new = links.select(F.col(src).alias("node"), F.col(dst).alias("next")).where("node IS NOT NULL AND next IS NOT NULL").distinct()
        if (held := self._held("edges")) is not None:
            new = new.join(held, ["node", "next"], "left_anti")
        new = write_once(new, "new_links")
        self._append(new, "edges")
        start = [seeds.select("node", F.lit(0).alias("depth"))] if seeds is not None else []
        if self._held("reached") is not None:
            start.append(new.join(self.nodes(), "node").select(F.col("next").alias("node"), (F.col("depth") + 1).alias("depth")))
        found = None
        for part in start:
            found = part if found is None else found.unionByName(part)
        while found is not None:
            frontier = write_once(self.nearer(found), "frontier")
            empty = frontier.isEmpty()
            if not empty or self._held("reached") is None:
                self._append(frontier, "reached")
            if empty:
                break
            found = self.beyond(frontier)
        return self


def reachable(links: DataFrame, seeds: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, depth`` of everything reached from ``seeds.node``, with the least depth.

    One round per link distance. A round joins only the newest nodes to the links, so the plan
    does not grow with the rounds and a lost executor repeats one round only.
    """
    return Closure(links.sparkSession).extend(links, seeds, src, dst).nodes()
