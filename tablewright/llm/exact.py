"""Exact dedup against a persistent digest index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import write_once

from .frames import col, packed, whole


class DigestIndex:
    """The digests of all texts seen so far, as a table bucketed and sorted by digest.

    Columns: ``digest`` (SHA-256, binary) and ``keep_id`` (the document that stays). A batch is
    reduced to one row per digest, anti-joined with the index by a sort-merge join that reads
    the index bucket by bucket without a shuffle, and appended with one file per bucket. The
    table is created empty, so the first batch takes the same way as all others. Take
    ``buckets`` so that a bucket of the index stays near 128 MB (``buckets_for``).

    The text of a row is hashed where it is read; only digests are shuffled, combined first. A
    digest that a third of all rows share is a hot key only in the join that brings the
    decision back, which adaptive execution splits.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int = 64):
        self.spark, self.table, self.buckets = spark, table, buckets
        if not spark.catalog.tableExists(table):
            self._written(spark.createDataFrame([], "digest binary, keep_id long"))

    @staticmethod
    def buckets_for(rows: int, bucket: int = 128 << 20) -> int:
        """Buckets for an index of so many digests: 48 bytes each, at least 4 buckets."""
        return max(4, -(-rows * 48 // bucket))

    def _written(self, rows: DataFrame) -> None:
        rows.write.bucketBy(self.buckets, "digest").sortBy("digest").mode("append").saveAsTable(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    @staticmethod
    def _groups(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
        """(``digest``, ``batch_id``, ``group_size``) of the texts of some rows."""
        named = docs.select(col(doc_id).alias("doc"), F.unhex(F.sha2(whole(text), 256)).alias("digest"))
        return named.groupBy("digest").agg(F.max("doc").alias("batch_id"), F.count("*").alias("group_size"))

    def fresh(self, groups: DataFrame) -> DataFrame:
        """The groups whose digest the index does not hold yet."""
        return groups.join(self.rows().hint("merge"), "digest", "left_anti")

    def append(self, docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> None:
        """Add the texts of a batch that no earlier batch brought, with the largest id of each."""
        groups = write_once(self._groups(docs, doc_id, text), "groups")
        found = self.fresh(groups).select("digest", F.col("batch_id").cast("long").alias("keep_id"))
        self._written(found.repartition(self.buckets, "digest"))

    def decide(self, docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """The decision for each row of ``docs``, whose texts the index holds; see ``add``."""
        sizes = write_once(self._groups(docs, doc_id, text).drop("batch_id"), "groups")
        decided = sizes.join(self.rows().hint("merge"), "digest")
        named = packed(docs, doc=col(doc_id), digest=F.unhex(F.sha2(whole(text), 256)))
        return named.join(decided, "digest").select(
            "row",
            "doc",
            "digest",
            "keep_id",
            "group_size",
            F.col("doc").eqNullSafe(F.col("keep_id")).alias("kept"),
        )

    def add(self, docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Append the new digests of a batch and return the decision for each of its rows.

        Returns ``row`` (the input row as a struct), ``doc``, ``digest``, ``keep_id``,
        ``group_size`` (rows of this batch with the text) and ``kept``. A text that an earlier
        batch brought keeps that batch's document; else the largest id of the batch stays.

        * A null text counts as empty. Empty texts are equal to each other. Texts of any length
          are hashed whole.
        * Rows that repeat both id and text are one document and share the decision.
        * A null id is smaller than all others; it stays only if no other id has the text.
        * An empty batch appends nothing and gives an empty result.
        """
        self.append(docs, doc_id=doc_id, text=text)
        return self.decide(docs, doc_id=doc_id, text=text)
