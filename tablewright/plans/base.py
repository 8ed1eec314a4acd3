"""The registry of queries, and how they read a table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(ops: str, sql: str | None = None):
    """Register ``name(tables)``; ``ops`` lists the operators it runs, ``sql`` says the same."""

    def register(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        REGISTRY[fn.__name__] = Query(build, sql, tuple(ops.split()))
        return fn

    return register


class Tables:
    """``tables.orders`` reads that table of the data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    @property
    def parts(self) -> int:
        """The partition count the session is set to."""
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(self, df: DataFrame) -> DataFrame:
        """Rows dealt out before costly work per row.

        Only for the given tables: each is one file of one row group, which one task would read.
        Captures that come in many files need no such step, so no operator takes it by itself.
        """
        return df.repartition(self.parts)

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))
