"""Log tables on shared storage, and row numbers for files."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_log(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A log table: key, payload columns, ``seq`` and ``ts``."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a parquet table at ``path``; a folder without files is none."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def append_log(df: DataFrame, path: str, order: str | None = None, codec: str = "zstd") -> None:
    """Append rows; ``seq`` grows over appends and, within one, along ``order`` if given.

    The number is written with the rows, so no later read computes it anew. A log has one
    writer at a time: it is the one that reads how far the numbers go.
    """
    spark = df.sparkSession
    top = 0
    if exists(spark, path):
        top = spark.read.parquet(path).agg(F.max("seq")).first()[0] or 0
    rows = df.orderBy(order) if order else df
    rows = rows.withColumn("seq", F.monotonically_increasing_id() + F.lit(top + 1))
    rows.write.mode("append").option("compression", codec).parquet(path)


def overwrite_table(df: DataFrame, path: str, codec: str = "zstd") -> None:
    """Full refresh of a table, which ``df`` may itself read from.

    The new rows are written next to the table and take its place when they are complete. A
    failure before that leaves the table as it is; one between the two renames leaves the old
    table under ``<path>.old-…``.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    here, new, old = path.rstrip("/"), f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    df.write.option("compression", codec).parquet(new)
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(here).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(place(here)) and not files.rename(place(here), place(old)):
        raise OSError(f"cannot move {here}")
    if not files.rename(place(new), place(here)):
        raise OSError(f"cannot move {new}")
    files.delete(place(old), True)


def clean_log(spark: SparkSession, path: str, ts: str, asof, age) -> None:
    """Drop rows older than ``age`` at ``asof``: the rows that stay are written, then take over."""
    from ..operators.log import retain

    overwrite_table(retain(spark.read.parquet(path), ts, asof, age), path)


def with_row_numbers(df: DataFrame, out: str) -> DataFrame:
    """1-based row numbers in file order, for a DataFrame read straight from files.

    Rows are counted per file block and numbered inside it; only the block counts, one row
    per block of the input, are put in order.
    """
    rows = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__id"),
    )
    blocks = rows.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("__first"))
    earlier = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    numbered = rows.join(blocks, ["__file", "__block"])
    number = (F.col("__id") - F.col("__first") + F.col("__offset") + 1).alias(out)
    return numbered.select(*df.columns, number)
