"""Incremental and streaming forms of the log verbs.

Results are tables of batch folders ``batch_id=N``. A batch is written with overwrite, so a
batch that Spark runs again after a failure replaces itself and is never doubled. Nothing
already written is rewritten per batch.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.log import Keys, as_list, compact, dedup
from ..session import write_once
from ..sources.tables import exists


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_batches(
    stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Call ``batch(rows, number)`` for all that came since the checkpoint."""
    query = (
        stream.writeStream.foreachBatch(batch)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_folder(out: str, batch_id: int) -> str:
    return f"{out.rstrip('/')}/batch_id={batch_id}"


def run_incremental(
    stream: DataFrame, fn: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> None:
    """Process the source rows that came since the checkpoint. A new checkpoint is a reset."""

    def batch(df: DataFrame, batch_id: int) -> None:
        fn(df).write.mode("overwrite").parquet(batch_folder(out, batch_id))

    run_batches(stream, batch, checkpoint)


def skip_to_end(stream: DataFrame, checkpoint: str) -> None:
    """Mark everything that is there as seen, without processing it."""
    run_batches(stream, lambda df, batch_id: None, checkpoint)


def stream_captures(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append a polled source to a log, row by row as it comes."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_latest(stream: DataFrame, keys: Keys, order: str, out: str, checkpoint: str) -> None:
    """Keep the latest row per key: each batch adds its own winners; ``read_latest`` folds them."""

    def batch(df: DataFrame, batch_id: int) -> None:
        compact(df, keys, order).write.mode("overwrite").parquet(batch_folder(out, batch_id))

    run_batches(stream, batch, checkpoint)


def read_latest(spark: SparkSession, out: str, keys: Keys, order: str) -> DataFrame:
    """The latest row per key over all batches."""
    return compact(spark.read.parquet(out).drop("batch_id"), keys, order)


def fold_latest(spark: SparkSession, out: str, folded: str, keys: Keys, order: str) -> None:
    """Write the folded table to a new place, to start the next round of batches from."""
    read_latest(spark, out, keys, order).write.mode("overwrite").parquet(batch_folder(folded, -1))


#: Bits a key takes in a filter, and how many of them it sets: about one key in 2,000 is met in vain.
FILTER_BITS, FILTER_HASHES = 16, 5


def _filters(out: str) -> str:
    return f"{out.rstrip('/')}_filters"


def _places(one: np.ndarray, other: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key, from its two hashes."""
    at = np.arange(FILTER_HASHES, dtype=np.uint64)
    return ((one.view(np.uint64)[:, None] + at * (other.view(np.uint64) | np.uint64(1))[:, None]) % np.uint64(bits)).astype(np.int64)


def key_filters(hashed: DataFrame) -> DataFrame:
    """A Bloom filter per bucket (``bucket``, ``size``, ``bits``) of the keys in ``bucket, one, other``."""

    def built(rows: pa.Table) -> pa.Table:
        size = FILTER_BITS * rows.num_rows
        marks = np.zeros(size, bool)
        marks[_places(rows["one"].to_numpy(), rows["other"].to_numpy(), size).ravel()] = True
        bits = np.packbits(marks).tobytes()
        return pa.table({"bucket": rows["bucket"][:1], "size": pa.array([size], pa.int64()), "bits": pa.array([bits], pa.binary())})

    return hashed.select("bucket", "one", "other").groupBy("bucket").applyInArrow(built, "bucket int, size long, bits binary")


def probable_folders(hashed: DataFrame, filters: DataFrame) -> DataFrame:
    """(``batch_id``, ``bucket``) of the folders that may hold one of the keys.

    ``hashed`` has ``bucket, one, other``, ``filters`` those of earlier batches. A task holds one
    bucket's keys of this batch and, one after the other, its filters.
    """

    def probed(rows: pa.Table, held: pa.Table) -> pa.Table:
        one, other = rows["one"].to_numpy(), rows["other"].to_numpy()
        met = []
        for number, size, bits in zip(*(held[c].to_pylist() for c in ("batch_id", "size", "bits")), strict=True):
            places = _places(one, other, size)
            marks = np.frombuffer(bits, np.uint8)
            if ((marks[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1).all(1).any():
                met.append(number)
        return pa.table({"batch_id": pa.array(met, pa.int32()), "bucket": pa.array([rows["bucket"][0].as_py()] * len(met) if met else [], pa.int32())})

    touched = filters.join(hashed.select("bucket").distinct(), "bucket", "left_semi")
    return hashed.groupBy("bucket").cogroup(touched.groupBy("bucket")).applyInArrow(probed, "batch_id int, bucket int")


def stream_dedup(
    stream: DataFrame, keys: Keys, order: str, out: str, checkpoint: str, buckets: int = 64
) -> None:
    """Keep the first row per key for good; no key is ever forgotten.

    Every batch folder is split by a bucket of the key's hash, and comes with a Bloom filter per
    bucket. A batch probes the filters of earlier batches first and reads only the folders that
    may hold one of its keys: for keys never seen, next to none. There is no state to lose, and
    the batch's own first row is chosen by ``order``, not by arrival within the batch.
    """
    names = as_list(keys)
    hashes = {"one": F.xxhash64(F.lit(1), *names), "other": F.xxhash64(F.lit(2), *names)}
    bucket = F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        fresh = write_once(dedup(df, keys, order).withColumn("bucket", bucket), "first_rows")
        if exists(spark, _filters(out)):
            earlier = spark.read.parquet(_filters(out)).where(F.col("batch_id") < batch_id)
            met = probable_folders(fresh.select("bucket", *[c.alias(n) for n, c in hashes.items()]), earlier)
            folders = [f"{batch_folder(out, r.batch_id)}/bucket={r.bucket}" for r in met.collect()]  # names, not rows
            if folders:
                fresh = fresh.join(known_keys(spark, out, folders, names), _same(names), "left_anti")
        fresh = write_once(fresh, "new_rows")
        fresh.repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(batch_folder(out, batch_id))
        hashed = fresh.select("bucket", *[c.alias(n) for n, c in hashes.items()])
        key_filters(hashed).write.mode("overwrite").parquet(batch_folder(_filters(out), batch_id))

    run_batches(stream, batch, checkpoint)


def _same(names: list[str]) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in names])


def known_keys(spark: SparkSession, out: str, folders: list[str], names: list[str]) -> DataFrame:
    """The keys in some folders of the history, as ``__<key>``."""
    history = spark.read.option("basePath", out).parquet(*folders)
    return history.select(*[F.col(k).alias(f"__{k}") for k in names])


def read_dedup(spark: SparkSession, out: str) -> DataFrame:
    """The first row per key over all batches."""
    return spark.read.parquet(out).drop("batch_id", "bucket")


def dedup_within(stream: DataFrame, keys: Keys, ts: str, delay: str) -> DataFrame:
    """First row per key with keys forgotten after ``delay``: bounded state for long streams.

    A row older than the latest seen by more than ``delay`` comes too late and is dropped. Of the
    rows of a key in one batch any one may stay.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(as_list(keys))
