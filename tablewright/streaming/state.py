"""Keyed state of streams: the latest row per key, and aggregates that merge and can be taken back."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.log import Keys, as_list
from ..sources.tables import exists
from .jobs import batch_folder, run_batches

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# ---- the latest row per key -----------------------------------------------------------


def _plain(column: pd.Series) -> list:
    """The values as Python objects, None for missing ones."""
    values = column.astype(object).tolist()
    return [None if gone else value for value, gone in zip(values, column.isna(), strict=True)] if column.hasnans else values


class _Latest(StatefulProcessor):
    """Keeps one row per key and hands a row on only if it is later than the one kept."""

    def __init__(self, keys: list[str], by: list[str], rest: T.StructType, ts: str | None, forget_seconds: int):
        self.keys, self.by, self.rest, self.ts, self.forget_ms = keys, by, rest, ts, 1000 * forget_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("latest", self.rest)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.rest.fieldNames()
        at = [names.index(c) for c in self.by]
        place = lambda row: tuple(row[i] for i in at)
        kept = self.kept.get()  # None where there is none
        best = tuple(kept) if kept is not None else None
        for frame in rows:
            for row in zip(*[_plain(frame[c]) for c in names], strict=True):
                if row[at[0]] is not None and (best is None or place(row) > place(best)):
                    best = row
        if best is not None and (kept is None or best != tuple(kept)):
            self.kept.update(best)
            if self.ts:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                since = pd.Timestamp(best[names.index(self.ts)])
                if not pd.isna(since):  # a row without a time is kept for good
                    self.handle.registerTimer(since.value // 1_000_000 + self.forget_ms)
            yield pd.DataFrame([(*key, *best)], columns=[*self.keys, *names])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.kept.clear()
        return iter([])

    def close(self) -> None:
        pass


def latest_updates(
    stream: DataFrame, keys: Keys, order: str, tie: str | None = None, ts: str | None = None, forget_seconds: int = 0
) -> DataFrame:
    """A stream of changes: each key's row whenever a later one has come.

    Rows are compared by ``order``, then by ``tie`` if given. A late row, whose order is not above
    the one kept, changes nothing, also if it comes in a later batch or after a restart; of equal
    rows the one that came first stays. A row without an order counts for nothing. What is kept is
    one row per key. With ``ts``, the stream's watermark column, a key is forgotten when the
    watermark is ``forget_seconds`` past the ``ts`` of its row; its next row is a change again,
    whatever its order.
    """
    keys = as_list(keys)
    rest = T.StructType([f for f in stream.schema if f.name not in keys])
    out = T.StructType([*[stream.schema[k] for k in keys], *rest])
    return stream.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Latest(keys, [order] + ([tie] if tie else []), rest, ts, forget_seconds),
        outputStructType=out,
        outputMode="Update",
        timeMode="EventTime" if ts else "None",
    )


def run_latest(
    stream: DataFrame, keys: Keys, order: str, out: str, checkpoint: str, **more
) -> None:
    """Write the changes (``latest_updates``) of each batch to ``out/batch_id=N``; read them with ``read_current``."""
    spark = stream.sparkSession
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        write = lambda df, number: df.write.mode("overwrite").parquet(batch_folder(out, number))
        run_batches(latest_updates(stream, keys, order, **more), write, checkpoint, mode="update")
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


def _folds(out: str) -> str:
    return f"{out.rstrip('/')}_folds"


def _since(spark: SparkSession, out: str) -> tuple[DataFrame | None, int | None]:
    """The newest fold, and the number of the last batch it holds."""
    if not exists(spark, _folds(out)):
        return None, None
    folds = spark.read.parquet(_folds(out))
    newest = folds.agg(F.max("upto")).first()[0]
    return folds.where(F.col("upto") == newest).drop("upto"), newest


def read_current(spark: SparkSession, out: str, keys: Keys) -> DataFrame:
    """The row each key has now: the newest fold and the batches since, the last batch standing."""
    keys = as_list(keys)
    fold, upto = _since(spark, out)
    rows = spark.read.parquet(out)
    if upto is not None:
        rows = rows.where(F.col("batch_id") > upto).unionByName(fold.withColumn("batch_id", F.lit(upto)))
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("row"))
    return last.select(*keys, "row.*")


def fold_updates(spark: SparkSession, out: str, keys: Keys) -> int:
    """Fold all batches there are into one table next to them, for readers to start from.

    A running stream goes on undisturbed: its next batches have higher numbers and are read on top
    of the fold. Folded batch folders may be removed once no reader uses them.
    """
    last = spark.read.parquet(out).agg(F.max("batch_id")).first()[0]
    read_current(spark, out, keys).write.mode("overwrite").parquet(f"{_folds(out)}/upto={last}")
    return last


# ---- aggregates that merge ------------------------------------------------------------


@dataclass(frozen=True)
class Aggregate:
    """``kind`` is count, sum, mean, min, max or last (the non-null value of the greatest ``order``)."""

    out: str
    kind: str
    value: Column | None = None
    order: Column | None = None

    def partial(self) -> list[Column]:
        v = self.value
        if self.kind == "count":
            return [(F.count("*") if v is None else F.count(v)).alias(f"{self.out}__n")]
        if self.kind == "mean":
            return [F.sum(v).alias(f"{self.out}__s"), F.count(v).alias(f"{self.out}__n")]
        if self.kind == "last":
            known = F.when(v.isNotNull(), self.order)
            return [F.max_by(v, known).alias(f"{self.out}__v"), F.max(known).alias(f"{self.out}__o")]
        return [{"sum": F.sum, "min": F.min, "max": F.max}[self.kind](v).alias(f"{self.out}__v")]

    def merged(self) -> Column:
        col = lambda part: F.col(f"{self.out}__{part}")
        if self.kind == "count":
            return F.sum(col("n")).alias(self.out)
        if self.kind == "mean":
            return (F.sum(col("s")) / F.nullif(F.sum(col("n")), F.lit(0))).alias(self.out)
        if self.kind == "last":
            return F.max_by(col("v"), col("o")).alias(self.out)
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](col("v")).alias(self.out)


def run_partials(
    stream: DataFrame, delivery: str, partial: Callable[[DataFrame, list[str]], DataFrame], out: str, checkpoint: str
) -> None:
    """Reduce each batch to partial states by ``delivery`` and what ``partial`` groups by.

    ``partial(rows, [delivery])`` returns states that hold the delivery column. A delivery that
    comes again, in a later batch, replaces what it brought before (see ``read_partials``), so a
    corrected file is taken back and counted anew without touching the others. All rows of a
    delivery must come in one batch. A batch that Spark repeats replaces itself.
    """

    def batch(df: DataFrame, number: int) -> None:
        partial(df, [delivery]).write.mode("overwrite").parquet(batch_folder(out, number))

    run_batches(stream, batch, checkpoint)


def read_partials(spark: SparkSession, out: str, delivery: str) -> DataFrame:
    """The states of every delivery's last batch; those of a replaced delivery are left out."""
    states = spark.read.parquet(out)
    last = states.groupBy(F.col(delivery).alias("__d")).agg(F.max("batch_id").alias("__b"))  # a row per delivery
    stands = F.col(delivery).eqNullSafe(F.col("__d")) & (F.col("batch_id") == F.col("__b"))
    return states.join(last, stands, "left_semi").drop("batch_id")


def partial_aggregates(keys: Keys, aggregates: Sequence[Aggregate]) -> Callable[[DataFrame, list[str]], DataFrame]:
    """``partial`` for ``run_partials``: one row per delivery and key."""

    def partial(rows: DataFrame, more: list[str]) -> DataFrame:
        return rows.groupBy(*more, *as_list(keys)).agg(*[c for a in aggregates for c in a.partial()])

    return partial


def merge_aggregates(states: DataFrame, keys: Keys, aggregates: Sequence[Aggregate]) -> DataFrame:
    """The aggregates of all deliveries together."""
    return states.groupBy(*as_list(keys)).agg(*[a.merged() for a in aggregates])
