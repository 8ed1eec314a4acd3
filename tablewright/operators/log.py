"""Verbs on keyed append-only logs: rows of ``key``, payload columns and a ``seq``.

Duplicate keys are legal in a log, so nothing relies on physical order; ``seq``
decides. All verbs reduce on the map side before they shuffle, which keeps one
key that owns a large part of the log cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = str | Sequence[str]


def as_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _pick(df: DataFrame, keys: Keys, order: list[Column]) -> DataFrame:
    # Catalyst turns "row_number() = 1" into a WindowGroupLimit below the
    # exchange: every task sends at most one row per key.
    rank = Window.partitionBy(*as_list(keys)).orderBy(*order)
    return (
        df.withColumn("__rank", F.row_number().over(rank))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )


def dedup(df: DataFrame, keys: Keys = "key", order: str = "seq") -> DataFrame:
    """One row per key, the first by ``order``."""
    return _pick(df, keys, [F.col(order).asc()])


def compact(df: DataFrame, keys: Keys = "key", order: str = "seq") -> DataFrame:
    """One row per key, the last by ``order``."""
    return _pick(df, keys, [F.col(order).desc()])


def merge_records(
    df: DataFrame,
    keys: Keys = "key",
    order: str = "seq",
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Fold partial rows of a key into one record: the latest non-null of each field."""
    keys = as_list(keys)
    fields = list(fields) if fields else [c for c in df.columns if c not in (*keys, order)]
    folded = [
        F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in fields
    ]
    return df.groupBy(*keys).agg(*folded, F.max(order).alias(order))


def latest(df: DataFrame, by: str, tie: str) -> DataFrame:
    """The single row with the greatest ``by``; the first by ``tie`` among equals."""
    return df.where(F.col(by).isNotNull()).orderBy(F.col(by).desc(), F.col(tie).asc()).limit(1)


def requeue_latest(log: DataFrame, by: str, order: str = "seq") -> DataFrame:
    """Append the latest row again, under its own key, so that it is processed anew."""
    next_seq = log.agg((F.max(order) + 1).alias(order)).scalar()
    return log.unionByName(latest(log, by, order).withColumn(order, next_seq))


def unprocessed(source: DataFrame, target: DataFrame, keys: Keys = "key") -> DataFrame:
    """Source rows whose key the target does not hold yet."""
    keys = as_list(keys)
    return source.join(target.select(*keys).distinct(), keys, "left_anti")


def mark_seen(processed: DataFrame, source: DataFrame, keys: Keys = "key") -> DataFrame:
    """The processed-key set with every current source key added, nothing processed."""
    keys = as_list(keys)
    return processed.select(*keys).unionByName(source.select(*keys)).distinct()


def retain(df: DataFrame, ts: str, asof: Column, age: Column | None = None) -> DataFrame:
    """Rows not older than ``age`` at ``asof``; without an age nothing stays."""
    if age is None:
        return df.where(F.lit(False))
    return df.where(F.col(ts) >= asof - age)


def split_required(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields, and the rejects with the names of what they miss."""
    missing = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]),
        lambda name: name.isNotNull(),
    )
    tagged = df.withColumn("missing", missing)
    return (
        tagged.where(F.size("missing") == 0).drop("missing"),
        tagged.where(F.size("missing") > 0),
    )


def filled(df: DataFrame, by: Keys | None = None) -> DataFrame:
    """Row count and the filled flag of a pipe, or of each ``by`` group."""
    grouped = df.groupBy(*as_list(by)) if by else df.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("rows")).withColumn("is_filled", F.col("rows") > 0)


def distinct_values(df: DataFrame, value: Column, name: str) -> DataFrame:
    """The set of a normalised value."""
    return df.select(value.alias(name)).where(F.col(name).isNotNull()).distinct()
