"""Running values along an ordered sequence, for groups of any size.

A window partitioned by the group alone would send one group to one task, and one group may hold
a third of all rows. Here the rows are placed once: range-partitioned by (group, order), so that
each part holds about as many rows as any other, however the rows are numbered, and written as a
table bucketed by part. All passes read that table in place, without a further shuffle: running
values are taken inside a part, and only the last group of a part can go on in the next one. What
it hands over is one row per part; these rows are scanned and joined back, small enough to be sent
to every task. The input itself is read for the placing only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

PART = "__part"


@dataclass(frozen=True)
class Running:
    """``kind`` is sum, max or last (the last non-null value so far)."""

    out: str
    kind: str
    value: Column
    before: bool = False  # only rows strictly before the current one

    def over(self, column: str, window) -> Column:
        c = F.col(column)
        if self.kind == "sum":
            return F.sum(c).over(window)
        if self.kind == "max":
            return F.max(c).over(window)
        return F.last(c, ignorenulls=True).over(window)

    def summary(self, column: str, order: str) -> Column:
        c = F.col(column)
        if self.kind == "sum":
            return F.sum(c)
        if self.kind == "max":
            return F.max(c)
        return F.max_by(c, F.when(c.isNotNull(), F.col(order)))

    def merge(self, carried: str, local: str) -> Column:
        before, here = F.col(carried), F.col(local)
        if self.kind == "sum":
            return F.coalesce(before, F.lit(0)) + F.coalesce(here, F.lit(0))
        if self.kind == "max":
            return F.greatest(before, here)  # skips NULL
        return F.coalesce(here, before)


def place(df: DataFrame, keys: Sequence[str], order: str, parts: int | None = None) -> DataFrame:
    """The rows in parts of about equal size along (keys, order), with the part as ``__part``.

    Rows of equal keys and order lie in one part. The table is an entry ``scan_…`` of the catalog
    that points to a scratch folder, as only tables can be bucketed.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"scan_{uuid.uuid4().hex}"
    cut = df.repartitionByRange(parts, *keys, order).withColumn(PART, F.spark_partition_id())
    writer = cut.write.bucketBy(parts, PART).sortBy(*keys, order)
    writer.option("path", scratch_path(spark, "placed")).saveAsTable(name)
    return spark.table(name)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *specs: Running,
    parts: int | None = None,
    keep_part: bool = False,
) -> DataFrame:
    """Add one running column per spec. ``order`` is a whole number; NULL keys are a group too.

    Rows that are placed already (``place`` with the same keys and order) stay where they are.
    With ``keep_part`` the result is still placed, for a further pass.
    """
    keys = list(keys)
    placed = df if PART in df.columns else place(df, keys, order, parts)
    columns = [c for c in placed.columns if c != PART]
    rows = placed.select(*columns, PART, *[spec.value.alias(f"__v{i}") for i, spec in enumerate(specs)])

    # One row per part: the group it ends with, and what that group hands over.
    sums = rows.groupBy(*keys, PART).agg(
        *[spec.summary(f"__v{i}", order).alias(f"__s{i}") for i, spec in enumerate(specs)]
    )
    handed = [f"__s{i}" for i in range(len(specs))]
    last = F.max_by(F.struct(*keys, *handed), F.struct(*keys))
    borders = sums.groupBy(PART).agg(last.alias("g")).withColumn("__next", F.lead(PART).over(Window.orderBy(PART)))
    so_far = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, 0)
    carried = borders.select("g.*", PART, "__next").select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        "__next",
        *[spec.over(f"__s{i}", so_far).alias(f"__c{i}") for i, spec in enumerate(specs)],
    )

    inside = Window.partitionBy(*keys, PART).orderBy(order)
    local = [
        spec.over(f"__v{i}", inside.rowsBetween(Window.unboundedPreceding, -1 if spec.before else 0)).alias(f"__l{i}")
        for i, spec in enumerate(specs)
    ]
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    joined = rows.select(*columns, PART, *local).join(
        F.broadcast(carried), reduce(and_, same, F.col(PART) == F.col("__next")), "left"
    )
    return joined.select(
        *columns,
        *([PART] if keep_part else []),
        *[spec.merge(f"__c{i}", f"__l{i}").alias(spec.out) for i, spec in enumerate(specs)],
    )
