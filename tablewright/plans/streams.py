"""Queries that run a table through Structured Streaming, file by file."""

from pyspark.sql import functions as F

from ..operators import log as L
from ..operators import sequence as Q
from ..session import scratch_path
from ..streaming import jobs as S
from ..streaming import state as K
from .base import Tables, query
from .sequences import INTERVALS_SQL


def events(t: Tables):
    """The events files as a stream, and fresh places for output and checkpoint."""
    # As a pattern, the path may name one file or a folder of files.
    stream = S.read_stream(t.spark, f"{t.folder}/events.parque[t]", t.events.schema, files_per_batch=64)
    return stream, scratch_path(t.spark, "out"), scratch_path(t.spark, "checkpoint")


@query(
    "T2 T1 A2",
    """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
    """,
)
def stream_latest(t: Tables):
    stream, out, checkpoint = events(t)
    S.stream_latest(stream.select("user_id", "event_id", "event_type", "value"), "user_id", "event_id", out, checkpoint)
    return S.read_latest(t.spark, out, "user_id", "event_id")


@query(
    "T3 A1",
    """
    SELECT user_id, event_type, event_id, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1
    """,
)
def stream_dedup(t: Tables):
    stream, out, checkpoint = events(t)
    keys = ["user_id", "event_type"]
    S.stream_dedup(stream.select(*keys, "event_id", "props"), keys, "event_id", out, checkpoint)
    return S.read_dedup(t.spark, out)


@query(
    "T4 U3",
    """
    SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
    """,
)
def stream_incremental(t: Tables):
    stream, out, checkpoint = events(t)
    S.run_incremental(
        stream,
        lambda df: df.select("event_id", "user_id", F.from_json("props", "k int")["k"].alias("k")),
        out,
        checkpoint,
    )
    S.run_incremental(stream, lambda df: df, out, checkpoint)  # nothing new: nothing is added
    return t.spark.read.parquet(out).drop("batch_id")


@query(
    "T5 T4",
    "SELECT event_id, user_id, event_type FROM events WHERE event_id % 2 = 1",
)
def stream_skipped(t: Tables):
    # Even events are there and marked as seen; the odd ones come later.
    source, out, checkpoint = (scratch_path(t.spark, name) for name in ("source", "out", "checkpoint"))
    rows = t.events.select("event_id", "user_id", "event_type")
    rows.where("event_id % 2 = 0").write.parquet(source)
    S.skip_to_end(S.read_stream(t.spark, source, rows.schema), checkpoint)
    rows.where("event_id % 2 = 1").write.mode("append").parquet(source)
    S.run_incremental(S.read_stream(t.spark, source, rows.schema), lambda df: df, out, checkpoint)
    return t.spark.read.parquet(out).drop("batch_id")


@query("T1", "SELECT event_id, user_id, event_type, value, props, ts FROM events")
def stream_captures(t: Tables):
    stream, out, checkpoint = events(t)
    S.stream_captures(stream, out, checkpoint)
    return t.spark.read.parquet(out)


@query(
    "T2 T6",
    """
    SELECT user_id, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND ts >= TIMESTAMP '2024-01-25 00:00:00'
    """,
)
def stream_latest_kept(t: Tables):
    stream, out, checkpoint = events(t)
    S.stream_latest(stream.select("user_id", "event_id", "ts"), "user_id", "event_id", out, checkpoint)
    folded = scratch_path(t.spark, "folded")
    S.fold_latest(t.spark, out, folded, "user_id", "event_id")
    last = S.read_latest(t.spark, folded, "user_id", "event_id")
    asof = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return L.retain(last, "ts", asof, F.expr("INTERVAL 6 DAYS")).select("user_id", "event_id")


def deliver(t: Tables, run, *parts):
    """Bring the given rows to a folder, one delivery after the other; ``run`` takes up its stream after each.

    A delivery is as many files as tasks write, and one batch: what came since the checkpoint.
    """
    source = scratch_path(t.spark, "source")
    for part in parts:
        part.write.mode("append").parquet(source)
        run(S.read_stream(t.spark, source, part.schema))


@query(
    "T2 A2",
    """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def stream_latest_state(t: Tables):
    # The odd events come first, then the even ones; half of the batches are folded in between.
    rows = t.events.select("user_id", "event_id", "event_type", "value", F.col("ts").cast("string").alias("ts"))
    out, checkpoint = (scratch_path(t.spark, name) for name in ("out", "checkpoint"))
    run = lambda stream: K.run_latest(stream, "user_id", "ts", out, checkpoint, tie="event_id")
    deliver(t, run, rows.where("event_id % 2 = 1"), rows.where("event_id % 2 = 0"))
    K.fold_updates(t.spark, out, "user_id")
    return K.read_current(t.spark, out, "user_id").drop("ts")


def totals():
    return [
        K.Aggregate("n", "count"),
        K.Aggregate("mean", "mean", F.col("value").cast("decimal(18,6)")),
        K.Aggregate("least", "min", F.col("value")),
        K.Aggregate("last_type", "last", F.col("event_type"), F.col("event_id")),
    ]


@query(
    "T4 A3 A10",
    """
    SELECT user_id, count(*) AS n, round(sum(value::DECIMAL(18, 6))::DOUBLE / count(value), 6) AS mean, min(value) AS least,
           arg_max(event_type, event_id) AS last_type
    FROM events GROUP BY user_id
    """,
)
def stream_totals(t: Tables):
    # Three deliveries; the second comes once more, corrected, and replaces what it brought before.
    rows = t.events.select("event_id", "user_id", "event_type", "value", (F.col("event_id") % 3).alias("delivery"))
    wrong = rows.where("delivery = 1").withColumn("value", -F.col("value"))
    out, checkpoint = (scratch_path(t.spark, name) for name in ("out", "checkpoint"))
    run = lambda stream: K.run_partials(stream, "delivery", K.partial_aggregates("user_id", totals()), out, checkpoint)
    deliver(t, run, rows.where("delivery = 0"), wrong, rows.where("delivery = 2"), rows.where("delivery = 1"))
    states = K.read_partials(t.spark, out, "delivery")
    merged = K.merge_aggregates(states, "user_id", totals())
    return merged.withColumn("mean", F.round(F.col("mean").cast("double"), 6))


@query(
    "T4 A8",
    f"WITH {INTERVALS_SQL} SELECT l_suppkey, lo::BIGINT AS lo, hi::BIGINT AS hi FROM merged",
)
def stream_intervals(t: Tables):
    # Each delivery is kept as its merged intervals, which merge again when they are read.
    day = F.unix_date(F.col("l_shipdate").cast("date"))
    rows = t.lineitem.select("l_suppkey", day.alias("lo"), (day + 3).alias("hi"), (F.col("l_orderkey") % 3).alias("delivery"))
    parts = [rows.where(f"delivery = {n}") for n in range(3)]
    out, checkpoint = (scratch_path(t.spark, name) for name in ("out", "checkpoint"))
    merged = lambda df, more: Q.merge_intervals(df, [*more, "l_suppkey"], "lo", "hi")
    deliver(t, lambda stream: K.run_partials(stream, "delivery", merged, out, checkpoint), *parts, parts[1])
    return Q.merge_intervals(K.read_partials(t.spark, out, "delivery"), ["l_suppkey"], "lo", "hi")


@query("T3 A1", "SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'")
def stream_dedup_within(t: Tables):
    # What comes more than a day behind the latest event is too late.
    late = F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp")
    rows = t.events.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    out, checkpoint = (scratch_path(t.spark, name) for name in ("out", "checkpoint"))

    def run(stream):
        S.stream_captures(S.dedup_within(stream, ["user_id", "event_type"], "ts", "1 day").select("user_id", "event_type"), out, checkpoint)

    deliver(t, run, rows.where(~late), rows.where(late))
    return t.spark.read.parquet(out)
