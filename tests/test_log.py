from datetime import datetime

from pyspark.sql import functions as F

from tablewright.operators import log as L
from tablewright.operators import project as P
from tablewright.sources import tables as S
from tablewright.session import scratch_path

ROWS = [("a", 1, "x", None), ("b", 2, None, "q"), ("a", 3, None, "r"), ("a", 4, "y", None), ("c", 5, None, None)]
SCHEMA = "key string, seq bigint, f string, g string"


def log(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_first_last_merge(spark):
    assert rows(L.dedup(log(spark))) == [("a", 1, "x", None), ("b", 2, None, "q"), ("c", 5, None, None)]
    assert rows(L.compact(log(spark))) == [("a", 4, "y", None), ("b", 2, None, "q"), ("c", 5, None, None)]
    merged = L.merge_records(log(spark)).select("key", "seq", "f", "g")
    assert rows(merged) == [("a", 4, "y", "r"), ("b", 2, None, "q"), ("c", 5, None, None)]


def test_verbs_are_idempotent(spark):
    for verb in (L.dedup, L.compact, L.merge_records):
        once = verb(log(spark)).select("key", "seq", "f", "g")
        assert rows(verb(once).select("key", "seq", "f", "g")) == rows(once)


def test_first_per_key_is_limited_before_the_shuffle(spark):
    plan = L.dedup(log(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") and "Partial" in plan


def test_requeue_and_empty(spark):
    assert rows(L.requeue_latest(log(spark).where("f IS NOT NULL"), "f")) == [
        ("a", 1, "x", None), ("a", 4, "y", None), ("a", 5, "y", None)]
    assert rows(L.requeue_latest(log(spark).where("false"), "f")) == []


def test_retention(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 8))], "id int, ts timestamp")
    asof = F.lit(datetime(2024, 1, 9))
    assert rows(L.retain(df, "ts", asof, F.expr("INTERVAL 7 DAYS")).select("id")) == [(2,)]
    assert L.retain(df, "ts", asof).count() == 0


def test_append_continues_numbers(spark):
    path = scratch_path(spark, "log")
    first = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "key string, n int")
    S.append_log(first, path, "n")
    S.append_log(spark.createDataFrame([("a", 4)], "key string, n int"), path)
    table = S.read_log(spark, path)
    assert [r.n for r in table.orderBy("seq").collect()] == [1, 2, 3, 4]
    assert table.select("seq").distinct().count() == 4
    assert rows(L.compact(table).select("key", "n")) == [("a", 4), ("b", 2), ("c", 3)]


def test_clean_log(spark):
    path = scratch_path(spark, "log")
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 8))], "id int, ts timestamp")
    S.overwrite_table(df, path)
    S.clean_log(spark, path, "ts", F.lit(datetime(2024, 1, 9)), F.expr("INTERVAL 7 DAYS"))
    assert rows(spark.read.parquet(path).select("id")) == [(2,)]


def test_first_complete_never_mixes(spark):
    df = spark.createDataFrame([(None, "b1", "c2"), ("a1", None, None)], "a string, b string, c string")
    pick = P.first_complete(
        {"x": (F.col("a"), True), "y": (F.col("b"), True)},
        {"x": (F.lit("z"), True), "y": (F.col("c"), False)},
    )
    assert [tuple(r.p) for r in df.select(pick.alias("p")).collect()] == [("z", "c2"), ("z", None)]


def test_overrides(spark):
    df = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "k int, v string")
    table = spark.createDataFrame([(1, "uno"), (2, None)], "k int, v string")
    assert rows(P.apply_overrides(df, table, "k", "v")) == [(1, "uno"), (2, None), (3, "three")]
    assert rows(P.apply_overrides(df, {3: "tres"}, "k", "v", default=F.lit("-"))) == [(1, "-"), (2, "-"), (3, "tres")]


def test_prefer_and_drop_first(spark):
    links = [["/x/PDF/", "/x/MSO2003_DOC/"], ["/x/PDF/", "/x/ODT/"], [], ["/a/MSO2003_DOC/", "/b/MSO2010_DOCX/"]]
    df = spark.createDataFrame([(v,) for v in links], "v array<string>")
    chosen = P.prefer(F.col("v"), ["MSO2010_DOCX", "MSO2003_DOC"], lambda c: P.path_segment_from_end(c, 2))
    assert [r[0] for r in df.select(chosen).collect()] == ["/x/MSO2003_DOC/", "/x/PDF/", None, "/b/MSO2010_DOCX/"]
    assert [len(r[0]) for r in df.select(P.drop_first(F.col("v"), 1)).collect()] == [1, 1, 0, 1]


def test_required_and_seen(spark):
    whole, rejects = L.split_required(log(spark), ["f", "g"])
    assert whole.count() == 0
    assert rejects.where("key = 'c'").first().missing == ["f", "g"]
    seen = L.mark_seen(spark.createDataFrame([("a",)], "key string"), log(spark))
    assert rows(seen) == [("a",), ("b",), ("c",)]
    assert L.unprocessed(log(spark), seen).count() == 0
