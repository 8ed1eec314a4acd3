from pyspark.sql import functions as F

from tablewright.operators import log as L
from tablewright.operators.graph import Closure, reachable
from tablewright.streaming import jobs as S
from tablewright.streaming import state as K

SCHEMA = "key string, seq bigint, v string"


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def rows(df):
    return sorted(map(tuple, df.select("key", "seq", "v").collect()))


FIRST = [[("a", 1, "x"), ("b", 2, "x"), ("a", 3, "y")], [("b", 4, "z"), ("c", 5, "x")], [("a", 6, "w")]]
LATER = [[("c", 7, "q"), ("d", 9, "x"), ("d", 8, "first")]]


def source(spark, tmp_path):
    return S.read_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1)


def test_latest_and_first_equal_the_batch_verbs(spark, tmp_path):
    for part in FIRST:
        write(spark, tmp_path / "in", part)
    latest, first = str(tmp_path / "latest"), str(tmp_path / "first")
    for round_ in (FIRST, LATER):
        if round_ is LATER:
            for part in LATER:
                write(spark, tmp_path / "in", part)
        S.stream_latest(source(spark, tmp_path), "key", "seq", latest, str(tmp_path / "c1"))
        S.stream_dedup(source(spark, tmp_path), "key", "seq", first, str(tmp_path / "c2"))
        table = spark.read.parquet(str(tmp_path / "in"))
        assert rows(S.read_latest(spark, latest, "key", "seq")) == rows(L.compact(table))
        kept = spark.read.parquet(first)
        assert kept.select("key").distinct().count() == kept.count()
        # Every key keeps the row of the batch that brought it first.
        assert {r[0] for r in rows(kept)} == {r[0] for r in rows(table)}
    assert ("d", 8, "first") in rows(spark.read.parquet(first))
    assert spark.read.parquet(latest).select("batch_id").distinct().count() == 4
    S.fold_latest(spark, latest, str(tmp_path / "folded"), "key", "seq")
    assert rows(S.read_latest(spark, str(tmp_path / "folded"), "key", "seq")) == rows(L.compact(table))


def test_a_repeated_batch_is_not_doubled(spark, tmp_path):
    write(spark, tmp_path / "in", FIRST[0])
    out = str(tmp_path / "out")
    S.stream_dedup(source(spark, tmp_path), "key", "seq", out, str(tmp_path / "c1"))
    # The checkpoint is lost, so batch 0 runs again over what it wrote.
    S.stream_dedup(source(spark, tmp_path), "key", "seq", out, str(tmp_path / "c2"))
    assert rows(spark.read.parquet(out)) == [("a", 1, "x"), ("b", 2, "x")]


def test_incremental_skip_and_reset(spark, tmp_path):
    double = lambda df: df.withColumn("v", F.concat("v", "v"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    write(spark, tmp_path / "in", FIRST[0])
    S.skip_to_end(source(spark, tmp_path), checkpoint)
    write(spark, tmp_path / "in", FIRST[1])
    S.run_incremental(source(spark, tmp_path), double, out, checkpoint)
    S.run_incremental(source(spark, tmp_path), double, out, checkpoint)
    assert rows(spark.read.parquet(out)) == [("b", 4, "zz"), ("c", 5, "xx")]
    again = str(tmp_path / "again")
    S.run_incremental(source(spark, tmp_path), double, again, str(tmp_path / "c2"))
    assert spark.read.parquet(again).count() == 5


def test_captures_append_once(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    for part in FIRST:
        write(spark, tmp_path / "in", part)
        S.stream_captures(source(spark, tmp_path), out, checkpoint)
    assert rows(spark.read.parquet(out)) == rows(spark.read.parquet(str(tmp_path / "in")))


def test_unseen_keys_read_no_history(spark, tmp_path, monkeypatch):
    read = []
    known = S.known_keys
    monkeypatch.setattr(S, "known_keys", lambda spark, out, folders, names: (read.append(folders), known(spark, out, folders, names))[1])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    run = lambda: S.stream_dedup(source(spark, tmp_path), "key", "seq", out, checkpoint, buckets=4)
    write(spark, tmp_path / "in", [(f"old{i}", i, "x") for i in range(200)])
    run()
    write(spark, tmp_path / "in", [(f"new{i}", i, "x") for i in range(20)])
    run()
    assert read == []  # the filters of the first batch say that none of these keys is there
    write(spark, tmp_path / "in", [("old7", 900, "late"), (None, 901, "first"), ("newest", 902, "x")])
    run()
    assert [len(f) for f in read] == [1] and read[0][0].split("/")[-2] == "batch_id=0"
    write(spark, tmp_path / "in", [(None, 903, "second")])
    run()
    assert len(read) == 2 and read[1][0].split("/")[-2] == "batch_id=2"
    have = {r[0]: r[2] for r in map(tuple, S.read_dedup(spark, out).select("key", "seq", "v").collect())}
    assert have == {f"old{i}": "x" for i in range(200)} | {f"new{i}": "x" for i in range(20)} | {None: "first", "newest": "x"}


def test_latest_state_over_restarts_late_and_equal_rows(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    run = lambda: K.run_latest(source(spark, tmp_path), "key", "seq", out, checkpoint)
    now = lambda: {r.key: (r.seq, r.v) for r in K.read_current(spark, out, "key").collect()}
    write(spark, tmp_path / "in", [("a", 5, "x"), ("a", 9, "y"), ("b", 1, None), (None, 2, "n")])
    run()
    assert now() == {"a": (9, "y"), "b": (1, None), None: (2, "n")}
    # after a restart: a late row, an equal one, one without an order, one newer
    write(spark, tmp_path / "in", [("a", 8, "late"), ("b", 1, "equal"), ("c", None, "no order"), (None, 3, "m")])
    run()
    assert now() == {"a": (9, "y"), "b": (1, None), None: (3, "m")}
    changes = spark.read.parquet(out).where("batch_id = 1")
    assert [(r.key, r.seq) for r in changes.collect()] == [(None, 3)]  # only what changed is handed on
    assert K.fold_updates(spark, out, "key") == 1
    write(spark, tmp_path / "in", [("a", 10, "z")])
    run()
    assert now() == {"a": (10, "z"), "b": (1, None), None: (3, "m")}
    assert K.fold_updates(spark, out, "key") == 2 and now()["a"] == (10, "z")


def test_a_key_costs_one_read_of_state_and_no_frame_of_objects(monkeypatch):
    import pandas as pd
    from pyspark.sql import types as T

    class Kept:
        value, calls = None, []

        def get(self):
            self.calls.append("get")
            return self.value

        def exists(self):
            self.calls.append("exists")
            return self.value is not None

        def update(self, row):
            self.value = row

    latest = K._Latest(["key"], ["seq"], T.StructType().add("seq", "long").add("v", "string").add("x", "double"), None, 0)
    latest.kept = Kept()
    monkeypatch.setattr(pd.DataFrame, "astype", lambda *a, **k: 1 / 0)
    frame = pd.DataFrame({"key": ["a"] * 3, "seq": [1, 3, 2], "v": ["p", None, "q"], "x": [0.5, float("nan"), 1.0]})
    out = list(latest.handleInputRows(("a",), iter([frame]), None))
    assert latest.kept.value == (3, None, None) and len(out) == 1 and latest.kept.calls == ["get"]


def test_ties_are_broken_by_a_column(spark, tmp_path):
    write(spark, tmp_path / "in", [("a", 5, "x"), ("a", 5, "z"), ("a", 5, "y")])
    out = str(tmp_path / "out")
    K.run_latest(source(spark, tmp_path), "key", "seq", out, str(tmp_path / "c"), tie="v")
    assert rows(K.read_current(spark, out, "key")) == [("a", 5, "z")]


def test_a_key_is_forgotten_when_the_watermark_is_past_it(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")

    def run():
        stream = source(spark, tmp_path).withColumn("ts", F.timestamp_seconds(F.col("v").cast("long"))).withWatermark("ts", "10 seconds")
        K.run_latest(stream, "key", "seq", out, checkpoint, ts="ts", forget_seconds=60)

    write(spark, tmp_path / "in", [("a", 9, "1000"), ("b", 9, "1000")])
    run()
    write(spark, tmp_path / "in", [("b", 10, "1065"), ("c", 1, "2000")])  # the watermark goes to 1990
    run()
    write(spark, tmp_path / "in", [("a", 2, "1995"), ("c", 0, "1996")])  # lower orders: a is new again, c is late
    run()
    assert rows(K.read_current(spark, out, "key")) == [("a", 2, "1995"), ("b", 10, "1065"), ("c", 1, "2000")]


def test_a_delivery_that_comes_again_replaces_itself(spark, tmp_path):
    v = F.col("seq")
    kinds = [
        K.Aggregate("n", "count"), K.Aggregate("s", "sum", v), K.Aggregate("m", "mean", v), K.Aggregate("lo", "min", v), K.Aggregate("hi", "max", v),
        K.Aggregate("last", "last", F.col("v"), v),
    ]
    # ``v`` names the delivery in front of its value
    part = lambda name, rows_: [(k, s, f"{name}{x or ''}" if x is not None else None) for k, s, x in rows_]
    write(spark, tmp_path / "in", part("1", [("a", 1, "p"), ("a", 2, "q"), ("b", 7, "r")]))
    write(spark, tmp_path / "in", part("2", [("a", 3, "s")]))
    write(spark, tmp_path / "in", part("1", [("a", 4, "t"), ("c", 5, "u")]))
    stream = source(spark, tmp_path).withColumn("delivery", F.substring("v", 1, 1))
    out = str(tmp_path / "out")
    K.run_partials(stream, "delivery", K.partial_aggregates("key", kinds), out, str(tmp_path / "c"))
    states = K.read_partials(spark, out, "delivery")
    got = {r.key: tuple(r)[1:] for r in K.merge_aggregates(states, "key", kinds).collect()}
    assert got == {"a": (2, 7, 3.5, 3, 4, "1t"), "c": (1, 5, 5.0, 5, 5, "1u")}


def test_dedup_within_is_a_streaming_plan(spark, tmp_path):
    write(spark, tmp_path / "in", FIRST[0])
    stream = source(spark, tmp_path).withColumn("ts", F.timestamp_seconds("seq"))
    assert S.dedup_within(stream, "key", "ts", "1 hour").isStreaming


def test_reachable(spark):
    links = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("b", "d"), ("a", "d")]
    df = spark.createDataFrame(links, "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("lone",)], "node string")
    assert {r.node: r.depth for r in reachable(df, seeds).collect()} == {"a": 0, "lone": 0, "b": 1, "d": 1, "c": 2}


def distances(links, seeds):
    depth, front = {s: 0 for s in seeds}, list(seeds)
    while front:
        nxt = []
        for node in front:
            for a, b in links:
                if a == node and b not in depth:
                    depth[b] = depth[node] + 1
                    nxt.append(b)
        front = nxt
    return depth


def test_closure_in_deliveries_equals_one(spark):
    import random

    rng = random.Random(11)
    links = [(f"n{rng.randint(0, 40)}", f"n{rng.randint(0, 40)}") for _ in range(70)]
    links += [("s", "n1"), *[(f"long{i}", f"long{i + 1}") for i in range(5)], ("s", "long0"), ("long5", "n7")]
    schema, late = "src string, dst string", [("s", "long4"), ("t", "only t"), ("n1", None), (None, "n1"), ("s", "n1")]
    closure = Closure(spark)
    seeds = lambda *names: spark.createDataFrame([(n,) for n in names], "node string")
    closure.extend(spark.createDataFrame(links[:40], schema), seeds("s", None))
    closure.extend(spark.createDataFrame(links[40:], schema))
    closure.extend(spark.createDataFrame(late, schema), seeds("t"))  # a shorter way, and a new seed
    have = {r.node: r.depth for r in closure.nodes().collect()}
    known = [(a, b) for a, b in links + late if a is not None and b is not None]
    assert have == distances(known, ["s", "t"])
    again = Closure(spark, closure.name)  # found again by its name; nothing new, nothing changes
    again.extend(spark.createDataFrame(links, schema))
    assert {r.node: r.depth for r in again.nodes().collect()} == have


def test_rounds_shuffle_what_is_new_only(spark):
    closure = Closure(spark).extend(spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string"), spark.createDataFrame([("a",)], "node string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frontier = spark.createDataFrame([("b", 1)], "node string, depth int")
        for step in (closure.beyond(frontier), closure.nearer(frontier)):
            text = step._jdf.queryExecution().executedPlan().toString()
            # one exchange, and it is that of the frontier: the bucketed side has none
            assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
