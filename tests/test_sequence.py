import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import sequence as Q
from tablewright.operators.scan import Running, running


def hot_rows(n=300):
    """Two thirds of the rows under one key, some values missing."""
    rng = random.Random(5)
    return [
        ("hot" if i % 3 else f"k{i % 7}", i * rng.choice([1, 1, 1]) + 1000, rng.choice([None, rng.randint(-9, 9)]))
        for i in range(n)
    ]


@pytest.mark.parametrize("parts", [1, 3, 40])
@pytest.mark.parametrize("before", [False, True])
def test_running_matches_plain_loop(spark, parts, before):
    data = hot_rows()
    df = spark.createDataFrame(data, "k string, pos bigint, v bigint")
    v = F.col("v")
    out = running(
        df, ["k"], "pos",
        Running("s", "sum", F.coalesce(v, F.lit(0)), before),
        Running("m", "max", v, before),
        Running("l", "last", v, before),
        parts=parts,
    ).collect()
    expected = {}
    state = {}
    for k, pos, value in sorted(data, key=lambda r: r[1]):
        s, m, last = state.get(k, (0, None, None))
        after = (
            s + (value or 0),
            value if m is None else m if value is None else max(m, value),
            last if value is None else value,
        )
        expected[pos] = (s, m, last) if before else after
        state[k] = after
    assert {r.pos: (r.s, r.m, r.l) for r in out} == expected


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_kv_runs(spark, parts):
    pairs = [
        ("d", 0, "note", "early"), ("d", 1, "who", "A"), ("d", 2, "x", "1"), ("d", 3, "x", "2"), ("d", 4, "who", "B"),
        ("d", 5, None, None), ("d", 6, "deal", None), ("d", 7, "who", None), ("e", 0, "deal", None),
    ]
    df = spark.createDataFrame(pairs, "key string, pos int, k string, v string")
    out = Q.fold_kv_runs(df, "key", "who", skip=[("deal", None)], parts=parts)
    assert sorted((r.key, r.run, r.record) for r in out.collect()) == [
        ("d", 0, {"note": "early"}),
        ("d", 1, {"who": "A", "x": "2"}),
        ("d", 2, {"who": "B"}),
        ("d", 3, {"who": None}),
    ]


def test_segments_and_single_marker(spark):
    docs = spark.createDataFrame([(1, "a\n# one\nb\n# two\nc"), (2, "# only\nx"), (3, "none")], "id int, text string")
    out = Q.segment_text(docs, r"^# \w+$", ["id"]).orderBy("id", "pos").collect()
    assert [(r.id, r.pos, r.marker, r.tail) for r in out] == [
        (1, 0, "# one", "\nb\n"), (1, 1, "# two", "\nc"), (2, 0, "# only", "\nx")]


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_turns_take_the_last_clock(spark, parts):
    rows = [
        (1, 0, None, "lost", None), (1, 1, None, "", "9:00"), (1, 2, "A", "hi", None), (1, 3, None, "more", "9:30"),
        (1, 4, "B", "yo", None), (2, 0, "C", "early", None), (2, 1, "D", "x", None), (2, 2, None, "", "8:00"),
    ]
    df = spark.createDataFrame(rows, "doc int, pos int, who string, text string, time string")
    out = Q.assemble_turns(
        df, "doc", F.col("who").isNotNull(), F.col("text"), ["who"], time=F.col("time"), sep="|", parts=parts
    )
    assert sorted((r.doc, r.rowno, r.time, r.text, r.who) for r in out.collect()) == [
        (1, 1, "9:30", "hi|more", "A"),
        (1, 2, "9:30", "yo", "B"),
        (2, 1, "8:00", "early", "C"),
        (2, 2, "8:00", "x|", "D"),
    ]


@pytest.mark.parametrize("parts", [1, 10, 64])
def test_intervals_are_disjoint_and_cover(spark, parts):
    rng = random.Random(3)
    data = [("hot" if i % 3 else "k", lo, lo + rng.randint(0, 6)) for i in range(200) for lo in [rng.randint(0, 600)]]
    df = spark.createDataFrame(data, "g string, lo int, hi int")
    merged = Q.merge_intervals(df, "g", "lo", "hi", parts=parts)
    expected = []
    for g in ("hot", "k"):
        spans = sorted((lo, hi) for k, lo, hi in data if k == g)
        low, high = spans[0]
        for a, b in spans[1:]:
            if a <= high:
                high = max(high, b)
            else:
                expected.append((g, low, high))
                low, high = a, b
        expected.append((g, low, high))
    assert sorted((r.g, r.lo, r.hi) for r in merged.collect()) == sorted(expected)
    totals = {r.g: r.duration for r in Q.interval_totals(merged, "g").collect()}
    assert totals == {g: sum(h - lo for k, lo, h in expected if k == g) for g in ("hot", "k")}


def test_series_and_forecast(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 4, None), ("b", 2, 5)], "n string, v int, r int")
    out = {r.n: (r.mean, r.max, r.top, r.best_rank) for r in Q.series_stats(df, "n", "v", "r").collect()}
    assert out == {"a": (2.5, 4, 0, 3), "b": (2.0, 2, 5, 5)}
    forecasts = spark.createDataFrame([("t1", "b1", 1), ("t1", "b2", None), ("t2", "b1", 3)], "time string, base string, x int")
    assert sorted(map(tuple, Q.latest_forecast(forecasts).collect())) == [("t1", "b2", None), ("t2", "b1", 3)]


def test_transcript(spark):
    text = "\n\n".join(
        [
            "Pradžia", "14.05 val.", "PIRMININKAS (V. ANDRIUKAITIS). Labas.", "A. B. ŽEMAITIS (TSF, X). Klausiu.",
            "15.30 val.", "Toliau.", "PIRMININKAS. Ačiū.", "K. NIEKAS. Kas?", "V. Pavardė tik tekstas.",
        ]
    )
    emphasis = ["PIRMININKAS (V. ANDRIUKAITIS", "A. B. ŽEMAITIS ", "PIRMININKAS.", "K. NIEKAS."]
    docs = spark.createDataFrame([("d", text, emphasis, "s", "2000-05-05")], "key string, text string, emphasis array<string>, source string, date string")
    members = spark.createDataFrame(
        [(1, "Vytenis Povilas", "Andriukaitis", "1996-11-25", None), (2, "Adomas Bronius", "Žemaitis", "1996-11-25", "2000-10-18"),
         (3, "Adomas Bronius", "Žemaitis", "1990-11-25", "1992-10-18")],
        "seq int, vardas string, pavarde string, nuo string, iki string")
    chairs = spark.createDataFrame([(1, "Vytautas", "Landsbergis", "1996-11-26", "2000-10-18")], "seq int, vardas string, pavarde string, start string, end string")
    out = Q.parse_transcripts(docs, members, chairs).orderBy("rowno").collect()
    assert [(r.rowno, r.time, r.speaker, r.text, r.parliamentary_group, r.position, r.vardas, r.pavarde, r.pirmininkas) for r in out] == [
        (1, "14:05", "PIRMININKAS", "Labas.", None, "pirmininkas", "Vytenis Povilas", "Andriukaitis", "V. ANDRIUKAITIS"),
        (2, "15:30", "A. B. ŽEMAITIS", "Klausiu.\n\nToliau.", "TSF", "seimo narys", "Adomas Bronius", "Žemaitis", None),
        (3, "15:30", "PIRMININKAS.", "Ačiū.", None, "pirmininkas", "Vytenis Povilas", "Andriukaitis", None),
        (4, "15:30", "K. NIEKAS.", "Kas?\n\nV. Pavardė tik tekstas.", None, None, None, None, None),
    ]


def test_a_value_without_a_label_is_kept(spark):
    df = spark.createDataFrame([("d", 0, "who", "A"), ("d", 1, None, "first"), ("d", 2, None, "kept")], "key string, pos int, k string, v string")
    row = Q.fold_kv_runs(df, "key", "who").first()
    assert (row.record, row.unlabelled) == ({"who": "A"}, "kept")


def test_control_signs_of_a_text_stay(spark):
    docs = spark.createDataFrame([(1, "\u0003a# one\u0001b\u0002\n# two\u0003c\n\u0001")], "id int, text string")
    out = Q.segment_text(docs, r"# \w+", ["id"]).orderBy("pos").collect()
    assert [(r.marker, r.tail) for r in out] == [("# one", "\u0001b\u0002\n"), ("# two", "\u0003c\n\u0001")]


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_null_is_a_group_too(spark, parts):
    rows = [(None, i, "x" if i == 1 else None) for i in range(6)] + [("g", i, "y" if i == 0 else None) for i in range(4)]
    df = spark.createDataFrame(rows, "key string, pos int, v string")
    out = Q.carry_forward(df, ["key"], "pos", F.col("v"), "seen", parts=parts).collect()
    assert {(r.key, r.pos): r.seen for r in out} == {(None, i): "x" if i else None for i in range(6)} | {("g", i): "y" for i in range(4)}


def test_openings_are_not_broadcast(spark):
    """A row per document, whose number the placed file does not show; only border rows are sent to all tasks."""
    import re

    rows = spark.range(2000).select(
        (F.col("id") % 500).alias("doc"), F.col("id").alias("pos"), (F.col("id") < 1000).alias("open"), F.when(F.col("id") >= 500, F.lit("14:05")).alias("t")
    )
    turns = Q.assemble_turns(rows, ["doc"], F.col("open"), F.lit("x"), time=F.col("t"))
    joins = re.findall(r"BroadcastHashJoin \[([^\]]*)\], \[([^\]]*)\]", turns._jdf.queryExecution().executedPlan().toString())
    assert joins and all("__next" in right for _, right in joins)
    assert {r.time for r in turns.collect()} == {"14:05"} and turns.count() == 1000
