import math
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tablewright.functions import geo
from tablewright.operators import joins as J
from tablewright.operators import spatial as S


def test_valid_at_matches_brute_force(spark):
    rng = random.Random(11)
    day0 = date(1999, 12, 20)
    periods = []
    for i in range(60):
        start = day0 + timedelta(days=rng.randint(0, 60))
        end = None if i % 9 == 0 else start + timedelta(days=rng.randint(-1, 40))
        periods.append((rng.choice("ab"), 100 - i, f"p{i}", start, end))
    facts = [(i, "abc"[i % 3], day0 + timedelta(days=rng.randint(-5, 120))) for i in range(200)] + [(999, "a", None)]
    out = J.valid_at_join(
        spark.createDataFrame(facts, "id int, k string, d date"),
        spark.createDataFrame(periods, "k string, seq int, name string, s date, e date"),
        "d", "s", "e", "seq", ["name"], ["k"],
    )

    def expected(k, d):
        hits = [p for p in periods if d and p[0] == k and p[3] < d and (p[4] is None or p[4] > d)]
        return min(hits, key=lambda p: p[1])[2] if hits else None

    assert {r.id: r.name for r in out.collect()} == {i: expected(k, d) for i, k, d in facts}


def test_bounds_are_strict(spark):
    periods = spark.createDataFrame([(1, "x", date(2000, 1, 1), date(2000, 1, 3))], "seq int, n string, s date, e date")
    facts = spark.createDataFrame([(i, date(2000, 1, i)) for i in (1, 2, 3)], "id int, d date")
    out = J.valid_at_join(facts, periods, "d", "s", "e", "seq", ["n"])
    assert {r.id: r.n for r in out.collect()} == {1: None, 2: "x", 3: None}


def test_chair_with_a_carried_name_never_falls_back(spark):
    members = spark.createDataFrame([(1, "Jonas", "Jonaitis", "1990-01-01", None)], "seq int, vardas string, pavarde string, nuo string, iki string")
    chairs = spark.createDataFrame([(1, "Vytautas", "L", "1990-01-01", None)], "seq int, vardas string, pavarde string, start string, end string")
    said = [
        (1, "PIRMININKAS", True, "K. NIEKAS"), (2, "PIRMININKAS", True, None), (3, "J. JONAITIS.", False, "x"),
        (4, "JONAITIS", False, None), (5, "K. NIEKAS", False, None),
    ]
    df = spark.createDataFrame(said, "id int, speaker string, is_chair boolean, chair_name string").withColumn("date", F.lit("2000-01-01"))
    out = {r.id: (r.position, r.pavarde) for r in J.attribute_roles(df, members, chairs, "date").collect()}
    assert out == {1: ("pirmininkas", None), 2: ("pirmininkas", "L"), 3: ("seimo narys", "Jonaitis"), 4: ("seimo narys", "Jonaitis"), 5: (None, None)}


def lookup_case(rng):
    """Members of few and of many terms, and what brute force finds for a speech."""
    day0 = date(1999, 12, 20)
    members = []
    for i in range(160):
        start = day0 + timedelta(days=rng.randint(0, 300))
        end = None if i % 9 == 0 else start + timedelta(days=rng.randint(-1, 90))
        # one surname holds most terms
        surname = "Jonaitis" if i % 4 else f"Pavardė{i % 7}"
        members.append((1000 - i, rng.choice(["Jonas", "Jonas Petras", ""]), surname, start if i % 31 else None, end))
    names = ["J. JONAITIS.", "J.P. JONAITIS", "JONAITIS", "P. J. JONAITIS", *[f"J. PAVARDĖ{n}" for n in range(8)], "...", None]
    said = [(i, rng.choice(names), day0 + timedelta(days=rng.randint(-5, 420))) for i in range(300)] + [(999, "JONAITIS", None)]

    def expected(who, d):
        key = " ".join((who or "").replace(".", " ").split())
        hits = []
        for seq, first, last, nuo, iki in members:
            letters = [w[0] for w in first.split()]
            forms = [letters, letters[:1], letters[:-1], letters[::-1], []]
            spelled = {" ".join([*f, last]).upper() for f in forms}
            if d and nuo and key in spelled and nuo < d and (iki is None or iki > d):
                hits.append((seq, first, last))
        return min(hits)[1:] if hits else (None, None)

    return members, said, expected


@pytest.mark.parametrize("few", [0, 30, 1000])
def test_speakers_match_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(J, "FEW", few, raising=False)
    members, said, expected = lookup_case(random.Random(5))
    out = J.resolve_speaker(
        spark.createDataFrame(said, "id int, speaker string, d date"),
        spark.createDataFrame(members, "seq int, vardas string, pavarde string, nuo date, iki date"), "speaker", "d",
    )
    assert {r.id: (r.vardas, r.pavarde) for r in out.collect()} == {i: expected(who, d) for i, who, d in said}


def unsized(spark, tmp_path):
    """Members in a file much smaller than what their variants and days come to, and speeches."""
    path = str(tmp_path / "members")
    name = F.concat(F.lit("Pav"), F.col("id").cast("string"))
    terms = spark.range(3000).select(
        F.col("id").alias("seq"), F.lit("Jonas Petras").alias("vardas"), name.alias("pavarde"),
        F.lit("1990-01-01").cast("date").alias("nuo"), F.lit(None).cast("date").alias("iki"),
    )
    terms.write.parquet(path)
    said = spark.range(50).select("id", F.upper(F.concat(F.lit("J. Pav"), F.col("id").cast("string"))).alias("speaker"), F.lit("2000-01-01").cast("date").alias("d"))
    return said, spark.read.parquet(path)


def broadcast_keys(df):
    """The keys of all broadcast joins in the plan before it runs."""
    return re.findall(r"BroadcastHashJoin \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())


def test_roles_leave_no_variants_to_a_broadcast(spark, tmp_path):
    said, members = unsized(spark, tmp_path)
    said = said.withColumn("is_chair", F.col("id") % 2 == 0).withColumn("chair_name", F.when(F.col("id") % 4 == 0, F.col("speaker")))
    chairs = spark.createDataFrame([(1, "V", "L", date(1990, 1, 1), None)], "seq int, vardas string, pavarde string, start date, end date")
    out = J.attribute_roles(said, members, chairs, "d")
    assert not any("__variant" in keys for keys in broadcast_keys(out))
    assert {r.id: r.pavarde for r in out.collect()} == {i: "L" if i % 4 == 2 else f"Pav{i}" for i in range(50)}


def test_variants_of_names_are_not_left_to_a_broadcast(spark, tmp_path):
    said, members = unsized(spark, tmp_path)
    out = J.resolve_speaker(said, members, "speaker", "d")
    assert not any("__variant" in keys for keys in broadcast_keys(out))
    assert out.where("pavarde IS NOT NULL").count() == 50


def test_terms_are_not_broadcast_to_speeches_in_packed_files(spark, tmp_path):
    said, members = unsized(spark, tmp_path)
    said.write.parquet(str(tmp_path / "said"))
    out = J.resolve_speaker(spark.read.parquet(str(tmp_path / "said")), members, "speaker", "d")
    assert broadcast_keys(out) == []
    assert out.where("pavarde IS NOT NULL").count() == 50


def test_surnames_of_many_terms_are_not_left_to_a_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(J, "FEW", 0)
    said, members = unsized(spark, tmp_path)
    said.write.parquet(str(tmp_path / "said"))
    out = J.resolve_speaker(spark.read.parquet(str(tmp_path / "said")), members, "speaker", "d")
    assert broadcast_keys(out) == []
    assert {r.id: r.pavarde for r in out.collect()} == {i: f"Pav{i}" for i in range(50)}


def test_split_names(spark):
    people = spark.createDataFrame([(n,) for n in ("JONAITIS JONAS", "van DYKAS Jonas PETRAS", "Vienas", "A B C", None)], "n string")
    known = spark.createDataFrame([("Jonas",), ("PETRAS",)], "f string")
    out = {r.n: (r.first_name, r.last_name, r.reject) for r in J.split_names(people, known, "n", "f").collect()}
    assert out == {
        "JONAITIS JONAS": ("Jonas", "Jonaitis", None),
        "van DYKAS Jonas PETRAS": ("Jonas Petras", "Van Dykas", None),
        "Vienas": (None, None, "one word"),
        "A B C": (None, None, "no first name"),
        None: (None, None, None),
    }


def test_contains_over_sizes(spark):
    rng = random.Random(2)
    boxes = [(i, rng.uniform(-50, 50), rng.uniform(-50, 50), 2.0 ** rng.randint(-3, 6)) for i in range(40)]
    points = [(i, rng.uniform(-60, 120), rng.uniform(-60, 120)) for i in range(400)]
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    x, y, w = F.col("x0"), F.col("y0"), F.col("w")
    shapes = spark.createDataFrame(boxes, "polygon_id int, x0 double, y0 double, w double").select(
        "polygon_id", geo.ring_edges(F.array(corner(x, y), corner(x + w, y), corner(x, y + w))).alias("edges")
    )
    out = S.contains_join(spark.createDataFrame(points, "point_id int, x double, y double"), shapes)
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
    expected = {
        (p, b) for p, px, py in points for b, bx, by, w in boxes if px > bx and py > by and (px - bx) + (py - by) < w
    }
    assert {tuple(r) for r in out.collect()} == expected


def distance(a, b, metric):
    (lon1, lat1), (lon2, lat2) = [(math.radians(lon), math.radians(lat)) for lon, lat in (a, b)]
    if metric == "mercator":
        y = lambda t: math.log(math.tan(math.pi / 4 + t / 2))
        return 6378137.0 * math.hypot(lon1 - lon2, y(lat1) - y(lat2))
    h = math.sin((lat1 - lat2) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon1 - lon2) / 2) ** 2
    return 2 * geo.EARTH_RADIUS * math.asin(math.sqrt(h))


@pytest.mark.parametrize("metric", ["mercator", "haversine"])
@pytest.mark.parametrize("leaf", [1, 4, 1000])
def test_nearest_matches_brute_force(spark, metric, leaf):
    rng = random.Random(7)
    # Most right places in one dense spot, some far out; equal places on both sides.
    right = [(i, 25 + rng.gauss(0, 0.002), 55 + rng.gauss(0, 0.002)) for i in range(150)]
    right += [(200 + i, rng.uniform(24, 26), rng.uniform(54, 56)) for i in range(30)] + [(5000, right[0][1], right[0][2])]
    left = [(i, rng.uniform(24.8, 25.2), rng.uniform(54.9, 55.1)) for i in range(60)]
    left += [(100 + i, right[i][1], right[i][2]) for i in range(5)] + [(300, left[0][1], left[0][2])]
    schema = "id int, lon double, lat double"
    out = S.nearest_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), 9000, metric, leaf)
    for row in out.collect():
        best = min((distance((row.lon, row.lat), (lon, lat), metric), i) for i, lon, lat in right)
        if best[0] > 9000:
            assert row.near_id is None and row.distance is None
        else:
            assert row.near_id == best[1]
            assert row.distance == pytest.approx(best[0], abs=1e-4)
    assert out.count() == len(left)


def test_codes(spark):
    facts = spark.createDataFrame([("1.0",), ("2",), ("x",)], "code string")
    names = spark.createDataFrame([("1", "z", 1), ("01", "a", 2), (None, "n", 3)], "code string, name string, seq int")
    out = {r.code: r.name for r in J.enrich_by_code(facts, names, "code", ["name"], "seq").collect()}
    assert out == {"1.0": "z", "2": None, "x": None}


def test_long_codes_keep_their_digits(spark):
    codes = ["9007199254740993", "12345678901234567890", "12.0", "1e3", " 7 ", "12.7", "-", None]
    out = [r.k for r in spark.createDataFrame([(c,) for c in codes], "c string").select(J.code_key(F.col("c")).alias("k")).collect()]
    assert out == ["9007199254740993", "12345678901234567890", "12", "1000", "7", "12", None, None]


def test_a_time_of_day_is_refused(spark):
    facts = spark.sql("SELECT 1 AS id, timestamp '2020-01-02 09:00:00' AS at")
    periods = spark.sql("SELECT 1 AS seq, date '2020-01-01' AS lo, date '2020-01-03' AS hi, 'x' AS name")
    with pytest.raises(ValueError, match="time of day"):
        J.valid_at_join(facts, periods, "at", "lo", "hi", "seq", ["name"])


def test_one_polygon_over_all_points(spark):
    """A star of thousands of edges: every key holds a part of the points, every cell a part of the edges."""
    import math
    import random

    n = 4000
    corner = [((1 + 0.4 * (i % 2)) * math.cos(2 * math.pi * i / n), (1 + 0.4 * (i % 2)) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    ring = [{"x1": a[0], "y1": a[1], "x2": b[0], "y2": b[1]} for a, b in zip(corner, corner[1:] + corner[:1])]
    rng = random.Random(1)
    points = [(i, rng.uniform(-1.5, 1.5), rng.uniform(-1.5, 1.5)) for i in range(400)] + [(1000, 0.0, 0.0), (1001, corner[0][0], corner[0][1])]

    def held(x, y):
        odd = False
        for e in ring:
            if (e["y1"] > y) != (e["y2"] > y) and x < e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]):
                odd = not odd
        return odd

    shapes = spark.createDataFrame([(7, ring)], "polygon_id int, edges array<struct<x1:double,y1:double,x2:double,y2:double>>")
    out = S.contains_join(spark.createDataFrame(points, "point_id int, x double, y double"), shapes)
    assert {r.point_id for r in out.collect()} == {i for i, x, y in points if i != 1001 and held(x, y)}
