"""Queries on temporal, name, spatial and code joins."""

from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import tagged_title
from ..operators import joins as J
from ..operators import project as P
from ..operators import spatial as S
from .base import Tables, query

LETTERS = "abcdefghij"


def surname(key):
    """A made-up surname per key, in letters."""
    return F.concat(F.lit("Pav"), F.translate(key.cast("string"), "0123456789", LETTERS))


def day(text: str, plus):
    return F.date_add(F.lit(text).cast("date"), plus.cast("int"))


@query(
    "J1",
    """
    WITH periods AS (
        SELECT 1000000 - s_suppkey AS seq, s_suppkey, s_name,
               DATE '1995-01-01' + CAST(s_suppkey * 17 % 2200 AS INTEGER) AS start,
               CASE WHEN s_suppkey % 10 <> 9 THEN DATE '1995-01-01' + CAST(s_suppkey * 17 % 2200 + s_suppkey % 200 AS INTEGER) END AS stop
        FROM supplier
    ), dates AS (
        SELECT d, arg_min(s_suppkey, seq) AS s_suppkey, arg_min(s_name, seq) AS s_name
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
        JOIN periods ON start < d AND (stop > d OR stop IS NULL) GROUP BY d
    )
    SELECT o_orderkey, s_suppkey, s_name FROM orders LEFT JOIN dates ON CAST(o_orderdate AS DATE) = d
    """,
)
def valid_at(t: Tables):
    first = F.col("s_suppkey") * 17 % 2200
    periods = t.supplier.select(
        (1000000 - F.col("s_suppkey")).alias("seq"),
        "s_suppkey",
        "s_name",
        day("1995-01-01", first).alias("start"),
        F.when(F.col("s_suppkey") % 10 != 9, day("1995-01-01", first + F.col("s_suppkey") % 200)).alias("end"),
    )
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    found = J.valid_at_join(orders, periods, "o_orderdate", "start", "end", "seq", ["s_suppkey", "s_name"])
    return found.drop("o_orderdate")


MEMBERS_SQL = """
    m AS (
        SELECT s_suppkey * 2 + k AS seq,
               CASE s_suppkey % 3 WHEN 0 THEN 'Jonas' WHEN 1 THEN 'Jonas Petras' ELSE 'Ąžuolas Jonas Kazys' END AS vardas,
               'Pav' || translate(s_suppkey::VARCHAR, '0123456789', 'abcdefghij') AS pavarde,
               CASE k WHEN 0 THEN DATE '1995-06-01' ELSE DATE '1999-03-01' + CAST(s_suppkey % 30 AS INTEGER) END AS nuo,
               CASE k WHEN 0 THEN DATE '1998-05-05' + CAST(s_suppkey % 700 AS INTEGER) END AS iki
        FROM supplier, (VALUES (0), (1)) AS terms(k)
    ), v AS (
        SELECT DISTINCT seq, vardas, pavarde, nuo, iki, upper(unnest([
            array_to_string(list_append(l, pavarde), ' '), l[1] || ' ' || pavarde,
            array_to_string(list_append(l[:-2], pavarde), ' '),
            array_to_string(list_append(list_reverse(l), pavarde), ' '), pavarde])) AS variant
        FROM (SELECT *, list_transform(string_split(vardas, ' '), lambda w: w[1]) AS l FROM m)
    ), s AS (
        SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d, l_linestatus = 'O' AS is_chair,
               CASE l_linenumber % 5 WHEN 0 THEN 'J.' || chr(160) WHEN 1 THEN 'J. P. ' WHEN 2 THEN 'K. J. Ą. ' WHEN 3 THEN '' ELSE 'Ą.J.K.' END
               || upper('Pav' || translate(l_suppkey::VARCHAR, '0123456789', 'abcdefghij'))
               || CASE WHEN l_linenumber % 2 = 0 THEN '.' ELSE '' END AS speaker,
               l_returnflag
        FROM lineitem
    )
"""


def members(t: Tables):
    """Two terms in office per supplier, under a made-up name."""
    kind = F.col("s_suppkey") % 3
    first = (
        F.when(kind == 0, "Jonas").when(kind == 1, "Jonas Petras").otherwise("Ąžuolas Jonas Kazys")
    )
    first_term = F.col("k") == 0
    terms = t.supplier.select("s_suppkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    return terms.select(
        (F.col("s_suppkey") * 2 + F.col("k")).alias("seq"),
        first.alias("vardas"),
        surname(F.col("s_suppkey")).alias("pavarde"),
        F.when(first_term, F.lit("1995-06-01").cast("date"))
        .otherwise(day("1999-03-01", F.col("s_suppkey") % 30))
        .alias("nuo"),
        F.when(first_term, day("1998-05-05", F.col("s_suppkey") % 700)).alias("iki"),
    )


def speeches(t: Tables):
    """A speech per order line, its speaker written in one of five ways."""
    way = F.col("l_linenumber") % 5
    lead = (
        F.when(way == 0, "J.\u00a0").when(way == 1, "J. P. ").when(way == 2, "K. J. Ą. ").when(way == 3, "").otherwise("Ą.J.K.")
    )
    dot = F.when(F.col("l_linenumber") % 2 == 0, ".").otherwise("")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.col("l_shipdate").cast("date").alias("d"),
        (F.col("l_linestatus") == "O").alias("is_chair"),
        F.concat(lead, F.upper(surname(F.col("l_suppkey"))), dot).alias("speaker"),
    )


NAMED_SQL = r"""
    , asked AS (
        SELECT DISTINCT speaker AS who, d, trim(upper(regexp_replace(speaker, '[.\s\x{00A0}]+', ' ', 'g'))) AS variant FROM s
    ), named AS (
        SELECT who, d, arg_min(vardas, seq) AS vardas, arg_min(pavarde, seq) AS pavarde
        FROM asked JOIN v USING (variant) WHERE nuo < d AND (iki > d OR iki IS NULL) GROUP BY who, d
    )
"""


@query(
    "J2",
    "WITH"
    + MEMBERS_SQL
    + NAMED_SQL
    + """
    SELECT l_orderkey, l_linenumber, speaker, vardas, pavarde
    FROM s LEFT JOIN named ON s.speaker = named.who AND s.d = named.d
    """,
)
def speaker_variant_join(t: Tables):
    found = J.resolve_speaker(speeches(t), members(t), "speaker", "d")
    return found.select("l_orderkey", "l_linenumber", "speaker", "vardas", "pavarde")


@query(
    "J3 J1 J2",
    "WITH"
    + MEMBERS_SQL
    + NAMED_SQL
    + """
    , chairs AS (
        SELECT n_nationkey AS seq, n_name, DATE '1995-01-01' + n_nationkey * 100 AS start,
               CASE WHEN n_nationkey < 24 THEN DATE '1995-01-01' + n_nationkey * 100 + 101 END AS stop FROM nation
    ), held AS (
        SELECT d, arg_min(n_name, seq) AS n_name
        FROM (SELECT DISTINCT d FROM s) JOIN chairs ON start < d AND (stop > d OR stop IS NULL) GROUP BY d
    )
    SELECT l_orderkey, l_linenumber,
           CASE WHEN is_chair THEN 'pirmininkas' WHEN pavarde IS NOT NULL THEN 'seimo narys' END AS position,
           CASE WHEN is_chair AND l_returnflag <> 'R' THEN n_name ELSE vardas END AS vardas,
           CASE WHEN is_chair AND l_returnflag <> 'R' THEN n_name || 'as' ELSE pavarde END AS pavarde
    FROM s LEFT JOIN named ON s.speaker = named.who AND s.d = named.d LEFT JOIN held ON s.d = held.d
    """,
)
def role_attribution(t: Tables):
    # Chairs of returned lines were named in the text; the others are looked up by office.
    chairs = t.nation.select(
        F.col("n_nationkey").alias("seq"),
        F.col("n_name").alias("vardas"),
        F.concat("n_name", F.lit("as")).alias("pavarde"),
        day("1995-01-01", F.col("n_nationkey") * 100).alias("start"),
        F.when(F.col("n_nationkey") < 24, day("1995-01-01", F.col("n_nationkey") * 100 + 101)).alias("end"),
    )
    named = F.col("is_chair") & (F.col("l_returnflag") == "R")
    said = speeches(t).withColumn("chair_name", F.when(named, F.col("speaker")))
    found = J.attribute_roles(said, members(t), chairs, "d")
    return found.select("l_orderkey", "l_linenumber", "position", "vardas", "pavarde")


@query(
    "J14",
    r"""
    WITH lines AS (
        SELECT conv_id, turn, role, lines[i] AS line, i - 1 AS pos
        FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i
              FROM (SELECT conv_id, turn, role, string_split(text, chr(10)) AS lines FROM conversations))
    ), heads AS (
        SELECT conv_id, turn, role, pos, upper(regexp_extract(line, '^[^\s]+')) AS head FROM lines
    )
    SELECT conv_id, turn, pos, head FROM heads u
    WHERE role = 'user' AND regexp_matches(head, '\p{Lu}') AND NOT regexp_matches(head, '[\p{Ll}\p{Lt}]')
      AND EXISTS (SELECT 1 FROM heads a WHERE a.role = 'assistant' AND a.conv_id = u.conv_id AND a.head = u.head)
    """,
)
def emphasised_heads(t: Tables):
    # Every line of a turn starts with a head.
    lines = t.conversations.select("conv_id", "turn", "role", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    heads = lines.select(
        "conv_id", "turn", "role", F.col("pos").cast("bigint").alias("pos"), F.upper(F.regexp_extract("line", r"^[^\s]+", 0)).alias("head")
    )
    marks = heads.where("role = 'assistant'").select("conv_id", F.col("head").alias("mark"))
    said = heads.where("role = 'user'").drop("role")
    return J.emphasised(said, marks, "conv_id", "head", "mark").select("conv_id", "turn", "pos", "head")


# ---- space -------------------------------------------------------------------------


def lon(key: str) -> str:
    return f"(20.9 + ({key} * 7919 % 10007) * 0.0006)"


def lat(key: str) -> str:
    return f"(53.9 + ({key} * 104729 % 10009) * 0.00025)"


def places(df, key: str, scale: str = "1"):
    return df.select(
        F.col(key).alias("id"),
        F.expr(lon(f"({key} * {scale} + 5)")).cast("double").alias("lon"),
        F.expr(lat(f"({key} * {scale} + 5)")).cast("double").alias("lat"),
    )


AREAS_SQL = """
    areas AS (
        SELECT n_nationkey, n_name, 4 + n_nationkey % 3 AS level, x0, y0, w, h FROM (
            SELECT *, 20.9::DOUBLE + (n_nationkey % 5) AS x0, 53.9::DOUBLE + (n_nationkey // 5) * 0.4 AS y0,
                   1.0::DOUBLE + (n_nationkey % 3) * 1.5 AS w, 0.5::DOUBLE + (n_nationkey % 3) * 0.7 AS h FROM nation)
    )
"""


def areas(t: Tables):
    """An L-shaped area per nation, on one of three levels."""
    n = F.col("n_nationkey")
    x, y = F.lit(20.9) + n % 5, F.lit(53.9) + F.floor(n / 5) * 0.4
    w, h = F.lit(1.0) + (n % 3) * 1.5, F.lit(0.5) + (n % 3) * 0.7
    point = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    ring = F.array(
        point(x, y), point(x + w, y), point(x + w, y + h / 2), point(x + w / 2, y + h / 2), point(x + w / 2, y + h), point(x, y + h)
    )
    return t.nation.select(
        n.alias("polygon_id"), "n_name", (n % 3 + 4).alias("level"), geo.ring_edges(ring).alias("edges")
    )


@query(
    "J4",
    f"""
    WITH {AREAS_SQL}, p AS (SELECT c_custkey, {lon('(c_custkey + 5)')}::DOUBLE AS x, {lat('(c_custkey + 5)')}::DOUBLE AS y FROM customer)
    SELECT c_custkey AS point_id, n_nationkey AS polygon_id FROM p JOIN areas
    ON x > x0 AND y > y0 AND y < y0 + h AND x < x0 + w AND (y < y0 + h / 2 OR x < x0 + w / 2)
    """,
)
def points_in_areas(t: Tables):
    points = places(t.customer, "c_custkey").select(
        F.col("id").alias("point_id"), F.col("lon").alias("x"), F.col("lat").alias("y")
    )
    return S.contains_join(points, areas(t))


@query(
    "J4 A7",
    f"""
    WITH {AREAS_SQL}, p AS (SELECT c_custkey, {lon('(c_custkey + 5)')}::DOUBLE AS x, {lat('(c_custkey + 5)')}::DOUBLE AS y FROM customer)
    SELECT c_custkey AS osm_id,
           max(n_nationkey) FILTER (WHERE level = 6) AS admin_level_6_osm_id,
           arg_max(n_name, n_nationkey) FILTER (WHERE level = 6) AS admin_level_6,
           max(n_nationkey) FILTER (WHERE level = 5) AS admin_level_5_osm_id,
           arg_max(n_name, n_nationkey) FILTER (WHERE level = 5) AS admin_level_5,
           max(n_nationkey) FILTER (WHERE level = 4) AS admin_level_4_osm_id,
           arg_max(n_name, n_nationkey) FILTER (WHERE level = 4) AS admin_level_4
    FROM p JOIN areas ON x > x0 AND y > y0 AND y < y0 + h AND x < x0 + w AND (y < y0 + h / 2 OR x < x0 + w / 2)
    GROUP BY c_custkey
    """,
)
def places_with_levels(t: Tables):
    held = points_in_areas(t).join(areas(t).drop("edges"), "polygon_id")
    wide = P.pivot_levels(held, "point_id", "level", [6, 5, 4], "n_name", "polygon_id")
    return wide.withColumnRenamed("point_id", "osm_id")


@query(
    "A7",
    """
    SELECT o_custkey, """
    + ", ".join(
        f"""arg_max(o_orderstatus, o_orderkey) FILTER (WHERE o_orderpriority[1] = '{n}') AS admin_level_{n},
            max(o_orderkey) FILTER (WHERE o_orderpriority[1] = '{n}') AS admin_level_{n}_osm_id"""
        for n in range(1, 6)
    )
    + " FROM orders GROUP BY o_custkey",
)
def pivot_levels(t: Tables):
    orders = t.orders.withColumn("level", F.substring("o_orderpriority", 1, 1).cast("int"))
    return P.pivot_levels(orders, "o_custkey", "level", [1, 2, 3, 4, 5], "o_orderstatus", "o_orderkey")


@query(
    "J4 A7 X17 P1",
    f"""
    WITH {AREAS_SQL}, p AS (
        SELECT *, {lon('(c_custkey + 5)')}::DOUBLE AS x, {lat('(c_custkey + 5)')}::DOUBLE AS y FROM customer
    ), held AS (
        SELECT c_custkey, max(n_nationkey) FILTER (WHERE level = 5) AS admin_level_5_osm_id,
               arg_max(n_name, n_nationkey) FILTER (WHERE level = 5) AS admin_level_5,
               max(n_nationkey) FILTER (WHERE level = 4) AS admin_level_4_osm_id,
               arg_max(n_name, n_nationkey) FILTER (WHERE level = 4) AS admin_level_4
        FROM p JOIN areas ON x > x0 AND y > y0 AND y < y0 + h AND x < x0 + w AND (y < y0 + h / 2 OR x < x0 + w / 2)
        GROUP BY c_custkey
    )
    SELECT p.c_custkey AS osm_id, lower(c_mktsegment) AS type, c_nationkey * 1000 AS population,
           CASE WHEN c_custkey % 3 > 0 THEN 'lt' END AS wikipedia_lang,
           CASE WHEN c_custkey % 3 < 2 THEN c_name ELSE c_name || ': x' END AS wikipedia_title,
           admin_level_5_osm_id, admin_level_5, admin_level_4_osm_id, admin_level_4
    FROM p LEFT JOIN held USING (c_custkey)
    """,
)
def place_records(t: Tables):
    # A place with its tags, its article split into language and title, and the areas around it.
    kind = F.col("c_custkey") % 3
    article = (
        F.when(kind == 0, F.col("c_name")).when(kind == 1, F.concat(F.lit("lt:"), "c_name")).otherwise(F.concat(F.lit("lt:"), "c_name", F.lit(": x")))
    )
    lang, title = tagged_title(article)
    tags = P.project(
        t.customer,
        F.col("c_custkey"),
        {
            "type": F.lower("c_mktsegment"),
            "population": F.col("c_nationkey") * 1000,
            "wikipedia_lang": lang,
            "wikipedia_title": title,
        },
    ).select(F.col("key").alias("osm_id"), "value.*")
    held = points_in_areas(t).join(areas(t).drop("edges"), "polygon_id")
    levels = P.pivot_levels(held, "point_id", "level", [5, 4], "n_name", "polygon_id")
    return P.with_parent(tags, levels.withColumnRenamed("point_id", "osm_id"), "osm_id", levels.columns[1:])


NEAR_SQL = f"""
    WITH c AS (SELECT c_custkey AS id, {lon('(c_custkey + 5)')}::DOUBLE AS lon, {lat('(c_custkey + 5)')}::DOUBLE AS lat FROM customer),
         s AS (SELECT s_suppkey AS id, {lon('(s_suppkey * 31 + 5)')}::DOUBLE AS lon, {lat('(s_suppkey * 31 + 5)')}::DOUBLE AS lat FROM supplier),
         near AS (SELECT c.id, s.id AS near_id, {{distance}} AS distance FROM c, s),
         best AS (SELECT id, arg_min(near_id, distance) AS near_id, min(distance) AS distance FROM near
                  WHERE distance <= {{radius}} GROUP BY id)
    SELECT c.id AS c_custkey, near_id, round(distance, 3) AS distance FROM c LEFT JOIN best USING (id)
"""


def nearest(t: Tables, radius: float, metric: str):
    hits = S.nearest_join(places(t.customer, "c_custkey"), places(t.supplier, "s_suppkey", "31"), radius, metric)
    return hits.select(F.col("id").alias("c_custkey"), "near_id", F.round("distance", 3).alias("distance"))


@query(
    "J5 X30",
    NEAR_SQL.format(
        distance="""sqrt(pow(radians(c.lon - s.lon) * 6378137.0, 2) + pow(6378137.0 *
            (ln(tan(pi() / 4 + radians(c.lat) / 2)) - ln(tan(pi() / 4 + radians(s.lat) / 2))), 2))""",
        radius=10000,
    ),
)
def nearest_supplier(t: Tables):
    return nearest(t, 10000, "mercator")


@query(
    "J5",
    NEAR_SQL.format(
        distance="""2 * 6371008.8 * asin(sqrt(pow(sin(radians(c.lat - s.lat) / 2), 2)
            + cos(radians(c.lat)) * cos(radians(s.lat)) * pow(sin(radians(c.lon - s.lon) / 2), 2)))""",
        radius=8000,
    ),
)
def nearest_supplier_on_ground(t: Tables):
    return nearest(t, 8000, "haversine")


# ---- names and codes --------------------------------------------------------------


@query(
    "J12 X2",
    """
    WITH n AS (
        SELECT p_partkey, p_partkey % 4 AS kind, upper(a[1]) || a[2:] AS first, upper(b[1]) || b[2:] AS last
        FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)
    )
    SELECT p_partkey, CASE kind WHEN 0 THEN first WHEN 1 THEN first || ' ' || first END AS first_name,
           CASE WHEN kind < 2 THEN last END AS last_name,
           CASE kind WHEN 2 THEN 'one word' WHEN 3 THEN 'no first name' END AS reject
    FROM n
    """,
)
def split_names(t: Tables):
    word = F.split(F.upper("p_name"), " ")
    kind = F.col("p_partkey") % 4
    name = (
        F.when(kind == 0, F.concat_ws(" ", word[1], word[0]))
        .when(kind == 1, F.concat_ws("\u00a0 ", word[1], word[0], word[0]))
        .when(kind == 2, word[1])
        .otherwise(F.concat_ws(" ", word[1], word[1], word[1]))
    )
    people = t.part.select("p_partkey", name.alias("name"))
    known = t.part.select(F.substring_index("p_name", " ", 1).alias("first"))
    return J.split_names(people, known, "name", "first").drop("name")


@query(
    "J15 X25",
    """
    SELECT l_orderkey, l_linenumber, line, s_name, s_nationkey
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey, (VALUES ('short'), ('long')) AS lines(line)
    UNION ALL SELECT l_orderkey, l_linenumber, 'unknown', NULL, NULL FROM lineitem
    """,
)
def enrich_by_code(t: Tables):
    # Codes of a few and of 17 digits, some written as 12.0, and codes that nobody has. Every code has
    # a later name row that sorts before the first.
    def rows(names, *values):
        struct = lambda v: F.struct(*[F.lit(x).alias(n) for n, x in zip(names, v, strict=True)])
        return F.inline(F.array(*map(struct, values)))

    text = lambda c: F.col(c).cast("string")
    long = lambda c: (F.lit(90071992547400001) + F.col(c)).cast("string")
    written = rows(
        ("line", "kodas"),
        ("short", F.concat(text("l_suppkey"), F.lit(".0"))),
        ("long", long("l_suppkey")),
        ("unknown", "-1"),
    )
    lines = t.lineitem.select("l_orderkey", "l_linenumber", written)
    name, nation = F.col("s_name"), F.col("s_nationkey")
    held = rows(
        ("seq", "kodas", "s_name", "s_nationkey"),
        (1, text("s_suppkey"), name, nation),
        (1, long("s_suppkey"), name, nation),
        (2, text("s_suppkey"), "A", nation),
        (2, long("s_suppkey"), "A", nation),
    )
    names = t.supplier.select(held)
    return J.enrich_by_code(lines, names, "kodas", ["s_name", "s_nationkey"], "seq").drop("kodas")
