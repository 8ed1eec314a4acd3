"""Queries on ordered rows."""

from pyspark.sql import functions as F

from ..functions.table import register
from ..operators import sequence as Q
from .base import Tables, query
from .joins import surname


@query(
    "W1",
    """
    SELECT user_id, run, k, arg_max(v, event_id) AS v
    FROM (SELECT user_id, event_id, event_type AS k, props AS v,
                 sum((event_type = 'view')::BIGINT) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS run
          FROM events)
    GROUP BY user_id, run, k
    """,
)
def kv_runs(t: Tables):
    pairs = t.events.select(
        "user_id", F.col("event_id").alias("pos"), F.col("event_type").alias("k"), F.col("props").alias("v")
    )
    records = Q.fold_kv_runs(pairs, "user_id", "view")
    return records.select("user_id", "run", F.explode("record").alias("k", "v"))


@query(
    "W2 W6",
    r"""
    WITH parts AS (
        SELECT doc_id, string_split(regexp_replace(text, '(?m)(^\p{Lu}\p{L}+)', chr(1) || '\1' || chr(2), 'g'), chr(1))[2:] AS p
        FROM documents
    ), rows AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS i, p FROM parts)
    SELECT doc_id, i - 1 AS pos, string_split(p[i], chr(2))[1] AS marker, string_split(p[i], chr(2))[2] AS tail
    FROM rows
    """,
)
def text_segments(t: Tables):
    cut = Q.segment_text(t.documents, r"^\p{Lu}\p{L}+", ["doc_id"])
    return cut.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "marker", "tail")


@query(
    "W3 W5",
    """
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'view' THEN props END IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen
    FROM events
    """,
)
def carry_clock(t: Tables):
    events = t.events.select("event_id", "user_id", "event_type", "props")
    seen = F.when(F.col("event_type") == "view", F.col("props"))
    return Q.carry_forward(events, ["user_id"], "event_id", seen, "seen").select("event_id", "user_id", "seen")


@query(
    "W4 W6",
    r"""
    WITH n AS (
        SELECT *, sum((role = 'user')::BIGINT) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS rowno FROM conversations
    )
    SELECT conv_id, rowno, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text, min(turn) AS opened
    FROM n WHERE rowno > 0 GROUP BY conv_id, rowno
    """,
)
def assemble_turns(t: Tables):
    segments = t.conversations.withColumn("pos", F.col("turn")).withColumn("opened", F.col("turn"))
    return Q.assemble_turns(segments, "conv_id", F.col("role") == "user", F.col("text"), ["opened"])


@query(
    "W4 W5",
    """
    WITH n AS (
        SELECT *, CASE WHEN event_type = 'click' THEN props END AS mark,
               sum((event_type = 'signup')::BIGINT) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS rowno
        FROM events
    ), c AS (
        SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen FROM n
    ), f AS (SELECT user_id, arg_min(mark, event_id) AS first_mark FROM n WHERE mark IS NOT NULL GROUP BY user_id)
    SELECT user_id, rowno, coalesce(arg_max(seen, event_id), any_value(first_mark)) AS time,
           string_agg(event_type, ' ' ORDER BY event_id) AS text, min(event_id) AS opener
    FROM c LEFT JOIN f USING (user_id) WHERE rowno > 0 GROUP BY user_id, rowno
    """,
)
def turns_with_clock(t: Tables):
    segments = t.events.select(
        "user_id", F.col("event_id").alias("pos"), "event_type", "props", F.col("event_id").alias("opener")
    )
    return Q.assemble_turns(
        segments,
        "user_id",
        F.col("event_type") == "signup",
        F.col("event_type"),
        ["opener"],
        time=F.when(F.col("event_type") == "click", F.col("props")),
        sep=" ",
    )


@query(
    "W2 W3 W4 W5 W6 X18 X19 X20 X21 J1 J2 J3 J14 U2",
    """
    WITH d AS (
        SELECT c_custkey AS key, upper('Pav' || translate(c_custkey::VARCHAR, '0123456789', 'abcdefghij')) AS sur,
               c_custkey % 2 = 0 AS member, c_custkey % 5 = 0 AS office, 1990 + c_custkey % 12 AS year FROM customer
    ), o AS (
        SELECT key, arg_min(r_name, r_regionkey) AS chair FROM d JOIN region
        ON make_date(1990 + r_regionkey * 3, 1, 1) < make_date(year, 6, 15)
           AND (r_regionkey = 4 OR make_date(1993 + r_regionkey * 3, 1, 1) > make_date(year, 6, 15))
        GROUP BY key
    )
    SELECT key, n::BIGINT AS rowno, CASE n WHEN 1 THEN '14:05' ELSE '15:10' END AS time,
           CASE n WHEN 1 THEN CASE WHEN office THEN 'PIRMININKAS.' ELSE 'PIRMININKAS' END WHEN 2 THEN 'J. ' || sur
                  ELSE 'PIRMININKAS.' END AS speaker,
           CASE n WHEN 1 THEN 'Labas rytas.' || chr(10) || chr(10) || 'Pradedame.'
                  WHEN 2 THEN 'Ačiū.' || chr(10) || chr(10) || 'Taip.' ELSE 'Pabaiga.' END AS text,
           CASE WHEN n = 2 THEN 'XY' END AS parliamentary_group,
           CASE WHEN n <> 2 THEN 'pirmininkas' WHEN member THEN 'seimo narys' END AS position,
           CASE WHEN n <> 2 AND office THEN chair WHEN member THEN 'Jonas Petras' END AS vardas,
           CASE WHEN n <> 2 AND office THEN chair WHEN member THEN sur END AS pavarde,
           CASE WHEN n = 1 AND NOT office THEN 'J. ' || sur END AS pirmininkas
    FROM d LEFT JOIN o USING (key), (VALUES (1), (2), (3)) AS turns(n)
    """,
)
def transcript_turns(t: Tables):
    """A transcript per customer: clock, chair (named, or in office), a speaker, a clock, the chair."""
    name = F.upper(surname(F.col("c_custkey")))
    office = F.col("c_custkey") % 5 == 0
    chair = F.when(office, F.lit("PIRMININKAS.")).otherwise(F.concat(F.lit("PIRMININKAS (J. "), name, F.lit(").")))
    text = F.concat(
        F.lit("Posėdis\n\n14.05 val.\n\n"), chair, F.lit(" Labas rytas.\n\nPradedame.\n\nJ. "), name,
        F.lit(" (XY). Ačiū.\n\n15.10 val.\n\nTaip.\n\nPIRMININKAS. Pabaiga."),
    )
    docs = t.customer.select(
        F.col("c_custkey").alias("key"),
        text.alias("text"),
        F.array(chair, F.lit("PIRMININKAS."), F.concat(F.lit("J. "), name, F.lit(" "))).alias("emphasis"),
        F.make_date(F.lit(1990) + F.col("c_custkey").cast("int") % 12, F.lit(6), F.lit(15)).alias("date"),
    )
    members = t.customer.select(
        F.col("c_custkey").alias("seq"),
        F.lit("Jonas Petras").alias("vardas"),
        name.alias("pavarde"),
        F.lit("1980-01-01").cast("date").alias("nuo"),
        F.when(F.col("c_custkey") % 2 == 1, F.lit("1981-01-01").cast("date")).alias("iki"),
    )
    first = F.col("r_regionkey") * 3
    chairs = t.region.select(
        F.col("r_regionkey").alias("seq"),
        F.col("r_name").alias("vardas"),
        F.col("r_name").alias("pavarde"),
        F.make_date(first + 1990, F.lit(1), F.lit(1)).alias("start"),
        F.when(F.col("r_regionkey") < 4, F.make_date(first + 1993, F.lit(1), F.lit(1))).alias("end"),
    )
    return Q.parse_transcripts(t.dealt(docs), t.dealt(members), chairs, ["date"]).drop("date")


INTERVALS_SQL = """
    l AS (SELECT DISTINCT l_suppkey, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS lo FROM lineitem),
    s AS (SELECT l_suppkey, lo, lo + 3 AS hi,
                 max(lo + 3) OVER (PARTITION BY l_suppkey ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM l),
    i AS (SELECT *, sum((reach IS NULL OR lo > reach)::INTEGER) OVER (PARTITION BY l_suppkey ORDER BY lo
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM s),
    merged AS (SELECT l_suppkey, min(lo) AS lo, max(hi) AS hi FROM i GROUP BY l_suppkey, island)
"""


def ship_intervals(t: Tables):
    lo = F.unix_date(F.col("l_shipdate").cast("date"))
    lines = t.lineitem.select("l_suppkey", lo.alias("lo"), (lo + 3).alias("hi"))
    return Q.merge_intervals(lines, "l_suppkey", "lo", "hi")


@query("A8", f"WITH {INTERVALS_SQL} SELECT l_suppkey, lo::BIGINT AS lo, hi::BIGINT AS hi FROM merged")
def merge_ship_intervals(t: Tables):
    return ship_intervals(t)


@query(
    "A8",
    f"""
    WITH {INTERVALS_SQL}
    SELECT l_suppkey, min(lo)::BIGINT AS start, max(hi)::BIGINT AS end, sum(hi - lo)::BIGINT AS duration
    FROM merged GROUP BY l_suppkey
    """,
)
def ship_totals(t: Tables):
    return Q.interval_totals(ship_intervals(t), "l_suppkey")


@query(
    "A9 X24 X25",
    """
    SELECT l_orderkey, l_linenumber,
           min(strftime(l_shipdate, '%Y-%m-%dT%H-%M')) OVER (PARTITION BY l_orderkey) || '/' || strftime(l_shipdate, '%Y-%m-%dT%H-%M') AS key,
           CAST(l_quantity AS INTEGER) AS temperature
    FROM lineitem
    """,
)
def forecast_keys(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH-mm").alias("time"),
        F.col("l_quantity").cast("int").alias("temperature"),
    )
    based = Q.with_group_min(rows, "l_orderkey", "time", "base")
    return based.select("l_orderkey", "l_linenumber", F.concat_ws("/", "base", "time").alias("key"), "temperature")


@query(
    "W8 A2",
    """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS time, max(o_orderkey) AS base,
           arg_max(o_totalprice, o_orderkey) AS o_totalprice, arg_max(o_custkey, o_orderkey) AS o_custkey
    FROM orders GROUP BY 1
    """,
)
def latest_forecast(t: Tables):
    rows = t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("time"), F.col("o_orderkey").alias("base"), "o_totalprice", "o_custkey"
    )
    return Q.latest_forecast(rows)


@query(
    "A10",
    """
    SELECT o_custkey, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS mean, CAST(round(max(o_totalprice) * 100) AS BIGINT) AS max,
           min(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderpriority[1]::INTEGER END) AS top,
           min(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority[1]::INTEGER END) AS best_rank
    FROM orders GROUP BY o_custkey
    """,
)
def series_stats(t: Tables):
    rank = F.when(F.col("o_orderstatus") != "P", F.substring("o_orderpriority", 1, 1).cast("int"))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    rows = t.orders.select("o_custkey", cents.alias("cents"), rank.alias("rank"))
    return Q.series_stats(rows, "o_custkey", "cents", "rank")


@query(
    "U2 W2",
    """
    WITH c AS (
        SELECT conv_id::VARCHAR AS key, turn, role, text,
               sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn) AS ends
        FROM conversations
    ), w AS (
        SELECT *, ends - length(text) - 1 AS start, max(ends) OVER (PARTITION BY key) AS whole FROM c
    ), m AS (SELECT * FROM w WHERE role = 'user')
    SELECT key, (row_number() OVER o - 1)::INT AS pos, start::BIGINT AS start,
           (coalesce(lead(start) OVER o, whole) - 1)::BIGINT AS stop, split_part(text, ' ', 1) AS marker
    FROM m WINDOW o AS (PARTITION BY key ORDER BY turn)
    """,
)
def question_spans(t: Tables):
    # What a user says opens a segment of the conversation's text; the call is SQL.
    marker = F.when(F.col("role") == "user", F.substring_index("text", " ", 1))
    turns = t.conversations.select(F.col("conv_id").cast("string").alias("key"), F.col("turn").alias("ord"), marker.alias("marker"), "text")
    register(t.spark)
    return t.spark.sql("SELECT * FROM segment_spans(TABLE({turns}) PARTITION BY key ORDER BY ord)", turns=turns)
