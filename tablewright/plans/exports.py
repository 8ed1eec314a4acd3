"""Queries that write a table out in a file format and read it back."""

from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import project as P
from ..session import scratch_path
from ..sources import export as E
from ..sources import files as R
from .base import Tables, query


@query(
    "S7 S8 S9",
    """
    SELECT event_id, event_type || ', "' || user_id || '"' AS label, value AS "place.value", props AS "place.props"
    FROM events
    """,
)
def csv_roundtrip(t: Tables):
    path = scratch_path(t.spark, "events.csv")
    rows = P.project(t.events, F.col("event_id"), {"value": F.col("value"), "props": F.col("props")})
    rows = t.events.select("event_id", "event_type", "user_id").join(
        rows.select(F.col("key").alias("event_id"), F.col("value").alias("place")), "event_id"
    )
    label = F.concat("event_type", F.lit(', "'), F.col("user_id").cast("string"), F.lit('"'))
    include = ["event_id", "label", "place.value", "place.props"]
    E.export_table(rows, path, "csv", include, computed={"label": label})
    schema = "event_id bigint, label string, `place.value` double, `place.props` string"
    return t.spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)


@query(
    "S7 S9",
    "SELECT o_orderkey AS key, o_orderpriority AS value, round(o_totalprice / 2, 4) AS half FROM orders",
)
def tsv_roundtrip(t: Tables):
    path = scratch_path(t.spark, "orders.tsv")
    computed = {
        "key": F.col("o_orderkey"),
        "value": F.col("o_orderpriority"),
        "half": F.round(F.col("o_totalprice") / 2, 4),
    }
    E.export_table(t.orders, path, "tsv", computed=computed, replace=True)
    schema = "key bigint, value string, half double"
    return t.spark.read.option("header", True).option("sep", "\t").schema(schema).csv(path)


@query("S10", "SELECT doc_id, lang, source, n_chars, text FROM documents")
def jsonl_roundtrip(t: Tables):
    path = scratch_path(t.spark, "documents.jsonl")
    tags = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    E.export_jsonl(t.documents.select("doc_id", tags.alias("tags"), "n_chars", "text"), path)
    back = t.spark.read.schema("doc_id bigint, tags map<string,string>, n_chars bigint, text string").json(path)
    return back.select("doc_id", F.col("tags")["lang"].alias("lang"), F.col("tags")["source"].alias("source"), "n_chars", "text")


@query(
    "S4 X12",
    """
    SELECT 'http://www.example.org/l.php?m=8&itemID=' || o_custkey || '&show=' || replace(o_orderpriority, ' ', '+') AS key,
           o_orderkey::VARCHAR AS "ID", o_orderpriority AS "TITLE"
    FROM orders
    """,
)
def keyed_csv(t: Tables):
    path = scratch_path(t.spark, "questions.csv")
    rows = t.orders.select(
        F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("MEETING_ID"), F.col("o_orderpriority").alias("TITLE")
    )
    rows.write.option("header", True).option("sep", ";").csv(path)
    url = U.build_url(
        "http://www.example.org/l.php?", [("m", F.lit(8)), ("itemID", F.col("MEETING_ID")), ("show", F.col("TITLE"))]
    )
    read = R.read_keyed_csv(
        t.spark, path, ";", key="url", derived={"url": url}, schema="ID string, MEETING_ID string, TITLE string"
    )
    return read.drop("MEETING_ID")


@query("S4", "SELECT o_orderkey + 1 AS key, o_orderkey, o_custkey FROM orders")
def numbered_csv(t: Tables):
    # Written in key order, so the row number in file order is the key plus one.
    path = scratch_path(t.spark, "orders.csv")
    t.orders.select("o_orderkey", "o_custkey").orderBy("o_orderkey").write.option("header", True).csv(path)
    return R.read_keyed_csv(t.spark, path, schema="o_orderkey bigint, o_custkey bigint")


@query(
    "S5 X25",
    """
    SELECT o_orderkey::VARCHAR AS key, o_custkey::VARCHAR AS regnr, o_orderkey AS kodas, o_totalprice AS alga,
           NULL::DOUBLE AS autorine FROM orders
    """,
)
def legacy_report(t: Tables):
    path = scratch_path(t.spark, "report")
    price = F.replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    line = F.concat_ws("; ", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"), price, F.lit(""))
    t.orders.select(line).write.text(path)
    names = {"regnr": "string", "kodas": "bigint", "alga": "double", "autorine": "double"}
    return R.read_legacy_report(t.spark, path + "/*.txt", 0, names, "kodas").select("key", *names)


@query(
    "S11 S12",
    """
    SELECT doc_id, 'http://www.example.org/' || source || '/archive?doc=' || doc_id || '&page=' || page AS key
    FROM (SELECT doc_id, source, unnest(range(1, n_chars // 2000 + 2)) AS page FROM documents)
    """,
)
def archive_seeds(t: Tables):
    # An archive page for every 2,000 characters of a document.
    last = F.floor(F.col("n_chars") / 2000) + 2
    template = "http://www.example.org/{source}/archive?doc={doc_id}&page={page}"
    return R.seed_urls(t.documents, template, F.lit(1).cast("bigint"), last, keep=["doc_id"])


@query(
    "S6",
    """
    WITH a AS (
        SELECT 'thing' AS dictionary, split_part(p_name, ' ', 2) AS target, split_part(p_name, ' ', 1) AS alias FROM part
    )
    SELECT 'choice' AS kind, 'client' AS dictionary, c_custkey::VARCHAR AS name, c_name AS value FROM customer
    UNION ALL SELECT 'choice', 'product', p_partkey::VARCHAR, p_name || ', ' || p_brand FROM part
    UNION ALL SELECT DISTINCT 'alias', dictionary, target, alias FROM a
    """,
)
def dictionary_folder(t: Tables):
    # A folder per dictionary: choices of clients and products, and things with indented aliases.
    root = scratch_path(t.spark, "index")
    comma = lambda *parts: F.concat_ws(",", *parts).alias("value")
    t.customer.select(comma(F.col("c_custkey"), "c_name")).write.text(f"{root}/client/choices.txt")
    product = F.concat_ws(", ", "p_name", "p_brand")
    t.part.select(comma(F.col("p_partkey"), product)).write.text(f"{root}/product/choices.txt")
    thing, alias = F.substring_index("p_name", " ", -1), F.substring_index("p_name", " ", 1)
    block = t.part.groupBy(thing.alias("thing")).agg(F.array_sort(F.collect_set(alias)).alias("aliases"))
    lines = F.concat(F.col("thing"), F.array_join(F.transform("aliases", lambda a: F.concat(F.lit("\n    "), a)), ""))
    block.select(lines.alias("value")).write.text(f"{root}/thing/aliases.txt")
    choices, aliases = R.load_dictionary(t.spark, root)
    return choices.select(
        F.lit("choice").alias("kind"), "dictionary", F.col("id").cast("string").alias("name"), F.col("name").alias("value")
    ).unionByName(
        aliases.select(F.lit("alias").alias("kind"), "dictionary", F.col("target").alias("name"), F.col("alias").alias("value"))
    )
