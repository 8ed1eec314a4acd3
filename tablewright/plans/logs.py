"""Queries on keyed logs."""

from pyspark.sql import functions as F

from ..operators import log as L
from ..operators import project as P
from ..operators.graph import Closure, reachable
from ..operators.pages import extract_links
from ..session import scratch_path
from ..sources import tables as S
from .base import Tables, query


@query(
    "A1",
    """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1
    """,
)
def first_event_per_user(t: Tables):
    return L.dedup(t.events.select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


@query(
    "A2",
    """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
    """,
)
def last_event_per_user(t: Tables):
    return L.compact(t.events.select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


@query(
    "A3",
    """
    SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
           arg_max(value, event_id) FILTER (WHERE event_id % 2 = 0) AS value,
           arg_max(props, event_id) FILTER (WHERE event_id % 2 = 1) AS props
    FROM events GROUP BY user_id
    """,
)
def merge_partial_records(t: Tables):
    even = F.col("event_id") % 2 == 0
    partial = t.events.select(
        "user_id",
        "event_id",
        "event_type",
        F.when(even, F.col("value")).alias("value"),
        F.when(~even, F.col("props")).alias("props"),
    )
    return L.merge_records(partial, "user_id", "event_id")


@query(
    "A11 U3",
    """
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date
    FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1
    """,
)
def latest_order(t: Tables):
    orders = t.orders.select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date")
    )
    return orders.transform(L.latest, "order_date", "o_orderkey")


@query(
    "A11 U3",
    """
    WITH log AS (SELECT o_custkey AS key, o_orderkey AS seq, strftime(o_orderdate, '%Y-%m-%d') AS begun FROM orders)
    SELECT key, seq, begun FROM log
    UNION ALL
    SELECT * FROM (SELECT key, (SELECT max(seq) + 1 FROM log), begun FROM log ORDER BY begun DESC, seq LIMIT 1)
    """,
)
def requeue_latest_session(t: Tables):
    log = t.orders.select(
        F.col("o_custkey").alias("key"),
        F.col("o_orderkey").alias("seq"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("begun"),
    )
    return L.requeue_latest(log, "begun")


@query(
    "A13",
    "SELECT lang, source, count(*) AS rows, count(*) > 0 AS is_filled FROM documents GROUP BY lang, source",
)
def filled_by_source(t: Tables):
    return L.filled(t.documents, ["lang", "source"])


@query(
    "A14",
    r"""
    SELECT DISTINCT lower(regexp_extract(line, '[^\s]+')) AS word
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '[^\s]')
    """,
)
def distinct_first_words(t: Tables):
    # The first word of every line.
    lines = t.documents.select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(r"[^\s]"))
    return L.distinct_values(lines, F.lower(F.regexp_extract("line", r"[^\s]+", 0)), "word")


@query(
    "T6",
    """
    SELECT event_id, user_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY
    """,
)
def retain_recent(t: Tables):
    return L.retain(
        t.events, "ts", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"), F.expr("INTERVAL 7 DAYS")
    ).select("event_id", "user_id", "event_type")


@query(
    "J13",
    """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    """,
)
def unprocessed_orders(t: Tables):
    done = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return L.unprocessed(t.orders.select("o_orderkey", "o_orderstatus"), done, "o_orderkey")


@query(
    "T5",
    """
    SELECT l_suppkey AS key FROM lineitem WHERE l_returnflag = 'R'
    UNION SELECT s_suppkey FROM supplier
    """,
)
def mark_suppliers_seen(t: Tables):
    processed = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("key"))
    return L.mark_seen(processed, t.supplier.select(F.col("s_suppkey").alias("key")))


@query(
    "S3 P9",
    """
    SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'quality,toxic' END AS missing
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """,
)
def required_labels(t: Tables):
    labelled = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    whole, rejects = L.split_required(labelled, ["quality", "toxic"])
    return whole.select("doc_id", F.lit(None).cast("string").alias("missing")).unionByName(
        rejects.select("doc_id", F.array_join("missing", ",").alias("missing"))
    )


@query(
    "S1 S2 A2",
    """
    SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (
        PARTITION BY user_id ORDER BY event_type IN ('click', 'view'), event_id DESC) = 1
    """,
)
def append_and_compact(t: Tables):
    path = scratch_path(t.spark, "log")
    events = t.events.select("user_id", "event_id", "event_type")
    early = F.col("event_type").isin("click", "view")
    S.append_log(events.where(early), path, "event_id")
    S.append_log(events.where(~early), path, "event_id")
    return L.compact(S.read_log(t.spark, path), "user_id", "seq").select("user_id", "event_id", "event_type")


@query(
    "A4 A5",
    """
    SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS reason, 'open' AS term FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT o_orderkey, o_totalprice, o_orderpriority, 'ended' FROM orders WHERE o_orderstatus <> 'O'
    """,
)
def union_terms(t: Tables):
    current = t.orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice")
    ended = t.orders.where("o_orderstatus <> 'O'").select(
        "o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("reason")
    )
    return P.union_tagged({"open": current, "ended": ended}, "term")


REACHED_SQL = r"""
    WITH RECURSIVE nav AS (
        SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS hrefs FROM pages
    ), chain AS (
        SELECT page_id, i, hrefs[i] AS src, hrefs[i + 1] AS dst
        FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs))) AS i FROM nav)
    ), walk(node) AS (
        SELECT hrefs[1] FROM nav
        JOIN pages USING (page_id) WHERE regexp_matches(url, '^https?://[^/]*\.org/')
        UNION
        SELECT dst FROM walk JOIN chain ON src = node
    )
    SELECT DISTINCT node FROM walk WHERE node IS NOT NULL
"""


def page_chains(t: Tables):
    """The chain of each page's links, and its first link where the page is one of .org."""
    links = extract_links(t.pages, keep=["page_id"]).select("page_id", "src_url", "pos", "href")
    following = links.select("page_id", (F.col("pos") - 1).alias("pos"), F.col("href").alias("dst"))
    chain = links.join(following, ["page_id", "pos"]).select("page_id", F.col("href").alias("src"), "dst")
    seeds = links.where((F.col("pos") == 0) & F.col("src_url").rlike(r"^https?://[^/]*\.org/"))
    return chain, seeds.select("page_id", F.col("href").alias("node"))


@query("T7 J13", REACHED_SQL)
def reachable_links(t: Tables):
    # The chain of a page's links, followed from the first links of .org pages.
    chain, seeds = page_chains(t)
    return reachable(chain, seeds.select("node")).select("node")


@query("T7", REACHED_SQL)
def extended_links(t: Tables):
    # The even pages come first; the odd ones extend what was reached from them.
    chain, seeds = page_chains(t)
    closure = Closure(t.spark)
    for part in ("page_id % 2 = 0", "page_id % 2 = 1"):
        closure.extend(chain.where(part), seeds.where(part).select("node"))
    return closure.nodes().select("node")


@query(
    "T8 S1",
    """
    SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id
    """,
)
def refreshed_table(t: Tables):
    # A table, then its latest rows in its own place.
    path = scratch_path(t.spark, "latest")
    S.overwrite_table(t.events.select("user_id", "event_id", "event_type"), path)
    S.overwrite_table(L.compact(t.spark.read.parquet(path), "user_id", "event_id"), path)
    return t.spark.read.parquet(path)


@query(
    "T6 S2",
    """
    SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 20 DAY
    """,
)
def cleaned_log(t: Tables):
    path = scratch_path(t.spark, "log")
    S.append_log(t.events.select("event_id", "user_id", "ts"), path)
    S.clean_log(t.spark, path, "ts", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"), F.expr("INTERVAL 20 DAYS"))
    return S.read_log(t.spark, path).drop("seq")


@query(
    "U4 P12",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IN ('R', 'A') THEN l_linestatus END AS content FROM lineitem
    """,
)
def nested_line_hook(t: Tables):
    # The lines of an order as one list; a hook adds a field to those with a listed code.
    line = F.struct("l_linenumber", "l_returnflag", "l_linestatus")
    orders = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    content = lambda x: F.when(x["l_returnflag"].isin("R", "A"), x["l_linestatus"])
    hooked = P.in_list(orders, "lines", lambda x: x.withField("content", content(x)))
    return hooked.select("l_orderkey", F.inline("lines")).select("l_orderkey", "l_linenumber", "content")
