"""Queries on captured pages."""

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import urls as U
from ..operators import log as L
from ..operators import pages as G
from ..operators import project as P
from ..operators import sequence as Q
from ..session import scratch_path
from ..sources.export import attachment_row, export_frame
from .base import Tables, query

LINKS_SQL = r"""
    links AS (
        SELECT page_id, url AS src_url, i - 1 AS pos, hrefs[i] AS href, texts[i] AS anchor_text
        FROM (SELECT page_id, url, hrefs, texts, unnest(range(1, len(hrefs) + 1)) AS i
              FROM (SELECT page_id, url,
                           regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>[^<]*</a>', 1) AS hrefs,
                           regexp_extract_all(html, '<a\s[^>]*href="[^"]*"[^>]*>([^<]*)</a>', 1) AS texts
                    FROM pages))
    )
"""


@query(
    "P2 X11 X26 A1",
    "WITH"
    + LINKS_SQL
    + r"""
    SELECT host, count(*) AS links, count(DISTINCT src_url) AS pages
    FROM (SELECT DISTINCT src_url, href, lower(regexp_extract(src_url, '^https?://([^/?#]+)', 1)) AS host FROM links)
    GROUP BY host
    """,
)
def links_by_host(t: Tables):
    links = L.dedup(G.extract_links(t.pages).drop("anchor_text"), ["src_url", "href"], "pos")
    return (
        links.select("src_url", U.host(F.col("target")).alias("host"))
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("links"), F.count_distinct("src_url").alias("pages"))
    )


@query("P2", "WITH" + LINKS_SQL + "SELECT src_url, pos, href, trim(anchor_text) AS anchor_text FROM links")
def page_links(t: Tables):
    return G.extract_links(t.pages).drop("target").withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "P3",
    "WITH"
    + LINKS_SQL
    + r"SELECT page_id, pos, href FROM links WHERE pos > 0 AND regexp_matches(anchor_text, '^\p{Lu}')",
)
def nav_links_filtered(t: Tables):
    # All but the first link of the navigation, those whose text starts with a capital.
    links = G.extract_links(t.pages, keep=["page_id"]).where((F.col("pos") > 0) & F.col("anchor_text").rlike(r"^\p{Lu}"))
    return links.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


@query(
    "P2 X12",
    r"""
    WITH p AS (
        SELECT page_id, regexp_extract(url, '^[^:]+://[^/?#]+', 0) AS site, regexp_extract(url, '^[^:]+:', 0) AS scheme,
               regexp_extract(url, '^[^:]+://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '^[^#]*', 0) AS whole
        FROM pages
    ), f AS (SELECT *, regexp_extract(path, '^.*/', 0) AS folder FROM p)
    SELECT page_id, pos, target FROM f, LATERAL (VALUES
        (0, site || path || '?p=2&q=a%20b'), (1, site || folder || 'other'), (2, site || '/root/x?y#z'),
        (3, whole), (4, whole || '#part'), (5, scheme || '//cdn.example.org/a'),
        (6, 'mailto:a@example.org'), (7, site || regexp_replace(folder, '[^/]+/$', '') || 'up'), (8, site || folder),
        (9, site || '/b/d')) AS v(pos, target)
    """,
)
def link_targets(t: Tables):
    # Every way to write a target, quoted, single-quoted or bare, behind what every page holds.
    hrefs = ('"?p=2&amp;q=a%20b"', "'./other'", "/root/x?y#z", '""', '"#part"', "'//cdn.example.org/a'", '"mailto:a@example.org"', '"../up"', '"."', '"/a/../b/./c/../d"')
    html = "".join(f"<p><a class=x href={h}>go</a>" for h in hrefs)
    pages = t.pages.withColumn("own", F.size(H.anchors(F.col("html")))).withColumn("html", F.concat("html", F.lit(html)))
    links = G.extract_links(pages, keep=["page_id", "own"]).where("pos >= own")
    return links.select("page_id", (F.col("pos") - F.col("own")).cast("int").alias("pos"), "target")


REFERENCES = "&scaron;&eacute;&notin; &#38;lt; &copy 2020 &notit; &#x41;&#0065 &#128; &unknown; &amp;amp; a&b"


TEXT_SQL = r"""
    SELECT page_id, array_to_string(list_filter(list_transform(
        string_split(
            replace(replace(replace(replace(replace(replace(
                regexp_replace(
                    regexp_replace(
                        regexp_replace({source}, '[\r\n]', ' ', 'g'),
                        '(?i)</?(?:p|br|div|li|ul|ol|tr|table|h[1-6]|article|section|header|footer|nav|title|body|head)(?:\s[^>]*)?/?>',
                        chr(10), 'g'),
                    '<[^>]*>', ' ', 'g'),
                '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'),
            chr(10)),
        lambda line: trim(regexp_replace(line, '\s+', ' ', 'g'))), lambda line: line <> ''), chr(10) || chr(10)) AS text
    FROM pages
"""
HIDDEN_SQL = r"regexp_replace(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g')"


@query(
    "P4 X26",
    f"""
    SELECT page_id, text || chr(10) || chr(10) || lang || ' šé∉ &lt; © 2020 ¬it; AA € &unknown; &amp; a&b' AS text, true AS same
    FROM ({TEXT_SQL.format(source=HIDDEN_SQL)}) JOIN
         (SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang FROM pages) USING (page_id)
    """,
)
def decoded_references(t: Tables):
    # Both ways to the text of a page read character references alike, behind what the page holds.
    lang = F.regexp_extract("html", '<html lang="([^"]*)"', 1)
    pages = t.pages.select("page_id", F.concat("html", F.lit("<p>"), lang, F.lit(f" {REFERENCES}</p>")).alias("html"))
    other = G.extract_text_without(pages, []).withColumnRenamed("text", "other")
    both = G.extract_text(pages).join(other, "page_id")
    return both.select("page_id", "text", (F.col("text") == F.col("other")).alias("same"))


@query("P4 X26", TEXT_SQL.format(source=HIDDEN_SQL))
def page_text(t: Tables):
    return G.extract_text(t.pages)


@query(
    "P4 U2",
    TEXT_SQL.format(
        source="regexp_replace("
        + HIDDEN_SQL
        + r""", '(?is)<nav>.*?</nav>|<div class="ad">.*?</div>|<footer>.*?</footer>', '', 'g')"""
    ),
)
def article_text(t: Tables):
    return G.extract_text_without(t.dealt(t.pages), ["nav", ".ad", "footer"])


@query(
    "S3",
    """
    SELECT page_id, CASE WHEN contains(html, '</html>') THEN 'ok' ELSE 'reject' END AS outcome FROM pages
    """,
)
def valid_captures(t: Tables):
    whole, rejects = G.valid_pages(t.pages, F.col("html").contains("</html>"))
    return P.union_tagged(
        {"ok": whole.select("page_id"), "reject": rejects.select("page_id")}, "outcome"
    )


@query(
    "S3",
    """
    SELECT page_id, whole, count(*) OVER (PARTITION BY whole) AS n
    FROM (SELECT page_id, contains(html, '</html>') AND contains(html, '<title>') AS whole FROM pages)
    """,
)
def quarantined_captures(t: Tables):
    # One pass: pages are checked, written by outcome and counted together.
    check = F.col("html").contains("</html>") & F.col("html").contains("<title>")
    passed, rejects, counts = G.quarantine(t.pages, check, scratch_path(t.spark, "captures"))
    sides = ((passed, True, counts["passed"]), (rejects, False, counts["quarantined"]))
    good, bad = (df.select("page_id", F.lit(ok).alias("whole"), F.lit(n).cast("bigint").alias("n")) for df, ok, n in sides)
    return good.unionByName(bad)


@query(
    "P1 P8 X8",
    r"""
    SELECT page_id, url AS source, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
           regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
           regexp_extract(html, 'track\((\d+)\)', 1)::BIGINT AS tracked, 'captured' AS kind
    FROM pages
    """,
)
def page_fields(t: Tables):
    html = F.col("html")
    value = P.project(
        t.pages,
        F.col("page_id"),
        {
            "source": F.col("url"),
            "title": F.regexp_extract(html, r"(?is)<title[^>]*>([^<]*)</title>", 1),
            "lang": F.regexp_extract(html, r'(?is)<html\s[^>]*lang="([^"]*)"', 1),
            "tracked": F.regexp_extract(html, r"track\((\d+)\)", 1).cast("bigint"),
            "kind": F.lit("captured"),
        },
    )
    return value.select(F.col("key").alias("page_id"), "value.*")


def order_pages(t: Tables):
    """An order as a page with a label/value table; one label is repeated."""
    cell = lambda label, value: F.concat(
        F.lit(f"<tr><th>{label}</th><td> "), value, F.lit(" </td></tr>")
    )
    html = F.concat(
        F.lit("<html><body><table class=info>"),
        cell("Būsena:", F.lit("draft")),
        cell("Būsena:", F.col("o_orderstatus")),
        cell("Rūšis:", F.col("o_orderpriority")),
        cell("Kaina:", F.col("o_totalprice").cast("decimal(18,2)").cast("string")),
        F.lit("<tr><td>a<td>b<td>c</table><p>end</body></html>"),
    )
    return t.orders.select(F.col("o_orderkey").alias("page_id"), html.alias("html"))


@query(
    "P5 P8",
    """
    SELECT o_orderkey AS page_id, o_orderstatus AS status, o_orderpriority AS kind,
           CAST(o_totalprice AS DECIMAL(18, 2))::VARCHAR AS price, NULL::VARCHAR AS language
    FROM orders
    """,
)
def labelled_order_pages(t: Tables):
    kv = G.extract_kv(t.dealt(order_pages(t)))
    return G.labelled_fields(
        kv, {"status": "Būsena:", "kind": "Rūšis:", "price": "Kaina:", "language": "Kalba:"}
    )


@query(
    "P6 X22 P11",
    """
    WITH cells AS (
        SELECT c_custkey AS page_id, 2 AS row_no, c_name AS street, c_mktsegment AS species, 'f' AS sex FROM customer
        UNION ALL
        SELECT c_custkey, 3, c_nationkey::VARCHAR, CAST(c_acctbal AS DECIMAL(18, 2))::VARCHAR, 'm' FROM customer
    )
    SELECT page_id, row_no, street, species, sex,
           sha1('{"street":"' || street || '","species":"' || species || '","cls":"' || sex || 'Name"}') AS key
    FROM cells
    """,
)
def customer_table_rows(t: Tables):
    # A page per customer: a row of two cells, two of three, one of those with a link.
    html = F.concat(
        F.lit("<table><tr><td>name<td>value</tr><tr><td><a href='/x'>"),
        F.col("c_name"),
        F.lit("</a></td><td><b>"),
        F.col("c_mktsegment"),
        F.lit("</b></td><td>fName</td></tr><tr><td>"),
        F.col("c_nationkey").cast("string"),
        F.lit("<td>"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string"),
        F.lit("<td>mName</table>"),
    )
    pages = t.customer.select(F.col("c_custkey").alias("page_id"), html.alias("html"))
    rows = G.keyed_rows(G.extract_rows(t.dealt(pages), n_cells=3), ["street", "species", "cls"])
    from ..functions.text import recode

    return rows.select(
        "page_id", "row_no", "street", "species", recode(F.col("cls"), {"fName": "f", "mName": "m"}).alias("sex"), "key"
    )


@query(
    "P18 X12",
    r"""
    SELECT url AS href, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS source FROM pages
    UNION ALL
    SELECT url || '/whole', lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) FROM pages WHERE contains(html, '</html>')
    """,
)
def redirect_hops(t: Tables):
    # Every complete capture stands for a preview page that only refreshes to its whole text.
    refresh = F.when(
        F.col("html").contains("</html>"),
        F.concat(F.lit('<head><meta http-equiv="refresh" content="0;URL='), "url", F.lit('/whole"></head>')),
    ).otherwise(F.lit('<head><meta http-equiv="refresh" content="5"></head>'))
    previews = t.pages.select("url", refresh.alias("html"))
    links = t.pages.select(F.col("url").alias("href"), U.host(F.col("url")).alias("source"))
    return G.follow_redirects(previews, links)


@query(
    "A10 X23",
    """
    SELECT p_partkey, (p_size + p_partkey % 7 + 3) / 3.0 AS mean,
           greatest(p_size, p_partkey % 7, 3)::BIGINT AS max,
           CASE WHEN p_size % 5 = 0 THEN 0 ELSE least(p_size, 40, p_partkey % 9 + 1) END::INTEGER AS top,
           least(CASE WHEN p_size % 5 = 0 THEN 40 ELSE least(p_size, 40) END, p_partkey % 9 + 1)::INTEGER AS best_rank
    FROM part
    """,
)
def name_popularity(t: Tables):
    # Ranks by year out of order and partly blank, values in year order, as the script holds them.
    rank = F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(F.col("p_size").cast("string"))
    html = F.concat(
        F.lit('<script>var tops = {"2012":"40","2010":"'),
        rank,
        F.lit('","2011":"'),
        (F.col("p_partkey") % 9 + 1).cast("string"),
        F.lit('"}; chart({data: ['),
        F.concat_ws(",", F.col("p_size").cast("string"), (F.col("p_partkey") % 7).cast("string"), F.lit("3")),
        F.lit("]})</script>"),
    )
    pages = t.part.select("p_partkey", html.alias("html"))
    # How the page script assigns its two literals.
    tops, data = r"var tops = (\{[^}]+\});", r"data: (\[[^\]]+\])"
    ranks = H.script_json(F.col("html"), tops, "map<string,string>")
    values = H.script_json(F.col("html"), data, "array<bigint>")
    series = pages.select("p_partkey", F.inline(Q.popularity(ranks, values)))
    return Q.series_stats(series, ["p_partkey"], "value", "rank")


@query(
    "X14 X15 S9",
    """
    SELECT doc_id::VARCHAR AS "attachment-url", source AS "question-url", strlen(text) AS size,
           CASE WHEN lang <> 'de' THEN source || ' nr ' || doc_id || '.v1.pdf' END AS filename,
           CASE WHEN lang <> 'de' THEN '.pdf' END AS ext, 'application/pdf' AS "content-type"
    FROM documents
    """,
)
def attachment_list(t: Tables):
    disposition = F.concat(
        F.lit('attachment; filename="'), F.col("source"), F.lit(" nr "), F.col("doc_id").cast("string"), F.lit('.v1.pdf"')
    )
    plain = F.create_map(F.lit("Content-Type"), F.lit("application/pdf"))
    full = F.create_map(
        F.lit("Content-Type"), F.lit("application/pdf"), F.lit("Content-Disposition"), disposition
    )
    captures = t.documents.select(
        F.col("doc_id").cast("string").alias("key"),
        F.col("source").alias("question"),
        F.when(F.col("lang") == "de", plain).otherwise(full).alias("headers"),
        F.encode("text", "UTF-8").alias("content"),
    )
    row = attachment_row(F.col("key"), F.col("question"), F.col("headers"), F.col("content"))
    out = export_frame(captures, computed=row, replace=True)
    return out.withColumn("size", F.col("size").cast("bigint"))
