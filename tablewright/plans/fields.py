"""Queries on projections and cleaning expressions."""

from pyspark.sql import functions as F

from ..functions import company as C
from ..functions import dates as D
from ..functions import geo
from ..functions import html as H
from ..functions import keys as K
from ..functions import text as X
from ..functions import urls as U
from ..operators import joins as J
from ..operators import project as P
from ..operators import resolve as R
from ..operators import sequence as Q
from .base import Tables, query


@query(
    "S8 P17",
    """
    SELECT l_orderkey, l_linenumber, o_orderdate AS "order.date", o_orderpriority AS "order.priority"
    FROM (SELECT l_orderkey, l_linenumber, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
          FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)
    """,
)
def lines_with_order(t: Tables):
    order = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.struct(
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderpriority").alias("priority")
        ).alias("order"),
    )
    lines = P.with_parent(t.lineitem.select("l_orderkey", "l_linenumber"), order, "l_orderkey", ["order"])
    return P.flatten(lines, ["l_orderkey", "l_linenumber", "order.date", "order.priority"])


@query(
    "X23 P9 P11 X25",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'use' WHEN 'view' THEN 'use' WHEN 'error' THEN 'fault'
                     ELSE event_type END AS kind,
           coalesce(CAST(json_extract(props, '$.amount') AS INTEGER), CAST(json_extract(props, '$.k') AS INTEGER), -1) AS k
    FROM events
    """,
)
def event_prop_recode(t: Tables):
    props = F.from_json("props", "k int, amount int")
    return t.events.select(
        "event_id",
        X.recode(F.col("event_type"), {"click": "use", "view": "use", "error": "fault"}).alias("kind"),
        F.coalesce(props["amount"], props["k"], F.lit(-1)).alias("k"),
    )


@query(
    "P9",
    """
    SELECT event_id,
           CASE WHEN event_type = 'purchase' THEN 'sale' WHEN value > 10 THEN 'large' ELSE 'plain' END AS shape,
           CASE WHEN event_type = 'purchase' THEN value WHEN value > 10 THEN NULL ELSE NULL END AS amount,
           CASE WHEN event_type = 'purchase' THEN NULL WHEN value > 10 THEN event_type ELSE 'none' END AS note
    FROM events
    """,
)
def complete_alternative(t: Tables):
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    large = F.when(F.col("value") > 10, F.col("event_type"))
    nothing, no_amount = F.lit(None).cast("string"), F.lit(None).cast("double")
    chosen = P.first_complete(
        {"shape": (F.lit("sale"), True), "amount": (bought, True), "note": (nothing, False)},
        {"shape": (F.lit("large"), True), "amount": (no_amount, False), "note": (large, True)},
        {"shape": (F.lit("plain"), True), "amount": (no_amount, False), "note": (F.lit("none"), True)},
    )
    return t.events.select("event_id", chosen.alias("c")).select("event_id", "c.*")


@query(
    "P10",
    """
    SELECT p_partkey,
           CASE WHEN p_partkey = 1 THEN 9.99 WHEN p_partkey = 2 THEN NULL
                WHEN s_suppkey IS NOT NULL THEN s_acctbal ELSE round(p_retailprice * 1.21, 4) END AS price
    FROM part LEFT JOIN supplier ON p_partkey = s_suppkey
    """,
)
def override_prices(t: Tables):
    # The chain is computed first; supplier corrections, then two by hand, are laid on last.
    computed = t.part.select("p_partkey", F.round(F.col("p_retailprice") * 1.21, 4).alias("price"))
    corrections = t.supplier.select(F.col("s_suppkey").alias("p_partkey"), F.col("s_acctbal").alias("price"))
    corrected = P.apply_overrides(computed, corrections, "p_partkey", "price")
    return P.apply_overrides(corrected, {1: 9.99, 2: None}, "p_partkey", "price")


@query(
    "P12",
    """
    SELECT event_id, event_type, CASE WHEN event_type IN ('click', 'view') THEN props END AS download FROM events
    """,
)
def conditional_download(t: Tables):
    rows = t.events.select("event_id", "event_type", "props")
    return P.conditional_column(
        rows, "download", F.col("event_type"), ["click", "view"], F.col("props")
    ).drop("props")


@query(
    "P14",
    """
    SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL
                           WHEN p_size % 4 = 1 THEN '/a/' || p_partkey || '/MSO2010_DOCX/'
                           WHEN p_size % 4 = 2 THEN '/a/' || p_partkey || '/MSO2003_DOC/'
                           ELSE '/a/' || p_partkey || '/PDF/' END AS attachment
    FROM part
    """,
)
def preferred_format(t: Tables):
    link = lambda kind: F.concat(F.lit("/a/"), F.col("p_partkey").cast("string"), F.lit(f"/{kind}/"))
    kinds = F.col("p_size") % 4
    links = (
        F.when(kinds == 0, F.array().cast("array<string>"))
        .when(kinds == 1, F.array(link("PDF"), link("MSO2003_DOC"), link("MSO2010_DOCX")))
        .when(kinds == 2, F.array(link("PDF"), link("MSO2003_DOC")))
        .otherwise(F.array(link("PDF"), link("ODT")))
    )
    chosen = P.prefer(links, ["MSO2010_DOCX", "MSO2003_DOC"], lambda c: P.path_segment_from_end(c, 2))
    return t.part.select("p_partkey", chosen.alias("attachment"))


@query(
    "P15",
    """
    SELECT event_id, k, v
    FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS k,
                 CASE WHEN event_id % 3 > 0 THEN props END AS v FROM events)
    WHERE NOT (k IS NULL AND v IS NULL) AND NOT (k IS NOT DISTINCT FROM 'view' AND v IS NULL)
    """,
)
def pair_exclusion(t: Tables):
    pairs = t.events.select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("k"),
        F.when(F.col("event_id") % 3 > 0, F.col("props")).alias("v"),
    )
    return P.exclude_pairs(pairs, "k", "v", [("view", None)])


def declarations(t: Tables):
    """Per customer a declaration of three sections of ordered label/value pairs."""
    pair = lambda k, v: F.struct(F.lit(k).alias("k"), v.cast("string").alias("v"))
    name = F.concat(F.lit('Uždaroji akcinė bendrovė "'), F.col("c_name"), F.lit('"'))
    deals = F.array(
        pair("Sandoris", F.lit(None)),
        pair("Sandorį sudaręs asmuo", F.col("c_name")),
        pair("Kitos sandorio salies pavadinimas", name),
        pair("Sandorio suma Lt", F.col("c_custkey") * 100),
        pair("Sandorį sudaręs asmuo", F.col("c_mktsegment")),
        pair("Kitos sandorio salies pavadinimas", F.lit("Swedbank lizingas, AB")),
        pair("Sandorio suma Lt", F.lit("")),
        pair("Sandorio suma Lt", F.lit("345.28")),
    )
    ties = F.array(
        pair("Pastaba", F.lit("be asmens")),
        pair("Asmuo, kurio ryšys nurodomas", F.col("c_name")),
        pair("Juridinio asmens pavadinimas", F.lit("x")),
    )
    other = F.array(pair("tyla", F.lit(None)), pair("kalba", F.lit("q")))
    entry = lambda kind, pairs: F.struct(F.lit(kind).alias("kind"), pairs.alias("pairs"))
    return t.customer.select(
        F.col("c_custkey").alias("key"),
        F.array(
            entry("SANDORIAI", deals),
            entry("RYŠIAI SU JURIDINIAIS ASMENIMIS", ties),
            entry("KITI DUOMENYS", other),
        ).alias("entries"),
    )


@query(
    "P16 W1 X4 X5 P15",
    """
    SELECT c_custkey AS key, r.run, r.k,
           CASE r.v WHEN '$name' THEN c_name WHEN '$segment' THEN c_mktsegment
                    WHEN '$original' THEN 'Uždaroji akcinė bendrovė "' || c_name || '"'
                    WHEN '$clean' THEN upper(replace(c_name, '#', ' '))
                    WHEN '$eur' THEN round(c_custkey * 100 / 3.4528, 4)::DOUBLE::VARCHAR ELSE r.v END AS v
    FROM customer, (VALUES
        (1, 'Sandorį sudaręs asmuo', '$name'),
        (1, 'Kitos sandorio salies pavadinimas', '$clean'),
        (1, 'Kitos sandorio salies pavadinimas (originalus)', '$original'),
        (1, 'Sandorio suma Eur', '$eur'),
        (2, 'Sandorį sudaręs asmuo', '$segment'),
        (2, 'Kitos sandorio salies pavadinimas', 'SWEDBANK BANKAS'),
        (2, 'Kitos sandorio salies pavadinimas (originalus)', 'Swedbank lizingas, AB'),
        (2, 'Sandorio suma Eur', '100.0')) AS r(run, k, v)
    """,
)
def declared_deals(t: Tables):
    pairs = P.sections(declarations(t), "entries", "SANDORIAI", ["key"])
    records = Q.fold_kv_runs(
        Q.declaration_pairs(pairs), ["key", "entry"], "Sandorį sudaręs asmuo", skip=[("Sandoris", None)]
    )
    rows = records.select("key", F.col("run").cast("int").alias("run"), F.explode("record").alias("k", "v"))
    amount = F.round(F.col("v").try_cast("double"), 4).cast("string")
    return rows.withColumn("v", F.when(F.col("k") == "Sandorio suma Eur", amount).otherwise(F.col("v")))


@query(
    "P16 W1",
    """
    SELECT c_custkey AS key, r.run, r.k, CASE r.v WHEN '$name' THEN c_name ELSE r.v END AS v
    FROM customer, (VALUES (0, 'Pastaba', 'be asmens'), (1, 'Asmuo, kurio ryšys nurodomas', '$name'),
                           (1, 'Juridinio asmens pavadinimas', 'NEVIEŠINAMA'),
                           (1, 'Juridinio asmens pavadinimas (originalus)', 'x')) AS r(run, k, v)
    """,
)
def declared_ties(t: Tables):
    pairs = P.sections(declarations(t), "entries", "RYŠIAI SU JURIDINIAIS ASMENIMIS", ["key"])
    records = Q.fold_kv_runs(Q.declaration_pairs(pairs), ["key", "entry"], "Asmuo, kurio ryšys nurodomas")
    return records.select("key", F.col("run").cast("int").alias("run"), F.explode("record").alias("k", "v"))


@query("P16", "SELECT c_custkey AS key, k.other FROM customer, (VALUES ('tyla'), ('kalba')) AS k(other)")
def declared_other(t: Tables):
    return P.section_keys(declarations(t), "entries", "KITI DUOMENYS", ["key"]).select("key", "other")


@query(
    "X1 X2",
    r"""
    SELECT doc_id, lower(trim(regexp_replace(text, '[^\p{L}\p{N}_]+', ' ', 'g'))) AS norm,
           array_to_string(list_transform(regexp_extract_all(text, '\p{L}+|[^\p{L}]+'),
               lambda w: upper(w[1]) || lower(w[2:])), '') AS title
    FROM (SELECT doc_id, replace(text, 'ß', 'ss') AS text FROM documents)
    """,
)
def normalise_names(t: Tables):
    docs = t.documents.select("doc_id", F.replace("text", F.lit("ß"), F.lit("ss")).alias("text"))
    return docs.select("doc_id", X.normalise(F.col("text")).alias("norm"), X.title_case(F.col("text")).alias("title"))


@query(
    "X4",
    r"""
    WITH raw AS (
        SELECT c_custkey, CASE c_custkey % 6
            WHEN 0 THEN 'UAB "' || c_name || '"'
            WHEN 1 THEN 'Uždaroji akcinė  bendrovė «' || c_mktsegment || '», Vilniaus skyrius'
            WHEN 2 THEN 'AB Swedbank lizingas'
            WHEN 3 THEN 'Viešoji įstaiga ' || c_mktsegment || ' f-kas'
            WHEN 4 THEN 'Lietuvos Respublikos ' || c_name
            ELSE 'x' END AS name
        FROM customer
    ), bare AS (
        SELECT c_custkey, trim(regexp_replace(upper(name), '[^\p{L}\p{N}_]+', ' ', 'g')) AS name FROM raw
    ), short AS (
        SELECT c_custkey, replace(replace(replace(replace(replace(name,
            'VIEŠOJI ĮSTAIGA', 'VĮ'), 'UŽDAROJI AKCINĖ BENDROVĖ', 'UAB'), 'LIETUVOS RESPUBLIKOS', 'LR'),
            'VILNIAUS SKYRIUS', ''), 'F KAS', 'FABRIKAS') AS name FROM bare
    ), kept AS (
        SELECT c_custkey, array_to_string(list_filter(string_split(name, ' '),
            lambda w: w NOT IN ('', 'AB', 'UAB', 'UADB', 'VŠĮ', 'LR', 'VĮ', 'AS', 'ASO')), ' ') AS name FROM short
    )
    SELECT c_custkey, CASE name WHEN 'SWEDBANK LIZINGAS' THEN 'SWEDBANK BANKAS' WHEN 'X' THEN 'NEVIEŠINAMA'
                      ELSE name END AS company FROM kept
    """,
)
def clean_companies(t: Tables):
    kind = F.col("c_custkey") % 6
    name = (
        F.when(kind == 0, F.concat(F.lit('UAB "'), "c_name", F.lit('"')))
        .when(kind == 1, F.concat(F.lit("Uždaroji akcinė  bendrovė «"), "c_mktsegment", F.lit("», Vilniaus skyrius")))
        .when(kind == 2, F.lit("AB Swedbank lizingas"))
        .when(kind == 3, F.concat(F.lit("Viešoji įstaiga "), "c_mktsegment", F.lit(" f-kas")))
        .when(kind == 4, F.concat(F.lit("Lietuvos Respublikos "), "c_name"))
        .otherwise(F.lit("x"))
    )
    return t.customer.select("c_custkey", C.clean_company(name).alias("company"))


@query(
    "X5 X25",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL
                            ELSE round(CAST(o_totalprice AS DECIMAL(18, 2))::DOUBLE / 3.4528, 4) END AS eur
    FROM orders
    """,
)
def litas_to_euro(t: Tables):
    lt = F.when(F.col("o_orderstatus") == "P", F.lit(" ")).otherwise(
        F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    )
    return t.orders.select("o_orderkey", F.round(C.lt_to_eur(lt), 4).alias("eur"))


@query("X6 X7 X8", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS born FROM orders")
def long_dates(t: Tables):
    # Orders' dates written out in four shapes with scanning damage, and read back.
    month = F.element_at(F.array(*[F.lit(m) for m in D.MONTHS]), F.month("o_orderdate"))
    year = F.replace(F.year("o_orderdate").cast("string"), F.lit("1"), F.lit("l"))
    year = F.replace(year, F.lit("00"), F.lit("O0"))
    day = F.dayofmonth("o_orderdate").cast("string")
    day = F.when(F.length(day) == 2, F.translate(day, "10", "lO")).otherwise(day)
    shape = F.col("o_orderkey") % 4
    written = (
        F.when(shape == 0, F.concat_ws(" ", F.lit("Gimė"), year, F.lit("m."), month, day, F.lit("d. Vilniuje.")))
        .when(shape == 1, F.concat_ws(" ", F.lit("Gime"), year, month, day, F.lit("d.")))
        .when(shape == 2, F.concat(F.lit("Biografija. Gimė "), year, F.lit("m. "), month, F.lit(" "), day, F.lit("d. Kaune")))
        .otherwise(F.concat(F.lit("Gimė "), F.date_format("o_orderdate", "yyyy MM dd")))
    )
    # Fixed value: how a biography states a birth date.
    birth = r"Gim[eė] (\d{4} \d{2} \d{2}|\d{4} m\. \p{L}+ \d+ d\.|\d{4} \p{L}+ \d+ d\.)"
    found = X.first_group(D.repair_digits(written), birth)
    return t.orders.select("o_orderkey", D.long_date_to_iso(found).alias("born"))


@query(
    "X11 X12",
    r"""
    SELECT page_id, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path,
           TRY_CAST(NULLIF(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS BIGINT) AS page,
           'http://www.example.org/l.php?tmpl_into%5B0%5D=index&m=8&itemID=' || page_id || '&q=a+b%2A~'
             || '&host=' || lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS built
    FROM pages
    """,
)
def url_fields(t: Tables):
    url = F.col("url")
    built = U.build_url(
        "http://www.example.org/l.php?",
        [
            ("tmpl_into[0]", F.lit("index")),
            ("m", F.lit(8)),
            ("itemID", F.col("page_id")),
            ("q", F.lit("a b*~")),
            ("host", U.host(url)),
        ],
    )
    return t.pages.select("page_id", U.path(url).alias("path"), U.query_int(url, "page").alias("page"), built.alias("built"))


@query(
    "X9 X10",
    """
    SELECT p_partkey, p_name || ', ' || split_part(p_brand, '#', 1) AS unit, split_part(p_brand, '#', 2) AS duty,
           split_part(p_brand, '#', 2) AS strict, NULL::VARCHAR AS safe
    FROM part
    """,
)
def split_fields(t: Tables):
    text = F.concat("p_name", F.lit(", "), "p_brand")
    return t.part.select(
        "p_partkey",
        X.rsplit_once(text, "#", 0).alias("unit"),
        X.rsplit_once(text, "#", 1).alias("duty"),
        X.split_part_strict(F.col("p_brand"), "#", 1).alias("strict"),
        X.split_part_safe(F.col("p_brand"), "#", 2).alias("safe"),
    )


@query(
    "X16 U2",
    """
    SELECT c_custkey, c_custkey::VARCHAR AS id, c_name AS name FROM customer
    UNION ALL SELECT c_custkey, 'n' || c_nationkey, c_mktsegment || ' g.' FROM customer
    """,
)
def packed_streets(t: Tables):
    packed = F.concat(
        F.col("c_custkey").cast("string"), F.lit("###<b>"), "c_name", F.lit("</b>| |n"),
        F.col("c_nationkey").cast("string"), F.lit("###"), "c_mktsegment", F.lit(" <b>g.</b>|"),
    )
    return t.customer.select("c_custkey", F.inline(X.packed_items(packed)))


@query(
    "X17",
    """
    SELECT doc_id, CASE WHEN lang <> 'de' THEN lang END AS lang,
           CASE WHEN lang <> 'de' THEN source || ':' || doc_id ELSE source END AS title
    FROM documents
    """,
)
def tagged_titles(t: Tables):
    tagged = F.when(
        F.col("lang") != "de", F.concat_ws(":", "lang", "source", F.col("doc_id").cast("string"))
    ).otherwise(F.col("source"))
    lang, title = X.tagged_title(tagged)
    return t.documents.select("doc_id", lang.alias("lang"), title.alias("title"))


@query(
    "X18 X19",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS party,
           CASE c_custkey % 3 WHEN 0 THEN 'A. Keliautojas|KLM' WHEN 1 THEN 'A. Keliautojas' END AS others,
           CASE WHEN c_custkey % 3 = 2 THEN 'Ačiū (a, b). ' || c_name ELSE c_name END AS rest
    FROM customer
    """,
)
def bracket_lists(t: Tables):
    kind = F.col("c_custkey") % 3
    said = (
        F.when(kind == 0, F.concat(F.lit(" (A. Keliautojas\u00a0, "), "c_mktsegment", F.lit(",\nKLM) .\n"), "c_name"))
        .when(kind == 1, F.concat(F.lit("(A. Keliautojas). "), "c_name"))
        .otherwise(F.concat(F.lit("Ačiū (a, b). "), "c_name"))
    )
    items = X.bracket_items(said)
    return t.customer.select(
        "c_custkey",
        X.first_acronym(items).alias("party"),
        F.when(items.isNotNull(), F.array_join(X.without_first_acronym(items), "|")).alias("others"),
        X.bracket_rest(said).alias("rest"),
    )


@query(
    "X20 X24",
    """
    SELECT o_orderkey, (o_orderkey % 24) || ':' || printf('%02d', o_orderkey % 60) AS clock,
           strftime(o_orderdate, '%Y-%m-%d') || 'T' || printf('%02d', o_orderkey % 24) || '-00' AS forecast
    FROM orders
    """,
)
def clock_texts(t: Tables):
    hour, minute = F.col("o_orderkey") % 24, F.col("o_orderkey") % 60
    spoken = F.format_string("%d.%02d val.", hour, minute)
    stamp = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.format_string("-%02d-00", hour))
    return t.orders.select("o_orderkey", X.clock(spoken).alias("clock"), D.forecast_time(stamp).alias("forecast"))


@query(
    "X21",
    """
    SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'PIRMININKĖ' WHEN 1 THEN 'PIRMININKAS.' WHEN 2 THEN 'PIRMININKAS'
                      WHEN 3 THEN 'A. B. ' || upper(substr(s_name, 1, 8)) END AS head
    FROM supplier
    """,
)
def emphasis_heads(t: Tables):
    kind = F.col("s_suppkey") % 5
    written = (
        F.when(kind == 0, F.concat(F.lit("PIRMININKĖ ("), "s_name"))
        .when(kind == 1, F.lit(" PIRMININKAS."))
        .when(kind == 2, F.lit("PIRMININKAS (A. KELIAUTOJAS, KLM)."))
        .when(kind == 3, F.concat(F.lit("A. B. "), F.upper("s_name")))
        .otherwise(F.lit("Svarstymas"))
    )
    return t.supplier.select("s_suppkey", X.emphasis_head(written).alias("head"))


@query(
    "X27 A8",
    """
    SELECT p_partkey, p_name AS parish, 1800 + p_size AS start,
           CASE WHEN p_size % 2 = 0 THEN 1820 + p_size ELSE 1860 + p_size END AS end,
           CASE WHEN p_size % 2 = 0 THEN 20 ELSE 30 END AS duration
    FROM part
    """,
)
def parish_books(t: Tables):
    year = lambda n: (F.col("p_size") + n).cast("string")
    title = F.concat(
        "p_name",
        F.lit(" RKB gimimo metrikų knyga "),
        F.when(
            F.col("p_size") % 2 == 0,
            F.concat(year(1810), F.lit("–"), year(1820), F.lit(" m., "), year(1800), F.lit("-"), year(1810), F.lit(" m.")),
        ).otherwise(
            F.concat(
                year(1800), F.lit("--"), year(1805), F.lit(" m., "), year(1803), F.lit("-"), year(1810), F.lit(" m., "),
                year(1815), F.lit(" m., "), year(1840), F.lit("–"), year(1860), F.lit(" m."),
            )
        ),
    )
    books = t.part.select("p_partkey", title.alias("title"))
    ranges = books.select("p_partkey", F.inline(D.title_year_ranges(F.col("title"))))
    totals = Q.interval_totals(Q.merge_intervals(ranges, ["p_partkey"], "lo", "hi"), ["p_partkey"])
    out = books.select("p_partkey", D.title_place(F.col("title")).alias("parish")).join(totals, "p_partkey", "left")
    return out.select("p_partkey", "parish", *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in ("start", "end", "duration")])


@query("X13 U1", "SELECT p_partkey, p_name || ' ąžuolė' AS name FROM part")
def plain_names(t: Tables):
    # Tone marks after the first letter of the name, and on letters with marks of their own.
    marked = F.concat(
        F.substring("p_name", 1, 1), F.lit("́"), F.expr("substring(p_name, 2)"), F.lit(" ąžùolė̃")
    )
    return t.part.select("p_partkey", X.strip_tone_accents(marked).alias("name"))


@query(
    "X28 X29 P9 P11",
    """
    SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 2007 WHEN 1 THEN 2011 ELSE 2015 END AS term,
           CASE WHEN c_custkey % 3 = 2 THEN c_custkey % 2 = 0 END AS mayor,
           CASE WHEN c_custkey % 3 < 2 AND c_custkey % 2 = 0 THEN c_name || ' (MERAS)' ELSE c_name END AS name,
           CASE WHEN c_nationkey % 2 = 0 THEN '2010-01-01'
                ELSE CASE c_custkey % 3 WHEN 0 THEN '2007-03-04' WHEN 1 THEN '2011-02-27' END END AS since,
           CASE WHEN c_nationkey = 3 THEN 'Palangos miesto savivaldybės taryba' ELSE 'Nr ' || c_nationkey END AS council
    FROM customer
    """,
)
def council_members(t: Tables):
    # The day a mandate of each term begins, and one council's full name.
    begins = {2007: "2007-03-04", 2011: "2011-02-27"}
    councils = {"Palangos savivaldybės taryba": "Palangos miesto savivaldybės taryba"}
    term = F.element_at(F.array(F.lit(2007), F.lit(2011), F.lit(2015)), (F.col("c_custkey") % 3 + 1).cast("int"))
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit(" (MERAS)"))).otherwise(F.col("c_name"))
    mayor, bare = J.mayor_flag(name, term)
    since = F.when(F.col("c_nationkey") % 2 == 0, F.lit("2010-01-01")).otherwise(F.lit(" "))
    council = F.when(F.col("c_nationkey") == 3, F.lit("Palangos savivaldybės taryba")).otherwise(
        F.concat(F.lit("Nr "), F.col("c_nationkey").cast("string"))
    )
    return t.customer.select(
        "c_custkey",
        term.alias("term"),
        mayor.alias("mayor"),
        bare.alias("name"),
        D.term_default(since, term, begins).alias("since"),
        X.recode(council, councils).alias("council"),
    )


LON = "(20.9 + (c_custkey * 7919 % 10007) * 0.0006)"
LAT = "(53.9 + (c_custkey * 104729 % 10009) * 0.00025)"


@query(
    "X30",
    f"""
    SELECT c_custkey, round(radians({LON}) * 6378137.0, 3) AS x,
           round(ln(tan(pi() / 4 + radians({LAT}) / 2)) * 6378137.0, 3) AS y
    FROM customer
    """,
)
def mercator_points(t: Tables):
    points = t.customer.select("c_custkey", F.expr(LON).cast("double").alias("lon"), F.expr(LAT).cast("double").alias("lat"))
    return points.select(
        "c_custkey",
        F.round(geo.mercator_x(F.col("lon")), 3).alias("x"),
        F.round(geo.mercator_y(F.col("lat")), 3).alias("y"),
    )


@query(
    "X31",
    """
    SELECT c_custkey, (c_custkey % 100 + (c_nationkey + 1) / 2.0)::DOUBLE AS x,
           (c_custkey % 7 + 1.5)::DOUBLE AS y
    FROM customer
    """,
)
def centroids(t: Tables):
    # A box of width nation + 1 and height 3 per customer, its corners in order.
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x, y = F.col("c_custkey") % 100, F.col("c_custkey") % 7
    w = F.col("c_nationkey") + 1
    ring = F.array(point(x, y), point(x + w, y), point(x + w, y + 3), point(x, y + 3))
    shapes = t.customer.select("c_custkey", geo.ring_edges(ring).alias("edges"))
    cx, cy = geo.centroid(F.col("edges"))
    return shapes.select("c_custkey", F.round(cx, 6).alias("x"), F.round(cy, 6).alias("y"))


@query(
    "X3 X2",
    """
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(left(p_name, 1)) || lower(substr(split_part(p_name, ' ', 1), 2))
                           || ' ' || upper(left(split_part(p_name, ' ', 2), 1)) || lower(substr(split_part(p_name, ' ', 2), 2))
                      ELSE 'ne ' || p_name || 'as' END AS value
    FROM part
    """,
)
def inflected_names(t: Tables):
    # Half the names are inflected forms the dictionary knows; the others are not and stay.
    forms = t.part.select(
        F.concat("p_name", F.lit("as")).alias("form"),
        F.col("p_name").alias("lemma"),
        F.lit(None).cast("string").alias("case"),
        F.lit(None).cast("string").alias("inflected"),
    ).distinct()
    form = F.concat(F.upper("p_name"), F.lit("AS"))
    unknown = F.concat(F.lit("ne "), "p_name", F.lit("as"))
    even = F.col("p_partkey") % 2 == 0
    rows = t.part.select("p_partkey", F.when(even, form).otherwise(unknown).alias("value"), even.alias("even"))
    flags = F.when(F.col("even"), F.array(F.lit("lemma"), F.lit("title"))).otherwise(F.array(F.lit("lemma")))
    return R.apply_flags(rows, "value", flags, 2, R.inflection_table(forms)).drop("even")


@query(
    "A12",
    """
    SELECT p_partkey, i AS pos, split_part(p_name, ' ', i) AS k, CASE i WHEN 1 THEN p_type END AS v
    FROM part, (VALUES (1), (2)) AS n(i)
    """,
)
def zipped_cells(t: Tables):
    pairs = P.zip_pairs(F.split("p_name", " "), F.array("p_type"))
    return t.part.select("p_partkey", F.posexplode(pairs).alias("pos", "p")).select(
        "p_partkey", (F.col("pos") + 1).alias("pos"), "p.k", "p.v"
    )


@query(
    "A12",
    "SELECT p_partkey, 'b' AS a, p_type AS kind FROM part",
)
def last_label_wins(t: Tables):
    pairs = P.zip_pairs(
        F.array(F.lit("a"), F.lit("kind"), F.lit("a")), F.array(F.lit("x"), F.col("p_type"), F.lit("b"), F.lit("over"))
    )
    rows = t.part.select("p_partkey", P.last_wins_map(pairs).alias("m"))
    return rows.select("p_partkey", F.col("m")["a"].alias("a"), F.col("m")["kind"].alias("kind"))


@query(
    "W7",
    "SELECT p_partkey, p_name AS first_names, upper(p_brand) || ' ' || upper(p_type) AS surname FROM part",
)
def case_run_split(t: Tables):
    runs = X.case_split(F.concat_ws("\u00a0 ", "p_name", F.upper("p_brand"), F.upper("p_type")))
    return t.part.select("p_partkey", F.get(runs, F.lit(0)).alias("first_names"), F.get(runs, F.lit(1)).alias("surname"))


@query(
    "P7 P13",
    """
    SELECT l_orderkey, l_linenumber, 0 AS pos, 'price' AS field, l_extendedprice AS amount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 1, 'tax', l_tax FROM lineitem
    """,
)
def line_children(t: Tables):
    child = lambda name, c: F.struct(F.lit(name).alias("field"), F.col(c).alias("amount"))
    lines = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.array(child("quantity", "l_quantity"), child("price", "l_extendedprice"), child("tax", "l_tax")).alias("children"),
    ).withColumn("children", P.drop_first(F.col("children"), 1))
    return P.explode_children(lines, "children", ["l_orderkey", "l_linenumber"])


@query(
    "A6",
    """
    SELECT o_orderkey AS p_asm_id, o_custkey AS unit_id, 'F' || o_orderstatus AS unit, 'narys' AS duty, 'Frakcijose' AS kind
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT o_orderkey, NULL, CASE WHEN o_orderkey % 2 = 0 THEN 'title' ELSE o_orderpriority END, 'pirmininkas', 'komitetas'
    FROM orders
    """,
)
def explode_roles(t: Tables):
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    none = F.lit(None).cast("string")
    faction = F.struct(
        F.col("o_custkey").alias("unit_id"), date.alias("since"), none.alias("until"), F.lit("narys").alias("duty"),
        F.concat(F.lit("F"), "o_orderstatus").alias("faction"),
    )
    duty = F.struct(
        F.lit(None).cast("bigint").alias("unit_id"), date.alias("since"), none.alias("until"),
        F.lit("pirmininkas").alias("duty"), F.when(F.col("o_orderkey") % 2 == 0, F.lit("title")).alias("title"),
        F.col("o_orderpriority").alias("unit"), F.lit("komitetas").alias("kind"),
    )
    members = t.orders.select(
        F.col("o_orderkey").alias("p_asm_id"),
        F.when(F.col("o_orderstatus") != "P", F.array(faction)).alias("factions"),
        F.array(duty).alias("duties"),
    )
    return P.explode_roles(members).select("p_asm_id", "unit_id", "unit", "duty", "kind")


@query(
    "X22",
    """
    SELECT n_nationkey, sha1('{"n_name":"' || n_name || '","r":' || n_regionkey || ',"none":null}') AS key FROM nation
    """,
)
def row_keys(t: Tables):
    named = t.nation.select("n_nationkey", "n_name", F.col("n_regionkey").alias("r"), F.lit(None).cast("string").alias("none"))
    return named.select("n_nationkey", K.row_hash(F.col("n_name"), F.col("r"), F.col("none")).alias("key"))


@query(
    "X26 X8",
    r"""
    SELECT page_id, trim(regexp_replace(replace(replace(array_to_string(regexp_extract_all(html, '<footer>([^<]*)', 1), ' '),
               '&copy;', '©'), '&middot;', '·'), '\s+', ' ', 'g')) || ' ą€' AS footer
    FROM pages
    """,
)
def decoded_footers(t: Tables):
    every = F.array_join(X.all_matches(F.col("html"), r"<footer>([^<]*)", 1), " ")
    footer = F.concat(every, F.lit("\u00a0 &#261;\u00ad&#x20AC; "))
    return t.pages.select("page_id", X.clean_space(H.decode_entities(footer)).alias("footer"))
