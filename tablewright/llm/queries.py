"""The queries of this folder: each operator over its whole table, with the SQL that says the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import scratch_path

from . import (
    alignment,
    divergence,
    exact,
    language,
    lines,
    packing,
    quality,
    secrets,
    shards,
    simhash,
    tokens,
    urls,
    vectors,
)
from .frames import held_out

# The rules for hosts and paths.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def sha256(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.filter_urls(table(spark, folder, "pages"), URL_RULES)
    return judged.select(F.col("page").alias("page_id"), "host", "path", "rule", "verdict", "block_score")


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learned = language.learn_dictionaries(docs, F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    found = docs.select("doc_id", language.language_of(F.col("text"), learned).alias("found"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.margin").alias("margin"),
        language.accepted(F.col("found")).alias("accepted"),
    )


def op3_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    judged = vectors.near_duplicates(table(spark, folder, "embeddings"))
    return judged.select(F.col("vec").alias("vec_id"), "n_links", "component_id", "kept", "recall")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = lines.dedup_lines(table(spark, folder, "documents"))
    return done.select(
        F.col("doc").alias("doc_id"), "n_lines", "n_dropped", sha256(F.col("kept_text")).alias("kept_sha256")
    )


OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM d),
l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM s
),
k AS (
  SELECT doc_id, line, pos,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
),
c AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
m AS (
  SELECT k.doc_id, k.line, k.pos, (c.key IS NOT NULL AND k.doc_id <> c.keeper) AS gone
  FROM k LEFT JOIN c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op5_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    coded = docs.select("doc_id", tokens.encode(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("ids"))
    back = coded.withColumn("decoded", tokens.decode(F.col("ids"), RANKS, public_tokenizers.PATTERN))
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The documents come in two batches, the upper half of the ids first, so that the index
    keeps the largest id of each text."""
    docs = table(spark, folder, "documents")
    name = "digests_" + scratch_path(spark, "").rstrip("/").rpartition("/")[2]
    index = exact.DigestIndex(spark, name, exact.DigestIndex.buckets_for(docs.count()))
    upper = F.coalesce(F.col("doc_id") >= docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0], F.lit(False))
    for batch in (docs.where(upper), docs.where(~upper)):
        index.append(batch)
    judged = index.decide(docs)
    return judged.select(
        F.col("doc").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"), VOCABULARY)
    return packed.withColumnsRenamed({"doc": "doc_id", "crc": "ids_crc32"})


def op8_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "documents").select("doc_id", secrets.secrets_in(F.col("text")).alias("found"))
    count = lambda kind: F.size(F.filter("found.base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        sha256(secrets.digest_form(F.col("found.base"))).alias("base_sha256"),
        secrets.digest_form(F.col("found.spans")).alias("spans"),
        F.col("found.oversize").alias("n_oversize"),
    )


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, folder, "documents"))
    return groups.select(
        F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"), with_rows=False)
    return judged.select(F.col("doc").alias("doc_id"), "held_out", "text_score", "meta_score", "score", "quality")


def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.shard_documents(table(spark, folder, "documents"))
    return placed.select(
        F.col("doc").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit(shards.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    aligned = alignment.align_tokens(table(spark, folder, "documents"), VOCABULARY, PIECES)
    return aligned.select(
        F.col("doc").cast("long").alias("doc_id"),
        *["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"],
        F.col("groups").alias("groups_sha256"),
    )


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit_sources(table(spark, folder, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
),
k AS (
  SELECT lang, term, count(*) AS ln FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30
),
lv AS (SELECT lang, count(*)::HUGEINT AS v, sum(ln)::HUGEINT AS lsum FROM k GROUP BY lang),
c AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
),
gs AS (SELECT lang, source, sum(n)::HUGEINT AS gsum FROM c GROUP BY lang, source),
f AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(gsum, 0) + 5 * coalesce(v, 0) AS total,
    coalesce(lsum, 0) + 5 * coalesce(v, 0) AS ltotal
  FROM g LEFT JOIN lv ON g.lang = lv.lang LEFT JOIN gs ON g.lang = gs.lang AND g.source = gs.source
),
p AS (
  SELECT f.lang, f.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // f.total AS p,
    1 + (1000000000::HUGEINT * (k.ln + 5)) // f.ltotal AS q
  FROM f JOIN k ON f.lang = k.lang
  LEFT JOIN c ON c.lang = f.lang AND c.source = f.source AND c.term = k.term
),
pv AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pv.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source
),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term) AS everything
QUALIFY part = 'pair' OR rank <= 50
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_language_id,
        op3_embedding_near_dedup,
        op4_line_dedup,
        op5_byte_level_bpe,
        op6_exact_dedup,
        op7_best_fit_packing,
        op8_secret_scans,
        op9_simhash_near_dedup,
        op10_quality_classifier,
        op11_sharding,
        op12_cross_tokenizer_alignment,
        op13_source_divergence,
    )
}
SQL = {"op4_line_dedup": OP4_SQL, "op6_exact_dedup": OP6_SQL, "op13_source_divergence": OP13_SQL}
