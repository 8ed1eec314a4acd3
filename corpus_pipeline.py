"""A training corpus in five stages, each of which works on all that the one before kept.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import language, lines, packing, secrets, simhash
from tablewright.llm.frames import held_out, whole
from tablewright.llm.queries import VOCABULARY
from tablewright.session import write_once


def with_text(docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``documents`` from ``row``, with the text (and its size) replaced."""
    changed = F.col("row").withField("text", F.col(text)).withField("n_chars", F.char_length(text).cast("long"))
    return docs.select(changed.alias("row")).select("row.*")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or with a margin too narrow to tell, go."""
    learned = language.learn_dictionaries(docs, F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    judged = docs.select(F.struct("*").alias("row"), language.language_of(F.col("text"), learned).alias("found"))
    return judged.where(language.accepted(F.col("found"))).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one; every document stays."""
    return with_text(lines.dedup_lines(docs), "kept_text")


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, one row stays: one of the smallest id, null ids last.

    Rows are told apart by two hashes of id and text; of rows that repeat both, any one stays.
    They are combined by these hashes before they are shuffled, once, to meet what stays.
    """
    key = {f"_key{n}": F.xxhash64(F.lit(n), F.col("doc_id"), whole("text")) for n in (1, 2)}
    groups = simhash.near_duplicates(docs, carried=key)
    first = F.min(F.struct(F.col("doc").isNull().alias("last"), "doc", *key))
    stays = groups.groupBy("group").agg(first.alias("first")).select(*[f"first.{name}" for name in key])
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in key.items()])
    return rows.dropDuplicates(list(key)).join(stays, list(key), "left_semi").select("row.*")


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, also those in decoded layers, are masked; every document stays."""
    found = docs.select(F.struct("*").alias("row"), secrets.secrets_in(F.col("text")).alias("found"))
    hidden = found.withColumn("safe", secrets.redacted(F.col("row.text"), F.col("found.spans")))
    return with_text(hidden, "safe")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and where they lie in the sequences."""
    return packing.pack(docs, VOCABULARY).withColumnsRenamed({"doc": "doc_id", "crc": "ids_crc32"})


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("secret_scans", scan_secrets),
    ("packing", pack_sequences),
]

#: No SQL can tell languages by compression, so the rows of ``run`` have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents``; each result but the last is written and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
