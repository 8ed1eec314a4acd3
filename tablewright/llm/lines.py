"""Line dedup: lines that many documents share stay in one of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import write_once

from .frames import BLANKS, col, lower_ascii, packed, whole


def line_key(line: Column) -> Column:
    """The line without outer ASCII blanks, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def dedup_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """Drop lines found in ``min_docs`` documents or more, except in the largest id that has them.

    Returns ``row`` (the input row as a struct), ``doc``, ``n_lines``, ``n_dropped`` and
    ``kept_text``. Lines are cut at ``\\n``; only keys of ``min_chars`` code points or more
    count. A key is known by two 64-bit hashes of its bytes.

    * A null or empty text is one empty line. A text that loses all lines becomes empty.
    * Rows that repeat an id are one document when documents are counted; each row stays and
      loses its own lines. Null ids are one document, smaller than all others.
    * An empty table gives an empty result. Columns of the input are only carried along.

    Only (hash, id, text hash, position) of long lines is shuffled for the count, combined
    before each shuffle, so a line in a third of all documents is one row per task when
    counted. The lines found common are written once, so the join that brings a hot line back
    to its documents shuffles both sides anew and adaptive execution can split it. Texts move
    once, to meet their dropped positions.
    """
    lines = F.split(F.col("txt"), "\n", -1)
    base = packed(docs, doc=col(doc_id), txt=whole(text)).withColumn("version", F.xxhash64("txt"))
    marked = F.transform(
        lines, lambda line, at: F.struct(line_key(line).alias("key"), at.alias("at"))
    )
    places = (
        base.select("doc", "version", F.explode(marked).alias("line"))
        .where(F.char_length("line.key") >= min_chars)
        .select(
            "doc",
            "version",
            F.xxhash64("line.key").alias("h1"),
            F.xxhash64(F.lit(1), "line.key").alias("h2"),
            F.col("line.at").alias("at"),
        )
    )
    common = write_once(
        places.groupBy("h1", "h2", "doc")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .drop("n_docs"),
        "common_lines",
    )
    gone = (
        places.join(common, ["h1", "h2"])
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy("doc", "version")
        .agg(F.collect_set("at").alias("gone"))
        .withColumnsRenamed({"doc": "gone_doc", "version": "gone_version"})
    )
    joined = base.join(
        gone,
        F.col("doc").eqNullSafe(F.col("gone_doc")) & (F.col("version") == F.col("gone_version")),
        "left",
    ).select("row", "doc", "txt", "gone", lines.alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda at: F.get("lines", at)), "\n")
    return joined.select(
        "row",
        "doc",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("txt")).otherwise(kept).alias("kept_text"),
    )
