"""Delimited files, legacy reports and dictionary folders."""

from __future__ import annotations

import io
import itertools
import re
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scan import Running, running
from .tables import with_row_numbers


def read_keyed_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    key: str | None = None,
    derived: dict[str, Column] | None = None,
    limit: int | None = None,
    schema=None,
) -> DataFrame:
    """A CSV file with header as ``key`` and its other columns.

    Derived columns are added first, then the key column is taken out. Without a key column
    the key is the 1-based row number. Only a schema saves Spark a look at the header.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    rows = (reader.schema(schema) if schema is not None else reader).csv(path)
    if key is None or limit is not None:
        rows = with_row_numbers(rows, "__row")
        if limit is not None:
            rows = rows.where(F.col("__row") <= limit)
    rows = rows.withColumns(derived or {})
    chosen = F.col("__row") if key is None else F.col(key)
    rest = [c for c in rows.columns if c not in ("__row", key)]
    return rows.select(chosen.alias("key"), *rest)


def decode_single_byte(raw: Column, encoding: str) -> Column:
    """Bytes of an encoding with one byte for each character, as text; runs in the JVM.

    Spark reads Latin-1 and not all of its relatives, so bytes are read as Latin-1 and the upper
    half is replaced. A byte without a character becomes U+FFFD.
    """
    upper = bytes(range(128, 256))
    if len(bytes(range(128)).decode(encoding)) != 128 or len(upper.decode(encoding, "replace")) != 128:
        raise ValueError(f"{encoding} has characters of several bytes")
    return F.translate(F.decode(raw, "ISO-8859-1"), upper.decode("latin-1"), upper.decode(encoding, "replace"))


def _plain_lines(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """``file, line_no, line`` of plain files, which Spark cuts into ranges of bytes."""
    lines = spark.read.text(paths).select("value", "_metadata")
    rows = with_row_numbers(lines, "__n").select(F.col("_metadata.file_path").alias("file"), "__n", "value")
    first = rows.groupBy("file").agg(F.min("__n").alias("__first"))  # a row per file
    numbered = rows.join(first, "file").withColumn("line_no", F.col("__n") - F.col("__first") + 1)
    return numbered.select("file", "line_no", decode_single_byte(F.col("value").cast("binary"), encoding).alias("line"))


def _zipped_lines(spark: SparkSession, paths: list[str], encoding: str, member: str | None) -> DataFrame:
    """``file, line_no, line`` of a member of each archive; an archive is one row and one task."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                archive = zipfile.ZipFile(io.BytesIO(content))
                stream = io.TextIOWrapper(archive.open(member or archive.namelist()[0]), encoding=encoding, errors="replace")
                numbered = enumerate((line.rstrip("\r\n") for line in stream), 1)
                while out := list(itertools.islice(numbered, 10_000)):
                    yield pd.DataFrame([(file, *x) for x in out], columns=["file", "line_no", "line"])

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(lines, "file string, line_no bigint, line string")


def read_legacy_report(
    spark: SparkSession,
    path: str,
    skip: int,
    names: dict[str, str],
    key: str,
    encoding: str = "iso-8859-4",
    member: str | None = None,
) -> DataFrame:
    """Report files, plain or zipped (``.zip``), in an encoding Spark does not read, as a keyed table.

    ``names`` maps the columns, in order, to types. The first ``skip`` lines of each file and
    blank lines do not count, but are numbered. A plain file is read in ranges of bytes by several
    tasks and never leaves the JVM; Python only unpacks archives. What is collected are file names.
    """
    found = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    zipped = [p for p in found if p.lower().endswith(".zip")]
    plain = [p for p in found if p not in set(zipped)]
    parts = []
    if plain or not found:
        parts.append(_plain_lines(spark, plain or [path], encoding))
    if zipped:
        parts.append(_zipped_lines(spark, zipped, encoding, member))
    read = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    read = read.where((F.col("line_no") > skip) & (F.trim("line") != ""))
    cells = F.split("line", r";\s*")

    def typed(i: int, kind: str) -> Column:
        cell = F.nullif(F.trim(F.get(cells, F.lit(i))), F.lit(""))
        return cell if kind == "string" else F.replace(cell, F.lit(","), F.lit(".")).cast(kind)

    columns = [typed(i, kind).alias(name) for i, (name, kind) in enumerate(names.items())]
    table = read.select("file", "line_no", *columns)
    return table.withColumn("key", F.col(key).cast("string"))


def _dictionary_lines(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``dictionary, file, pos, line`` of the files ``<dictionary>/<name>``, line by line.

    Such a file may also be a folder of part files; lines count from 1 in each dictionary.
    """
    lines = spark.read.text([f"{folder.rstrip('/')}/*/{name}"]).select("value", "_metadata")
    rows = with_row_numbers(lines, "__n").select(
        F.url_decode(F.regexp_extract("_metadata.file_path", rf"([^/]+)/{re.escape(name)}(?:/[^/]*)?$", 1)).alias("dictionary"),
        F.col("_metadata.file_path").alias("file"),
        "__n",
        F.col("value").alias("line"),
    )
    first = rows.groupBy("dictionary").agg(F.min("__n").alias("__first"))
    numbered = rows.join(first, "dictionary")
    return numbered.select("dictionary", "file", (F.col("__n") - F.col("__first") + 1).cast("int").alias("pos"), "line")


def load_choices(spark: SparkSession, folder: str) -> DataFrame:
    """``dictionary, id, name, pos`` of every ``<dictionary>/choices.txt``; a line is ``id,name``."""
    rows = _dictionary_lines(spark, folder, "choices.txt").where("trim(line) != ''")
    cut = F.instr("line", ",")
    number = F.trim(F.substring_index("line", ",", 1))
    wrong = F.raise_error(F.concat_ws(":", F.lit("malformed choice"), "file", "pos", "line"))
    return rows.select(
        "dictionary",
        F.when((cut > 0) & number.rlike(r"^[+-]?\d+$"), number.cast("bigint")).otherwise(wrong).alias("id"),
        F.trim(F.col("line").substr(cut + 1, F.length("line"))).alias("name"),
        "pos",
    )


def load_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """``dictionary, target, alias, pos`` of every ``<dictionary>/aliases.txt``.

    An indented line is an alias of the last line that is not; a target without aliases has
    one row with a NULL alias; empty lines do not count.
    """
    rows = _dictionary_lines(spark, folder, "aliases.txt").where("trim(line) != ''")
    head = ~F.col("line").startswith(" ")
    carried = running(
        rows, ["dictionary"], "pos", Running("target", "last", F.when(head, F.rtrim(F.col("line"))))
    )
    alias = F.when(~head, F.trim(F.col("line")))
    rows = carried.select("dictionary", "target", alias.alias("alias"), "pos")
    held = rows.where("alias IS NOT NULL").select("dictionary", "target").distinct()
    bare = rows.where("alias IS NULL").join(held, ["dictionary", "target"], "left_anti")
    return rows.where("alias IS NOT NULL AND target IS NOT NULL").unionByName(bare)


def load_dictionary(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(choices, aliases) of a folder of dictionaries."""
    return load_choices(spark, folder), load_aliases(spark, folder)


def load_missing(spark: SparkSession, folder: str) -> DataFrame:
    """``dictionary, mention`` of every ``<dictionary>/missing.txt``."""
    rows = _dictionary_lines(spark, folder, "missing.txt")
    return rows.select("dictionary", F.trim("line").alias("mention")).where("mention != ''")


def seed_urls(df: DataFrame, template: str, lo: Column, hi: Column, keep: Sequence[str] = ()) -> DataFrame:
    """``key`` of every page number of every row, from ``lo`` up to, not with, ``hi``.

    The template names ``page`` and columns of ``df``; a row whose range is empty gives none.
    """
    pages = F.when(hi > lo, F.sequence(lo, hi - 1))
    values = {c: F.col(c) for c in df.columns if "{" + c + "}" in template}
    numbered = df.select("*", F.explode(pages).alias("page"))
    return numbered.select(*keep, strformat(template, **{**values, "page": F.col("page")}).alias("key"))


def strformat(template: str, **values: Column) -> Column:
    """A text with ``{name}`` places filled from columns."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out
