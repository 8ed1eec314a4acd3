"""Rectangular and JSON-lines export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.project import flatten

SEPARATORS = {"csv": ",", "tsv": "\t"}


def export_frame(
    df: DataFrame,
    include: Sequence[str] | None = None,
    computed: dict[str, Column] | None = None,
    replace: bool = False,
) -> DataFrame:
    """The columns an export writes: computed ones added, or alone; then the chosen, in order.

    ``include`` may name nested fields; they become flat columns of that dotted name.
    """
    if computed:
        new = [c.alias(name) for name, c in computed.items()]
        df = df.select(*new) if replace else df.withColumns(computed)
    return flatten(df, include) if include else df


def export_table(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    include: Sequence[str] | None = None,
    computed: dict[str, Column] | None = None,
    replace: bool = False,
) -> None:
    """Write ``csv`` or ``tsv`` with a header; quotes in cells are doubled."""
    out = export_frame(df, include, computed, replace)
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("sep", SEPARATORS[fmt])
        .option("escape", '"')
        .csv(path)
    )


def export_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line; maps and structs stay nested."""
    df.write.mode("overwrite").json(path)


def attachment_row(key: Column, question: Column, headers: Column, content: Column) -> dict[str, Column]:
    """The computed columns of an attachment list; a file without the header has NULL names."""
    from ..functions.urls import extension, header_param

    name = header_param(F.try_element_at(headers, F.lit("Content-Disposition")), "filename")
    return {
        "attachment-url": key,
        "question-url": question,
        "size": F.octet_length(content),
        "filename": name,
        "ext": extension(name),
        "content-type": F.try_element_at(headers, F.lit("Content-Type")),
    }
