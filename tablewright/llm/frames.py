"""Small helpers the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def col(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as the struct ``row``, next to the named columns.

    What an operator adds can then never clash with a column of its input.
    """
    return df.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in columns.items()])


def whole(text: str) -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(col(text).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def held_out(doc_id: Column) -> Column:
    """True for the third of the ids that nothing is learned from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
