"""Dates written out in words, damaged digits, forecast times, year ranges in titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# Month names as they stand in long dates.
MONTHS = {
    "sausio": 1,
    "vasario": 2,
    "kovo": 3,
    "balandžio": 4,
    "gegužės": 5,
    "birželio": 6,
    "liepos": 7,
    "rugpjūčio": 8,
    "rugsėjo": 9,
    "spalio": 10,
    "lapkričio": 11,
    "gruodžio": 12,
}


def _two(c: Column) -> Column:
    return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def long_date_to_iso(c: Column) -> Column:
    """Three to six words to ISO; any other shape passes through, an unknown month is NULL.

    The shapes are ``1945-04-10``, ``1945 balandžio 10 d.``, ``1945 m. balandžio 10 d.`` and
    ``1945 m. balandžio mėn 10 d.``.
    """
    table = F.create_map(*[x for name, n in MONTHS.items() for x in (F.lit(name), F.lit(f"{n:02d}"))])

    def shaped(part: Column, month_at: int, day_at: int) -> Column:
        month = F.try_element_at(table, F.lower(F.get(part, F.lit(month_at))))
        day = _two(F.get(part, F.lit(day_at)))
        return F.concat(F.get(part, F.lit(0)), F.lit("-"), month, F.lit("-"), day)

    def iso(c: Column, part: Column) -> Column:
        n = F.size(part)
        return (
            F.when(n == 3, F.array_join(part, "-"))
            .when(n == 4, shaped(part, 1, 2))
            .when(n == 5, shaped(part, 2, 3))
            .when(n == 6, shaped(part, 2, 4))
            .otherwise(c)
        )

    def split(c: Column) -> Column:
        return F.filter(F.split(F.translate(c, "-", " "), r"\s+"), lambda w: w != "")

    return let(c, lambda c: let(split(c), lambda part: iso(c, part)))


def repair_digits(c: Column) -> Column:
    """Letters O and l inside digit runs to 0 and 1, and a blank before ``m.`` and ``d.``."""
    c = F.replace(c, F.lit("lO"), F.lit("10"))
    c = F.regexp_replace(c, r"O(?=[O\d])|(?<=[O\d])O", "0")
    c = F.regexp_replace(c, r"l(?=[l\d])|(?<=[l\d])l", "1")
    c = F.regexp_replace(c, r"(\d+)m.", "$1 m.")
    return F.regexp_replace(c, r"(\d+)d.", "$1 d.")


def forecast_time(c: Column) -> Column:
    """``2017-01-05-13-00`` to ``2017-01-05T13-00``; anything else is NULL."""
    # The text is kept as written; parsing only tells whether it is a time.
    valid = F.try_to_timestamp(c, F.lit("yyyy-MM-dd-HH-mm")).isNotNull()
    return F.when(valid, F.concat(F.substring(c, 1, 10), F.lit("T"), F.substring(c, 12, 5)))


def title_year_ranges(c: Column) -> Column:
    """Year ranges of a book title after `` RKB ``; a single year is a range of length 0."""
    tail = F.when(F.instr(c, " RKB ") > 0, c.substr(F.instr(c, " RKB ") + 5, F.length(c)))
    found = F.regexp_extract_all(tail, F.lit(r"\d{4}(?:(?:--|-|–)\d{4})? m\."), F.lit(0))
    return F.transform(
        found,
        lambda m: F.struct(
            F.substring(m, 1, 4).cast("int").alias("lo"),
            F.regexp_extract(m, r"(\d{4}) m\.$", 1).cast("int").alias("hi"),
        ),
    )


def title_place(c: Column) -> Column:
    """The parish: the title before its first `` RKB ``."""
    return F.when(F.instr(c, " RKB ") > 0, F.substring_index(c, " RKB ", 1))


def term_default(c: Column, term: Column, defaults: dict[int, str]) -> Column:
    """A mandate date, or the default of its term when the cell is empty."""
    table = F.create_map(*[F.lit(x) for pair in defaults.items() for x in pair])
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.try_element_at(table, term))
