"""Cleaning expressions on text columns. All stay inside the JVM but the accent one."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

NON_WORD = r"[^\p{L}\p{N}_]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def normalise(c: Column) -> Column:
    """Non-word runs to one blank, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(c, NON_WORD, " ")))


def title_case(c: Column) -> Column:
    """A capital at every letter that follows a non-letter, the rest lower case."""
    pieces = F.split(c, r"(?<!\p{L})(?=\p{L})")
    cased = F.transform(
        pieces,
        lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(p.substr(F.lit(2), F.length(p)))),
    )
    return F.array_join(cased, "")


def clean_space(c: Column) -> Column:
    """Soft hyphens out, no-break spaces to blanks, blank runs to one, trimmed."""
    c = F.translate(F.replace(c, F.lit("\u00ad"), F.lit("")), "\u00a0", " ")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def is_upper(word: Column) -> Column:
    """At least one capital and no small letter."""
    return word.rlike(r"\p{Lu}") & ~word.rlike(r"[\p{Ll}\p{Lt}]")


def words(c: Column) -> Column:
    """Words between blanks of any kind, also no-break ones; empty text has none."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def case_split(c: Column) -> Column:
    """Runs of words of one case, in order: first names, then an upper-case surname."""
    empty = F.array().cast("array<struct<up:boolean,txt:string>>")

    def step(runs, word):
        up = is_upper(word)
        last = F.element_at(runs, -1)
        fresh = F.array(F.struct(up.alias("up"), word.alias("txt")))
        grown = F.array(
            F.struct(up.alias("up"), F.concat_ws(" ", last["txt"], word).alias("txt"))
        )
        return F.when(F.size(runs) == 0, fresh).when(
            last["up"] == up, F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), grown)
        ).otherwise(F.concat(runs, fresh))

    return F.transform(F.aggregate(words(c), empty, step), lambda r: r["txt"])


def rsplit_once(c: Column, sep: str, part: int) -> Column:
    """``part`` 0 is the text before the last ``sep``, 1 the text after it (NULL without one)."""


    def cut(c: Column) -> Column:
        after = F.substring_index(c, sep, -1)
        if part == 1:
            return F.when(F.contains(c, F.lit(sep)), after)
        before = F.left(c, F.length(c) - F.length(after) - F.lit(len(sep)))
        return F.when(F.contains(c, F.lit(sep)), before).otherwise(c)

    return let(c, cut)


def split_part_strict(c: Column, sep: str, part: int) -> Column:
    """The ``part``-th piece; a missing piece is an error, as it is for a required field."""
    return F.element_at(F.split(c, _quote(sep)), part + 1)


def split_part_safe(c: Column, sep: str, part: int) -> Column:
    """The ``part``-th piece or NULL."""
    return F.get(F.split(c, _quote(sep)), F.lit(part))


def _quote(sep: str) -> str:
    return "".join(f"\\{ch}" if not ch.isalnum() and ch != " " else ch for ch in sep)


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, NULL when there is none (the caller rejects the row)."""
    return let(c, lambda c: F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group)))


def all_matches(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def tagged_title(c: Column) -> tuple[Column, Column]:
    """``lang:title`` split at the first colon; without a colon the language is NULL."""
    at = F.instr(c, ":")
    return (
        F.when(at > 0, F.substring_index(c, ":", 1)),
        F.when(at > 0, c.substr(at + 1, F.length(c))).otherwise(c),
    )


def recode(c: Column, mapping: dict[str, str]) -> Column:
    """Mapped values replaced, all others passed through."""
    if not mapping:
        return c
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return let(c, lambda c: F.coalesce(F.try_element_at(table, c), c))


# The tone marks of Lithuanian dictionaries.
TONE_MARKS = ("COMBINING ACUTE ACCENT", "COMBINING GRAVE ACCENT", "COMBINING TILDE")


@F.pandas_udf(StringType())
def strip_tone_accents(names: pd.Series) -> pd.Series:
    """Tone marks out, the letters' own diacritics kept."""
    drop = {ord(unicodedata.lookup(mark)): None for mark in TONE_MARKS}
    plain = names.str.normalize("NFD").str.translate(drop)
    return plain.str.normalize("NFC")


# ---- transcript lines -------------------------------------------------------

# How a transcript marks a clock line, the chair and a speaker, a clock text, and
# the bracket line behind a speaker.
SPEAKER_MARK = (
    r"^\s*\d+\.\d+ val\.$"
    r"|^PIRMININK(?:AS|Ė)\b\.?"
    r"|^(?:\w\.\s*){1,3}[\w-]+\b\.?"
)
CLOCK = r"(\d+)\.(\d+) val\."
BRACKETS = r"(?m)^\s*\(([^)]+)\)\s*\."


def emphasis_head(c: Column) -> Column:
    """The speaker mark an emphasised text starts a line with."""
    return first_group(F.trim(c), f"(?mU){SPEAKER_MARK}", 0)


def clock(c: Column) -> Column:
    """``14.05 val.`` as ``14:05``."""
    return F.when(
        c.rlike(CLOCK),
        F.concat_ws(":", F.regexp_extract(c, CLOCK, 1), F.regexp_extract(c, CLOCK, 2)),
    )


def bracket_items(c: Column) -> Column:
    """The trimmed items of the first line that starts ``(a, b).``; NULL without one."""
    return let(
        F.regexp_extract(c, BRACKETS, 1),
        lambda inner: F.when(
            inner != "",
            F.transform(F.split(inner, ","), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")),
        ),
    )


def bracket_rest(c: Column) -> Column:
    """The text after that bracket line, or the text itself."""
    rest = F.regexp_extract(c, BRACKETS + r"([\s\S]*)", 2)
    return F.when(c.rlike(BRACKETS), F.regexp_replace(rest, r"^\s+|\s+$", "")).otherwise(c)


def is_acronym(c: Column) -> Column:
    """No blank or dot, and two capitals side by side."""
    return ~c.rlike(r"[ .]") & c.rlike(r"\p{Lu}{2}")


def first_acronym(items: Column) -> Column:
    return F.get(F.filter(items, is_acronym), F.lit(0))


def without_first_acronym(items: Column) -> Column:
    """The list less its first acronym; other acronyms stay."""
    at = F.array_position(F.transform(items, is_acronym), F.lit(True))
    return F.when(at > 0, F.filter(items, lambda _, i: i != at - 1)).otherwise(items)


# ---- packed lists -------------------------------------------------------------


def packed_items(c: Column) -> Column:
    """``id###name|id###name`` as an array of (id, name); blank items and bold tags go."""
    items = F.filter(F.split(c, r"\|"), lambda item: F.trim(item) != "")
    return F.transform(
        items,
        lambda item: F.struct(
            F.substring_index(item, "###", 1).alias("id"),
            F.regexp_replace(F.get(F.split(item, "###"), F.lit(1)), "</?b>", "").alias("name"),
        ),
    )
