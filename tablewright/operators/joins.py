"""Temporal, name-variant and membership joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_upper, title_case, words
from ..session import write_once

# Days since 0001-01-01 fit into RADIX ** LEVELS. A date looks up one block per level, and
# dates outnumber periods: few levels, more blocks per period.
RADIX = 16
LEVELS = 6
DAY_OFFSET = 719163
OPEN_END = RADIX**LEVELS


def _day(date: Column) -> Column:
    return F.unix_date(date.cast("date")).cast("bigint") + DAY_OFFSET


def _blocks(periods: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``level, block``: the fewest aligned blocks of 1, 16, 256, … days that make up [__lo, __hi)."""
    ranges = []
    for level in range(LEVELS):
        size, parent = RADIX**level, RADIX ** (level + 1)
        start, stop = f"(__lo + {size - 1}) div {size}", f"__hi div {size}"
        # Blocks that a whole parent block covers are left to the next level.
        inner = f"((__lo + {parent - 1}) div {parent}) * {RADIX}"
        outer = f"(__hi div {parent}) * {RADIX}"
        covered = f"{inner} < {outer}" if level < LEVELS - 1 else "false"
        ranges.append(
            f"struct({level} AS level, {start} AS a, if({covered}, {inner}, {stop}) AS b, "
            f"if({covered}, {outer}, 0L) AS c, if({covered}, {stop}, 0L) AS d)"
        )
    span = "if({0} < {1}, sequence({0}, {1} - 1), cast(array() AS array<bigint>))".format
    per_level = periods.select(*keep, F.expr(f"inline(array({', '.join(ranges)}))"))
    blocks = F.expr(f"explode(concat({span('a', 'b')}, {span('c', 'd')}))")
    return per_level.select(*keep, "level", blocks.alias("block"))


def period_lookup(
    dates: DataFrame,
    periods: DataFrame,
    start: str,
    end: str,
    order: str,
    payload: Sequence[str],
    keys: Sequence[str] = (),
    lookup: DataFrame | None = None,
) -> DataFrame:
    """For each ``keys, __date`` with a valid period: the payload of the first by ``order``.

    The join is by equality only. A period is cut into aligned blocks of days; per (keys,
    block) only the smallest ``order`` is kept, so any number of overlapping periods leaves
    one row. A date then looks up its own block on each level.
    """
    keys = list(keys)
    table = periods.withColumn("__lo", _day(F.col(start)) + 1).withColumn(
        "__hi", F.coalesce(_day(F.col(end)), F.lit(OPEN_END))
    )
    blocks = _blocks(table.where("__lo < __hi"), [*keys, order])
    first = blocks.groupBy(*keys, "level", "block").agg(F.min(order).alias("__first"))
    if keys:  # many times the periods, which the size of their table does not show: never to be broadcast
        first = first.hint("merge")

    day = _day(F.col("__date"))
    levels = F.array(
        *[
            F.struct(
                F.lit(n).alias("level"), F.floor(day / F.lit(RADIX**n)).cast("bigint").alias("block")
            )
            for n in range(LEVELS)
        ]
    )
    found = (
        dates.select(*keys, "__date", F.inline(levels))
        .join(first, [*keys, "level", "block"])
        .groupBy(*keys, "__date")
        .agg(F.min("__first").alias("__order"))
    )
    source = periods if lookup is None else lookup
    held = source.select(F.col(order).alias("__order"), *[F.col(c).alias(f"__p_{c}") for c in payload])
    # As many rows as periods, however few they are found for and however small their file is.
    return found.join(held.hint("merge"), "__order").drop("__order")


def days_only(df: DataFrame, *columns: str) -> None:
    """Refuse columns that hold a time of day, which a join on days would cut off."""
    for name in columns:
        if df.schema[name].dataType.typeName().startswith("timestamp"):
            raise ValueError(f"{name} holds a time of day; cast it to date")


def valid_at_join(
    facts: DataFrame,
    periods: DataFrame,
    on_date: str,
    start: str,
    end: str,
    order: str,
    payload: Sequence[str],
    keys: Sequence[str] = (),
    lookup: DataFrame | None = None,
) -> DataFrame:
    """Left join each fact to the first period, by ``order``, with start < date < end.

    Both bounds are strict and a NULL end is open. Dates are days: a column with a time of day
    is refused, cast it first. ``order`` is a whole number, unique in
    ``periods`` (or in ``lookup``, which then holds the payload); ``keys`` are equal on both
    sides. Only distinct (keys, date) pairs are looked up; the facts pick the outcome up by an
    equality join.
    """
    keys = list(keys)
    days_only(facts, on_date)
    days_only(periods, start, end)
    rows = facts.withColumn("__date", F.col(on_date).cast("date"))
    dates = rows.select(*keys, "__date").distinct()
    chosen = period_lookup(dates, periods, start, end, order, payload, keys, lookup)
    joined = rows.join(chosen, [*keys, "__date"], "left")
    return joined.select(*facts.columns, *[F.col(f"__p_{c}").alias(c) for c in payload])


# ---- speakers ----------------------------------------------------------------


def speaker_key(speaker: Column) -> Column:
    """Runs of dots and blanks to one blank, upper case, trimmed."""
    return F.trim(F.upper(F.regexp_replace(speaker, r"(?U)[.\s]+", " ")))


def speaker_surname(speaker: Column) -> Column:
    """The last word after dots became blanks, upper case; NULL for no word."""
    return F.upper(F.try_element_at(words(F.replace(speaker, F.lit("."), F.lit(" "))), F.lit(-1)))


def name_variants(first_names: Column, surname: Column) -> Column:
    """Distinct spellings: all initials, first, all but last, reversed, surname alone."""
    letters = F.transform(words(first_names), lambda w: F.substring(w, 1, 1))
    n = F.size(letters)
    forms = [
        letters,
        F.slice(letters, F.lit(1), F.lit(1)),
        F.slice(letters, F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.reverse(letters),
        F.array().cast("array<string>"),
    ]
    return F.array_distinct(
        F.array(*[F.upper(F.array_join(F.concat(f, F.array(surname)), " ")) for f in forms])
    )


SPEAKER = ["__surname", "__variant"]

#: Terms of one surname that may be carried along in a row; a surname with more is looked up by blocks.
FEW = 64


def _asked(speeches: DataFrame, who: Column, date: str) -> DataFrame:
    """``__who`` and ``__date`` next to the speeches.

    A speech without a speaker gets a key of its own that nobody has, so that such rows are
    spread over the join instead of meeting in one place.
    """
    hashed = [F.col(f.name) for f in speeches.schema if f.dataType.typeName() != "map"]
    nobody = F.concat(F.lit("\u0000"), F.xxhash64(*hashed).cast("string"))
    named = F.when(who.rlike(r"[\p{L}\p{N}]"), who)
    return speeches.withColumn("__who", F.coalesce(named, nobody)).withColumn("__date", F.col(date).cast("date"))


def _with_member(asked: DataFrame, members: DataFrame) -> DataFrame:
    """``asked`` with ``__p_vardas, __p_pavarde`` of the member in office: names are taken apart once each.

    The terms of a name variant are carried as one row, so that speeches meet them once, by name,
    and compare days in place. A surname with more than ``FEW`` terms is looked up by blocks of days.
    What terms and variants come to is not to be seen from the size of ``members``: no such side is
    left to a broadcast.
    """
    table = members.select(
        "seq",
        F.col("nuo").cast("date").alias("nuo"),
        F.col("iki").cast("date").alias("iki"),
        "vardas",
        "pavarde",
        F.upper("pavarde").alias("__surname"),
    ).where("seq IS NOT NULL")
    many = table.groupBy("__surname").count().where(F.col("count") > FEW).select("__surname")
    many = write_once(many, "many_terms")
    some_many = not many.isEmpty()
    variants = F.explode(name_variants(F.col("vardas"), F.col("pavarde"))).alias("__variant")
    few = table.join(many.hint("merge"), "__surname", "left_anti") if some_many else table
    few = few.select("*", variants)
    terms = F.sort_array(F.collect_list(F.struct("seq", "nuo", "iki", "vardas", "pavarde")))
    terms = few.groupBy(*SPEAKER).agg(terms.alias("__terms"))

    names = asked.select("__who").where(~F.col("__who").startswith("\u0000")).distinct()
    keyed = names.select(
        "__who", speaker_surname(F.col("__who")).alias("__surname"), speaker_key(F.col("__who")).alias("__variant")
    ).where("__surname IS NOT NULL")
    known = keyed.join(terms.hint("merge"), SPEAKER).select("__who", "__terms")
    day = F.col("__date")
    valid = F.filter("__terms", lambda p: (p["nuo"] < day) & (p["iki"].isNull() | (p["iki"] > day)))
    joined = asked.join(known.hint("merge"), "__who", "left").withColumn("__term", F.try_element_at(valid, F.lit(1))).drop("__terms")
    here = [F.col("__term")[c].alias(f"__p_{c}") for c in ("vardas", "pavarde")]
    if not some_many:
        return joined.select(*asked.columns, *here)

    asked_many = keyed.join(many.hint("merge"), "__surname")
    dates = asked.join(asked_many.hint("merge"), "__who").select("__who", "__date", *SPEAKER).distinct()
    found = period_lookup(
        dates.select(*SPEAKER, "__date").distinct(),
        table.join(many.hint("merge"), "__surname", "left_semi").select("*", variants),
        "nuo", "iki", "seq", ["vardas", "pavarde"], SPEAKER, members,
    )
    found = dates.join(found.hint("merge"), [*SPEAKER, "__date"]).drop(*SPEAKER)
    joined = joined.select(*asked.columns, "__term").join(found.hint("merge"), ["__who", "__date"], "left")
    here = [F.coalesce(F.col("__term")[c], F.col(f"__p_{c}")).alias(f"__p_{c}") for c in ("vardas", "pavarde")]
    return joined.select(*asked.columns, *here)


def resolve_speaker(speeches: DataFrame, members: DataFrame, speaker: str, date: str) -> DataFrame:
    """Left join a speech to the member in office whose name variant the speaker wrote.

    ``members`` has ``seq, vardas, pavarde, nuo, iki``; the first by ``seq`` is taken.
    """
    days_only(speeches, date)
    asked = _asked(speeches, F.col(speaker), date)
    found = _with_member(asked, members)
    return found.select(
        *speeches.columns, F.col("__p_vardas").alias("vardas"), F.col("__p_pavarde").alias("pavarde")
    )


def attribute_roles(speeches: DataFrame, members: DataFrame, chairs: DataFrame, date: str) -> DataFrame:
    """Position and person of every speaker.

    ``speeches`` has ``speaker, is_chair, chair_name`` (the carried chair). A chair with a
    carried name is looked up among the members only; a chair without one is the chair in
    office; anybody else is a member when found. Both lookups start from the speeches, which
    then are joined to the two outcomes.
    """
    days_only(speeches, date)
    asked = _asked(speeches, F.when(F.col("is_chair"), F.col("chair_name")).otherwise(F.col("speaker")), date)
    by_office = F.col("is_chair") & F.col("chair_name").isNull()
    holders = chairs.withColumnsRenamed({"vardas": "c_vardas", "pavarde": "c_pavarde"})
    office = period_lookup(
        asked.where(by_office).select("__date").distinct(),
        holders, "start", "end", "seq", ["c_vardas", "c_pavarde"],
    )
    joined = _with_member(asked, members).join(office, "__date", "left")

    def person(field: str) -> Column:
        return F.when(by_office, F.col(f"__p_c_{field}")).otherwise(F.col(f"__p_{field}"))

    position = F.when(F.col("is_chair"), F.lit("pirmininkas")).when(
        F.col("__p_pavarde").isNotNull(), F.lit("seimo narys")
    )
    return joined.select(
        *speeches.columns,
        position.alias("position"),
        person("vardas").alias("vardas"),
        person("pavarde").alias("pavarde"),
    )


def emphasised(segments: DataFrame, emphasis: DataFrame, doc: str, head: str, member: str) -> DataFrame:
    """Segments whose upper-case head is among the emphasised heads of their document."""
    marks = emphasis.select(doc, F.col(member).alias(head)).distinct()
    return segments.where(is_upper(F.col(head))).join(marks, [doc, head], "left_semi")


# ---- names and codes ------------------------------------------------------------


def split_names(people: DataFrame, first_names: DataFrame, name: str, known: str) -> DataFrame:
    """``first_name, last_name, reject`` for a full name written surname first.

    Two words are last then first. With more words those in the first-name table are first
    names; none found, or a single word, is a reject.
    """
    names = people.select(F.col(name).alias("__name")).where("__name IS NOT NULL").distinct()
    token = names.select(
        "__name", F.posexplode(words(title_case(F.col("__name")))).alias("__pos", "__word")
    ).withColumn("__low", F.lower("__word"))
    table = first_names.select(F.lower(known).alias("__low")).distinct().withColumn("__hit", F.lit(True))
    parts = (
        token.join(table, "__low", "left")
        .groupBy("__name")
        .agg(
            F.count(F.lit(1)).alias("__n"),
            F.array_sort(
                F.collect_list(
                    F.struct("__pos", "__word", F.coalesce("__hit", F.lit(False)).alias("__hit"))
                )
            ).alias("__parts"),
        )
    )

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("__parts", keep), lambda p: p["__word"]), " ")

    known_part = joined(lambda p: p["__hit"])
    two = F.col("__n") == 2
    reject = F.when(F.col("__n") < 2, F.lit("one word")).when(
        (F.col("__n") > 2) & (known_part == ""), F.lit("no first name")
    )
    split = parts.select(
        "__name",
        reject.alias("reject"),
        F.when(reject.isNull(), F.when(two, F.col("__parts")[1]["__word"]).otherwise(known_part)).alias("first_name"),
        F.when(
            reject.isNull(),
            F.when(two, F.col("__parts")[0]["__word"]).otherwise(joined(lambda p: ~p["__hit"])),
        ).alias("last_name"),
    )
    return people.join(split.withColumnRenamed("__name", name), name, "left")


def mayor_flag(name: Column, term: Column) -> tuple[Column, Column]:
    """(is mayor, name without the mark): only 2015 rows are true or false."""
    marked = name.rlike(r"\s\((?:MERAS|MERĖ)\)\s*$")
    flag = F.when(term == 2015, marked)
    bare = F.when(
        (term == 2015) & marked, F.regexp_replace(name, r"\s+\((?:MERAS|MERĖ)\)\s*$", "")
    ).otherwise(name)
    return flag, F.trim(bare)


def code_key(code: Column) -> Column:
    """A numeric code, read as 123 or 123.0, as plain text; long codes keep all digits."""
    return F.floor(code.cast("string").try_cast("decimal(38,4)")).cast("string")


def enrich_by_code(facts: DataFrame, names: DataFrame, code: str, cols: Sequence[str], order: str) -> DataFrame:
    """Left join names to facts on the normalised code; the first name row, by ``order``, stands.

    Facts without a code are no key of the join: they meet a NULL code, which matches nothing.
    """
    table = (
        names.select(code_key(F.col(code)).alias("__code"), F.col(order).alias("__order"), *cols)
        .where("__code IS NOT NULL")
        .groupBy("__code")
        .agg(F.min_by(F.struct(*cols), "__order").alias("__n"))
    )
    joined = facts.withColumn("__code", code_key(F.col(code))).join(table, "__code", "left")
    return joined.select(*facts.columns, *[F.col("__n")[c].alias(c) for c in cols])
