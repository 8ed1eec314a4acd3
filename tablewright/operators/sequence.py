"""Folding ordered rows: key/value runs, text segments, carried values, turns, intervals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.company import clean_company, lt_to_eur
from ..session import write_once
from .joins import attribute_roles
from .log import as_list
from .project import exclude_pairs
from .scan import Running, place, running


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: str, value: Column, out: str, parts: int | None = None
) -> DataFrame:
    """The last non-null ``value`` up to and with the current row."""
    return running(df, keys, order, Running(out, "last", value), parts=parts)


# ---- key/value runs -----------------------------------------------------------


def run_numbers(pairs: DataFrame, keys: Sequence[str], first_key: str, parts: int | None = None) -> DataFrame:
    """``run`` of each ordered pair: a new run at every ``first_key``; before it, run 0."""
    starts = (F.col("k") == first_key).cast("bigint")
    return running(pairs, keys, "pos", Running("run", "sum", F.coalesce(starts, F.lit(0))), parts=parts)


def fold_kv_runs(
    pairs: DataFrame,
    keys: Sequence[str],
    first_key: str,
    skip: Sequence[tuple] = (),
    parts: int | None = None,
) -> DataFrame:
    """One record per run of pairs ``pos, k, v``: ``run, record`` (a map, last value wins).

    ``unlabelled`` is the last value that stands under a NULL label, which no map can hold.
    Listed pairs are left out and a run without pairs gives no record. Within a run the last
    value per field is taken by a combining aggregate, so only the fields of a record, not its
    pairs, come together in one row.
    """
    keys = as_list(keys)
    kept = exclude_pairs(run_numbers(pairs, keys, first_key, parts), "k", "v", skip)
    fields = kept.groupBy(*keys, "run", "k").agg(F.max_by("v", "pos").alias("v"))
    pair = F.when(F.col("k").isNotNull(), F.struct("k", "v"))
    return fields.groupBy(*keys, "run").agg(
        F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("record"),
        F.max(F.when(F.col("k").isNull(), F.col("v"))).alias("unlabelled"),
    )


# The fields of declarations that hold a company or an amount in litas.
COMPANY_FIELDS = ("Kitos sandorio salies pavadinimas", "Juridinio asmens pavadinimas")
AMOUNT_LT, AMOUNT_EUR = "Sandorio suma Lt", "Sandorio suma Eur"


def declaration_pairs(pairs: DataFrame) -> DataFrame:
    """Company fields cleaned next to their original, amounts in litas turned into euro.

    An original takes the position of its field, so later folding treats both alike.
    """
    company = F.col("k").isin(*COMPANY_FIELDS)
    amount = F.col("k") == AMOUNT_LT
    original = F.struct(F.concat(F.col("k"), F.lit(" (originalus)")).alias("k"), F.col("v").alias("v"))
    cleaned = F.struct(
        F.when(amount, F.lit(AMOUNT_EUR)).otherwise(F.col("k")).alias("k"),
        F.when(company, clean_company(F.col("v")))
        .when(amount, F.coalesce(lt_to_eur(F.col("v")).cast("string"), F.col("v")))
        .otherwise(F.col("v"))
        .alias("v"),
    )
    rest = [c for c in pairs.columns if c not in ("k", "v")]
    out = F.when(company, F.array(original, cleaned)).otherwise(F.array(cleaned))
    return pairs.select(*rest, F.inline(out))


# ---- segments and turns -------------------------------------------------------

# Signs that mark places in a text; a text's own are written as an escape meanwhile.
_OPEN, _CLOSE, _ESCAPE = "\u0001", "\u0002", "\u0003"
_ESCAPES = ((_ESCAPE, "c"), (_OPEN, "a"), (_CLOSE, "b"))


def _escaped(c: Column) -> Column:
    for sign, letter in _ESCAPES:
        c = F.replace(c, F.lit(sign), F.lit(_ESCAPE + letter))
    return c


def _unescaped(c: Column) -> Column:
    for sign, letter in reversed(_ESCAPES):
        c = F.replace(c, F.lit(_ESCAPE + letter), F.lit(sign))
    return c


def segment_text(docs: DataFrame, pattern: str, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``pos, marker, tail`` for each match: the text from it up to the next match.

    Text before the first marker is dropped. Map-only: the text is marked in place and split.
    """
    marked = F.regexp_replace(_escaped(F.col(text)), f"(?m)({pattern})", f"{_OPEN}$1{_CLOSE}")
    parts = T.let(F.split(marked, _OPEN), lambda p: F.slice(p, F.lit(2), F.size(p)))
    rows = docs.select(*keep, F.posexplode(parts).alias("pos", "__s"))
    return rows.select(
        *keep,
        "pos",
        _unescaped(F.substring_index("__s", _CLOSE, 1)).alias("marker"),
        _unescaped(F.substring_index("__s", _CLOSE, -1)).alias("tail"),
    )


def assemble_turns(
    segments: DataFrame,
    doc: Sequence[str],
    is_speaker: Column,
    text: Column,
    carried: Sequence[str] = (),
    time: Column | None = None,
    sep: str = "\n\n",
    parts: int | None = None,
    also: Sequence[Running] = (),
) -> DataFrame:
    """Merge segments ``pos`` into turns: ``rowno`` (from 1), ``text``, the opener's columns.

    ``also`` are further values running along the segments, which ``carried`` may name.

    A segment that opens no turn belongs to the open one; segments before the first opener
    vanish. ``time`` is the last clock up to the end of the turn, or the document's first.
    """
    doc = as_list(doc)
    base = segments.withColumn("__open", F.coalesce(is_speaker, F.lit(False))).withColumn("__text", text)
    specs = [Running("rowno", "sum", F.col("__open").cast("bigint")), *also]
    if time is not None:
        base = base.withColumn("__time", time)
        specs.append(Running("__clock", "last", F.col("__time")))
    base = place(base, doc, "pos", parts)
    numbered = running(base, doc, "pos", *specs)
    opener = F.when(F.col("__open"), F.col("pos"))
    chunks = F.array_sort(F.collect_list(F.struct("pos", F.col("__text").alias("t"))))
    aggs = [
        F.array_join(F.transform(chunks, lambda s: s["t"]), sep).alias("text"),
        *[F.max_by(F.col(c), opener).alias(c) for c in carried],
    ]
    if time is not None:
        aggs.append(F.max_by(F.col("__clock"), F.when(F.col("__clock").isNotNull(), F.col("pos"))).alias("__t"))
    turns = numbered.where("rowno > 0").groupBy(*doc, "rowno").agg(*aggs)
    if time is None:
        return turns
    # A turn before the first clock has the document's first: only documents are joined.
    opening = base.where("__time IS NOT NULL").groupBy(*doc).agg(F.min_by("__time", "pos").alias("__first"))
    opening = opening.withColumnsRenamed({d: f"__d{i}" for i, d in enumerate(doc)})
    same = reduce(and_, [F.col(d).eqNullSafe(F.col(f"__d{i}")) for i, d in enumerate(doc)])
    timed = turns.join(opening.hint("merge"), same, "left")  # as many rows as documents, which packed files do not show
    return timed.select(*doc, "rowno", F.coalesce("__t", "__first").alias("time"), "text", *carried)


def classify_segments(segments: DataFrame, emphasis: Column) -> DataFrame:
    """Clock, speaker or plain, with the speaker's brackets, group and named chair.

    Input has ``marker, tail``; ``emphasis`` is the array of emphasised heads of the document.
    """
    marker, tail = F.col("marker"), F.col("tail")
    time = T.clock(marker)
    speaks = time.isNull() & T.is_upper(marker) & F.array_contains(emphasis, marker)
    items = F.when(speaks, T.bracket_items(tail))
    out = segments.withColumn("time", time).withColumn("is_speaker", F.coalesce(speaks, F.lit(False)))
    out = out.withColumn("__items", items)
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    out = out.withColumn(
        "text",
        F.when(F.col("time").isNotNull(), strip(tail))
        .when(F.col("is_speaker"), strip(T.bracket_rest(tail)))
        .otherwise(F.concat(marker, tail)),
    )
    out = out.withColumn("speaker", F.when(F.col("is_speaker"), marker))
    out = out.withColumn("parliamentary_group", T.first_acronym(F.col("__items")))
    out = out.withColumn("__items", T.without_first_acronym(F.col("__items")))
    out = out.withColumn("is_chair", F.coalesce(F.col("speaker").startswith("PIRMININK"), F.lit(False)))
    named = F.col("is_chair") & (F.size("__items") == 1)
    return out.withColumn("pirmininkas", F.when(named, F.col("__items")[0])).drop("__items")


def parse_transcripts(
    docs: DataFrame, members: DataFrame, chairs: DataFrame, keep: Sequence[str] = ("source", "date")
) -> DataFrame:
    """Transcript text to attributed turns.

    ``docs`` has ``key, text, emphasis`` (array of emphasised texts) and the ``keep`` columns,
    among them ``date``.
    """
    heads = F.array_compact(F.transform("emphasis", T.emphasis_head))
    marked = docs.withColumn("__heads", heads)
    cut = segment_text(marked, f"(?U:{T.SPEAKER_MARK})", ["key", *keep, "__heads"])
    # Text is cut and classified once and written; placing it samples the written rows.
    segments = write_once(classify_segments(cut, F.col("__heads")).drop("__heads"), "segments")
    turns = assemble_turns(
        segments,
        ["key"],
        F.col("is_speaker"),
        F.col("text"),
        [*keep, "speaker", "parliamentary_group", "pirmininkas", "is_chair", "chair_name"],
        time=F.col("time"),
        also=[Running("chair_name", "last", F.col("pirmininkas"))],
    )
    named = attribute_roles(write_once(turns, "turns"), members, chairs, "date")
    return named.select(
        "key",
        *keep,
        "rowno",
        "time",
        "speaker",
        "text",
        "parliamentary_group",
        "position",
        "vardas",
        "pavarde",
        "pirmininkas",
    )


# ---- intervals and series ------------------------------------------------------


def merge_intervals(df: DataFrame, group: Sequence[str], lo: str, hi: str, parts: int | None = None) -> DataFrame:
    """Union of whole-number intervals per group: ``group, lo, hi``; touching ones merge.

    Intervals of one start are combined before the shuffle and placed once; both passes read
    them where they lie.
    """
    group = as_list(group)
    starts = df.groupBy(*group, F.col(lo).cast("bigint").alias("lo")).agg(F.max(F.col(hi).cast("bigint")).alias("hi"))
    placed = place(starts, group, "lo", parts)
    reach = running(placed, group, "lo", Running("__reach", "max", F.col("hi"), before=True), keep_part=True)
    fresh = (F.col("__reach").isNull() | (F.col("lo") > F.col("__reach"))).cast("bigint")
    island = running(reach, group, "lo", Running("__island", "sum", fresh))
    return (
        island.groupBy(*group, "__island")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .drop("__island")
    )


def interval_totals(merged: DataFrame, group: Sequence[str]) -> DataFrame:
    """``start, end, duration`` over merged intervals; the length is end minus start."""
    return merged.groupBy(*as_list(group)).agg(
        F.min("lo").alias("start"), F.max("hi").alias("end"), F.sum(F.col("hi") - F.col("lo")).alias("duration")
    )


def with_group_min(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """The least ``value`` of the group on each of its rows (the base time of a forecast)."""
    least = df.groupBy(*as_list(group)).agg(F.min(value).alias(out))
    return df.join(least, as_list(group))


def latest_forecast(forecasts: DataFrame, target: str = "time", base: str = "base") -> DataFrame:
    """For each target time the row of the latest issue time; of several, the greatest row.

    A whole row is taken, never columns of two.
    """
    rest = [c for c in forecasts.columns if c not in (target, base)]
    last = forecasts.groupBy(target).agg(F.max(F.struct(base, *rest)).alias("row"))
    return last.select(target, "row.*")


def series_stats(series: DataFrame, group: Sequence[str], value: str, rank: str) -> DataFrame:
    """``mean, max, top`` and ``best_rank``.

    A year without a rank counts as rank 0, so ``top`` is 0 when any is missing;
    ``best_rank`` leaves those years out.
    """
    return series.groupBy(*as_list(group)).agg(
        F.avg(value).alias("mean"),
        F.max(value).alias("max"),
        F.min(F.coalesce(F.col(rank), F.lit(0))).alias("top"),
        F.min(rank).alias("best_rank"),
    )


def popularity(ranks: Column, values: Column) -> Column:
    """Array of (year, value, rank): values stand in the numeric order of the ranks' years."""
    def zipped(ranks: Column) -> Column:
        years = F.array_sort(F.transform(F.map_keys(ranks), lambda y: y.cast("int")))
        return F.transform(
            F.arrays_zip(years.alias("year"), values.alias("value")),
            lambda p: F.struct(
                p["year"].alias("year"),
                p["value"].alias("value"),
                F.nullif(F.try_element_at(ranks, p["year"].cast("string")), F.lit("")).cast("int").alias("rank"),
            ),
        )

    return T.let(ranks, zipped)
