"""How far the sources of a language differ in their words, by sparse merges of pairs of sources."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import write_once

from .frames import col

#: Bytes of a term stand for themselves, A-Z lower-cased; all others end a term.
TERM_BYTES = bytes(c if c >= 0x80 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
UNITS = 1_000_000_000


def terms(text: str) -> list[bytes]:
    """The terms of a text: runs of letters A-Z (lower-cased) and characters beyond ASCII."""
    return text.encode().translate(TERM_BYTES).split()


def share(count, smooth: int, total):
    """``1 + floor(UNITS * (count + smooth) / total)``, exactly, for whole numbers below 9e15.

    Long division, three decimal digits at a time, so that no product leaves 64 bits.
    """
    left, found = count + smooth, 0 * (count + smooth)
    whole_, left = left // total, left % total
    found = found + whole_
    for _ in range(3):
        left = left * 1000
        found = found * 1000 + left // total
        left = left % total
    return found + 1


def share_of(count: Column, smooth: int, total: Column) -> Column:
    """``share`` as an expression over whole numbers of up to 28 digits."""
    top = F.lit(UNITS).cast("decimal(10,0)") * (count.cast("decimal(19,0)") + F.lit(smooth).cast("decimal(5,0)"))
    return F.call_function("div", top, total.cast("decimal(20,0)")) + 1


def counted_terms(docs: DataFrame, lang: Column, source: Column, text: Column, most: int = 4_000_000) -> DataFrame:
    """(``lang``, ``source``, ``term``, ``n``, ``docs``): occurrences and documents, in part sums.

    Each task adds up what it reads and hands it on whenever it holds ``most`` occurrences, or a
    quarter of that in different terms. Terms are numbered as they come, so what is held of an
    occurrence is a number. A row with the empty term stands for a group that occurs.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        held: dict[tuple[str, str], tuple[list[np.ndarray], list[np.ndarray]]] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            words = pa.array(list(numbers), pa.binary()).cast(pa.string())
            for (lang, source), (occurrences, in_docs) in held.items():
                n, docs = (np.bincount(np.concatenate(ids), minlength=len(words)) for ids in (occurrences, in_docs))
                used = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(used), pa.string()),
                        "source": pa.array([source] * len(used), pa.string()),
                        "term": words.take(pa.array(used)),
                        "n": pa.array(n[used], pa.int64()),
                        "docs": pa.array(docs[used], pa.int64()),
                    }
                )
            held.clear()
            numbers.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                key = (lang.as_py(), source.as_py())
                if key not in held:
                    marker = np.array([numbers[b""]])
                    held[key] = ([marker], [marker])
                found = terms(text.as_py())
                ids = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
                held[key][0].append(ids)
                held[key][1].append(np.unique(ids))
                size += len(ids)
                if size >= most or len(numbers) >= most // 4:
                    yield from handed()
                    size = 0
        yield from handed()

    schema = "lang string, source string, term string, n long, docs long"
    return docs.select(lang.alias("lang"), source.alias("source"), text.alias("text")).mapInArrow(count, schema)


def gallop(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    """For each of the sorted ``small``, the first place in sorted ``large`` that is not below it.

    All search at once: from where they would lie if ``large`` were even, steps double until
    they enclose the value, and halving finds it inside. Values near their guess cost few steps.
    """
    size = len(large)
    if not size or not len(small):
        return np.zeros(len(small), np.int64)
    low_value, high_value = int(large[0]), int(large[-1])
    guess = (small.astype(np.float64) - low_value) * (size / max(1, high_value - low_value + 1))
    low = np.clip(guess.astype(np.int64), 0, size - 1)
    high = low.copy()  # large[low - 1] < value <= large[high], with open ends outside
    step = 1
    while True:
        far = (low > 0) & (large[np.maximum(low - 1, 0)] >= small)
        if not far.any():
            break
        high[far] = low[far] - 1
        low[far] = np.maximum(low[far] - step, 0)
        step *= 2
    step = 1
    while True:
        far = (high < size) & (large[np.minimum(high, size - 1)] < small)
        if not far.any():
            break
        low[far] = np.maximum(low[far], high[far] + 1)
        high[far] = np.minimum(high[far] + step, size)
        step *= 2
    while (low < high).any():
        middle = (low + high) // 2
        less = large[np.minimum(middle, size - 1)] < small
        narrow = low < high
        low = np.where(narrow & less, middle + 1, low)
        high = np.where(narrow & ~less, middle, high)
    return low


def merged(one: tuple, other: tuple, smooth: int) -> tuple[int, int]:
    """(sum of differences, terms) over the terms that either of two groups has.

    A group is (sorted term ids, counts, total). Shared terms are found by galloping through
    the longer list; a term only one has meets the other's share of a count of zero.
    """
    if len(one[0]) > len(other[0]):
        one, other = other, one
    (ids, counts, total), (more_ids, more_counts, more_total) = one, other
    p, q = share(counts, smooth, total), share(more_counts, smooth, more_total)
    p0, q0 = int(share(0, smooth, total)), int(share(0, smooth, more_total))
    at = gallop(ids, more_ids)
    both = at < len(more_ids)
    both[both] = more_ids[at[both]] == ids[both]
    alone = np.ones(len(more_ids), bool)
    alone[at[both]] = False
    value = np.abs(p[both] - q[at[both]]).sum() + np.abs(p[~both] - q0).sum() + np.abs(q[alone] - p0).sum()
    return int(value), len(ids) + int(alone.sum())


def price_pairs(arrays: DataFrame, smooth: int) -> DataFrame:
    """Part sums (``lang``, ``one``, ``other``, ``value``, ``terms``) per unordered pair of groups.

    ``arrays`` has ``lang``, ``segment``, ``low``, ``high`` (the tiles of the task), ``tile``,
    ``source``, ``total``, ``ids`` and ``counts``. A task holds two tiles of one segment.
    """

    def price(table: pa.Table) -> pa.Table:
        lang, low, high = (table[c][0].as_py() for c in ("lang", "low", "high"))
        groups = [
            (
                tile, source, (ids.values.to_numpy(), counts.values.to_numpy(), np.int64(total))
            )
            for tile, source, total, ids, counts in zip(
                table["tile"].to_pylist(), table["source"].to_pylist(), table["total"].to_pylist(), table["ids"], table["counts"], strict=True
            )
        ]
        pairs = [(a, b) for a in groups for b in groups if a[1] < b[1] and {a[0], b[0]} == {low, high}]
        done = [(a[1], b[1], *merged(a[2], b[2], smooth)) for a, b in pairs]
        columns = list(zip(*done, strict=True)) or [[], [], [], []]
        types = (pa.string(), pa.string(), pa.int64(), pa.int64())
        body = {n: pa.array(list(c), t) for n, c, t in zip(("one", "other", "value", "terms"), columns, types, strict=True)}
        return pa.table({"lang": pa.array([lang] * len(done), pa.string()), **body})

    schema = "lang string, one string, other string, value long, terms long"
    return arrays.groupBy("lang", "segment", "low", "high").applyInArrow(price, schema)


def audit_sources(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = 30,
    smooth: int = 5,
    top: int = 50,
    segment: int = 8_192,
    tile: int = 8,
) -> DataFrame:
    """How each (``lang``, ``source``) differs from the language's other sources and from the language.

    A language keeps the terms that at least ``least_docs`` of its documents hold. Every group
    and every language gives each kept term its smoothed share in billionths (``share``). Rows
    with ``part`` 'pair' hold the sum of absolute differences over all kept terms to each other
    source (``item``), all ranks; rows with ``part`` 'term' the ``top`` terms the group uses more
    than its language, by that difference. ``rank`` is by value, then by item in UTF-8 order.

    * Null text, language and source count as the empty string, which is a group like others.
    * A group without terms is compared all the same; a language that keeps no term gives pairs
      of value 0. A lone source gives no pairs.
    * Repeated rows count as often as they occur. An empty table gives an empty result. Other
      columns are not read. Texts of any length are counted whole.

    Tasks add up counts before anything is shuffled, so no hot term or group is met row by row.
    Kept terms are numbered inside hashed segments of about ``segment`` terms. Each group is one
    sorted array per segment, and the arrays of two tiles of ``tile`` groups meet in one task,
    which prices their pairs and adds nothing for terms that both lack: those are counted and
    priced once per pair at the end.
    """
    named = [F.coalesce(col(c).cast("string"), F.lit("")) for c in (lang, source, text)]
    parts = write_once(counted_terms(docs, *named), "term_parts")
    groups = write_once(parts.where("term = ''").select("lang", "source").distinct(), "groups")
    by_term = parts.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = write_once(by_term.where(F.col("docs") >= least_docs).drop("docs"), "kept_terms")
    segments = max(1, -(-kept.count() // segment))
    place = Window.partitionBy("lang", "segment").orderBy("term")
    kept = write_once(
        kept.withColumn("segment", F.pmod(F.xxhash64("term"), F.lit(segments))).withColumn("id", F.row_number().over(place)),
        "numbered_terms",
    )
    used = write_once(
        parts.where("term <> ''").select("lang", "source", "term", "n").join(kept, ["lang", "term"])
        .groupBy("lang", "source", "term", "segment", "id", "lang_n").agg(F.sum("n").alias("n")),
        "used_terms",
    )

    # A lang's kept terms, a group's and a lang's total: the denominators of all shares.
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_sum"))
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("group_sum"))
    numbered = Window.partitionBy("lang").orderBy("source")
    facts = (
        groups.join(sizes, "lang", "left").join(sums, ["lang", "source"], "left")
        .select(
            "lang", "source", F.coalesce("v", F.lit(0)).alias("v"),
            (F.coalesce("group_sum", F.lit(0)) + smooth * F.coalesce("v", F.lit(0))).alias("total"),
            (F.coalesce("lang_sum", F.lit(0)) + smooth * F.coalesce("v", F.lit(0))).alias("lang_total"),
            F.floor((F.row_number().over(numbered) - 1) / tile).cast("int").alias("tile"),
        )
    )
    facts = write_once(facts, "group_facts")

    entry = F.array_sort(F.collect_list(F.struct("id", "n")))
    arrays = used.groupBy("lang", "source", "segment").agg(entry.alias("e")).select(
        "lang", "source", "segment", F.col("e.id").alias("ids"), F.col("e.n").alias("counts")
    )
    # Every group has a row in every segment, be it without terms, so that one-sided terms are
    # priced against it and all pairs are met.
    tiles = facts.groupBy("lang").agg(F.max("tile").alias("last_tile"))
    every = facts.select(
        "lang", "source", "tile", F.greatest("total", F.lit(1)).alias("total"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(segments - 1).cast("long"))).alias("segment"),
    )
    none = lambda name, kind: F.coalesce(name, F.array().cast(f"array<{kind}>")).alias(name)
    ready = every.join(arrays, ["lang", "source", "segment"], "left").select(
        "lang", "source", "segment", "tile", "total", none("ids", "int"), none("counts", "bigint")
    )
    ready = ready.join(tiles, "lang").withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("last_tile"))))
    ready = ready.withColumn("low", F.least("tile", "meets")).withColumn("high", F.greatest("tile", "meets"))
    priced = price_pairs(ready.drop("meets", "last_tile"), smooth)
    summed = priced.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))

    total_of = lambda name: facts.select("lang", F.col("source").alias(name), F.col("v"), F.greatest("total", F.lit(1)).alias(f"{name}_total"))
    zero = lambda name: share_of(F.lit(0), smooth, F.col(f"{name}_total"))
    both = summed.join(total_of("one"), ["lang", "one"]).join(total_of("other").drop("v"), ["lang", "other"])
    absent = (F.col("v") - F.col("terms")) * F.abs(zero("one") - zero("other"))
    value = F.when(F.col("v") == 0, F.lit(0)).otherwise(F.col("value") + F.when(F.col("v") > 0, absent))
    both = both.select("lang", "one", "other", value.cast("long").alias("value"))
    way = lambda a, b: both.select("lang", F.col(a).alias("source"), F.lit("pair").alias("part"), F.col(b).alias("item"), "value")
    pairs = way("one", "other").unionByName(way("other", "one"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    rated = used.join(facts, ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (share_of(F.col("n"), smooth, F.col("total")) - share_of(F.col("lang_n"), smooth, F.col("lang_total"))).cast("long").alias("value"),
    )
    best = rated.where("value > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(best)
