"""Projection, recoding and nested-column work."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .log import as_list


def project(df: DataFrame, key: Column, fields: dict[str, Column]) -> DataFrame:
    """``key`` and one ``value`` struct."""
    return df.select(
        key.alias("key"), F.struct(*[c.alias(name) for name, c in fields.items()]).alias("value")
    )


def flatten(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Dotted paths as flat columns of that name; a NULL struct gives NULLs."""
    return df.select(*[F.col(path).alias(path) for path in paths])


def first_complete(*alternatives: dict[str, tuple[Column, bool]]) -> Column:
    """The first struct whose required fields are all there, taken whole.

    Each alternative maps a field to (column, required).
    """
    structs = []
    for fields in alternatives:
        whole = F.struct(*[c.alias(name) for name, (c, _) in fields.items()])
        required = [c.isNotNull() for c, needed in fields.values() if needed]
        ready = F.lit(True)
        for condition in required:
            ready = ready & condition
        structs.append(F.when(ready, whole))
    return F.coalesce(*structs)


def apply_overrides(
    df: DataFrame,
    overrides: DataFrame | dict,
    on: str,
    col: str,
    default: Column | None = None,
) -> DataFrame:
    """Final values by key over a computed column, laid on last.

    A dict is written by hand and therefore small. A table is joined on its key and the
    optimizer broadcasts it only when it measures small. ``default`` fills the misses.
    """
    computed = F.col(col) if default is None else default
    if isinstance(overrides, dict):
        table = F.create_map(*[F.lit(x) for pair in overrides.items() for x in pair])
        hit = F.map_contains_key(table, F.col(on))
        return df.withColumn(
            col, F.when(hit, F.try_element_at(table, F.col(on))).otherwise(computed)
        )
    table = overrides.select(
        F.col(on), F.col(col).alias("__value"), F.lit(True).alias("__hit")
    )
    joined = df.join(table, on, "left")
    final = F.when(F.col("__hit"), F.col("__value")).otherwise(computed)
    return joined.withColumn(col, final).select(*df.columns)


def drop_first(arr: Column, n: int) -> Column:
    return F.slice(arr, F.lit(n + 1), F.greatest(F.size(arr) - n, F.lit(0)))


def prefer(arr: Column, ranking: Sequence[str], kind: Callable[[Column], Column]) -> Column:
    """The item whose ``kind`` ranks first, by position among equals; else the first item."""
    order = F.array(*[F.lit(r) for r in ranking])

    def score(item, i):
        at = F.array_position(order, F.coalesce(kind(item), F.lit("")))
        rank = F.when(at > 0, at).otherwise(F.lit(len(ranking) + 1))
        return F.struct(rank.alias("rank"), i.alias("pos"), item.alias("item"))

    return F.array_min(F.transform(arr, score))["item"]


def path_segment_from_end(c: Column, n: int) -> Column:
    return F.get(F.reverse(F.split(c, "/")), F.lit(n - 1))


def exclude_pairs(df: DataFrame, key: str, value: str, skip: Sequence[tuple]) -> DataFrame:
    """Rows whose (key, value) is not listed; (NULL, NULL) is always left out."""
    for k, v in [(None, None), *skip]:
        df = df.where(~(F.col(key).eqNullSafe(F.lit(k)) & F.col(value).eqNullSafe(F.lit(v))))
    return df


def sections(df: DataFrame, entries: str, kind: str, keep: Sequence[str]) -> DataFrame:
    """Ordered pairs of the entries whose title is ``kind``: ``entry, pos, k, v``."""
    entry = df.select(*keep, F.posexplode(entries).alias("entry", "__e")).where(
        F.col("__e")["kind"] == kind
    )
    return entry.select(
        *keep, "entry", F.posexplode(F.col("__e")["pairs"]).alias("pos", "__p")
    ).select(*keep, "entry", "pos", F.col("__p")["k"].alias("k"), F.col("__p")["v"].alias("v"))


def section_keys(df: DataFrame, entries: str, kind: str, keep: Sequence[str]) -> DataFrame:
    """The section that lists bare keys: one row per key."""
    return sections(df, entries, kind, keep).select(*keep, "entry", "pos", F.col("k").alias("other"))


def explode_children(df: DataFrame, col: str, keep: Sequence[str], outer: bool = False) -> DataFrame:
    """Array of struct to rows with the parent's columns copied in."""
    explode = F.posexplode_outer if outer else F.posexplode
    rows = df.select(*keep, explode(col).alias("pos", "__child"))
    fields = df.schema[col].dataType.elementType.fieldNames()
    return rows.select(*keep, "pos", *[F.col("__child")[f].alias(f) for f in fields])


def with_parent(child: DataFrame, parent: DataFrame, on: str, cols: Sequence[str]) -> DataFrame:
    """Child rows with columns of the parent that linked them."""
    return child.join(parent.select(on, *cols), on, "left")


def conditional_column(df: DataFrame, name: str, code: Column, codes: Sequence[str], value: Column) -> DataFrame:
    """``value`` where the code is listed, NULL elsewhere; no row is dropped."""
    return df.withColumn(name, F.when(code.isin(*codes), value))


def in_list(df: DataFrame, col: str, change: Callable[[Column], Column]) -> DataFrame:
    """Rewrite every element of an array of structs; the list keeps its order and length."""
    return df.withColumn(col, F.transform(col, change))


def union_tagged(sources: dict, tag: str) -> DataFrame:
    """Tables of one shape, or nearly, under a tag column."""
    parts = [df.withColumn(tag, F.lit(value)) for value, df in sources.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def explode_roles(members: DataFrame, key: str = "p_asm_id") -> DataFrame:
    """Factions and duties of a member as one child table with a type tag."""
    factions = members.select(key, F.explode("factions").alias("r")).select(
        key,
        F.col("r")["unit_id"].alias("unit_id"),
        F.col("r")["since"].alias("since"),
        F.col("r")["until"].alias("until"),
        F.col("r")["duty"].alias("duty"),
        F.col("r")["faction"].alias("unit"),
        F.lit("Frakcijose").alias("kind"),
    )
    duties = members.select(key, F.explode("duties").alias("r")).select(
        key,
        F.col("r")["unit_id"].alias("unit_id"),
        F.col("r")["since"].alias("since"),
        F.col("r")["until"].alias("until"),
        F.col("r")["duty"].alias("duty"),
        F.coalesce(F.col("r")["title"], F.col("r")["unit"]).alias("unit"),
        F.col("r")["kind"].alias("kind"),
    )
    return factions.unionByName(duties)


def pivot_levels(
    df: DataFrame, key: str, level: str, levels: Sequence[int], name: str, number: str
) -> DataFrame:
    """One column pair per level: the name and number of the highest-numbered row."""
    wide = []
    for n in levels:
        here = F.when(F.col(level) == n, F.col(number))
        wide.append(F.max_by(F.col(name), here).alias(f"admin_level_{n}"))
        wide.append(F.max(here).alias(f"admin_level_{n}_osm_id"))
    return df.groupBy(*as_list(key)).agg(*wide)


def zip_pairs(labels: Column, values: Column) -> Column:
    """Label and value lists paired up to the longer one."""
    n = F.greatest(F.size(labels), F.size(values))
    return F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(F.get(labels, i).alias("k"), F.get(values, i).alias("v")),
        ),
    ).otherwise(F.array().cast("array<struct<k:string,v:string>>"))


def last_wins_map(pairs: Column) -> Column:
    """Array of (k, v) to a map without NULL keys; the last of repeated keys wins."""

    # Map building is strict about repeated keys, so earlier repeats go first.
    def last_only(pairs: Column, keys: Column) -> Column:
        return F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), p["k"]))

    named = F.filter(pairs, lambda p: p["k"].isNotNull())
    kept = let(
        named, lambda ps: let(F.transform(ps, lambda p: p["k"]), lambda keys: last_only(ps, keys))
    )
    return F.map_from_entries(kept)
