"""Point-in-polygon and nearest-within-radius joins, as equality joins on grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..session import cut_lineage

LEAF = 32  # distinct places a grid cell may hold before the search refines it


FINE = 4  # a polygon's box is laid on a grid of up to 2 ** FINE + 1 cells a side


def contains_join(points: DataFrame, polygons: DataFrame) -> DataFrame:
    """``point_id, polygon_id`` for every point strictly inside a polygon.

    ``points`` has ``point_id, x, y``; ``polygons`` has ``polygon_id, edges``. A polygon is cut
    into cells in proportion to its box. A cell that no edge comes near lies inside as a whole,
    and answers without a test, or is left out; any other holds only the edges of its band that
    a ray to the right can meet. So the points of a large polygon are spread over many keys, and
    none meets the whole outline. A point probes one cell on each grid in use.
    """
    xs, ys = F.transform("edges", lambda e: e["x1"]), F.transform("edges", lambda e: e["y1"])
    box = polygons.select(
        "polygon_id",
        "edges",
        F.array_min(xs).alias("x_lo"),
        F.array_max(xs).alias("x_hi"),
        F.array_min(ys).alias("y_lo"),
        F.array_max(ys).alias("y_hi"),
    )
    extent = F.greatest(F.col("x_hi") - F.col("x_lo"), F.col("y_hi") - F.col("y_lo"), F.lit(1e-9))
    box = box.withColumn("grid", (F.ceil(F.log2(extent)) - FINE).cast("int"))
    # At most one number per power of two in the data: a handful.
    grids = [r.grid for r in box.select("grid").distinct().collect()]
    size = F.pow(F.lit(2.0), F.col("grid"))

    def cells(lo: str, hi: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(lo) / size).cast("bigint"), F.floor(F.col(hi) / size).cast("bigint")))

    def banded(axis: str, lo: Column, hi: Column | None) -> Column:
        ends = lambda e: (e[f"{axis}1"], e[f"{axis}2"])
        above = lambda e: F.greatest(*ends(e)) >= lo
        return F.filter("edges", lambda e: above(e) if hi is None else above(e) & (F.least(*ends(e)) <= hi))

    hair = size * 1e-9  # an edge that ends at a cell's border counts for both sides
    x0, y0 = F.col("cx") * size, F.col("cy") * size
    covered = (
        box.withColumn("cy", cells("y_lo", "y_hi"))
        .withColumn("edges", banded("y", y0 - hair, y0 + size + hair))
        .withColumn("cx", cells("x_lo", "x_hi"))
        .withColumn("edges", banded("x", x0 - hair, None))
        .withColumn("near", F.exists("edges", lambda e: F.least(e["x1"], e["x2"]) <= x0 + size + hair))
        .where(F.col("near") | geo.inside(F.col("edges"), x0 + size / 2, y0 + size / 2))
        .select("polygon_id", "grid", "cx", "cy", F.when(F.col("near"), F.col("edges")).alias("edges"))
    )
    probes = points.select(
        "point_id", "x", "y", F.explode(F.array(*[F.lit(n) for n in grids]).cast("array<int>")).alias("grid")
    )
    probes = probes.withColumn("cx", F.floor(F.col("x") / size).cast("bigint"))
    probes = probes.withColumn("cy", F.floor(F.col("y") / size).cast("bigint"))
    met = probes.join(covered, ["grid", "cx", "cy"])
    held = F.col("edges").isNull() | geo.inside(F.col("edges"), F.col("x"), F.col("y"))
    return met.where(held).select("point_id", "polygon_id")


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    metric: str = "mercator",
    leaf: int = LEAF,
) -> DataFrame:
    """Left join each point to its nearest right point within ``radius``.

    Both sides have ``id, lon, lat``. Adds ``near_id, distance``; NULL without a hit. Equal
    distances go to the smaller id. ``radius`` and ``distance`` are Web-Mercator units, or
    ground metres with ``metric="haversine"`` (searched along straight chords, which order
    points as arcs do).

    Equal places are searched once. The right places stand on a grid of ``radius``-sized
    cells; while a cell holds more than ``leaf`` places the grid is halved, and the search
    descends: a left place keeps only the cells that can still hold its nearest neighbour
    (closest corner not beyond the best farthest corner), so dense spots do not pair all
    with all.
    """
    if metric == "mercator":
        axes = lambda: [geo.mercator_x(F.col("lon")), geo.mercator_y(F.col("lat"))]
        reach = float(radius)
    elif metric == "haversine":
        axes = lambda: geo.sphere(F.col("lon"), F.col("lat"))
        reach = 2 * geo.EARTH_RADIUS * math.sin(radius / (2 * geo.EARTH_RADIUS))
    else:
        raise ValueError(f"unknown metric {metric!r}")

    dims = range(len(axes()))
    place = ["lon", "lat"]
    right_places = (
        right.where("lon IS NOT NULL AND lat IS NOT NULL")
        .groupBy(*place)
        .agg(F.min("id").alias("near_id"))
        .select("near_id", *[a.alias(f"r{d}") for d, a in zip(dims, axes())])
    )
    left_places = left.select(*place).where("lon IS NOT NULL AND lat IS NOT NULL").distinct()
    left_places = left_places.select(*place, *[a.alias(f"l{d}") for d, a in zip(dims, axes())])

    def cells(prefix: str, depth: int) -> list[Column]:
        size = reach / 2**depth
        return [F.floor(F.col(f"{prefix}{d}") / F.lit(size)).cast("bigint") for d in dims]

    depth = 0
    while True:  # ends: distinct places part once cells are smaller than what a double tells apart
        if depth == 1:  # dense: the places are read once per level from here on
            right_places = cut_lineage(right_places)
        crowd = right_places.groupBy(*cells("r", depth)).count().agg(F.max("count")).first()[0]
        if (crowd or 0) <= leaf:
            break
        depth += 1

    grid = right_places.select(
        "*", *[c.alias(f"cell{d}") for d, c in zip(dims, cells("r", depth))]
    )

    def at(level: int) -> list[Column]:
        return [F.shiftright(F.col(f"cell{d}"), depth - level) for d in dims]

    def gap(a: Column, lo: Column, hi: Column) -> Column:
        return F.greatest(lo - a, a - hi, F.lit(0.0))

    def span(a: Column, lo: Column, hi: Column) -> Column:
        return F.greatest(F.abs(a - lo), F.abs(a - hi))

    def norm(parts: list[Column]) -> Column:
        total = parts[0] * parts[0]
        for p in parts[1:]:
            total = total + p * p
        return F.sqrt(total)

    def boxes(level: int) -> DataFrame:
        ranges = [
            agg(f"r{d}").alias(f"{name}{d}") for d in dims for agg, name in ((F.min, "lo"), (F.max, "hi"))
        ]
        up = [c.alias(f"up{d}") for d, c in zip(dims, at(max(level - 1, 0)))]
        here = [c.alias(f"c{d}") for d, c in zip(dims, at(level))]
        return grid.select(*up, *here, *[f"r{d}" for d in dims]).groupBy(
            *[f"up{d}" for d in dims], *[f"c{d}" for d in dims]
        ).agg(*ranges)

    probe = left_places
    for d, c in zip(dims, cells("l", 0)):
        probe = probe.withColumn(f"up{d}", F.explode(F.sequence(c - 1, c + 1)))

    lefts = [f"l{d}" for d in dims]
    ups = [f"up{d}" for d in dims]
    if depth:
        frontier = probe
        for level in range(depth + 1):
            lo, hi = [F.col(f"lo{d}") for d in dims], [F.col(f"hi{d}") for d in dims]
            here = [F.col(x) for x in lefts]
            met = frontier.join(boxes(level), ups)
            met = met.withColumn("__near", norm([gap(a, b, c) for a, b, c in zip(here, lo, hi)]))
            met = met.withColumn("__far", norm([span(a, b, c) for a, b, c in zip(here, lo, hi)]))
            met = met.where(F.col("__near") <= reach)
            frontier = (
                # a place's own candidates: few, as the previous level pruned them
                met.withColumn("__best", F.min("__far").over(Window.partitionBy(*place)))
                # a hair of slack, so that rounding never drops a tie
                .where(F.col("__near") <= F.col("__best") * (1 + 1e-12) + 1e-9)
                .select(*place, *lefts, *[F.col(f"c{d}").alias(f"up{d}") for d in dims])
            )
        probe = frontier
    leaves = grid.select(
        "near_id", *[f"r{d}" for d in dims], *[F.col(f"cell{d}").alias(f"up{d}") for d in dims]
    )
    met = probe.join(leaves, ups)
    met = met.withColumn("__d", norm([F.col(f"r{d}") - F.col(f"l{d}") for d in dims]))
    nearest = (
        met.where(F.col("__d") <= reach)
        .groupBy(*place)
        .agg(F.min(F.struct(F.col("__d"), F.col("near_id"))).alias("__hit"))
    )
    distance = F.col("__hit")["__d"]
    if metric == "haversine":
        distance = F.asin(F.least(distance / (2 * geo.EARTH_RADIUS), F.lit(1.0))) * 2 * geo.EARTH_RADIUS
    nearest = nearest.select(*place, F.col("__hit")["near_id"].alias("near_id"), distance.alias("distance"))
    return left.join(nearest, place, "left").select(*left.columns, "near_id", "distance")
