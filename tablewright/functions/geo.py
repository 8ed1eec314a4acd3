"""Plane and sphere coordinates, polygon edges, centroid and the inside test."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MERCATOR_RADIUS = 6378137.0
EARTH_RADIUS = 6371008.8


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * MERCATOR_RADIUS


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * MERCATOR_RADIUS


def sphere(lon: Column, lat: Column) -> list[Column]:
    """Metres from the earth's centre along three axes."""
    lon, lat = F.radians(lon), F.radians(lat)
    return [
        F.cos(lat) * F.cos(lon) * EARTH_RADIUS,
        F.cos(lat) * F.sin(lon) * EARTH_RADIUS,
        F.sin(lat) * EARTH_RADIUS,
    ]


def ring_edges(ring: Column) -> Column:
    """``ARRAY<STRUCT<x,y>>`` to its edges, closed; several rings' edges may be concatenated."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1)))
    return F.zip_with(
        ring,
        following,
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def centroid(edges: Column) -> tuple[Column, Column]:
    """Area-weighted centre from the shoelace sums."""

    def total(term) -> Column:
        return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + term(e))

    def cross(e) -> Column:
        return e["x1"] * e["y2"] - e["x2"] * e["y1"]

    area2 = total(cross)
    return (
        total(lambda e: (e["x1"] + e["x2"]) * cross(e)) / (area2 * 3),
        total(lambda e: (e["y1"] + e["y2"]) * cross(e)) / (area2 * 3),
    )


def inside(edges: Column, x: Column, y: Column) -> Column:
    """Odd number of crossings to the right, and not on an edge."""

    def crosses(e) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        return spans & (x < at)

    def touches(e) -> Column:
        turn = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        within = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(
            F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
        )
        return (turn == 0) & within

    odd = F.size(F.filter(edges, crosses)) % 2 == 1
    return odd & ~F.exists(edges, touches)
