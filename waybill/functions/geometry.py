"""Polygons as GeoJSON text, and predicates over their rings, in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import LATITUDE_BOUNDS, LONGITUDE_BOUNDS

POLYGON = "struct<type:string,coordinates:array<array<array<double>>>>"


def parse(geojson: Column) -> Column:
    """Struct of a polygon's type and rings; fields are null where the text is not one."""
    return F.from_json(geojson, POLYGON)


def in_bounds(latitude: Column, longitude: Column) -> Column:
    return latitude.between(*LATITUDE_BOUNDS) & longitude.between(*LONGITUDE_BOUNDS)


def position_ok(latitude: Column, longitude: Column) -> Column:
    """Inside the bounds, or exactly (0, 0), which a check of its own reports."""
    return in_bounds(latitude, longitude) | ((latitude == 0) & (longitude == 0))


def _outer(shape: Column) -> Column:
    return F.get(shape["coordinates"], F.lit(0))


def shaped(geojson: Column) -> Column:
    """A polygon whose outer ring has four points at least and none at (0, 0). False for null."""
    shape = parse(geojson)
    ring = _outer(shape)
    zero = F.exists(ring, lambda p: (F.get(p, F.lit(0)) == 0) & (F.get(p, F.lit(1)) == 0))
    return F.coalesce((shape["type"] == "Polygon") & (F.size(ring) >= 4) & ~F.coalesce(zero, F.lit(False)), F.lit(False))


def polygon_ok(geojson: Column) -> Column:
    """As ``shaped``; null passes, as a required check reports it."""
    return geojson.isNull() | shaped(geojson)


def polygon_in_bounds(geojson: Column) -> Column:
    """False only where a well-shaped polygon has an outer point out of bounds."""
    out = F.exists(_outer(parse(geojson)), lambda p: ~F.coalesce(in_bounds(F.get(p, F.lit(1)), F.get(p, F.lit(0))), F.lit(False)))
    return ~F.coalesce(shaped(geojson) & out, F.lit(False))


def closed(geojson: Column) -> Column:
    """A polygon fit for matching: outer ring of four points at least, all of two numbers, the last one the first."""
    shape = parse(geojson)
    ring = _outer(shape)
    holes = F.exists(ring, lambda p: p.isNull() | F.get(p, F.lit(0)).isNull() | F.get(p, F.lit(1)).isNull())
    first, last = F.try_element_at(ring, F.lit(1)), F.try_element_at(ring, F.lit(-1))
    ends = (F.get(first, F.lit(0)) == F.get(last, F.lit(0))) & (F.get(first, F.lit(1)) == F.get(last, F.lit(1)))
    return F.coalesce((shape["type"] == "Polygon") & (F.size(ring) >= 4) & ~holes & ends, F.lit(False))


def edges(geojson: Column) -> Column:
    """Edges of all rings, holes included, as structs x1, y1, x2, y2."""

    def of_ring(ring: Column) -> Column:
        pairs = F.arrays_zip(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))).alias("a"), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))).alias("b"))
        at = lambda p, side, i: F.get(p[side], F.lit(i))
        return F.transform(pairs, lambda p: F.struct(at(p, "a", 0).alias("x1"), at(p, "a", 1).alias("y1"), at(p, "b", 0).alias("x2"), at(p, "b", 1).alias("y2")))

    return F.flatten(F.transform(parse(geojson)["coordinates"], of_ring))


def contains(x: Column, y: Column, lines: Column) -> Column:
    """Whether (x, y) is inside or on the boundary: on an edge, or an odd number of edges cross to its right."""

    def on(e: Column) -> Column:
        cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        within = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        return (cross == 0) & within

    def crossed(e: Column) -> Column:
        at = e["x1"] + F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"])
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < at)

    return F.exists(lines, on) | (F.size(F.filter(lines, crossed)) % 2 == 1)
