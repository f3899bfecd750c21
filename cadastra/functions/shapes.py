"""Geometries of any kind as Column expressions: an array of parts, each a point, a line or a polygon.

Collections inside collections are flat here. A point has one ring of one point, a line one ring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastra.functions import geometry as g

SHAPE = f"array<struct<kind:string,rings:{g.POLYGON}>>"


def part(kind: str, rings: Column) -> Column:
    """kind: Point, LineString or Polygon."""
    return F.struct(F.lit(kind).alias("kind"), rings.cast(g.POLYGON).alias("rings"))


def is_empty(shape: Column) -> Column:
    """Whether a shape is null or has no part."""
    return F.coalesce(F.size(shape) <= 0, F.lit(True))


def kind(shape: Column) -> Column:
    """The type's name; several parts of one kind are a Multi..., of several kinds a GeometryCollection, no part is null."""
    kinds = F.array_distinct(F.transform(shape, lambda p: p["kind"]))
    multi = F.when(F.size(shape) > 1, F.concat(F.lit("Multi"), F.get(kinds, 0))).otherwise(F.get(kinds, 0))
    return F.when(~is_empty(shape), F.when(F.size(kinds) > 1, "GeometryCollection").otherwise(multi))


def lines_of(shape: Column) -> Column:
    """The lines of a shape; points and polygons go."""
    return F.transform(F.filter(shape, lambda p: p["kind"] == "LineString"), lambda p: F.get(p["rings"], 0))


def polygons_of(shape: Column) -> Column:
    return F.transform(F.filter(shape, lambda p: p["kind"] == "Polygon"), lambda p: p["rings"])


def line_ends(lines: Column) -> Column:
    """First and last points of lines of two points or more, in order."""
    return F.flatten(F.transform(F.filter(lines, lambda v: F.size(v) >= 2), lambda v: F.array(F.get(v, 0), F.element_at(v, -1))))


def points_of(shape: Column) -> Column:
    """Points as they are and the two ends of lines, in order; polygons have none."""

    def of(p):
        pts = F.get(p["rings"], 0)
        return F.when(p["kind"] == "Point", pts).when(p["kind"] == "LineString", line_ends(F.array(pts))).otherwise(F.array().cast(g.LINE))

    return F.flatten(F.transform(shape, of))
