"""Planar geometry as Column expressions.

point: struct<x:double,y:double>; line: array<point>; ring: closed line; polygon:
array<ring> with the shell first; all measures and predicates are higher-order
functions that Catalyst evaluates in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
LINE = f"array<{POINT}>"
POLYGON = f"array<{LINE}>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def line(*points: Column) -> Column:
    return F.array(*points)


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A polygon of one counter-clockwise ring."""
    return F.array(F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0)))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once: expressions that lambdas name are computed at each step of theirs."""
    return F.get(F.transform(F.array(value), use), 0)


def over_segments(pts: Column, fold: Callable[[Column, Column, Column], Column], zero: Column) -> Column:
    """Fold over the segments (p, q) of a line."""

    def run(v):
        steps = F.sequence(F.lit(1), F.size(v) - 1)
        return F.when(F.size(v) < 2, zero).otherwise(F.aggregate(steps, zero, lambda acc, i: fold(acc, F.get(v, i - 1), F.get(v, i))))

    return let(pts, run)


def segments(pts: Column) -> Column:
    """array<struct<p:point,q:point>> of a line."""
    return F.when(
        F.size(pts) >= 2,
        F.transform(F.sequence(F.lit(1), F.size(pts) - 1), lambda i: F.struct(F.get(pts, i - 1).alias("p"), F.get(pts, i).alias("q"))),
    ).otherwise(F.array().cast(f"array<struct<p:{POINT},q:{POINT}>>"))


def signed_area(ring: Column) -> Column:
    """Shoelace area, positive for counter-clockwise rings."""
    return over_segments(ring, lambda a, p, q: a + p["x"] * q["y"] - q["x"] * p["y"], F.lit(0.0)) / 2


def area(polygon: Column) -> Column:
    """Shell less holes."""
    holes = F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(0)))
    return F.abs(signed_area(F.get(polygon, 0))) - F.aggregate(holes, F.lit(0.0), lambda a, r: a + F.abs(signed_area(r)))


def distance(p: Column, q: Column) -> Column:
    return F.hypot(q["x"] - p["x"], q["y"] - p["y"])


def length(pts: Column) -> Column:
    return over_segments(pts, lambda a, p, q: a + distance(p, q), F.lit(0.0))


def bounds(pts: Column) -> Column:
    """struct<xmin,ymin,xmax,ymax> of a line or ring."""
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def ring_centroid(ring: Column) -> Column:
    """Area-weighted centroid of a ring."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def fold(acc, p, q):
        c = p["x"] * q["y"] - q["x"] * p["y"]
        return F.struct((acc["a"] + c).alias("a"), (acc["x"] + (p["x"] + q["x"]) * c).alias("x"), (acc["y"] + (p["y"] + q["y"]) * c).alias("y"))

    s = over_segments(ring, fold, zero)
    return F.when(s["a"] != 0, point(s["x"] / (3 * s["a"]), s["y"] / (3 * s["a"])))


def centroid(polygon: Column) -> Column:
    """Area-weighted centroid of a polygon, its holes left out."""
    part = F.transform(polygon, lambda r, i: F.struct((F.abs(signed_area(r)) * F.when(i == 0, 1.0).otherwise(-1.0)).alias("a"), ring_centroid(r).alias("c")))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    s = F.aggregate(F.filter(part, lambda r: r["c"].isNotNull()), zero, lambda t, r: F.struct((t["a"] + r["a"]).alias("a"), (t["x"] + r["a"] * r["c"]["x"]).alias("x"), (t["y"] + r["a"] * r["c"]["y"]).alias("y")))
    return F.when(s["a"] > 0, point(s["x"] / s["a"], s["y"] / s["a"]))


def line_centroid(pts: Column) -> Column:
    """Length-weighted centroid of a line."""
    zero = F.struct(F.lit(0.0).alias("l"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def fold(acc, p, q):
        d = distance(p, q)
        return F.struct((acc["l"] + d).alias("l"), (acc["x"] + d * (p["x"] + q["x"]) / 2).alias("x"), (acc["y"] + d * (p["y"] + q["y"]) / 2).alias("y"))

    s = over_segments(pts, fold, zero)
    return F.when(s["l"] > 0, point(s["x"] / s["l"], s["y"] / s["l"]))


def on_line(pt: Column, pts: Column) -> Column:
    """Whether a point lies on a line."""

    def hit(acc, p, q):
        cross = (q["x"] - p["x"]) * (pt["y"] - p["y"]) - (q["y"] - p["y"]) * (pt["x"] - p["x"])
        within = pt["x"].between(F.least(p["x"], q["x"]), F.greatest(p["x"], q["x"])) & pt["y"].between(F.least(p["y"], q["y"]), F.greatest(p["y"], q["y"]))
        return acc | ((cross == 0) & within)

    return over_segments(pts, hit, F.lit(False))


def _ray_parity(pt: Column, ring: Column) -> Column:
    def cross(acc, p, q):
        spans = (p["y"] > pt["y"]) != (q["y"] > pt["y"])
        at = (q["x"] - p["x"]) * (pt["y"] - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) + p["x"]
        return acc != (spans & F.coalesce(pt["x"] < at, F.lit(False)))

    return over_segments(ring, cross, F.lit(False))


def within(pt: Column, polygon: Column) -> Column:
    """Whether a point lies inside a polygon; its edges and holes are outside."""
    on_edge = lambda v: F.exists(polygon, lambda r: on_line(v, r))
    inside = lambda v: F.aggregate(polygon, F.lit(False), lambda acc, r: acc != _ray_parity(v, r))
    return let(pt, lambda v: ~on_edge(v) & inside(v))


def foot_on_segment(pt: Column, p: Column, q: Column) -> Column:
    """The nearest point of a segment."""
    dx, dy = q["x"] - p["x"], q["y"] - p["y"]
    d2 = dx * dx + dy * dy
    t = F.when(d2 == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((pt["x"] - p["x"]) * dx + (pt["y"] - p["y"]) * dy) / F.nullif(d2, F.lit(0.0)))))
    return point(p["x"] + t * dx, p["y"] + t * dy)


def nearest_on_line(pt: Column, pts: Column) -> Column:
    """struct<d, foot> of the nearest point of a line; of equals the smallest."""
    feet = F.transform(segments(pts), lambda s: foot_on_segment(pt, s["p"], s["q"]))
    return F.array_min(F.transform(feet, lambda f: F.struct(distance(pt, f).alias("d"), f.alias("foot"))))


def project(origin: Column, ux: Column, uy: Column, pt: Column) -> Column:
    """How far along a unit direction a point lies."""
    return (pt["x"] - origin["x"]) * ux + (pt["y"] - origin["y"]) * uy


def crossing(p: Column, q: Column, r: Column, s: Column) -> Column:
    """struct<t, u, at> where segments pq and rs cross (t along pq, u along rs); null if they do not or are parallel."""
    dx, dy, ex, ey = q["x"] - p["x"], q["y"] - p["y"], s["x"] - r["x"], s["y"] - r["y"]
    den = F.nullif(dx * ey - dy * ex, F.lit(0.0))
    t = ((r["x"] - p["x"]) * ey - (r["y"] - p["y"]) * ex) / den
    u = ((r["x"] - p["x"]) * dy - (r["y"] - p["y"]) * dx) / den
    return F.when(t.between(0, 1) & u.between(0, 1), F.struct(t.alias("t"), u.alias("u"), point(p["x"] + t * dx, p["y"] + t * dy).alias("at")))


def interior_point(polygon: Column) -> Column:
    """A point inside: the middle of the longest stretch that the horizontal line through the middle
    of the bounding box has inside the polygon."""
    b = bounds(F.get(polygon, 0))
    return let((b["ymin"] + b["ymax"]) / 2, lambda y: _longest_inside(polygon, y))


def _longest_inside(polygon: Column, y: Column) -> Column:
    def crossings(ring):
        return F.filter(
            F.transform(segments(ring), lambda s: F.when((s["p"]["y"] > y) != (s["q"]["y"] > y), s["p"]["x"] + (y - s["p"]["y"]) * (s["q"]["x"] - s["p"]["x"]) / F.nullif(s["q"]["y"] - s["p"]["y"], F.lit(0.0)))),
            lambda v: v.isNotNull(),
        )

    def middle(xs):
        pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size(xs) / 2).cast("int") - 1), lambda i: F.struct((F.get(xs, 2 * i + 1) - F.get(xs, 2 * i)).alias("w"), ((F.get(xs, 2 * i + 1) + F.get(xs, 2 * i)) / 2).alias("x")))
        return F.when(F.size(xs) >= 2, point(F.array_max(pairs)["x"], y))

    return let(F.array_sort(F.flatten(F.transform(polygon, crossings))), middle)


def chaikin(pts: Column, iterations: int = 1) -> Column:
    """Corner cutting with both ends fixed; lines of fewer than three points stay."""
    for _ in range(iterations):
        pts = let(pts, _cut_corners)
    return pts


def _cut_corners(src: Column) -> Column:
    def corner(i):
        p, q = F.get(src, i), F.get(src, i + 1)
        return F.array(point(0.75 * p["x"] + 0.25 * q["x"], 0.75 * p["y"] + 0.25 * q["y"]), point(0.25 * p["x"] + 0.75 * q["x"], 0.25 * p["y"] + 0.75 * q["y"]))

    cut = F.flatten(F.transform(F.sequence(F.lit(0), F.size(src) - 2), corner))
    smooth = F.concat(F.array(F.get(src, 0)), cut, F.array(F.element_at(src, -1)))
    return F.when(F.size(src) < 3, src).otherwise(smooth)


def simplify(pts: Column, tol: float) -> Column:
    """Douglas-Peucker: points that are not over `tol` from the line between the kept ones around them go; the
    ends stay. A fold over a stack of open stretches."""
    return let(pts, lambda v: _simplified(v, tol))


def _simplified(pts: Column, tol: float) -> Column:
    n = F.size(pts)

    def stretch(i, j):
        return F.struct(i.alias("i"), j.alias("j"))

    def farthest(top):
        inner = F.when(top["j"] - top["i"] > 1, F.sequence(top["i"] + 1, top["j"] - 1)).otherwise(F.array().cast("array<int>"))
        return F.array_max(F.transform(inner, lambda k: F.struct(distance(F.get(pts, k), foot_on_segment(F.get(pts, k), F.get(pts, top["i"]), F.get(pts, top["j"]))).alias("d"), (-k).alias("k"))))

    def cut(todo, kept, top, far):
        rest = F.slice(todo, 1, F.size(todo) - 1)
        more = F.struct(F.concat(rest, F.array(stretch(top["i"], -far["k"]), stretch(-far["k"], top["j"]))).alias("todo"), F.concat(kept, F.array(-far["k"])).alias("kept"))
        return F.when(F.coalesce(far["d"] > tol, F.lit(False)), more).otherwise(F.struct(rest.alias("todo"), kept.alias("kept")))

    def step(acc, _):
        return F.when(F.size(acc["todo"]) == 0, acc).otherwise(
            let(F.element_at(acc["todo"], -1), lambda top: let(farthest(top), lambda far: cut(acc["todo"], acc["kept"], top, far)))
        )

    start = F.struct(F.array(stretch(F.lit(0), n - 1)).alias("todo"), F.array(F.lit(0), n - 1).alias("kept"))
    kept = F.array_sort(F.aggregate(F.sequence(F.lit(1), 2 * n), start, step)["kept"])
    return F.when(n < 3, pts).otherwise(F.transform(kept, lambda k: F.get(pts, k)))
