"""Straightened borders that may move area: each border between two differently labelled polygons is replaced by a simpler,
smoother line, and the pieces of ground that this cuts are given back to one of the two.

A border changes both polygons, so borders of one polygon must be taken one after the other. `edge_colours` gives each pair of
neighbours a colour so that no polygon has two pairs of one colour: pairs are in a random order (a hash of both keys), a pair's
colour is one more than the largest of the earlier pairs that it shares a polygon with. All pairs of a colour are straightened
together, colour by colour, with the result of the one-by-one pass in that order; colours grow with the longest chain of falling
hashes, some tens for any input, and not with the number of polygons. The work on one pair, of two polygons, is one row's.

A piece goes to the polygon that its inner point lies in; if that is on the old border, to the one that it overlaps more, at a tie to
the smaller key; ground of neither stays as it was, so the area of both together is kept. An old border that touches itself nowhere
keeps its ends; a closed one starts at its least corner."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geometry as g
from cadastra.operators import spatial
from cadastra.session import materialize

_NEAR = 1e-9
PARTS = f"array<{g.POLYGON}>"
Point = tuple[float, float]
Side = tuple[Point, Point]


# ---------------------------------------------------------------- colours
def edge_colours(pairs: DataFrame) -> list[DataFrame]:
    """pairs (a, b), a < b, each once: a table of pairs for each colour."""
    left = materialize(pairs.select("a", "b", F.struct(F.xxhash64("a", "b").alias("h"), "a", "b").alias("turn")), "pairs")
    colours = []
    while left.limit(1).count():
        first = left.select(F.explode(F.array("a", "b")).alias("key"), "turn").groupBy("key").agg(F.min("turn").alias("turn"))
        ready = left.join(first.withColumnRenamed("key", "a"), ["a", "turn"], "left_semi").join(first.withColumnRenamed("key", "b"), ["b", "turn"], "left_semi")
        ready = materialize(ready.select("a", "b"), "colour")
        colours.append(ready)
        left = materialize(left.join(ready, ["a", "b"], "left_anti"), "pairs")
    return colours


def straighten(polygons: DataFrame, key: str, label: str, tol: float = 1.0, iterations: int = 2) -> DataFrame:
    """(key, label, parts): noded polygons (key, label, poly) with all borders between different labels straightened."""
    labels = polygons.select(F.col(key).alias("k"), F.col(label).alias("l"))
    pairs = spatial.shared_borders(polygons, key).where(F.col(key) < F.col("other")).select(F.col(key).alias("a"), F.col("other").alias("b"))
    pairs = pairs.join(labels.withColumnsRenamed({"k": "a", "l": "la"}), "a").join(labels.withColumnsRenamed({"k": "b", "l": "lb"}), "b")
    pairs = pairs.where(~F.coalesce(F.col("la") == F.col("lb"), F.lit(False))).select("a", "b")  # without a label: different from all
    now = materialize(polygons.select(F.col(key).alias("key"), F.col(label).alias("label"), F.array("poly").alias("parts")), "parts")
    kind = now.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                both = _straighten(*(_from_rows(row[c]) for c in ("pa", "pb")), tol, iterations)
                out += [(row[k], parts) for k, parts in zip("ab", both, strict=True)] if both else []
            parts = pa.array([_to_rows(p) for _, p in out], pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], batch.schema.field("a").type), parts], ["key", "parts"])

    for colour in edge_colours(pairs):
        own = now.select("key", "parts")
        both = colour.join(own.withColumnsRenamed({"key": "a", "parts": "pa"}), "a").join(own.withColumnsRenamed({"key": "b", "parts": "pb"}), "b")
        new = both.select("a", "b", "pa", "pb").mapInArrow(run, f"key {kind}, parts {PARTS}").withColumnRenamed("parts", "new")
        now = materialize(now.join(new, "key", "left").select("key", "label", F.coalesce("new", "parts").alias("parts")), "parts")
    return now.select(F.col("key").alias(key), F.col("label").alias(label), "parts")


# ---------------------------------------------------------------- one pair
def _from_rows(parts) -> list[list[list[Point]]]:
    return [[[(p["x"], p["y"]) for p in ring] for ring in poly] for poly in parts]


def _to_rows(parts):
    return [[[{"x": x, "y": y} for x, y in ring] for ring in poly] for poly in parts]


def _sides(parts) -> list[Side]:
    return [(p, q) for poly in parts for ring in poly for p, q in zip(ring, ring[1:], strict=False) if p != q]


def _area(sides: list[Side]) -> float:
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in sides) / 2


def merged_lines(sides: set[Side]) -> list[list[Point]]:
    """Undirected sides as lines that end where other than two sides meet; rings start at their least corner. Each line runs from its
    lesser end, a ring toward the lesser of its neighbours."""
    near = defaultdict(set)
    for p, q in sides:
        near[p].add(q)
        near[q].add(p)
    left, lines = set(sides), []
    for start in [v for v in sorted(near) if len(near[v]) != 2] + sorted(near):
        for step in sorted(near[start]):
            line, p, q = [start], start, step
            while (side := (min(p, q), max(p, q))) in left:
                left.remove(side)
                line.append(q)
                if len(near[q]) != 2 or q == start:
                    break
                p, q = q, next(x for x in near[q] if x != p)
            if len(line) > 1:
                lines.append(line if line[0] <= line[-1] else line[::-1])
    return lines


def _off(p: Point, a: Point, b: Point) -> float:
    dx, dy = b[0] - a[0], b[1] - a[1]
    n = dx * dx + dy * dy
    t = max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / n)) if n else 0.0
    return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)


def _new_line(line: list[Point], tol: float, iterations: int) -> list[Point]:
    keep, todo = {0, len(line) - 1}, [(0, len(line) - 1)]
    while todo:
        i, j = todo.pop()
        far = max(((_off(line[k], line[i], line[j]), -k) for k in range(i + 1, j)), default=(0.0, 0))
        if far[0] > tol:
            keep.add(-far[1])
            todo += [(i, -far[1]), (-far[1], j)]
    line = [line[k] for k in sorted(keep)]
    for _ in range(iterations if len(line) > 2 else 0):
        cut = [c for p, q in zip(line, line[1:], strict=False) for c in ((0.75 * p[0] + 0.25 * q[0], 0.75 * p[1] + 0.25 * q[1]), (0.25 * p[0] + 0.75 * q[0], 0.25 * p[1] + 0.75 * q[1]))]
        line = [line[0], *cut, line[-1]]
    return line


def _through(sides: list[Side], corners: set[Point]) -> list[Side]:
    """Sides cut at the corners that lie on them."""
    out, xs = [], sorted(corners)
    for p, q in sides:
        low, high = bisect_left(xs, (min(p[0], q[0]) - _NEAR,)), bisect_right(xs, (max(p[0], q[0]) + _NEAR, math.inf))
        on = [v for v in xs[low:high] if v not in (p, q) and min(p[1], q[1]) - _NEAR <= v[1] <= max(p[1], q[1]) + _NEAR and _off(v, p, q) <= _NEAR]
        stops = [p, *sorted(on, key=lambda v: math.dist(p, v)), q]
        out += zip(stops, stops[1:], strict=False)
    return out


def _noded(fixed: set[Side], new: list[Side]) -> set[Side]:
    """All sides, cut where a new one meets another."""
    every, cuts = [*fixed, *new], defaultdict(list)
    for i, (p, q) in enumerate(every[len(fixed) :], len(fixed)):
        for j in range(i):
            r, s = every[j]
            if max(p[0], q[0]) < min(r[0], s[0]) - _NEAR or max(r[0], s[0]) < min(p[0], q[0]) - _NEAR or max(p[1], q[1]) < min(r[1], s[1]) - _NEAR or max(r[1], s[1]) < min(p[1], q[1]) - _NEAR:
                continue
            touching = False
            for k, v, a, b in ((i, r, p, q), (i, s, p, q), (j, p, r, s), (j, q, r, s)):
                if _off(v, a, b) <= _NEAR:
                    cuts[k].append(v)
                    touching = True
            d = (q[0] - p[0]) * (s[1] - r[1]) - (q[1] - p[1]) * (s[0] - r[0])
            if touching or not d:
                continue
            t = ((r[0] - p[0]) * (s[1] - r[1]) - (r[1] - p[1]) * (s[0] - r[0])) / d
            u = ((r[0] - p[0]) * (q[1] - p[1]) - (r[1] - p[1]) * (q[0] - p[0])) / d
            if 0 < t < 1 and 0 < u < 1:
                at = (p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1]))
                cuts[i].append(at)
                cuts[j].append(at)
    out = set()
    for i, (p, q) in enumerate(every):
        stops = [p, *sorted(cuts[i], key=lambda v: math.dist(p, v)), q]
        out |= {(min(a, b), max(a, b)) for a, b in zip(stops, stops[1:], strict=False) if math.dist(a, b) > _NEAR}
    return out


def _cycles(directed: list[Side]) -> list[list[Side]]:
    """Directed sides as closed walks that keep what is on their left together."""
    leave = defaultdict(list)
    for side in directed:
        leave[side[0]].append(side)

    def after(side):
        p, q = side
        back = math.atan2(p[1] - q[1], p[0] - q[0])
        return min(leave[q], key=lambda s: ((back - math.atan2(s[1][1] - q[1], s[1][0] - q[0])) % (2 * math.pi) or 2 * math.pi, s))

    left, out = set(directed), []
    for first in sorted(left):
        walk, side = [], first
        while side in left:
            left.remove(side)
            walk.append(side)
            side = after(side)
        if walk:
            out.append(walk)
    return out


def _holds(sides: list[Side], v: Point) -> bool:
    return sum((p[1] > v[1]) != (q[1] > v[1]) and v[0] < p[0] + (v[1] - p[1]) * (q[0] - p[0]) / (q[1] - p[1]) for p, q in sides) % 2 == 1


def _with_holes(cycles: list[list[Side]]) -> list[list[list[Side]]]:
    """Shells, each with the holes that it is the smallest around."""
    shells = sorted(([c] for c in cycles if _area(c) > 0), key=lambda s: _area(s[0]))
    for hole in (c for c in cycles if _area(c) < 0):
        p, q = hole[0]
        mid = ((p[0] + q[0]) / 2, (p[1] + q[1]) / 2)
        for shell in shells:
            if (q, p) not in shell[0] and _area(shell[0]) > -_area(hole) and _holds(shell[0], mid):
                shell.append(hole)
                break
    return shells


def _faces(sides: set[Side]) -> list[list[Side]]:
    """The faces of an arrangement as directed sides, holes with them; sides with one face on both sides are none's border."""
    while True:
        cycles = _cycles([*sides, *((q, p) for p, q in sides)])
        idle = {(min(s), max(s)) for c in cycles for s in c if (s[1], s[0]) in set(c)}
        if not idle:
            return [[s for ring in shell for s in ring] for shell in _with_holes(cycles)]
        sides = sides - idle


def _inner_point(sides: list[Side]) -> Point:
    """The middle of the longest stretch inside, half way between the two corner heights around the middle of the height."""
    ys = sorted({p[1] for p, _ in sides})
    half = (ys[0] + ys[-1]) / 2
    y = (max(v for v in ys if v <= half) + min(v for v in ys if v > half)) / 2
    xs = sorted(p[0] + (y - p[1]) * (q[0] - p[0]) / (q[1] - p[1]) for p, q in sides if (p[1] > y) != (q[1] > y))
    _, x = max((b - a, (a + b) / 2) for a, b in zip(xs[::2], xs[1::2], strict=True))
    return x, y


def _overlap(one: list[Side], other: list[Side]) -> float:
    """The area that two sets of rings share, in slabs between all corners and crossings."""
    ys = {p[1] for p, _ in (*one, *other)}
    ys |= {v[1] for s in _noded({(min(s), max(s)) for s in one}, [(min(s), max(s)) for s in other]) for v in s}
    total, ys = 0.0, sorted(ys)
    for low, high in zip(ys, ys[1:], strict=False):
        y = (low + high) / 2
        met = sorted((p[0] + (y - p[1]) * (q[0] - p[0]) / (q[1] - p[1]), k) for k, sides in enumerate((one, other)) for p, q in sides if (p[1] > y) != (q[1] > y))
        inside = [False, False]
        for (x, k), (then, _) in zip(met, met[1:], strict=False):
            inside[k] = not inside[k]
            total += (then - x) * (high - low) if all(inside) else 0.0
    return total


def _polygons(faces: list[list[Side]]) -> list[list[list[Point]]]:
    """The union of faces of one arrangement."""
    directed = {s for f in faces for s in f}
    outline = [s for s in directed if (s[1], s[0]) not in directed]
    return [[[*(p for p, _ in ring), ring[0][0]] for ring in shell] for shell in _with_holes(_cycles(outline))]


def _straighten(a, b, tol: float, iterations: int):
    """New parts of both, or None where they share no border or nothing closed is left of it."""
    sides = [_sides(x) for x in (a, b)]
    sides = [_through(x, {p for p, _ in y}) for x, y in (sides, sides[::-1])]  # an earlier border may have left a corner with one of them only
    plain = [{(min(s), max(s)) for s in x} for x in sides]
    shared = plain[0] & plain[1]
    if not shared:
        return None
    lines = [_new_line(line, tol, iterations) for line in merged_lines(shared)]
    new = [(min(p, q), max(p, q)) for line in lines for p, q in zip(line, line[1:], strict=False) if p != q]
    given: tuple[list, list] = ([], [])
    for face in _faces(_noded((plain[0] | plain[1]) - shared, sorted(set(new)))):
        v = _inner_point(face)
        inside = [_holds(x, v) for x in sides]
        if inside[0] == inside[1] or any(_off(v, *s) <= _NEAR for s in shared):
            areas = [_overlap(face, x) for x in sides]
            if max(areas) <= _NEAR:
                continue
            inside = [areas[0] >= areas[1], areas[0] < areas[1]]
        given[1 if inside[1] else 0].append(face)
    return tuple(_polygons(f) if f else old for f, old in zip(given, (a, b), strict=True))
