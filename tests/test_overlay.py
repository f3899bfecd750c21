"""Overlay, buffers and blocks on small cases with known areas."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geometry as g
from cadastra.functions import projection, shapes
from cadastra.operators import network, overlay


def box(x0, y0, x1, y1):
    return [[{"x": float(x), "y": float(y)} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def polys(spark, *rows):
    return frame(spark, list(rows), f"id int, poly {g.POLYGON}")


def line(*pts):
    return [{"x": float(x), "y": float(y)} for x, y in pts]


def areas(df, key="id"):
    return {r[0]: round(r[1], 6) for r in df.groupBy(key).agg(F.sum(g.area(F.col("poly")))).collect()}


def test_overlay_areas(spark):
    left, right = polys(spark, (1, box(0, 0, 10, 10)), (2, box(20, 0, 24, 4))), polys(spark, (9, box(5, 5, 15, 15)))
    cut = overlay.overlay(left, right, "id", 5.0)
    assert areas(cut.where("inside")) == {1: 25} and areas(cut.where("NOT inside")) == {1: 75, 2: 16}
    with pytest.raises(RuntimeError):
        overlay.clip_to_boundary(left, polys(spark, (9, box(50, 50, 60, 60))), "id", 5.0)


def test_union(spark):
    left, right = polys(spark, (1, box(0, 0, 10, 10))), polys(spark, (9, box(5, 5, 15, 15)))
    assert overlay.union(left.unionByName(right), 5.0).agg(F.sum(g.area(F.col("poly")))).first()[0] == pytest.approx(175)


def test_a_bow_tie_becomes_two_triangles(spark):
    bow = frame(spark, [(1, [line((0, 0), (4, 4), (4, 0), (0, 4), (0, 0))])], f"id int, poly {g.POLYGON}")
    got = overlay.make_valid(bow, "id", 2.0).select(F.round(g.area(F.col("poly")), 6).alias("a")).collect()
    assert sorted(r.a for r in got) == [4, 4]


def test_buffers(spark):
    lines = frame(spark, [(1, line((0, 0), (10, 0), (10, 10)))], f"id int, line {g.LINE}")
    circle = 32 * math.sin(2 * math.pi / 64)  # 64 chords
    assert areas(overlay.buffer_lines(lines, "id", 1.0, 5.0))[1] == pytest.approx(40 + circle - (1 - circle / 4), abs=1e-3)
    square = polys(spark, (1, box(0, 0, 10, 10)))
    assert areas(overlay.buffer(square, "id", 2.0, 5.0, quads=2))[1] == pytest.approx(100 + 80 + 4 * 4 * math.sin(2 * math.pi / 8), abs=1e-3)


def test_closing_ladder_joins_parts(spark):
    parts = frame(spark, [(1, 1, box(0, 0, 4, 4)), (1, 2, box(4.5, 0, 8, 4)), (2, 3, box(20, 0, 24, 4))], f"id int, block bigint, poly {g.POLYGON}")
    got = overlay.close_ladder(parts, "id", 4.0, start=0.4, most=1.0, quads=4)
    assert {r.id: r["count"] for r in got.groupBy("id").count().collect()} == {1: 1, 2: 1}
    assert areas(got)[1] == pytest.approx(32, abs=0.2) and areas(got)[2] == 16


def test_strip_snap_and_dedup(spark):
    wall = frame(spark, [(line((0, 0), (100, 0)),)], f"line {g.LINE}")
    sides = frame(spark, [tuple(line((10, -20), (10, 40))), tuple(line((50, 2), (90, 2)))], f"a {g.POINT}, b {g.POINT}")
    got = {(r.inside, *(round(p.y, 6) for p in r.line)) for r in network.split_strip(sides, wall, 10.0, 20.0).collect()}
    assert got == {(False, -20, -10), (True, -10, 10), (False, 10, 40), (True, 2, 2)}
    snapped = network.snap(frame(spark, [tuple(line((1, 1), (30, 30))), tuple(line((99, -5), (101.5, 9)))], f"a {g.POINT}, b {g.POINT}"), wall, 3.0)
    assert sorted([tuple(p) for p in r.line] for r in snapped.collect()) == [[(0, 0), (30, 30)], [(99, -5), (100, 0), (101.5, 9)]]
    pts = frame(spark, [({"x": x, "y": 0.0},) for x in (0.0, 0.9, 1.8, 2.7, 9.0)], f"pt {g.POINT}")
    assert sorted(r.pt.x for r in network.dedup_points(pts, 1.0).collect()) == [0, 1.8, 9]


def test_clip_lines(spark):
    ring = polys(spark, (1, box(0, 0, 10, 10) + [box(4, 4, 6, 6)[0][::-1]]))
    got = network.clip_lines(frame(spark, [(line((-5, 5), (15, 5)),)], f"line {g.LINE}"), ring, 5.0).collect()
    assert sorted(tuple(round(p.x, 6) for p in r.line) for r in got) == [(0, 4), (6, 10)]


def test_town_blocks(spark):
    """A cross of streets, one of which ends short of the next, in a square whose corner is outside the town."""
    nodes = [(1, 100, 0), (2, 100, 100), (3, 100, 200), (4, 20, 100), (5, 150, 100)]
    n = frame(spark, [(i, {"x": float(x), "y": float(y)}) for i, x, y in nodes], f"osmid bigint, pt {g.POINT}")
    e = frame(spark, [(1, 2, 0, None), (2, 3, 0, None), (4, 2, 0, None), (2, 5, 0, None)], f"u bigint, v bigint, key int, line {g.LINE}")
    blocks = network.town_blocks(n, e, polys(spark, (1, box(0, 0, 200, 200))), polys(spark, (1, box(-50, -50, 190, 250))), 50.0, least_area=500.0)
    got = sorted(round(r.a) for r in blocks.select(g.area(F.col("poly")).alias("a")).collect())
    assert sum(got) == 190 * 200 and got == [9000, 9000, 10000, 10000]


def test_projection_round_trip(spark):
    pts = frame(spark, [({"x": 15.0, "y": 45.0},), ({"x": 19.04, "y": 47.5},), ({"x": 16.2, "y": 46.1},)], f"pt {g.POINT}")
    z = F.lit(33)
    rows = pts.select("pt", projection.to_metric(F.col("pt"), z).alias("m")).select("pt", "m", projection.to_degrees(F.col("m"), z).alias("back")).collect()
    assert rows[0].m.x == 500000 and rows[0].m.y == pytest.approx(4982950.400, abs=1e-3)
    assert all(math.isclose(r.pt.x, r.back.x, abs_tol=1e-8) and math.isclose(r.pt.y, r.back.y, abs_tol=1e-8) for r in rows)


def test_shapes(spark):
    p, ln = shapes.part("Point", F.array(F.array(g.point(F.lit(1), F.lit(1))))), shapes.part("LineString", F.array(F.array(*(g.point(F.lit(x), F.lit(0)) for x in (0, 5, 9)))))
    poly = shapes.part("Polygon", g.rectangle(*(F.lit(float(x)) for x in (0, 0, 1, 1))))
    cases = {"Point": [p], "LineString": [ln], "MultiLineString": [ln, ln], "MultiPolygon": [poly, poly], "GeometryCollection": [p, ln, poly]}
    for name, parts in cases.items():
        s = F.array(*parts)
        r = spark.range(1).select(shapes.kind(s).alias("k"), F.size(shapes.lines_of(s)).alias("l"), F.transform(shapes.points_of(s), lambda v: v["x"]).alias("x"), shapes.is_empty(s).alias("e")).first()
        assert (r.k, r.l, r.e) == (name, sum(x is ln for x in parts), False)
        assert r.x == [v for x in parts for v in ([1] if x is p else [0, 9] if x is ln else [])]
    assert spark.range(1).select(shapes.is_empty(F.lit(None).cast(shapes.SHAPE))).first()[0]
