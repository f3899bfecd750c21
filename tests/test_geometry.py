"""Analytic cases and invariants of the geometry and territory operators."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geometry as g
from cadastra.operators import graph, labels, parcels, relational, smooth, spatial
from cadastra.plans import queries


def poly(*rings):
    return [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]


SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
HOLE = [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_measures_and_within(spark):
    pts = [(5, 1), (0, 5), (10, 5), (5, 5), (4, 5), (11, 5)]
    df = frame(spark, [(poly(SQUARE, HOLE), [{"x": float(x), "y": float(y)} for x, y in pts])], f"poly {g.POLYGON}, pts {g.LINE}")
    r = df.select(g.area(F.col("poly")).alias("a"), g.length(F.get("poly", 0)).alias("l"), F.transform("pts", lambda p: g.within(p, F.col("poly"))).alias("w"), g.ring_centroid(F.get("poly", 0)).alias("c")).first()
    assert r.a == 96 and r.l == 40 and tuple(r.c) == (5, 5)
    assert r.w == [True, False, False, False, False, False]


def test_interior_point_avoids_the_hole(spark):
    df = frame(spark, [(poly(SQUARE, HOLE),)], f"poly {g.POLYGON}")
    assert df.select(g.within(g.interior_point(F.col("poly")), F.col("poly"))).first()[0]


def test_chaikin(spark):
    df = frame(spark, [([{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 4.0}],), ([{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}],)], f"l {g.LINE}")
    a, b = (r[0] for r in df.select(g.chaikin(F.col("l"))).collect())
    assert [tuple(p) for p in a] == [(0, 0), (1, 0), (3, 0), (4, 1), (4, 3), (4, 4)]
    assert [tuple(p) for p in b] == [(0, 0), (1, 0)]


def halves(spark, *rings):
    df = frame(spark, [(1, "", poly(*rings))], f"k int, path string, poly {g.POLYGON}")
    return {r.path: r for r in labels.halve(df, "k").select("path", "poly", g.bounds(F.get("poly", 0)).alias("b"), g.area(F.col("poly")).alias("a"), F.size("poly").alias("n")).collect()}


def test_halves_of_a_rectangle(spark):
    rows = halves(spark, [(0, 0), (4, 0), (4, 2), (0, 2), (0, 0)])
    assert rows["0"].a == rows["1"].a == 4 and rows["0"].b.xmax == rows["1"].b.xmin == 2


def test_halves_with_holes_and_arms(spark):
    across = halves(spark, SQUARE, [(4, 4), (4, 6), (6, 6), (6, 4), (4, 4)])  # the cut at x = 5 opens the hole
    assert {p: (r.a, r.n) for p, r in across.items()} == {"0": (48, 1), "1": (48, 1)}
    aside = halves(spark, SQUARE, [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)])
    assert {p: r.n for p, r in aside.items()} == {"0": 2, "1": 1} and sum(r.a for r in aside.values()) == pytest.approx(99)
    comb = halves(spark, [(0, 0), (10, 0), (10, 3), (2, 3), (2, 6), (10, 6), (10, 9), (0, 9), (0, 0)])  # two arms to the right
    assert sorted(comb) == ["0", "1", "3"] and sum(r.a for r in comb.values()) == pytest.approx(66)


def test_square_cut_in_two_faces(spark):
    lines = frame(spark, [(poly(SQUARE)[0],), (poly([(5, -1), (5, 11)])[0],)], f"line {g.LINE}")
    faces = parcels.polygonize(lines, 4.0).select(F.round(g.area(F.col("poly")), 6).alias("a")).collect()
    assert sorted(r.a for r in faces) == [50, 50]


def test_island_becomes_a_hole(spark):
    lines = frame(spark, [(poly(SQUARE)[0],), (poly(HOLE)[0],)], f"line {g.LINE}")
    faces = parcels.polygonize(lines, 4.0).select(F.round(g.area(F.col("poly")), 6).alias("a"), F.size("poly").alias("n")).collect()
    assert sorted((r.a, r.n) for r in faces) == [(4, 1), (96, 2)]


def tiles(spark, n=3):
    return spark.range(n * n).select(F.col("id").alias("cell"), g.rectangle(F.col("id") % n, F.floor(F.col("id") / n), F.col("id") % n + 1, F.floor(F.col("id") / n) + 1).alias("poly"))


def test_adjacency(spark):
    t = tiles(spark)
    assert spatial.touching(t, "cell").where("cell = 4").count() == 8
    shared = {r.other: r.shared for r in spatial.shared_borders(t, "cell").where("cell = 4").collect()}
    assert shared == {1: 1, 3: 1, 5: 1, 7: 1}


def test_dissolve_with_a_hole_and_corner_touch(spark):
    ring = tiles(spark).withColumn("label", F.when(F.col("cell") == 4, "in").otherwise("out"))
    got = {r.label: (r.a, r.n) for r in parcels.dissolve(ring, "label", 3.0).select("label", F.round(g.area(F.col("poly")), 6).alias("a"), F.size("poly").alias("n")).collect()}
    assert got == {"in": (1, 1), "out": (8, 2)}
    chess = tiles(spark).withColumn("label", F.col("cell") % 2)
    areas = [r.a for r in parcels.dissolve(chess, "label", 3.0).where("label = 0").select(g.area(F.col("poly")).alias("a")).collect()]
    assert sum(areas) == pytest.approx(5)


def steps(spark):
    """Two parts of a square of sixteen tiles with a stair between them."""
    merged = parcels.dissolve(tiles(spark, 4).withColumn("label", F.when(F.col("cell").isin(0, 1, 4, 5, 8, 12), 1).otherwise(2)), "label", 4.0)
    return merged.withColumnRenamed("block", "cell")


def test_smoothing_keeps_outer_sides_and_area(spark):
    before = steps(spark)
    for tol in (0.2, 3.0):
        after = {r.label: r for r in smooth.smooth_borders(before, "cell", 2, tol).select("label", g.area(F.col("poly")).alias("a"), g.bounds(F.get("poly", 0)).alias("b"), F.size(F.get("poly", 0)).alias("n")).collect()}
        assert sum(r.a for r in after.values()) == pytest.approx(16)
        assert after[1].b.xmin == after[1].b.ymin == 0 and after[2].b.xmax == after[2].b.ymax == 4
    assert after[1].n < 12  # a straight line from end to end


def test_simplify(spark):
    pts = [{"x": float(x), "y": float(y)} for x, y in ((0, 0), (1, 0.1), (2, 3), (3, 0.2), (4, 0))]
    df = frame(spark, [(pts,)], f"l {g.LINE}")
    kept = lambda tol: [p.x for p in df.select(g.simplify(F.col("l"), tol)).first()[0]]
    assert kept(5.0) == [0, 4] and kept(1.2) == [0, 2, 4] and kept(0.0) == [0, 1, 2, 3, 4]


def test_shared_lines_are_as_long_as_can_be(spark):
    r = smooth.shared_lines(steps(spark), "cell").collect()
    assert len(r) == 1 and r[0].shared == 5 and len(r[0].lines) == 1 and len(r[0].lines[0]) == 6
    ring = tiles(spark).withColumn("label", F.when(F.col("cell") == 4, "in").otherwise("out"))
    island = smooth.shared_lines(parcels.dissolve(ring, "label", 3.0), "block").collect()
    assert len(island) == 1 and island[0].shared == 4 and len(island[0].lines) == 1


def test_noding_of_halved_neighbours(spark):
    rows = [(1, poly([(0, 0), (2, 0), (2, 4), (0, 4), (0, 0)])), (2, poly([(2, 0), (4, 0), (4, 1), (2, 1), (2, 0)])), (3, poly([(2, 1), (4, 1), (4, 4), (2, 4), (2, 1)]))]
    noded = spatial.node_polygons(frame(spark, rows, f"cell int, poly {g.POLYGON}"), "cell", 2.0)
    assert {r.cell: r.n for r in noded.select("cell", F.size(F.get("poly", 0)).alias("n")).collect()} == {1: 6, 2: 5, 3: 5}
    assert {(r.cell, r.other): r.shared for r in spatial.shared_borders(noded, "cell").where("cell < other").collect()} == {(1, 2): 1, (1, 3): 3, (2, 3): 2}


def brute_territories(boxes, pts, depth):
    """Area by label: rectangles halved, filled in order of (block, path) and added up."""
    done = []

    def halve(key, path, x0, y0, x1, y1):
        inside = {v for x, y, v in pts if x0 < x < x1 and y0 < y < y1}
        if len(inside) < 2:
            done.append([(key, path), (x0, y0, x1, y1), next(iter(inside), None)])
        elif len(path) < depth:
            wide = x1 - x0 >= y1 - y0
            m = (x0 + x1) / 2 if wide else (y0 + y1) / 2
            halve(key, path + "0", x0, y0, *((m, y1) if wide else (x1, m)))
            halve(key, path + "1", *((m, y0) if wide else (x0, m)), x1, y1)

    for key, box in boxes.items():
        halve(key, "", *box)
    done.sort()
    for one in done:
        if one[2] is None:
            a = one[1]
            votes = [o[2] for o in done if o is not one and o[2] is not None and o[1][0] <= a[2] and a[0] <= o[1][2] and o[1][1] <= a[3] and a[1] <= o[1][3]]
            one[2] = min(set(votes), key=lambda v: (-votes.count(v), v)) if votes else None
    areas = {}
    for _, (x0, y0, x1, y1), v in done:
        areas[v] = areas.get(v, 0) + (x1 - x0) * (y1 - y0)
    return areas


def test_territories_equal_brute_force(spark):
    boxes = {k: (4.0 * (k % 4), 4.0 * (k // 4), 4.0 * (k % 4) + 4, 4.0 * (k // 4) + 4) for k in range(12)}
    pts = [((i * 37 % 157) / 10 + 0.03, (i * 53 % 113) / 10 + 0.03, 1 + (i * 37 % 157) // 60) for i in range(14)]
    points = frame(spark, [({"x": x, "y": y}, v) for x, y, v in pts], f"pt {g.POINT}, label int")
    blocks = frame(spark, [(k, poly([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)])) for k, (x0, y0, x1, y1) in boxes.items()], f"cell int, poly {g.POLYGON}")
    got = labels.territories(points, blocks, "cell", "label", 4.0).groupBy("label").agg(F.sum(g.area(F.col("poly"))).alias("a")).collect()
    assert {r.label: round(r.a, 6) for r in got} == {k: round(v, 6) for k, v in brute_territories(boxes, pts, 45).items()}


def test_bisect_gives_pure_pieces(spark):
    pts = [(0.5, 0.5, 1), (3.5, 0.5, 2), (0.6, 1.5, 1), (3.4, 1.4, 1)]
    points = frame(spark, [({"x": float(x), "y": float(y)}, v) for x, y, v in pts], f"pt {g.POINT}, label int")
    box = frame(spark, [(1, poly([(0, 0), (4, 0), (4, 2), (0, 2), (0, 0)]))], f"cell int, poly {g.POLYGON}")
    pieces = labels.bisect_mixed(points, box, "cell", "label", 6)
    inside = spatial.points_in_polygons(points.withColumnRenamed("label", "own"), pieces.drop("cell"), 1.0)
    assert inside.where("own <> label").count() == 0
    assert pieces.agg(F.sum(g.area(F.col("poly")))).first()[0] == pytest.approx(8)


def test_registered_bisection_loses_no_area(spark, monkeypatch):
    """Close points of two labels take more than three cuts."""
    pts = [(1.0, 1.0, 1), (1.1, 1.0, 2), (4.0, 4.1, 1)]
    monkeypatch.setattr(queries, "points", lambda t: frame(spark, [({"x": x, "y": y}, v) for x, y, v in pts], f"pt {g.POINT}, label int"))
    monkeypatch.setattr(queries, "cells", lambda t: frame(spark, [(1, poly([(0, 0), (5, 0), (5, 5), (0, 5), (0, 0)]))], f"cell int, poly {g.POLYGON}"))
    rows = queries.bisect_mixed_cells(None).collect()
    assert sum(r.area for r in rows) == pytest.approx(25, abs=1e-4)
    assert max(len(r.path) for r in rows) > 3 and {r.label for r in rows} == {None, 1, 2}


def test_fill_in_order_equals_the_sequential_pass(spark):
    t = tiles(spark, 4).withColumn("label", F.when(F.col("cell") == 0, 1).when(F.col("cell") == 15, 2).when(F.col("cell") == 3, 2))
    near = spatial.touching(t, "cell")
    got = {r.cell: r.label for r in labels.fill_in_order(t, near, "cell", "label").collect()}
    around = {}
    for r in near.collect():
        around.setdefault(r.cell, []).append(r.other)
    lab = {r.cell: r.label for r in t.collect()}
    for c in sorted(lab):
        if lab[c] is None:
            votes = [lab[o] for o in around[c] if lab[o] is not None]
            if votes:
                lab[c] = min(set(votes), key=lambda v: (-votes.count(v), v))
    assert got == lab


def test_small_blocks_merge_and_keep_area(spark):
    t = tiles(spark, 4)
    sized = t.select(F.lit("a").alias("town"), F.col("cell").alias("block"), (g.area(F.col("poly")) + F.col("cell") / 100).alias("area"))
    borders = spatial.shared_borders(t, "cell").select(F.lit("a").alias("town"), F.col("cell").alias("block"), "other", "shared")
    into = parcels.merge_groups(sized, borders, 3.0)
    areas = sized.join(into, ["town", "block"]).groupBy("into").agg(F.sum("area").alias("a")).collect()
    assert sum(r.a for r in areas) == pytest.approx(16 + 1.2) and min(r.a for r in areas) >= 3


def test_degrees_and_rays(spark):
    nodes = frame(spark, [(1, {"x": 0.0, "y": 0.0}), (2, {"x": 10.0, "y": 0.0}), (3, {"x": 20.0, "y": -5.0}), (4, {"x": 20.0, "y": 5.0})], f"osmid bigint, pt {g.POINT}")
    edges = frame(spark, [(1, 2, 0, None), (2, 1, 0, None), (3, 4, 0, None), (4, 3, 0, None), (3, 3, 1, None)], f"u bigint, v bigint, key int, line {g.LINE}")
    assert {r.node: r.degree for r in graph.degrees(edges).collect()} == {1: 1, 2: 1, 3: 3, 4: 1}
    rays = {r.node: (r.p, r.q) for r in graph.dead_end_rays(nodes, edges, 100.0).collect()}
    assert tuple(rays[2][1]) == (110, 0)
    lines = {r.node: [tuple(p) for p in r.line] for r in parcels.extensions(nodes, edges, 100.0).collect()}
    assert lines == {2: [(10, 0), (20, 0)]}


def test_nearest_foot(spark):
    points = frame(spark, [(1, {"x": 5.0, "y": 3.0}), (2, {"x": 5.0, "y": 50.0})], f"pid int, pt {g.POINT}")
    lines = frame(spark, [(poly([(0, 0), (10, 0)])[0],)], f"line {g.LINE}")
    got = spatial.nearest_feet(points, lines, "pid", 10.0).collect()
    assert [(r.pid, tuple(r.foot), r.dist) for r in got] == [(1, (5, 0), 3)]


def test_keep_first_and_majority(spark):
    df = frame(spark, [(1, None, 3, "c"), (1, None, 2, "b"), (2, "x", 1, "a")], "k int, j string, o int, v string")
    assert sorted((r.k, r.v) for r in relational.keep_first(df, ["k", "j"], ["o"]).collect()) == [(1, "b"), (2, "a")]
    votes = frame(spark, [(1, "b"), (1, "a"), (1, None), (1, None), (1, None)], "k int, l string")
    assert [tuple(r) for r in relational.majority(votes, ["k"], "l").collect()] == [(1, "a", 1)]


def test_crossing_and_parallel(spark):
    mk = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    df = frame(spark, [(mk((0, 0), (2, 2), (0, 2), (2, 0)),), (mk((0, 0), (1, 0), (0, 1), (1, 1)),)], f"a {g.LINE}")
    x = df.select(g.crossing(*(F.get("a", i) for i in range(4))).alias("x")).collect()
    assert tuple(x[0].x["at"]) == (1, 1) and x[1].x is None
    assert math.isclose(x[0].x.t, 0.5)
