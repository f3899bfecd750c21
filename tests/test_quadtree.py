"""Points in polygons over the quadtree against the plain predicate, and what one of its tasks holds."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from cadastra.functions import geometry as g
from cadastra.operators import quadtree, spatial


def star(rng, cx, cy, r, corners):
    """A ring with ragged corners."""
    pts = [(cx + rng.uniform(0.3, 1) * r * math.cos(2 * math.pi * i / corners), cy + rng.uniform(0.3, 1) * r * math.sin(2 * math.pi * i / corners)) for i in range(corners)]
    return [*pts, pts[0]]


def case(spark):
    """Points on a half grid, so that many are on borders and corners, a third of them in one place; stars, a long diagonal, a box with a hole,
    boxes on the grid, one of them twice, one without rings."""
    rng = random.Random(5)
    pts = [(i, (rng.randrange(-80, 80) / 2, rng.randrange(-80, 80) / 2)) for i in range(1500)] + [(i, (3.25, 7.5)) for i in range(1500, 2250)]
    pts += [(9000, None), (9001, (None, 1.0))]
    polys = [(i, [star(rng, rng.uniform(-40, 40), rng.uniform(-40, 40), rng.uniform(1, 30), rng.randrange(5, 60))]) for i in range(20)]
    polys.append((20, [[(-40.0, -40.0), (-39.0, -40.0), (40.0, 39.0), (40.0, 40.0), (-40.0, -40.0)]]))
    square = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    polys.append((21, [square(-30.0, -30.0, 30.0, 30.0), square(0.0, 0.0, 10.0, 10.0)]))
    polys += [(22 + i, [square(4.0 * i, -8.0, 4.0 * i + 4, 8.0)]) for i in range(5)] + [(22, [square(0.0, -8.0, 4.0, 8.0)]), (30, []), (31, None)]
    return spark.createDataFrame(pts, f"pid int, pt {g.POINT}"), spark.createDataFrame(polys, f"k int, poly {g.POLYGON}")


def pairs(df):
    return sorted((r.k, r.pid) for r in df.select("k", "pid").collect())


def test_rows_of_the_plain_predicate(spark):
    points, polys = case(spark)
    want = pairs(points.crossJoin(polys).where(F.expr("pt.x IS NOT NULL AND size(poly) > 0")).where(g.within(F.col("pt"), F.col("poly"))))
    assert len(want) > 1000
    for size, most, depth in ((128.0, 16, 7), (50.0, 100, 3), (16.0, 1, 0)):
        assert pairs(quadtree.points_in_polygons(points, polys, size, most, depth)) == want
    assert pairs(spatial.points_in_polygons(points.where("pt.x IS NOT NULL"), polys.where("size(poly) > 0"), 10.0)) == want


def test_empty_sides(spark):
    points, polys = case(spark)
    assert quadtree.points_in_polygons(points.limit(0), polys, 50.0).count() == 0
    assert quadtree.points_in_polygons(points, polys.limit(0), 50.0).count() == 0


def test_what_a_task_holds(spark):
    """No leaf's part has over two shares of points; the diagonal has rows along itself only; few pairs are tested of many that hold."""
    points, polys = case(spark)
    most, depth, size = 16, 7, 128.0
    placed, tree = quadtree.place(points, size, most, depth)
    assert placed.count() == 2250
    held = placed.groupBy(*quadtree.NODE, "part").count().agg(F.max("count")).first()[0]
    assert held <= 2 * most
    named = polys.withColumn("uid", F.col("k").cast("bigint"))
    covers = quadtree.cover(named, tree, size, depth)
    leaves = tree.where("leaf").count()
    assert covers.where("uid = 20").count() < leaves / 3
    tested = covers.where("NOT whole").agg(F.sum("n")).first()[0]
    assert tested < points.count() * polys.count() / 5
    assert covers.where("NOT whole").agg(F.max(F.size("sides"))).first()[0] < 59  # never all of a large ring
