"""Border smoothing over a noded partition.

Every chain of border between two junctions (vertices where three or more sides meet) is
smoothed by itself with its ends fixed. Both polygons along a chain get the same points,
since corner cutting gives the same points from either end, so no gaps or overlaps open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions import geometry as g
from cadastra.operators import spatial
from cadastra.session import dealt


def stops(polygons: DataFrame, key: str) -> DataFrame:
    """(v): vertices that stay: those where three or more different sides meet, and the ends of sides that only
    one polygon has."""
    sides = spatial.edges_of(polygons, key).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    ends = sides.select(F.explode(F.array("a", "b")).alias("v"), (F.col("n") == 1).cast("int").alias("outer"))
    return ends.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.max("outer").alias("outer")).where("n >= 3 OR outer = 1").select("v")


def _chains(ring: Column, stops: Column) -> Column:
    """A ring, started at a stop if it has one, as lines from stop to stop."""
    is_stop = lambda p: F.exists(stops, lambda s: s.eqNullSafe(p))
    open_ = F.slice(ring, 1, F.size(ring) - 1)
    first = F.coalesce(F.get(F.filter(F.transform(open_, lambda p, i: F.when(is_stop(p), i)), lambda i: i.isNotNull()), 0), F.lit(0))
    turned = g.let(first, lambda i: F.concat(F.slice(open_, i + 1, F.size(open_)), F.slice(open_, 1, i + 1)))

    def step(acc, p):
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat(last, F.array(p))))
        return F.when(is_stop(F.element_at(last, -1)) & (F.size(last) > 1), F.concat(acc, F.array(F.array(F.element_at(last, -1), p)))).otherwise(grown)

    return g.let(turned, lambda t: F.aggregate(F.slice(t, 2, F.size(t)), F.array(F.slice(t, 1, 1)), step))


def smooth_borders(polygons: DataFrame, key: str, iterations: int = 2, tol: float = 1.0) -> DataFrame:
    """polygons with each chain of shared border simplified and then smoothed; chain ends and outer sides stay. A border
    that closes on itself keeps its least vertex."""
    fixed = stops(polygons, key)
    at = polygons.select(key, F.explode(F.array_distinct(F.flatten("poly"))).alias("v")).join(dealt(fixed), "v").groupBy(key).agg(F.collect_list("v").alias("stops"))
    joined = polygons.join(dealt(at), key, "left").withColumn("stops", F.coalesce("stops", F.array().cast(g.LINE)))

    def cut(line):
        """The same points whichever way the line runs."""
        back = F.element_at(line, -1) < F.get(line, 0)
        done = g.chaikin(g.simplify(F.when(back, F.reverse(line)).otherwise(line), tol), iterations)
        return g.let(F.when(back, F.reverse(done)).otherwise(done), lambda v: F.slice(v, 1, F.size(v) - 1))

    def ring(r):
        own = g.let(F.filter("stops", lambda s: F.array_contains(r, s)), lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(F.array_min(r))))
        pts = F.flatten(F.transform(g.let(own, lambda s: _chains(r, s)), lambda c: F.when(F.size(c) < 3, F.slice(c, 1, 1)).otherwise(cut(c))))
        return g.let(pts, lambda v: F.concat(v, F.slice(v, 1, 1)))

    return joined.withColumn("poly", F.transform("poly", ring)).drop("stops")


def shared_lines(polygons: DataFrame, key: str) -> DataFrame:
    """(key, other, lines, shared): the common border of each pair of neighbours as lines that are as long as can be,
    and its length. A line is a run of sides that follow each other on the ring of the first."""
    ring = polygons.select(key, F.posexplode("poly").alias("r", "ring"))
    side = ring.select(key, "r", F.size("ring").alias("n"), F.posexplode(g.segments(F.col("ring"))).alias("i", "s"))
    side = side.select(key, "r", "n", "i", F.col("s.p").alias("p"), F.col("s.q").alias("q"), F.least("s.p", "s.q").alias("a"), F.greatest("s.p", "s.q").alias("b"))
    theirs = spatial.edges_of(polygons, key).select(F.col(key).alias("other"), "a", "b")
    pair = side.join(dealt(theirs), ["a", "b"]).where(F.col(key) < F.col("other"))
    w = Window.partitionBy(key, "other", "r").orderBy("i")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    run = F.sum((F.coalesce(F.lag("i").over(w), F.lit(-2)) != F.col("i") - 1).cast("int")).over(w)
    runs = pair.withColumn("run", run).withColumn("wraps", (F.min("i").over(whole) == 0) & (F.max("i").over(whole) == F.col("n") - 2) & (F.max("run").over(whole) > 1))
    runs = runs.withColumn("last", F.max("run").over(whole))
    # the run that ends a ring goes on with the one that begins it
    at = F.when(F.col("wraps") & (F.col("run") == F.col("last")), F.struct(F.lit(1).alias("run"), (F.col("i") - F.col("n")).alias("i"))).otherwise(F.struct(F.col("run").alias("run"), F.col("i").alias("i")))
    runs = runs.withColumn("at", at)
    steps = F.array_sort(F.collect_list(F.struct(F.col("at.i").alias("i"), "p", "q")))
    line = runs.groupBy(key, "other", "r", F.col("at.run").alias("run")).agg(steps.alias("x"), F.sum(g.distance(F.col("p"), F.col("q"))).alias("len"))
    line = line.withColumn("line", F.concat(F.transform("x", lambda e: e["p"]), F.array(F.element_at("x", -1)["q"])))
    return line.groupBy(key, "other").agg(F.array_sort(F.collect_list("line")).alias("lines"), F.sum("len").alias("shared"))
