"""Simplification of a partition that keeps its topology.

Borders are cut into chains between junctions, each simplified once for both sides. A stretch of a chain is replaced by the straight
side between its ends if no removed corner is farther than tol from it, no corner of the partition lies in the area between
stretch and side or on the side, and no other side has the same ends. All stretches that break a rule are halved at their
farthest corner, round by round, all chains together; where only the first rule is broken that is Douglas-Peucker. As no side sweeps over a
corner, none crosses another and no ring is lost. Rounds grow with the depth of the halving, not with the number of chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geometry as g
from cadastra.operators import chains, spatial
from cadastra.session import materialize


def _farthest(pts: Column) -> Column:
    """struct<d, k>: the inner corner that is farthest from the side between the ends (the first of equals), as its place from 0."""
    first, last = F.get(pts, 0), F.element_at(pts, -1)
    off = F.transform(F.sequence(F.lit(1), F.size(pts) - 2), lambda k: F.struct(g.distance(F.get(pts, k), g.foot_on_segment(F.get(pts, k), first, last)).alias("d"), (-k).alias("k")))
    return F.when(F.size(pts) > 2, F.array_max(off))


def _sweeping(stretches: DataFrame, corners: DataFrame, size: float) -> DataFrame:
    """(chain, at) of the stretches whose side would sweep over a corner, or meet one, that is not theirs."""
    celled = stretches.withColumn("_cell", F.explode(spatial.cells(g.bounds(F.col("pts")), size)))
    near = celled.join(corners, "_cell")
    box = g.bounds(F.col("pts"))
    near = near.where(F.col("v.x").between(box["xmin"], box["xmax"]) & F.col("v.y").between(box["ymin"], box["ymax"]) & ~F.array_contains("pts", F.col("v")))
    ring = F.concat("pts", F.slice("pts", 1, 1))
    side = F.array(F.get("pts", 0), F.element_at("pts", -1))
    return near.where(g.within(F.col("v"), F.array(ring)) | g.on_line(F.col("v"), side)).select("chain", "at").distinct()


def simplified(lines: DataFrame, tol: float, size: float) -> DataFrame:
    """(chain, at, pts): stretches of the lines (line), chains of a noded network as of chains.merge_lines, each to be replaced by the
    side between its ends."""
    corners = lines.select(F.explode("line").alias("v")).distinct()
    corners = materialize(corners.withColumn("_cell", F.struct(F.floor(F.col("v.x") / size).cast("int").alias("cx"), F.floor(F.col("v.y") / size).cast("int").alias("cy"))), "corners")
    now = materialize(lines.select(F.xxhash64("line").alias("chain"), F.lit(0).alias("at"), F.col("line").alias("pts"), F.lit(False).alias("sound")), "stretches")
    while True:
        long = now.withColumn("far", _farthest(F.col("pts"))).withColumn("wide", F.coalesce(F.col("far.d") > tol, F.lit(False)) | (F.get("pts", 0) == F.element_at("pts", -1)))
        fresh = long.where("NOT sound AND NOT wide AND far IS NOT NULL").select("chain", "at", "pts")
        ends = now.groupBy(F.least(F.get("pts", 0), F.element_at("pts", -1)).alias("a"), F.greatest(F.get("pts", 0), F.element_at("pts", -1)).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.struct("chain", "at")).alias("who"))
        twice = ends.where("n > 1").select(F.explode("who").alias("w")).select("w.*")  # the sides between two corners
        swept = _sweeping(fresh, corners, size).unionByName(twice).distinct().withColumn("bad", F.lit(True))
        told = long.join(swept, ["chain", "at"], "left").withColumn("cut", F.when((F.coalesce("bad", F.lit(False)) | F.col("wide")) & F.col("far").isNotNull(), -F.col("far.k")))
        told = materialize(told.select("chain", "at", "pts", "cut"), "told")
        if not told.where("cut IS NOT NULL").limit(1).count():
            return told.select("chain", "at", "pts")
        halves = F.array(
            F.struct(F.col("at").alias("at"), F.slice("pts", 1, F.col("cut") + 1).alias("pts")), F.struct((F.col("at") + F.col("cut")).alias("at"), F.slice("pts", F.col("cut") + 1, F.size("pts")).alias("pts"))
        )
        new = told.where("cut IS NOT NULL").select("chain", F.explode(halves).alias("h"), F.lit(False).alias("sound")).select("chain", "h.at", "h.pts", "sound")
        now = materialize(told.where("cut IS NULL").select("chain", "at", "pts", F.lit(True).alias("sound")).unionByName(new), "stretches")


def simplify_partition(polygons: DataFrame, key: str, tol: float, size: float) -> DataFrame:
    """(key, poly): noded polygons with fewer corners."""
    sides = spatial.edges_of(polygons, key).select("a", "b").distinct()
    stretches = simplified(materialize(chains.merge_lines(sides), "chains"), tol, size)
    kept = stretches.select(F.explode(F.array(F.get("pts", 0), F.element_at("pts", -1))).alias("v")).distinct()
    ring = polygons.select(key, F.posexplode("poly").alias("r", "ring")).select(key, "r", F.posexplode(F.slice("ring", 1, F.size("ring") - 1)).alias("i", "v"))
    left = ring.join(kept, "v").groupBy(key, "r").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("ring"))
    closed = left.withColumn("ring", F.concat("ring", F.slice("ring", 1, 1)))
    return closed.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "ring"))), lambda x: x["ring"]).alias("poly"))
