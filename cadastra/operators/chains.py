"""Sides joined to lines that are as long as can be: a line ends where other than two sides meet, or closes on itself.

Open lines are ranked as lists: every side, taken both ways, points to the one that follows it, and each round doubles how far it points,
until it has the line's last side and the steps to it. A line of n sides takes log2 n rounds, all lines together. What still points
on when a round settles nothing more is on rings, which are walked from their least side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geometry as g
from cadastra.operators import parcels
from cadastra.session import materialize


def followed(sides: DataFrame) -> DataFrame:
    """(id, p, q, next): each side of (a, b) both ways, with the id of the one that goes on from q where two sides meet there, else null."""
    once = sides.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    half = once.select(F.explode(F.array(F.struct(F.col("a").alias("p"), F.col("b").alias("q")), F.struct(F.col("b").alias("p"), F.col("a").alias("q")))).alias("h")).select("h.p", "h.q")
    half = materialize(half.withColumn("id", F.xxhash64("p", "q")), "halves")
    # at a corner of two sides the halves that leave it are each other's continuation; two rows at most are gathered
    through = half.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("q", "id")).alias("u"), F.max(F.struct("q", "id")).alias("v")).where("n = 2")
    onward = through.select(F.explode(F.array(F.struct(F.col("u.q").alias("p"), F.col("p").alias("q"), F.col("v.id").alias("next")), F.struct(F.col("v.q").alias("p"), F.col("p").alias("q"), F.col("u.id").alias("next")))).alias("o")).select("o.*")
    return materialize(half.join(onward, ["p", "q"], "left").select("id", "p", "q", "next"), "followed")


def ranked(ways: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ways (id, next): (id, last, steps) of those on open lists, and (id) of those on rings."""
    state = ways.select("id", F.col("next").alias("to"), F.coalesce("next", "id").alias("last"), F.when(F.col("next").isNull(), 0).otherwise(1).cast("bigint").alias("steps"))
    state, before = materialize(state, "ranks"), None
    while True:
        open_ = state.where("to IS NOT NULL")
        left = open_.count()
        if left in (0, before):
            return state.where("to IS NULL").select("id", "last", "steps"), open_.select("id")
        ahead = state.select(F.col("id").alias("to"), F.col("to").alias("to2"), F.col("last").alias("last2"), F.col("steps").alias("more"))
        moved = open_.join(ahead, "to").select("id", F.col("to2").alias("to"), F.col("last2").alias("last"), (F.col("steps") + F.col("more")).alias("steps"))
        state, before = materialize(state.where("to IS NULL").unionByName(moved), "ranks"), left


def _in_order(place: Column) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct((-place).alias("o"), "p"))), lambda x: x["p"])


def merge_lines(sides: DataFrame) -> DataFrame:
    """(line): the lines of sides (a, b). Each runs from its lesser end; a ring starts at its least corner, a ring through a junction
    there, and both run toward the lesser of the two neighbours. Repeated and reversed sides are one, sides without length none."""
    ways = followed(sides)
    open_, closed = ranked(ways)
    ends = ways.select(F.col("id").alias("last"), F.col("q").alias("end"))
    lines = ways.join(open_, "id").groupBy("last").agg(_in_order(F.col("steps")).alias("pts")).join(ends, "last").select(F.concat("pts", F.array("end")).alias("line"))
    forth = F.struct(F.get("line", 0), F.get("line", 1)) < F.struct(F.element_at("line", -1), F.element_at("line", -2))
    lines = lines.where((F.size("line") == 2) & (F.get("line", 0) < F.get("line", 1)) | (F.size("line") > 2) & forth)
    rings = parcels.walk(materialize(ways.join(closed, "id"), "rings")).groupBy("face").agg(_in_order(F.col("far")).alias("pts"))
    turned = g.let(F.array_position("pts", F.array_min("pts")).cast("int"), lambda i: F.concat(F.slice("pts", i, F.size("pts")), F.slice("pts", 1, i - 1)))
    rings = rings.select(turned.alias("pts")).where(F.get("pts", 1) < F.element_at("pts", -1))
    return lines.unionByName(rings.select(F.concat("pts", F.slice("pts", 1, 1)).alias("line")))
