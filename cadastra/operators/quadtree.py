"""Points in polygons over a quadtree whose depth follows the points: a node of more than `most` points has four children, down to a
stated depth or to a single place, and what is still larger there is dealt in parts. Nodes without points do not exist.

Polygons go down the tree, a level a round, all together. A node keeps a polygon only if a side of it meets the node or the node lies
inside, so a long diagonal has rows along its sides and no more; a node wholly inside takes its points without a test. With a node goes
only what decides there: sides at the node's height that are not all left of it, which a ray to the right can cross. So each
leaf's part holds about `most` points, and a test costs the sides near it, whatever the polygon's size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geometry as g
from cadastra.session import materialize

NODE = ["l", "cx", "cy"]
HOT_CELLS = 1000  #: a place with over a 1/HOT_CELLS of all points is joined by broadcast: there are fewer than this


def _fine(pt: str, unit: float) -> list[Column]:
    return [F.floor(F.col(f"{pt}.{c}") / unit).cast("bigint").alias(f"i{c}") for c in "xy"]


def build(places: DataFrame, most: int, depth: int) -> DataFrame:
    """places (ix, iy, n), counts on the finest grid: (l, cx, cy, n, leaf) of all nodes that the tree has."""
    at = places.select("n", "ix", "iy", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("l"))
    up = [F.expr(f"CAST(floor({c} / pow(2, {depth} - l)) AS BIGINT)").alias(name) for c, name in (("ix", "cx"), ("iy", "cy"))]
    nodes = at.select("n", "l", *up).groupBy(*NODE).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("places"))
    nodes = materialize(nodes.select(*NODE, "n", ((F.col("n") <= most) | (F.col("places") == 1) | (F.col("l") == depth)).alias("leaf")), "nodes")
    parents = nodes.where("NOT leaf").select((F.col("l") + 1).alias("l"), F.col("cx").alias("px"), F.col("cy").alias("py"))
    below = nodes.withColumns({"px": F.expr("CAST(floor(cx / 2) AS BIGINT)"), "py": F.expr("CAST(floor(cy / 2) AS BIGINT)")})
    kept = below.where("l > 0").join(parents, ["l", "px", "py"], "left_semi").select(*NODE, "n", "leaf")
    return materialize(nodes.where("l = 0").unionByName(kept), "tree")


def place(points: DataFrame, size: float, most: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """points with the leaf (l, cx, cy) and the part of it that each is in, and the tree. Points without coordinates are in none."""
    unit = size / 2**depth
    at = points.where("pt.x IS NOT NULL AND pt.y IS NOT NULL").select("*", *_fine("pt", unit))
    places = materialize(at.groupBy("ix", "iy").agg(F.count(F.lit(1)).alias("n")), "places")
    tree = build(places, most, depth)
    levels = places.select("ix", "iy", F.col("n").alias("here"), F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("l"))
    up = {name: F.expr(f"CAST(floor({c} / pow(2, {depth} - l)) AS BIGINT)") for c, name in (("ix", "cx"), ("iy", "cy"))}
    leaf = levels.withColumns(up).join(tree.where("leaf"), NODE)
    leaf = materialize(leaf.select("ix", "iy", "here", F.struct(*NODE, F.ceil(F.col("n") / most).alias("parts")).alias("leaf")), "leaves")
    total = places.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = leaf.where(F.col("here") > total / HOT_CELLS).select("ix", "iy", F.col("leaf").alias("hot"))
    both = at.join(F.broadcast(hot), ["ix", "iy"], "left")
    rest = both.where("hot IS NULL").drop("hot").join(leaf.select("ix", "iy", "leaf"), ["ix", "iy"])
    dealt = both.where("hot IS NOT NULL").withColumnRenamed("hot", "leaf").unionByName(rest)
    part = F.pmod(F.monotonically_increasing_id(), F.col("leaf.parts")).alias("part")  # numbered once, in the written table
    return materialize(dealt.select(*points.columns, "leaf.l", "leaf.cx", "leaf.cy", part), "placed"), tree


def _box(size: float, pad: float) -> Column:
    """The square of a node, wider by pad: borders of nodes are rounded."""
    w = size / F.pow(F.lit(2.0), F.col("l"))
    return F.struct(*(e.alias(n) for n, e in (("x0", F.col("cx") * w - pad), ("y0", F.col("cy") * w - pad), ("x1", (F.col("cx") + 1) * w + pad), ("y1", (F.col("cy") + 1) * w + pad))))


def _meets(s: Column, b: Column) -> Column:
    """Whether a side meets a box: their bounds do and the corners are not all beside the side's line."""
    p, q = s["p"], s["q"]
    beside = [(q["x"] - p["x"]) * (b[y] - p["y"]) - (q["y"] - p["y"]) * (b[x] - p["x"]) for x in ("x0", "x1") for y in ("y0", "y1")]
    x = (F.greatest(p["x"], q["x"]) >= b["x0"]) & (F.least(p["x"], q["x"]) <= b["x1"])
    y = (F.greatest(p["y"], q["y"]) >= b["y0"]) & (F.least(p["y"], q["y"]) <= b["y1"])
    return x & y & (F.least(*beside) <= 0) & (F.greatest(*beside) >= 0)


def _strictly_in(pt: Column, sides: Column) -> Column:
    """geometry.within for the sides of all rings."""

    def inside(v):
        def crossed(s):
            p, q = s["p"], s["q"]
            at = (q["x"] - p["x"]) * (v["y"] - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) + p["x"]
            return ((p["y"] > v["y"]) != (q["y"] > v["y"])) & F.coalesce(v["x"] < at, F.lit(False))

        on = F.exists(sides, lambda s: g.on_line(v, F.array(s["p"], s["q"])))
        return ~on & (F.size(F.filter(sides, crossed)) % 2 == 1)

    return g.let(pt, inside)


def _judged(at: DataFrame, size: float, pad: float) -> DataFrame:
    """Rows (uid, node, sides, whole) that the polygon really reaches, with the sides that decide in the node."""
    box = at.withColumn("b", _box(size, pad))

    def decides(s: Column) -> Column:
        x, ys = F.greatest(s["p"]["x"], s["q"]["x"]), (s["p"]["y"], s["q"]["y"])
        return (x >= F.col("b.x0")) & (F.greatest(*ys) >= F.col("b.y0")) & (F.least(*ys) <= F.col("b.y1"))

    near = F.filter("sides", decides)
    cut = box.withColumn("sides", F.when(F.col("whole"), F.col("sides")).otherwise(near)).withColumn("border", ~F.col("whole") & F.exists("sides", lambda s: _meets(s, F.col("b"))))
    middle = g.point((F.col("b.x0") + F.col("b.x1")) / 2, (F.col("b.y0") + F.col("b.y1")) / 2)
    whole = F.col("whole") | (~F.col("border") & _strictly_in(middle, F.col("sides")))
    kept = cut.withColumn("whole", whole).where("border OR whole")
    return kept.withColumn("sides", F.when(F.col("whole"), F.slice("sides", 1, 0)).otherwise(F.col("sides"))).drop("b", "border")


def cover(polygons: DataFrame, tree: DataFrame, size: float, depth: int) -> DataFrame:
    """polygons (uid, poly): (uid, box, l, cx, cy, n, whole, sides) of every leaf that each reaches."""
    pad = size / 2**depth * 1e-6
    sides = F.flatten(F.transform("poly", g.segments))
    box = polygons.where("size(poly) > 0").select("uid", sides.alias("sides"), g.bounds(F.get("poly", 0)).alias("box"))
    span = lambda lo, hi: F.explode(F.sequence(F.floor((F.col(lo) - pad) / size).cast("bigint"), F.floor((F.col(hi) + pad) / size).cast("bigint")))
    at = box.select("uid", "box", "sides", F.lit(0).alias("l"), span("box.xmin", "box.xmax").alias("cx")).select("uid", "box", "sides", "l", "cx", span("box.ymin", "box.ymax").alias("cy"))
    at = at.withColumn("whole", F.lit(False)).join(tree, NODE)
    children = tree.withColumns({"cx2": F.col("cx"), "cy2": F.col("cy"), "cx": F.expr("CAST(floor(cx / 2) AS BIGINT)"), "cy": F.expr("CAST(floor(cy / 2) AS BIGINT)"), "l": F.col("l") - 1})
    found = []
    while True:
        at = materialize(_judged(at, size, pad), "cover")
        found.append(at.where("leaf"))
        open_ = at.where("NOT leaf").drop("n", "leaf")
        if not open_.limit(1).count():
            break
        at = open_.join(children, NODE).select("uid", "box", "sides", "whole", (F.col("l") + 1).alias("l"), F.col("cx2").alias("cx"), F.col("cy2").alias("cy"), "n", "leaf")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.drop("leaf")


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float, most: int = 256, depth: int = 12) -> DataFrame:
    """points (pt) joined to the polygons (poly) that they lie strictly inside, the rows of the join on a fixed grid. size: the side of
    the largest nodes, some share of the whole extent; most: points that one leaf's part holds, about; depth: of the tree."""
    placed, tree = place(points, size, most, depth)
    named = materialize(polygons.withColumn("uid", F.monotonically_increasing_id()), "polygons")
    covers = cover(named, tree, size, depth)
    dealt = covers.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n") / most) - 1))).drop("n")
    hits = dealt.join(placed, [*NODE, "part"])
    in_box = F.col("pt.x").between(F.col("box.xmin"), F.col("box.xmax")) & F.col("pt.y").between(F.col("box.ymin"), F.col("box.ymax"))
    hits = hits.where(F.col("whole") | in_box).where(F.col("whole") | _strictly_in(F.col("pt"), F.col("sides")))
    return hits.select("uid", *points.columns).join(named, "uid").drop("uid")
