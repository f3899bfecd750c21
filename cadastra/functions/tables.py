"""Table functions for SQL: `register` makes them known to a session.

    SELECT t.id, h.part, h.poly FROM t, LATERAL felez(t.poly) h"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from cadastra.functions import geometry as g
from cadastra.operators import labels


class Halves:
    """The parts of a polygon on both sides of its cut (see labels.halve), even numbers on the low side. No rows for null or a polygon
    without area."""

    def eval(self, poly):
        for number, rings in labels.cut_in_half([[(p["x"], p["y"]) for p in ring] for ring in poly or []]):
            yield number, [[{"x": x, "y": y} for x, y in ring] for ring in rings]


def register(spark: SparkSession) -> None:
    spark.udtf.register("felez", udtf(Halves, returnType=f"part int, poly {g.POLYGON}", useArrow=True))
