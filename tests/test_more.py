"""Geometry types of inputs, categorical colours, what only one of two layers covers, and the same linkage as a stream."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geometry as g
from cadastra.functions import shapes, tables
from cadastra.operators import labels, overlay
from cadastra.sources import readers
from cadastra.streaming import ingest

from .test_overlay import box, polys


def test_only_polygons_of_mixed_shapes(spark):
    p, ln = shapes.part("Point", F.array(F.array(g.point(F.lit(1), F.lit(1))))), shapes.part("LineString", F.array(F.array(*(g.point(F.lit(x), F.lit(0)) for x in (0, 5)))))
    poly = shapes.part("Polygon", g.rectangle(*(F.lit(float(x)) for x in (0, 0, 2, 3))))
    rows = None
    for i, parts in enumerate([[p], [ln, ln], [poly], [poly, poly], [poly, p]]):
        row = spark.range(1).select(F.lit(i).alias("id"), F.array(*parts).alias("shape"))
        rows = row if rows is None else rows.unionByName(row)
    rows = rows.unionByName(spark.range(1).select(F.lit(9).alias("id"), F.lit(None).cast(shapes.SHAPE).alias("shape")))
    got = readers.polygons_of(rows).select("id", "part", g.area(F.col("poly")).alias("a")).collect()
    assert sorted(map(tuple, got)) == [(2, 0, 6.0), (3, 0, 6.0), (3, 1, 6.0)]


def test_colours_in_order_of_first_appearance(spark):
    rows = spark.createDataFrame([(None if i == 3 else 100 - i, i + 50 * again) for i in range(25) for again in (1, 0)], "label int, at int")
    got = {r.label: r.color for r in labels.categorical(rows, "label", "at").collect()}
    assert got == {None if i == 3 else 100 - i: labels.TAB20[min(i, 19)] for i in range(25)}


def test_difference_and_symmetric_difference(spark):
    """Two boxes that overlap in a quarter, one with a hole inside the overlap."""
    hole = box(6, 6, 8, 8)[0][::-1]
    left, right = polys(spark, (1, [*box(0, 0, 10, 10), hole])), polys(spark, (2, box(5, 5, 15, 15)))
    assert overlay.difference(left, right, "id", 5.0).select(F.sum(g.area(F.col("poly")))).first()[0] == pytest.approx(75.0)
    assert overlay.symmetric_difference_area(left, right, 5.0).first()[0] == pytest.approx(75 + 75 + 4)


def test_arrivals_are_linked_and_counted(spark, tmp_path):
    """Two files of geocoder lines, a registry beside them; counts a window with a watermark."""
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [[i, f"Fő utca {12 + i // 2}/A", "Tököl", "2316 Magyarország", 47.3, 18.9] for i in range(6)]
    for k in (0, 1):
        (folder / f"{k}.txt").write_text("\n".join(json.dumps(x, ensure_ascii=False) for x in lines[k::2]) + "\n\n", encoding="utf-8")
    stream = ingest.geocode_stream(spark, str(folder))
    cleaned = spark.read.text(str(folder)).where("trim(value) <> ''")
    want = readers.clean_geocodes(cleaned)
    first = want.select("utca", "cim", "telepules").distinct().collect()
    registry = spark.createDataFrame([(r.utca, r.cim, r.telepules, i) for i, r in enumerate(first)], "utca string, cim string, telepulesnev_hu string, szavazokorid int")
    ingest.write_stream(ingest.link_stream(stream, registry), str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == want.count() == 6 and {r.szavazokorid for r in got.collect()} == set(range(len(first)))
    timed = ingest.geocode_stream(spark, str(folder)).withColumn("arrived", F.timestamp_seconds(F.lit(1_700_000_000)))
    counts = ingest.arrivals_by_town(timed).writeStream.format("memory").queryName("arrivals").outputMode("complete").trigger(availableNow=True).start()
    counts.awaitTermination(120)
    assert [tuple(r) for r in spark.table("arrivals").select("telepules", "n", "without_number").collect()] == [("Tököl", 6, want.where("cim IS NULL").count())]


def test_halves_as_a_table_function(spark):
    """The same pieces in SQL as from the operator."""
    tables.register(spark)
    df = polys(spark, (1, box(0, 0, 4, 2)), (2, [*box(0, 0, 10, 10), box(4, 4, 6, 6)[0][::-1]]), (3, box(1, 1, 1, 5)))
    df.unionByName(spark.createDataFrame([(4, None)], df.schema)).createOrReplaceTempView("shapes_to_halve")
    got = spark.sql("SELECT s.id, CAST(h.part AS STRING) AS path, h.poly FROM shapes_to_halve s, LATERAL felez(s.poly) h").collect()
    want = labels.halve(df.withColumn("path", F.lit("")), "id").select("id", "path", "poly").collect()
    assert len(want) == 4 and sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
