"""Registered queries against DuckDB on the smallest tables, and reader and streaming cases."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from cadastra.plans import registry
from cadastra.sources import readers, sinks
from cadastra.streaming import ingest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = [tuple(round(float(r[i]), 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return sorted(columns), sorted(clean, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_duckdb(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    want = duck.execute(registry.oracle_sql()[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([c[0] for c in want.description], want.fetchall())


LINES = [
    '[1, "Fő utca 12/A", "Vác", "2600 Hungary", 47.7, 19.1]',
    '[2, "Cég", "Vác", "Fő u. 3", "2600 Hungary", 47.7, 19.1]',
    '[3, "a", null, "b", "Vác", "Duna krt. 5-B épület", "2600 Hungary", 47.7, 19.1]',
    "[4, 1, 2, 3, 4, 5, 6, 7]",
    '[5, "", "Vác", "2600 Hungary", 47.7, 19.1]',
    '[6, "Fő utca 1", "Vác", "2600", 47.7, 19.1]',
    "",
    "  ",
    "not json",
]


def test_ragged_lines(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string").where("trim(value) <> ''")
    got = {r.gid: (r.utca, r.cim, r.iszam, tuple(r.pt)) for r in readers.clean_geocodes(lines).collect()}
    assert got == {
        1: ("Fő utca", "12 A", 2600, (19.1, 47.7)),
        2: ("Fő utca", "3", 2600, (19.1, 47.7)),
        3: ("Duna körút", "5 B", 2600, (19.1, 47.7)),
    }


def test_registry(spark):
    rows = [
        (1, 1, 1, "Fő u.", "0012", 1, "Vac", 5, "2022-04-03"),
        (1, 1, 1, "Fő u.", "0012", 1, "Waitzen", 4, "2022-04-03"),  # the same town in another language
        (2, None, 1, "Fő u.", "0", None, "Vac", 4, "2022-04-03"),
        (2, None, 1, "Fő u.", "3", 1, "Vac", 4, "2022-04-03"),  # no street id
        (3, 1, 1, "Fő u.", None, 1, None, 4, "2014-04-06"),  # a town without a name stays
        (4, 1, 1, "Fő u.", "7", 1, "Vac", 4, "2018-04-08"),
        (5, 1, 1, None, "7", 1, "Szob", 4, "2014-04-06"),
    ]
    towns = spark.createDataFrame([("Vac", "Vác")], "src string, dst string")
    got = readers.clean_registry(spark.createDataFrame(rows, readers.REGISTRY).coalesce(1), towns).collect()
    assert sorted((r.szavazokorid, r.utca, r.cim, r.telepulesnev_hu, r.eventfromid) for r in got) == [(1, "Fő utca", "12", "Vác", 5), (3, "Fő utca", None, None, 4), (5, "7", None, "Szob", 4)]


def test_town_without_homes_is_an_error(spark, tmp_path):
    for name in ("nodes", "edges", "residential", "boundary"):
        sinks.write_by_town(spark.createDataFrame([("a", 1)], "town string, v int"), f"{tmp_path}/{name}")
    assert readers.load_town(spark, str(tmp_path), "a")["nodes"].count() == 1
    with pytest.raises(RuntimeError):
        readers.load_town(spark, str(tmp_path), "b")


def test_place_lookup(spark):
    rows = spark.createDataFrame([("x", None, None, "V", None, None), ("y", None, None, None, None, None)], "src string, city string, town string, village string, municipality string, river string")
    assert sorted(tuple(r) for r in readers.lookup_towns(rows).collect()) == [("x", "V"), ("y", "y")]


def test_counters(spark):
    df, seen = sinks.counted(spark.range(10), "rows_read", big=F.count_if(F.col("id") > 7))
    df.collect()
    assert seen.get == {"rows": 10, "big": 2}


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(LINES), encoding="utf-8")
    q = ingest.write_stream(ingest.geocode_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
