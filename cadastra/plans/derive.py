"""Inputs derived from the given tables in SQL that Spark and DuckDB evaluate alike.

{name} stands for a table; the driver's tables have no addresses or geometries, so these are made
from keys of theirs, and grow with them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The tables of one folder, for queries."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        names = set(re.findall(r"{(\w+)}", text))
        return self.spark.sql(text, **{n: self.read(n) for n in names})


def plain(text: str) -> str:
    """The same SQL over views."""
    return re.sub(r"{(\w+)}", r"\1", text)


def number(key: str) -> str:
    n = f"(1 + ({key} * 7) % 17)"
    s = f"CAST({n} AS STRING)"
    return (
        f"CASE {key} % 5 WHEN 0 THEN {s} WHEN 1 THEN concat({s}, '-', CAST({n} + 2 AS STRING)) WHEN 2 THEN concat({s}, ' A') "
        f"WHEN 3 THEN concat({s}, CASE WHEN {key} % 2 = 0 THEN ' A' ELSE ' B' END) ELSE NULL END"
    )


def street(key: str) -> str:
    return f"concat('Utca ', CAST({key} % 4 AS STRING))"


REGISTRY = f"SELECT c_custkey AS rid, c_nationkey AS town, c_custkey % 7 AS district, {street('c_custkey')} AS street, {number('c_custkey')} AS number FROM {{customer}}"
GEOCODES = f"SELECT s_suppkey AS gid, s_nationkey AS town, {street('s_suppkey')} AS street, {number('s_suppkey')} AS number FROM {{supplier}}"

#: Cells: the squares of a grid of 100 columns, a row for every 100 parts. Points: the orders, 7.5 a square and in
#: as many rows; two squares of seven stay without points, every fiftieth point is on a border or so, and
#: labels change inside squares, every four rows and at every 31 units, from another place in each row.
CELLS = "SELECT p_partkey AS cell, CAST(p_partkey % 100 AS DOUBLE) * 5 AS x0, CAST(floor(CAST(p_partkey AS DOUBLE) / 100) AS DOUBLE) * 5 AS y0 FROM {part}"
_SPREAD = (
    "SELECT o_orderkey AS pid, r, CAST(c + CASE WHEN (c + 2 * r) % 7 < 2 THEN 2 ELSE 0 END AS DOUBLE) * 5 + CAST(o_custkey * 7 % 50 AS DOUBLE) / 10 + CAST(0.03 AS DOUBLE) AS x, "
    "CAST(r AS DOUBLE) * 5 + CASE WHEN o_custkey % 25 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(o_custkey * 53 % 50 AS DOUBLE) / 10 + CAST(0.03 AS DOUBLE) END AS y FROM "
    "(SELECT o_orderkey, o_custkey, o_orderkey * 37 % 100 AS c, CAST(floor(CAST(o_orderkey AS DOUBLE) / 750) AS BIGINT) AS r FROM {orders})"
)
POINTS = f"SELECT pid, x, y, CAST(floor(CAST(r AS DOUBLE) / 4) AS BIGINT) * 20 + CAST(floor((x + CAST(5 * (3 * r % 7) AS DOUBLE)) / 31) AS BIGINT) AS label FROM ({_SPREAD})"
#: Towns: ten rows of cells each, a hole in each.
TOWNS = "SELECT DISTINCT CAST(floor(CAST(p_partkey AS DOUBLE) / 1000) AS BIGINT) AS town FROM {part}"
#: Zones of all sizes: squares of one to five units, every twentieth a strip of 64 on the diagonal, every 500th 256 by 32 units.
ZONES = "SELECT p_partkey AS zone, CASE WHEN p_partkey % 20 = 0 THEN 'strip' WHEN p_partkey % 500 = 7 THEN 'wide' ELSE 'square' END AS kind, CAST(p_partkey * 13 % 500 AS DOUBLE) AS x0, CAST(floor(CAST(p_partkey AS DOUBLE) / 34) AS DOUBLE) AS y0, CAST(1 + p_partkey % 5 AS DOUBLE) AS side FROM {part}"
#: A third of all orders in one square of four units, a third of those in one place, the others wide apart.
CROWD = (
    "SELECT o_orderkey AS pid, CASE WHEN o_orderkey % 9 = 0 THEN CAST(41 AS DOUBLE) WHEN o_orderkey % 3 = 0 THEN 40 + CAST(o_custkey * 7 % 32 AS DOUBLE) / 8 ELSE CAST(o_orderkey * 37 % 4096 AS DOUBLE) / 8 END AS x, "
    "CASE WHEN o_orderkey % 9 = 0 THEN CAST(5.5 AS DOUBLE) WHEN o_orderkey % 3 = 0 THEN 4 + CAST(o_orderkey * 5 % 32 AS DOUBLE) / 8 ELSE CAST(floor(CAST(o_orderkey AS DOUBLE) / 32) AS DOUBLE) / 8 END AS y FROM {orders}"
)
#: Street lines: 20 parts make a frame of 50 units, each with a line across it.
LINES = (
    "SELECT tile, ox, ox AS x0, CAST(k % 50 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS y0, ox + 50 AS x1, CAST(k * 7 % 50 AS DOUBLE) + CAST(0.25 AS DOUBLE) AS y1 FROM "
    "(SELECT p_partkey AS k, CAST(floor(CAST(p_partkey AS DOUBLE) / 20) AS BIGINT) AS tile, CAST(floor(CAST(p_partkey AS DOUBLE) / 20) AS DOUBLE) * 60 AS ox FROM {part})"
)
EDGES = "SELECT o_custkey AS u, CAST(100000 AS BIGINT) + o_orderkey % 97 AS v, 0 AS key FROM {orders}"

#: DuckDB: a registry and a geocode table with parsed house numbers
PARSE = r"'^ *([0-9]+) *(- *([0-9]+))? *([A-Za-z])? *$'"
PARSED = f"""
parsed_{{0}} AS (SELECT *, TRY_CAST(regexp_extract(number, {PARSE}, 1) AS INT) AS lo,
  coalesce(TRY_CAST(nullif(regexp_extract(number, {PARSE}, 3), '') AS INT), TRY_CAST(regexp_extract(number, {PARSE}, 1) AS INT)) AS hi,
  regexp_extract(number, {PARSE}, 3) AS hi_text, upper(nullif(regexp_extract(number, {PARSE}, 4), '')) AS letter FROM {{0}}),
able_{{0}} AS (SELECT * FROM parsed_{{0}} WHERE lo IS NOT NULL AND (hi_text = '' OR hi > lo))"""
LINK = (
    f"WITH reg AS ({plain(REGISTRY)}), geo AS ({plain(GEOCODES)}),"
    + PARSED.format("reg")
    + ","
    + PARSED.format("geo")
    + """,
p1 AS (SELECT r.rid, g.gid FROM reg r JOIN geo g ON r.street IS NOT DISTINCT FROM g.street AND r.number IS NOT DISTINCT FROM g.number AND r.town IS NOT DISTINCT FROM g.town),
r2 AS (SELECT * FROM able_reg WHERE rid NOT IN (SELECT rid FROM p1)),
p2 AS (SELECT r.rid, g.gid FROM r2 r JOIN able_geo g ON r.street IS NOT DISTINCT FROM g.street AND r.town IS NOT DISTINCT FROM g.town AND greatest(r.lo, g.lo) <= least(r.hi, g.hi) AND r.letter IS NOT DISTINCT FROM g.letter),
r3 AS (SELECT * FROM r2 WHERE rid NOT IN (SELECT rid FROM p2)),
p3 AS (SELECT r.rid, g.gid FROM r3 r JOIN able_geo g ON r.street IS NOT DISTINCT FROM g.street AND r.town IS NOT DISTINCT FROM g.town AND greatest(r.lo, g.lo) <= least(r.hi, g.hi)),
linked AS (SELECT *, 1 AS pass FROM p1 UNION ALL SELECT *, 2 FROM p2 UNION ALL SELECT *, 3 FROM p3)
"""
)
