"""Registered queries: name -> (function of Tables, DuckDB SQL or None)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geometry as g
from cadastra.functions import projection, shapes, tables
from cadastra.functions import text as tx
from cadastra.operators import chains, graph, labels, link, network, overlay, parcels, quadtree, redistribute, relational, separator, simplify, smooth, spatial, town
from cadastra.plans.derive import CELLS, CROWD, EDGES, GEOCODES, LINES, LINK, POINTS, REGISTRY, TOWNS, ZONES, Tables, plain
from cadastra.session import dealt, materialize, scratch_dir
from cadastra.sources import readers, sinks

REGISTERED: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def add(f):
        REGISTERED[f.__name__] = (f, sql)
        return f

    return add


def registry(t: Tables) -> DataFrame:
    return t.sql(REGISTRY)


def geocodes(t: Tables) -> DataFrame:
    return t.sql(GEOCODES)


def points(t: Tables) -> DataFrame:
    return t.sql(POINTS).select("pid", g.point(F.col("x"), F.col("y")).alias("pt"), "label")


def cells(t: Tables) -> DataFrame:
    return t.sql(CELLS).select("cell", g.rectangle(F.col("x0"), F.col("y0"), F.col("x0") + 5, F.col("y0") + 5).alias("poly"))


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- linkage
@query(LINK + "SELECT rid, gid FROM p1")
def link_exact_null_safe(t):
    return link.exact(registry(t), geocodes(t)).where("gid IS NOT NULL").select("rid", "gid")


@query(LINK.replace("r.number IS NOT DISTINCT FROM g.number", "r.number = g.number") + "SELECT rid, gid FROM p1")
def link_exact_nulls_apart(t):
    return link.exact(registry(t), geocodes(t), null_matches=False).where("gid IS NOT NULL").select("rid", "gid")


@query(LINK + "SELECT rid, gid FROM p2")
def link_range_overlap(t):
    return link.by_range(link.exact_split(registry(t), geocodes(t))[1], geocodes(t))[0].select("rid", "gid")


@query(LINK + "SELECT rid, gid FROM p3")
def link_range_no_letter(t):
    rest = link.by_range(link.exact_split(registry(t), geocodes(t))[1], geocodes(t))[1]
    return link.by_range(rest, geocodes(t), letters=False)[0].select("rid", "gid")


@query(LINK + "SELECT rid, number FROM r3")
def link_residual_anti(t):
    return link.by_range(link.exact_split(registry(t), geocodes(t))[1], geocodes(t))[1].select("rid", "number")


@query(LINK + "SELECT rid, number FROM reg WHERE rid NOT IN (SELECT rid FROM p1) AND rid NOT IN (SELECT rid FROM able_reg)")
def link_unparsed(t):
    return link.by_range(link.exact_split(registry(t), geocodes(t))[1], geocodes(t))[2].select("rid", "number")


@query(LINK + "SELECT l.rid, l.gid, l.pass, r.town, r.district, r.street, r.number, g.number AS number_geo FROM linked l JOIN reg r USING (rid) JOIN geo g USING (gid)")
def link_cascade_union(t):
    return link.cascade(registry(t), geocodes(t)).select("rid", "gid", "pass", "town", "district", "street", "number", "number_geo")


@query(LINK + "SELECT count(DISTINCT l.rid) AS matched, count(DISTINCT r.rid) AS registry_rows, round(count(DISTINCT l.rid) * 100 / count(DISTINCT r.rid), 6) AS percent FROM reg r LEFT JOIN linked l ON r.rid = l.rid")
def link_coverage(t):
    return link.coverage(link.cascade(registry(t), geocodes(t)), registry(t))


_FOLD_REG = "SELECT c_custkey AS rid, concat(CASE c_custkey % 3 WHEN 0 THEN 'Árvíz u.' WHEN 1 THEN ' ŐRZŐ   út.' ELSE 'Fő utca' END, '') AS street, concat(CAST(c_custkey % 1000 AS STRING), CASE WHEN c_custkey % 2 = 0 THEN '.0' ELSE '' END) AS number FROM {customer}"
_FOLD_GEO = "SELECT s_suppkey AS gid, CASE s_suppkey % 3 WHEN 0 THEN 'arviz utca' WHEN 1 THEN 'orzo  ut' ELSE 'Fo Utca' END AS street, CAST(s_suppkey % 1000 AS STRING) AS number FROM {supplier}"


@query(
    f"""WITH r AS ({plain(_FOLD_REG)}), g AS ({plain(_FOLD_GEO)}),
    rk AS (SELECT rid, strip_accents(CASE rid % 3 WHEN 0 THEN 'árvíz utca' WHEN 1 THEN 'őrző út' ELSE 'fő utca' END) AS k, regexp_replace(number, '\\.0$', '') AS n FROM r),
    gk AS (SELECT gid, regexp_replace(lower(street), ' +', ' ', 'g') AS k, number AS n FROM g)
    SELECT rid, gid, k AS street_key, n AS number_key FROM rk JOIN gk USING (k, n)"""
)
def link_ascii_folded(t):
    return link.folded(t.sql(_FOLD_REG), t.sql(_FOLD_GEO)).select("rid", "gid", "street_key", "number_key")


@query("SELECT c_custkey, n_name AS town, coalesce(r_name, n_name) AS town_full FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey < 3")
def town_map_coalesce(t):
    names = t.sql("SELECT n_name AS src, r_name AS dst FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE r_regionkey < 3")
    rows = t.sql("SELECT c_custkey, n_name AS town FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey")
    return link.map_towns(rows, names)


# ---------------------------------------------------------------- address text
_STREETS = "SELECT p_partkey AS id, concat(CASE p_partkey % 8 WHEN 0 THEN 'Fo u.' WHEN 1 THEN 'Terez  krt.' WHEN 2 THEN 'Petofi stny' WHEN 3 THEN ' Duna RKP. ' WHEN 4 THEN 'hrsz' WHEN 5 THEN 'Main st.' WHEN 6 THEN 'Sun Blvd' ELSE 'Lake ave. u' END, CASE WHEN p_partkey % 3 = 0 THEN ' u' ELSE '' END) AS s FROM {part}"


def _nested(column: str, steps: list[tuple[str, str]], flags: str = "gi") -> str:
    for pattern, full in steps:
        column = f"regexp_replace({column}, '{pattern}', '{full}', '{flags}')"
    return column


_STREET_SQL = _nested("s", [(rf"\b{a}{'' if a in tx.DOTLESS else chr(92) + '.?'}\b", b) for a, b in tx.STREET_WORDS])


@query(f"SELECT id, rtrim(trim(regexp_replace({_STREET_SQL}, '\\s+', ' ', 'g')), '.') AS street FROM ({plain(_STREETS)})")
def street_abbrev(t):
    return t.sql(_STREETS).select("id", tx.expand_street(F.col("s")).alias("street"))


_HOUSES = "SELECT o_orderkey AS id, concat(CAST(1 + o_orderkey % 50 AS STRING), CASE o_orderkey % 7 WHEN 0 THEN '-B epulet 2' WHEN 1 THEN '/A' WHEN 2 THEN '-114' WHEN 3 THEN 'a' WHEN 4 THEN '/b lh. 3' WHEN 5 THEN ' - 3 building' ELSE '' END) AS s FROM {orders}"


@query(
    f"""SELECT id, upper(trim(regexp_replace(regexp_replace(replace(replace(regexp_replace(replace(regexp_replace(trim(s), '\\s*(epulet|lh\\.?|building)\\b.*$', '', 'i'), '/', ' '),
    '([0-9])-([0-9])', '\\1#\\2', 'g'), '-', ' '), '#', '-'), '([0-9])([A-Za-z])', '\\1 \\2', 'g'), '\\s+', ' ', 'g'))) AS number FROM ({plain(_HOUSES)})"""
)
def house_number_std(t):
    return t.sql(_HOUSES).select("id", tx.standard_number(F.col("s")).alias("number"))


_REPAIRS = "SELECT o_orderkey AS id, concat('00', CAST(o_orderkey % 90 AS STRING), CASE o_orderkey % 6 WHEN 0 THEN '/B A' WHEN 1 THEN ' A B' WHEN 2 THEN '-004D D' WHEN 3 THEN ' {=bldg. C' WHEN 4 THEN ' <block> 07' ELSE '' END) AS s FROM orders_"


@query(
    r"""SELECT id, regexp_replace(regexp_replace(regexp_replace(
      trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '[{=}<>]', ' ', 'g'), '\b(building|bldg\.?|block)\b', ' ', 'gi'), '\s+', ' ', 'g'), '(^|[^0-9])0+([0-9])', '\1\2', 'g'), '\s+', ' ', 'g')),
      '(\b\d+/\w)\s+[A-Z]\b', '\1', 'g'), '(\b\d+\s+[A-Z])\s+[A-Z]\b', '\1', 'g'), '(\b\d+-\d+[A-Z])\s+[A-Z]\b', '\1', 'g') AS number FROM ("""
    + _REPAIRS.replace("orders_", "orders")
    + ")"
)
def number_repair(t):
    tail = F.element_at(F.array(*(F.lit(x) for x in ("/B A", " A B", "-004D D", " {=bldg. C", " <block> 07", ""))), (F.col("o_orderkey") % 6 + 1).cast("int"))
    raw = t.read("orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("00"), (F.col("o_orderkey") % 90).cast("string"), tail).alias("s"))
    return raw.select("id", tx.repair_number(F.col("s")).alias("number"))


_SPLITS = "SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN concat('Fo utca ', CAST(c_custkey % 30 AS STRING), '/A') WHEN 1 THEN concat(CAST(c_custkey % 30 AS STRING), ' Fo ut 7') WHEN 2 THEN 'Fo utca' WHEN 3 THEN concat('Fo 3 ut  ', CAST(c_custkey % 9 AS STRING)) ELSE NULL END AS s FROM {customer}"


@query(f"SELECT id, CASE WHEN regexp_matches(s, '[0-9]') THEN trim(regexp_extract(s, '^([^0-9]*)([0-9].*)$', 1)) END AS street, CASE WHEN regexp_matches(s, '[0-9]') THEN trim(regexp_extract(s, '^([^0-9]*)([0-9].*)$', 2)) END AS number FROM ({plain(_SPLITS)})")
def split_street_number(t):
    a, b = tx.split_at_digit(F.col("s"))
    return t.sql(_SPLITS).select("id", a.alias("street"), b.alias("number"))


@query(f"SELECT id, trim(regexp_extract(s, '^(.*?)(?:\\s+(\\d+\\S*))?$', 1)) AS street, nullif(regexp_extract(s, '^(.*?)(?:\\s+(\\d+\\S*))?$', 2), '') AS number FROM ({plain(_SPLITS)}) WHERE s IS NOT NULL")
def split_last_number(t):
    a, b = tx.split_last_number(F.col("s"))
    return t.sql(_SPLITS).where("s IS NOT NULL").select("id", a.alias("street"), b.alias("number"))


_MISPLACED = "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '  ' ELSE 'Fo utca' END AS street, CASE c_custkey % 4 WHEN 0 THEN '012 hrsz' WHEN 1 THEN '7' WHEN 2 THEN NULL ELSE ' ' END AS number FROM {customer}"


@query(
    f"""WITH r AS ({plain(_MISPLACED)}), a AS (SELECT id, CASE WHEN number LIKE '%hrsz%' THEN number ELSE street END AS street, CASE WHEN number LIKE '%hrsz%' THEN NULL ELSE number END AS number FROM r),
    b AS (SELECT *, trim(coalesce(street, '')) = '' AND trim(coalesce(number, '')) <> '' AS alone FROM a)
    SELECT id, CASE WHEN alone THEN number ELSE street END AS street, CASE WHEN NOT alone THEN number END AS number FROM b"""
)
def number_moves_to_street(t):
    a, b = tx.move_misplaced(F.col("street"), F.col("number"))
    return t.sql(_MISPLACED).select("id", a.alias("street"), b.alias("number"))


@query(LINK + "SELECT rid, lo, hi, letter FROM able_reg")
def house_number_parse(t):
    return registry(t).select("rid", tx.parse_house(F.col("number")).alias("h")).where("h IS NOT NULL").select("rid", "h.lo", "h.hi", "h.letter")


@query("SELECT doc_id, coalesce(regexp_matches(text, '\\p{L}') AND regexp_matches(text, '\\p{Nd}'), false) AS mixed FROM documents")
def letter_and_digit(t):
    return t.read("documents").select("doc_id", tx.letter_and_digit(F.col("text")).alias("mixed"))


_NAMES = "SELECT n_nationkey AS id, CASE n_nationkey % 3 WHEN 0 THEN array(' ', n_name) WHEN 1 THEN array(' ') ELSE NULL END AS names FROM {nation}"


@query("SELECT n_nationkey AS id, CASE WHEN n_nationkey % 3 = 0 AND trim(n_name) <> '' THEN 'white' ELSE 'red' END AS colour FROM nation")
def edge_colour(t):
    return t.sql(_NAMES).select("id", tx.edge_colour(F.col("names")).alias("colour"))


# ---------------------------------------------------------------- readers
_ADDRESS = "concat('Fo utca ', CAST(event_id % 90 AS STRING))"
_LINES = f"""SELECT event_id, CASE event_id % 6
  WHEN 0 THEN concat('[', CAST(event_id AS STRING), ',"', {_ADDRESS}, '","Vac","1234 Hungary",47.5,19.0]')
  WHEN 1 THEN concat('[', CAST(event_id AS STRING), ',"Firm","Vac","', {_ADDRESS}, '","2345 Hungary",47.25,18.5]')
  WHEN 2 THEN concat('[', CAST(event_id AS STRING), ',"a","b",null,"Vac","', {_ADDRESS}, '","3456 Hungary",46.5,20.5]')
  WHEN 3 THEN concat('[', CAST(event_id AS STRING), ',"', {_ADDRESS}, '","Vac","12a4 Hungary",47.5,19.0]')
  WHEN 4 THEN concat('[', CAST(event_id AS STRING), ',"nodigits","Vac","1234 Hungary",47.5,19.0]')
  ELSE '[1,2,3]' END AS value FROM {{events}}"""


@query(
    f"""SELECT event_id AS gid, {_ADDRESS} AS cim, 'Vac' AS telepules, CASE event_id % 6 WHEN 0 THEN 1234 WHEN 1 THEN 2345 ELSE 3456 END::BIGINT AS iszam, 'Hungary' AS orszag,
    CASE event_id % 6 WHEN 0 THEN 47.5 WHEN 1 THEN 47.25 ELSE 46.5 END::DOUBLE AS lat, CASE event_id % 6 WHEN 0 THEN 19.0 WHEN 1 THEN 18.5 ELSE 20.5 END::DOUBLE AS lon
    FROM events WHERE event_id % 6 < 3"""
)
def ragged_array_reader(t):
    return readers.ragged_geocodes(t.sql(_LINES))


@query("SELECT count(*) AS rows_read, count(*) FILTER (WHERE event_id % 6 < 3) AS rows_used, round(count(*) FILTER (WHERE event_id % 6 < 3) * 100 / count(*), 6) AS percent FROM events")
def reader_yield(t):
    return readers.repair_yield(t.sql(_LINES))


_REGISTRY_ROWS = """SELECT c_custkey, CAST(c_custkey % 7 AS BIGINT) AS szavazokorid, CASE WHEN c_custkey % 11 <> 5 THEN CAST(floor(CAST(c_custkey AS DOUBLE) / 12) AS BIGINT) END AS kozteruletid, CAST(9 AS BIGINT) AS kozteruletnevid,
  CASE WHEN c_custkey % 13 = 4 THEN NULL WHEN c_custkey % 24 < 12 THEN 'Fo u.' ELSE 'Duna krt.' END AS kozteruletnev,
  CASE c_custkey % 6 WHEN 0 THEN '0012' WHEN 1 THEN '0' WHEN 2 THEN '7/A' WHEN 3 THEN NULL WHEN 4 THEN '7/A' ELSE '15' END AS utcacim,
  CASE WHEN c_custkey % 17 <> 6 THEN CAST(c_nationkey % 5 AS BIGINT) END AS telepulesid,
  CASE WHEN c_custkey % 19 = 3 THEN NULL WHEN c_custkey % 2 = 0 THEN concat('Town ', CAST(c_nationkey % 5 AS STRING)) ELSE concat('Stadt ', CAST(c_nationkey % 5 AS STRING)) END AS telepulesnev,
  c_custkey AS eventfromid, CASE c_custkey % 3 WHEN 0 THEN '2014-04-06' WHEN 1 THEN '2022-04-03' ELSE '2018-04-08' END AS date FROM {customer}"""
_TOWN_NAMES = "SELECT DISTINCT concat('Stadt ', CAST(n_regionkey AS STRING)) AS src, concat('Town ', CAST(n_regionkey AS STRING)) AS dst FROM {nation}"
_CLEANED = f"""WITH f AS (SELECT * FROM ({plain(_REGISTRY_ROWS)}) WHERE telepulesid IS NOT NULL AND kozteruletid IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY szavazokorid, kozteruletid, kozteruletnevid, kozteruletnev, utcacim, telepulesid, date ORDER BY c_custkey) = 1),
    a AS (SELECT *, CASE utcacim WHEN '0012' THEN '12' ELSE utcacim END AS number FROM f WHERE date IN ('2014-04-06', '2022-04-03') AND utcacim IS DISTINCT FROM '0')
    SELECT DISTINCT szavazokorid, kozteruletid, kozteruletnevid, CASE WHEN kozteruletnev IS NULL THEN number ELSE replace(replace(kozteruletnev, 'u.', 'utca'), 'krt.', 'körút') END AS utca,
      CASE WHEN kozteruletnev IS NULL THEN NULL ELSE replace(number, '/', ' ') END AS cim, telepulesid, telepulesnev, coalesce(dst, telepulesnev) AS telepulesnev_hu, eventfromid, date
    FROM a LEFT JOIN ({plain(_TOWN_NAMES)}) ON telepulesnev = src"""


@query(_CLEANED)
def clean_registry(t):
    """Two names for one town, null ids, streets and town names, years without addresses, and repeated rows."""
    return readers.clean_registry(t.sql(_REGISTRY_ROWS).withColumnRenamed("c_custkey", "_row"), t.sql(_TOWN_NAMES))


@query(_CLEANED)
def clean_registry_csv(t):
    """The same from CSV files with a header, their rows in order of the files."""
    path = f"{scratch_dir(t.spark)}/registry-{uuid.uuid4().hex}"
    t.sql(_REGISTRY_ROWS).repartitionByRange(4, "c_custkey").sortWithinPartitions("c_custkey").drop("c_custkey").write.option("header", True).csv(path)
    return readers.clean_registry(readers.registry_csv(t.spark, path), t.sql(_TOWN_NAMES))


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def registry_parquet(t):
    """A registry table read without wholly equal rows."""
    path = f"{scratch_dir(t.spark)}/registry-{uuid.uuid4().hex}"
    t.read("customer").select("c_nationkey", "c_mktsegment").write.parquet(path)
    return readers.registry_parquet(t.spark, path)


@query(
    f"""SELECT event_id AS gid, 'Fo utca' AS utca, CAST(event_id % 90 AS VARCHAR) AS cim, 'Vac' AS telepules, CASE event_id % 6 WHEN 0 THEN 1234 WHEN 1 THEN 2345 ELSE 3456 END::BIGINT AS iszam, 'Hungary' AS orszag,
    CASE event_id % 6 WHEN 0 THEN 47.5 WHEN 1 THEN 47.25 ELSE 46.5 END::DOUBLE AS lat, CASE event_id % 6 WHEN 0 THEN 19.0 WHEN 1 THEN 18.5 ELSE 20.5 END::DOUBLE AS lon FROM events WHERE event_id % 6 < 3"""
)
def clean_geocodes(t):
    """JSON lines appended to a folder and read back as typed geocodes."""
    path = f"{scratch_dir(t.spark)}/lines-{uuid.uuid4().hex}"
    t.sql(_LINES).select("value").write.text(path)
    return readers.clean_geocodes(readers.json_lines(t.spark, path)).select("gid", "utca", "cim", "telepules", "iszam", "orszag", F.col("pt.y").alias("lat"), F.col("pt.x").alias("lon"))


@query("SELECT CAST(event_id + 1000 AS VARCHAR) AS geoid, 'Fo utca' AS cim, 'Vac' AS telepules, CASE WHEN event_id % 2 = 0 THEN 47.5 ELSE 46.0 END::DOUBLE AS lat, CASE WHEN event_id % 2 = 0 THEN 19.25 ELSE 20.0 END::DOUBLE AS lon FROM events")
def positional_geocodes(t):
    """The first-generation view; every second row has its coordinates in the wrong places."""
    rows = "SELECT concat('[', CAST(event_id + 1000 AS STRING), ',\"Fo utca\",\"Vac\",', CASE WHEN event_id % 2 = 0 THEN '1,2,47.5,19.25]' ELSE '46.0,20.0,1,2]' END) AS value FROM {events}"
    return readers.positional_geocodes(t.sql(rows))


_ANSWERS = "SELECT n_name AS src, CASE WHEN n_nationkey % 3 = 0 THEN concat('City ', n_name) END AS city, CASE WHEN n_nationkey % 3 = 1 THEN concat('Town ', n_name) END AS town, CAST(NULL AS STRING) AS village, CASE WHEN n_nationkey % 3 < 2 THEN 'M' END AS municipality, CAST(NULL AS STRING) AS river FROM {nation}"


@query(f"SELECT src, coalesce(city, town, village, municipality, river, src) AS dst FROM ({plain(_ANSWERS)})")
def place_lookup(t):
    """Recorded place lookups, written as a name map and read again."""
    path = f"{scratch_dir(t.spark)}/names-{uuid.uuid4().hex}"
    sinks.write_names(readers.lookup_towns(t.sql(_ANSWERS)), path)
    return readers.town_names(t.spark, path)


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def append_json_lines(t):
    """Rows appended as JSON lines in two runs, and read again."""
    path = f"{scratch_dir(t.spark)}/json-{uuid.uuid4().hex}"
    rows = t.read("orders").select("o_orderkey", "o_orderpriority")
    for part in (rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus <> 'F' OR o_orderstatus IS NULL")):
        sinks.append_json_lines(part, path)
    return t.spark.read.schema("o_orderkey bigint, o_orderpriority string").json(path)


@query("SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey = 7")
def town_partition(t):
    """A table with a folder a town, of which one is read."""
    path = f"{scratch_dir(t.spark)}/towns-{uuid.uuid4().hex}"
    sinks.write_by_town(t.read("customer").select("c_custkey", "c_name", "c_nationkey"), path, "c_nationkey")
    return t.spark.read.parquet(path).where("c_nationkey = 7")


@query("SELECT c_custkey, c_acctbal FROM customer")
def columns_by_pattern(t):
    """Columns whose names hold a part are dropped."""
    return relational.without_pattern(relational.without_pattern(t.read("customer"), "nation").drop("c_name"), "segment")


_CELLS = "SELECT event_id, CAST(event_id % 60 AS DOUBLE) AS c0, CAST(event_id % 25 AS DOUBLE) AS lon, CAST(event_id % 53 AS DOUBLE) AS lat FROM {events}"


@query(
    f"""WITH r AS (SELECT *, lat BETWEEN 45 AND 49 AS glat, lon BETWEEN 16 AND 23 AS glon FROM ({plain(_CELLS)})),
    a AS (SELECT *, CASE WHEN c0 BETWEEN 45 AND 49 THEN 0 WHEN lat BETWEEN 45 AND 49 THEN 1 WHEN lon BETWEEN 45 AND 49 THEN 2 END AS li FROM r),
    b AS (SELECT *, CASE WHEN c0 BETWEEN 16 AND 23 AND (glat OR li IS NULL OR li <> 0) THEN 0 WHEN lat BETWEEN 16 AND 23 AND (glat OR li IS NULL OR li <> 1) THEN 1 WHEN lon BETWEEN 16 AND 23 AND (glat OR li IS NULL OR li <> 2) THEN 2 END AS oi FROM a)
    SELECT event_id, CASE WHEN glat THEN lat ELSE CASE li WHEN 0 THEN c0 WHEN 1 THEN lat WHEN 2 THEN lon END END AS lat,
      CASE WHEN glon THEN lon ELSE CASE oi WHEN 0 THEN c0 WHEN 1 THEN lat WHEN 2 THEN lon END END AS lon FROM b"""
)
def coord_repair(t):
    row = F.array(*(F.col(c).cast("string") for c in ("c0", "lat", "lon")))
    return t.sql(_CELLS).select("event_id", tx.repair_coordinates(row, F.col("lat"), F.col("lon")).alias("at")).select("event_id", "at.lat", "at.lon")


_COERCE = "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN concat(CAST(event_id AS STRING), 'x') ELSE CAST(event_id AS STRING) END AS s FROM {events}"


@query(f"SELECT event_id, TRY_CAST(s AS BIGINT) AS n FROM ({plain(_COERCE)})")
def typed_scan_coerce(t):
    return t.sql(_COERCE).select("event_id", F.col("s").try_cast("bigint").alias("n"))


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def registry_distinct(t):
    return t.read("customer").select("c_nationkey", "c_mktsegment").distinct()


# ---------------------------------------------------------------- relational rules
@query("SELECT o_custkey, o_orderstatus, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1")
def dedup_keep_first(t):
    rows = t.read("orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderpriority")
    return relational.keep_first(rows, ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@query(f"SELECT rid, number FROM ({plain(REGISTRY)}) WHERE number IS DISTINCT FROM '8'")
def filter_keep_nulls(t):
    return registry(t).where(relational.differs(F.col("number"), "8")).select("rid", "number")


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) IN ('1995-01-01', '1995-01-02', '1996-06-30', '1997-12-24')")
def date_isin(t):
    day = F.col("o_orderdate").cast("date").cast("string")
    return t.read("orders").where(day.isin("1995-01-01", "1995-01-02", "1996-06-30", "1997-12-24")).select("o_orderkey", day.alias("day"))


@query(r"SELECT doc_id FROM documents WHERE NOT coalesce(regexp_matches(text, '[a-z]\.\z'), false)")
def regex_not_match(t):
    return t.read("documents").where(relational.not_matching(F.col("text"), r"[a-z]\.\z")).select("doc_id")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000")
def expression_filter(t):
    return t.spark.sql("SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = :status AND o_totalprice > :least", args={"status": "F", "least": 200000}, orders=t.read("orders"))


@query("SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderpriority ASC NULLS LAST, o_orderkey LIMIT 20")
def top_n_sorted(t):
    return t.read("orders").select("o_orderkey", "o_orderpriority").orderBy(F.asc_nulls_last("o_orderpriority"), "o_orderkey").limit(20)


@query(f"SELECT count(number) AS numbered, count(*) AS all_rows FROM ({plain(REGISTRY)})")
def not_null_count(t):
    return registry(t).agg(F.count("number").alias("numbered"), F.count(F.lit(1)).alias("all_rows"))


@query("SELECT quality, count(*) AS n, min(source) AS first_source FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality")
def group_null_label(t):
    joined = t.read("documents").select("doc_id", "source").join(t.read("labels"), "doc_id", "left")
    return joined.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.min("source").alias("first_source"))


@query("WITH k AS (SELECT c_nationkey, c_mktsegment, count(*) AS votes FROM customer GROUP BY ALL) SELECT c_nationkey, c_mktsegment, votes FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY votes DESC, c_mktsegment) AS rn FROM k) WHERE rn = 1")
def majority_label(t):
    return relational.majority(t.read("customer").select("c_nationkey", "c_mktsegment"), ["c_nationkey"], "c_mktsegment")


# ---------------------------------------------------------------- spatial
_IN = f"WITH p AS ({plain(POINTS)}), c AS ({plain(CELLS)}), hit AS (SELECT cell, pid, label FROM p JOIN c ON x > x0 AND x < x0 + 5 AND y > y0 AND y < y0 + 5)"
_LABELS = _IN + ", lab AS (SELECT cell, count(pid) AS n_points, count(DISTINCT label) AS n_labels, CASE WHEN count(DISTINCT label) = 1 THEN min(label) END AS label FROM c LEFT JOIN hit USING (cell) GROUP BY cell)"


@query(_IN + "SELECT cell, pid, label FROM hit")
def points_in_cells(t):
    return spatial.points_in_polygons(points(t), cells(t), 5.0).select("cell", "pid", "label")


@query(_LABELS + "SELECT * FROM lab")
def cell_label_distinct(t):
    return labels.label_counts(points(t), cells(t), "cell", "label", 5.0)


@query(_IN + "SELECT cell, count(pid) AS n, min(pid) AS first_point, max(pid) AS last_point FROM c LEFT JOIN hit USING (cell) GROUP BY cell")
def points_listed(t):
    inside = spatial.points_in_polygons(points(t), cells(t), 5.0, how="left")
    return inside.groupBy("cell").agg(F.count("pid").alias("n"), F.min("pid").alias("first_point"), F.max("pid").alias("last_point"))


_IN_TOWN = "x > 12.5 AND x < 487.5 AND y > 50 * town + 2.5 AND y < 50 * town + 47.5 AND NOT (x >= 100 AND x <= 200 AND y >= 50 * town + 10 AND y <= 50 * town + 20)"


def _towns(t):
    """Boundaries of towns: ten rows of cells less a rim, with a hole."""
    y = F.col("town") * 50.0
    shell, hole = (g.rectangle(F.lit(x0), y + y0, F.lit(x1), y + y1) for x0, y0, x1, y1 in ((12.5, 2.5, 487.5, 47.5), (100.0, 10.0, 200.0, 20.0)))
    return t.sql(TOWNS).select("town", F.concat(shell, hole).alias("poly"))


@query(f"SELECT pid, town FROM ({plain(POINTS)}) JOIN ({plain(TOWNS)}) ON {_IN_TOWN}")
def points_in_town(t):
    return spatial.points_in_polygons(points(t), _towns(t), 50.0).select("pid", "town")


@query(f"SELECT pid FROM ({plain(POINTS)}), (SELECT 1::BIGINT AS town) WHERE {_IN_TOWN}")
def points_in_named_town(t):
    town = _towns(t).where("town = 1")
    return spatial.points_in_polygons(points(t), town, 50.0).select("pid")


@query(
    f"""SELECT zone, pid FROM ({plain(CROWD)}) p JOIN ({plain(ZONES)}) z ON CASE kind WHEN 'strip' THEN y > y0 AND y < y0 + 64 AND x > x0 + (y - y0) AND x < x0 + 1 + (y - y0)
    WHEN 'wide' THEN x > x0 AND x < x0 + 256 AND y > y0 AND y < y0 + 32 ELSE x > x0 AND x < x0 + side AND y > y0 AND y < y0 + side END"""
)
def points_in_zones(t):
    """Zones of all sizes and crowded points, over a quadtree that follows the points."""
    x, y, e = F.col("x0"), F.col("y0"), F.col("side")
    strip = F.array(F.array(g.point(x, y), g.point(x + 1, y), g.point(x + 65, y + 64), g.point(x + 64, y + 64), g.point(x, y)))
    poly = F.when(F.col("kind") == "strip", strip).when(F.col("kind") == "wide", g.rectangle(x, y, x + 256, y + 32)).otherwise(g.rectangle(x, y, x + e, y + e))
    zones = t.sql(ZONES).select("zone", poly.alias("poly"))
    crowd = t.sql(CROWD).select("pid", g.point(F.col("x"), F.col("y")).alias("pt"))
    return quadtree.points_in_polygons(crowd, zones, 512.0, depth=9).select("zone", "pid")


def _shapes(t):
    """Triangles for odd keys, else squares, every second of these with a hole off its centre."""
    x, y, k = F.col("x0"), F.col("y0"), F.col("cell")
    triangle = F.array(F.array(g.point(x, y), g.point(x + 5, y), g.point(x, y + 5), g.point(x, y)))
    square, hole = g.rectangle(x, y, x + 5, y + 5), g.rectangle(x + 1, y + 1, x + 2, y + 2)
    poly = F.when(k % 2 == 1, triangle).when(k % 4 == 2, F.concat(square, hole)).otherwise(square)
    return t.sql(CELLS).select("cell", poly.alias("poly"), F.when(k % 2 == 1, "triangle").when(k % 4 == 2, "ring").otherwise("square").alias("kind"))


_SHAPES = f"SELECT *, CASE WHEN cell % 2 = 1 THEN 'triangle' WHEN cell % 4 = 2 THEN 'ring' ELSE 'square' END AS kind FROM ({plain(CELLS)})"
_AREA = "CASE kind WHEN 'triangle' THEN 12.5 WHEN 'ring' THEN 24 ELSE 25 END"


@query(
    f"""SELECT cell, ({_AREA})::DOUBLE AS area, round(CASE kind WHEN 'triangle' THEN 10 + sqrt(50) ELSE 20 END, 6) AS perimeter,
    round(x0 + CASE kind WHEN 'triangle' THEN 5 / 3.0 WHEN 'ring' THEN 61 / 24.0 ELSE 2.5 END, 6) AS cx, round(y0 + CASE kind WHEN 'triangle' THEN 5 / 3.0 WHEN 'ring' THEN 61 / 24.0 ELSE 2.5 END, 6) AS cy, x0 + 5 AS xmax, y0 AS ymin FROM ({_SHAPES})"""
)
def polygon_measures(t):
    ring = F.get("poly", 0)
    c, b = g.centroid(F.col("poly")), g.bounds(ring)
    return _shapes(t).select("cell", r6(g.area(F.col("poly"))).alias("area"), r6(g.length(ring)).alias("perimeter"), r6(c["x"]).alias("cx"), r6(c["y"]).alias("cy"), b["xmax"].alias("xmax"), b["ymin"].alias("ymin"))


@query(f"SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM ({plain(POINTS)})")
def total_bounds(t):
    return points(t).agg(F.min("pt.x").alias("xmin"), F.min("pt.y").alias("ymin"), F.max("pt.x").alias("xmax"), F.max("pt.y").alias("ymax"))


@query(f"SELECT round(min({_AREA})::DOUBLE, 6) AS least, round(sum({_AREA})::DOUBLE, 4) AS total, count(*) FILTER (WHERE kind = 'triangle') AS small FROM ({_SHAPES})")
def area_summary(t):
    a = g.area(F.col("poly"))
    return _shapes(t).agg(r6(F.min(a)).alias("least"), F.round(F.sum(a), 4).alias("total"), F.count_if(a < 20).alias("small"))


@query(f"SELECT cell, true AS inside FROM ({_SHAPES})")
def interior_points(t):
    return _shapes(t).select("cell", g.within(g.interior_point(F.col("poly")), F.col("poly")).alias("inside"))


_NEAR = _LABELS + ", near AS (SELECT a.cell, b.cell AS other FROM c a JOIN c b ON a.cell <> b.cell AND abs(a.x0 - b.x0) <= 5 AND abs(a.y0 - b.y0) <= 5)"


def _labelled(t):
    return dealt(cells(t)).join(labels.label_counts(points(t), cells(t), "cell", "label", 5.0).select("cell", "label"), "cell")


@query(
    _NEAR
    + """, votes AS (SELECT n.cell, l.label, count(*) AS v FROM near n JOIN lab e ON e.cell = n.cell AND e.label IS NULL JOIN lab l ON l.cell = n.other AND l.label IS NOT NULL GROUP BY ALL),
    best AS (SELECT cell, label FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY v DESC, label) AS rn FROM votes) WHERE rn = 1)
    SELECT lab.cell, coalesce(lab.label, best.label) AS label FROM lab LEFT JOIN best USING (cell)"""
)
def majority_neighbor_fill(t):
    return labels.vote_once(_labelled(t), spatial.touching(cells(t), "cell"), "cell", "label").select("cell", "label")


@query(_NEAR + "SELECT a.cell, b.cell AS other, 5.0::DOUBLE AS shared FROM c a JOIN c b ON abs(a.x0 - b.x0) + abs(a.y0 - b.y0) = 5")
def neighbor_shared_length(t):
    return spatial.shared_borders(cells(t), "cell")


@query(_NEAR + "SELECT n.cell, n.other, a.label AS label_a, b.label AS label_b FROM near n JOIN lab a ON a.cell = n.cell JOIN lab b ON b.cell = n.other WHERE n.cell < n.other AND a.label <> b.label")
def pairs_differing_label(t):
    return spatial.differing_neighbours(_labelled(t), "cell", "label")


@query(f"WITH e AS (SELECT DISTINCT least(u, v) AS a, greatest(u, v) AS b, key FROM ({plain(EDGES)})) SELECT node, count(*) AS degree FROM (SELECT a AS node FROM e UNION ALL SELECT b FROM e) GROUP BY node")
def node_degrees(t):
    return graph.degrees(t.sql(EDGES))


@query(f"WITH e AS (SELECT DISTINCT least(u, v) AS a, greatest(u, v) AS b, key FROM ({plain(EDGES)})) SELECT node FROM (SELECT a AS node FROM e UNION ALL SELECT b FROM e) GROUP BY node HAVING count(*) = 1")
def dead_end_degree(t):
    return graph.dead_ends(t.sql(EDGES))


@query(
    f"""WITH e AS ({plain(EDGES)}), ends AS (SELECT u AS node, 0 AS pref, u, v, key FROM e UNION ALL SELECT v, 1, u, v, key FROM e)
    SELECT node, u, v, key FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY pref, u, v, key) AS rn FROM ends) WHERE rn = 1"""
)
def first_incident_edge(t):
    e = t.sql(EDGES)
    nodes = e.select(F.col("u").alias("node")).union(e.select("v")).distinct()
    return graph.first_incident(nodes, e)


@query(
    f"""WITH p AS ({plain(POINTS)}), b AS ({plain(CELLS)}),
    feet AS (SELECT pid, x, y, greatest(x0, least(x0 + 5, x)) AS fx, y0 AS fy FROM p JOIN b ON x BETWEEN x0 - 2 AND x0 + 7 AND y BETWEEN y0 - 2 AND y0 + 2),
    d AS (SELECT *, sqrt((x - fx) * (x - fx) + (y - fy) * (y - fy)) AS dist FROM feet)
    SELECT pid, round(min(dist), 6) AS dist, round(arg_min(fx, dist), 6) AS foot_x, arg_min(fy, dist) AS foot_y FROM d WHERE dist <= 2 GROUP BY pid HAVING min(dist) > 0.1"""
)
def nearest_foot_on_boundary(t):
    base = t.sql(CELLS).select(F.array(g.point(F.col("x0"), F.col("y0")), g.point(F.col("x0") + 5, F.col("y0"))).alias("line"))
    near = spatial.nearest_feet(points(t), base, "pid", 2.0, 0.1)
    return near.select("pid", r6("dist").alias("dist"), r6("foot.x").alias("foot_x"), F.col("foot.y").alias("foot_y"))


@query(
    f"""WITH p AS (SELECT *, pid % 2 = 0 AS up FROM ({plain(POINTS)})), b AS ({plain(CELLS)}),
    hit AS (SELECT pid, y0 - y AS s, x AS at_x, y0 AS at_y FROM p JOIN b ON up AND x BETWEEN x0 AND x0 + 5 AND y0 - y BETWEEN 0 AND 20
            UNION ALL SELECT pid, x0 - x, x0, y FROM p JOIN b ON NOT up AND y BETWEEN y0 AND y0 + 5 AND x0 - x BETWEEN 0 AND 20)
    SELECT pid, round(min(s), 6) AS s, round(arg_min(at_x, s), 6) AS at_x, round(arg_min(at_y, s), 6) AS at_y FROM hit WHERE s > 0.25 GROUP BY pid"""
)
def ray_first_hit(t):
    p = points(t)
    up = F.col("pid") % 2 == 0
    rays = p.select("pid", up.alias("flat"), F.col("pt").alias("p"), F.when(up, g.point(F.col("pt.x"), F.col("pt.y") + 20)).otherwise(g.point(F.col("pt.x") + 20, F.col("pt.y"))).alias("q"))
    c = t.sql(CELLS)
    x, y = F.col("x0"), F.col("y0")
    flat = c.select(F.lit(True).alias("flat"), F.array(g.point(x, y), g.point(x + 5, y)).alias("line"))
    tall = c.select(F.lit(False).alias("flat"), F.array(g.point(x, y), g.point(x, y + 5)).alias("line"))
    hits = spatial.first_hits(rays, flat.unionByName(tall), "pid", 5.0, 0.25, same=("flat",))
    return hits.select("pid", r6("s").alias("s"), r6("at.x").alias("at_x"), r6("at.y").alias("at_y"))


def _roads(t):
    """A level stretch of road, 8 units long, at each point."""
    return points(t).select("pid", F.array("pt", g.point(F.col("pt.x") + 8, F.col("pt.y"))).alias("line"))


@query(
    f"""WITH p AS ({plain(POINTS)}), c AS ({plain(CELLS)})
    SELECT cell, round(sum(least(x + 8, x0 + 5) - greatest(x, x0)), 4) AS inside FROM p JOIN c ON y > y0 AND y < y0 + 5 AND x < x0 + 5 AND x + 8 > x0 GROUP BY cell"""
)
def road_length_in_cells(t):
    return spatial.lines_inside(_roads(t), cells(t), 5.0).where("inside > 0").groupBy("cell").agg(F.round(F.sum("inside"), 4).alias("inside"))


@query(
    f"""WITH p AS ({plain(POINTS)}), c AS ({plain(CELLS)})
    SELECT cell FROM c WHERE EXISTS (SELECT 1 FROM p WHERE y > y0 AND y < y0 + 5 AND x < x0 + 5 AND x + 8 > x0)"""
)
def roads_in_area_semi(t):
    return spatial.polygons_with_roads(_roads(t), cells(t), 5.0).select("cell")


_TILES = f"WITH c AS (SELECT *, (floor(x0 / 35) + 20 * floor(y0 / 50))::BIGINT AS label FROM ({plain(CELLS)})), e AS (SELECT label, x0 AS x, y0 AS y, 'h' AS d FROM c UNION ALL SELECT label, x0, y0 + 5, 'h' FROM c UNION ALL SELECT label, x0, y0, 'v' FROM c UNION ALL SELECT label, x0 + 5, y0, 'v' FROM c)"


def _tiles(t):
    c = t.sql(CELLS)
    return c.select("cell", (F.floor(F.col("x0") / 35) + 20 * F.floor(F.col("y0") / 50)).alias("label"), g.rectangle(F.col("x0"), F.col("y0"), F.col("x0") + 5, F.col("y0") + 5).alias("poly"))


@query(_TILES + ", o AS (SELECT label, x, y, d FROM e GROUP BY ALL HAVING count(*) = 1) SELECT label, count(*) * 5.0::DOUBLE AS border FROM o GROUP BY label")
def dissolve_boundary_length(t):
    return parcels.outline(_tiles(t), "label").groupBy("label").agg(F.sum("len").alias("border"))


@query(_TILES + "SELECT label, count(*) * 25.0::DOUBLE AS area, 1::BIGINT AS parts FROM c GROUP BY label")
def dissolve_area(t):
    whole = parcels.dissolve(_tiles(t), "label", 35.0)
    return whole.groupBy("label").agg(F.round(F.sum(g.area(F.col("poly"))), 6).alias("area"), F.count(F.lit(1)).alias("parts"))


_POLYLINE = "SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS y FROM embeddings, range(64) r(i)"


@query(
    f"""WITH v AS ({_POLYLINE}), seg AS (SELECT a.vec_id, a.i, a.y AS y1, b.y AS y2 FROM v a JOIN v b ON a.vec_id = b.vec_id AND b.i = a.i + 1),
    pts AS (SELECT vec_id, 0 AS k, i * 1.0::DOUBLE AS x, y FROM v WHERE i = 0 UNION ALL SELECT vec_id, 1 + 2 * i, i + 0.25, 0.75 * y1 + 0.25 * y2 FROM seg
      UNION ALL SELECT vec_id, 2 + 2 * i, i + 0.75, 0.25 * y1 + 0.75 * y2 FROM seg UNION ALL SELECT vec_id, 127, 63.0, y FROM v WHERE i = 63)
    SELECT vec_id, k::BIGINT AS k, round(x, 6) AS x, round(y, 5) AS y FROM pts"""
)
def chaikin_smooth(t):
    pts = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: g.point(i, F.get("embedding", i)))
    smooth_line = t.read("embeddings").select("vec_id", F.posexplode(g.chaikin(pts, 1)).alias("k", "p"))
    return smooth_line.select("vec_id", F.col("k").cast("bigint").alias("k"), r6("p.x").alias("x"), F.round("p.y", 5).alias("y"))


@query(
    f"""SELECT layer, count(*) AS n FROM (SELECT 'points' AS layer FROM ({plain(POINTS)}) UNION ALL SELECT 'cells' FROM ({plain(CELLS)})) GROUP BY layer"""
)
def layers_stacked(t):
    layers = spatial.stack_layers(points=points(t).select("pid"), cells=cells(t).select("cell"))
    return layers.groupBy("layer").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH RECURSIVE f AS (SELECT n_regionkey AS label, min(n_nationkey) AS seen FROM nation GROUP BY 1), r AS (SELECT label, row_number() OVER (ORDER BY seen) - 1 AS i FROM f),
    hue(i, h) AS (SELECT 0, 0.618033988749895::DOUBLE % 1.0::DOUBLE UNION ALL SELECT i + 1, (h + 0.618033988749895::DOUBLE) % 1.0::DOUBLE FROM hue WHERE i < 60),
    hv AS (SELECT label, h, CASE WHEN r.i % 2 = 0 THEN 0.92 ELSE 0.8 END::DOUBLE AS v FROM r JOIN hue USING (i)),
    pq AS (SELECT label, v, floor(h * 6)::INT % 6 AS k, v * (1 - 0.6::DOUBLE) AS p, v * (1 - 0.6::DOUBLE * (h * 6 - floor(h * 6))) AS q, v * (1 - 0.6::DOUBLE * (1 - (h * 6 - floor(h * 6)))) AS t FROM hv),
    rgb AS (SELECT label, [v, q, p, p, t, v][k + 1] AS r, [t, v, v, q, p, p][k + 1] AS g, [p, p, t, v, v, q][k + 1] AS b FROM pq)
    SELECT label, '#' || lpad(lower(to_hex(floor(r * 255)::BIGINT)), 2, '0') || lpad(lower(to_hex(floor(g * 255)::BIGINT)), 2, '0') || lpad(lower(to_hex(floor(b * 255)::BIGINT)), 2, '0') AS color FROM rgb"""
)
def palette_hex(t):
    return labels.palette(t.read("nation").select(F.col("n_regionkey").alias("label"), "n_nationkey"), "label", "n_nationkey")


# ---------------------------------------------------------------- order-dependent and iterative steps
@query(
    _LABELS.replace("WITH p AS", "WITH RECURSIVE p AS", 1).replace("SELECT cell, pid, label FROM p", "SELECT cell, pid, label, x, y FROM p")
    + """, piece AS (
      SELECT cell, '' AS path, x0, y0, x0 + 5 AS x1, y0 + 5 AS y1, NULL::BIGINT AS label, 2::BIGINT AS k FROM c JOIN lab USING (cell) WHERE n_labels > 1
      UNION ALL
      SELECT h.cell, h.path, h.x0, h.y0, h.x1, h.y1, min(hit.label), count(DISTINCT hit.label) FROM (
        SELECT cell, path || side AS path, CASE WHEN wide AND side = '1' THEN (x0 + x1) / 2 ELSE x0 END AS x0, CASE WHEN NOT wide AND side = '1' THEN (y0 + y1) / 2 ELSE y0 END AS y0,
          CASE WHEN wide AND side = '0' THEN (x0 + x1) / 2 ELSE x1 END AS x1, CASE WHEN NOT wide AND side = '0' THEN (y0 + y1) / 2 ELSE y1 END AS y1
        FROM (SELECT *, x1 - x0 >= y1 - y0 AS wide FROM piece WHERE k > 1 AND length(path) < 25), (VALUES ('0'), ('1')) s(side)) h
      LEFT JOIN hit ON hit.cell = h.cell AND hit.x > h.x0 AND hit.x < h.x1 AND hit.y > h.y0 AND hit.y < h.y1 GROUP BY h.cell, h.path, h.x0, h.y0, h.x1, h.y1)
    SELECT cell, path, label, round((x1 - x0) * (y1 - y0), 6) AS area FROM piece WHERE k <= 1
    UNION ALL SELECT cell, '', label, 25.0::DOUBLE FROM lab WHERE n_labels <= 1"""
)
def bisect_mixed_cells(t):
    pieces = labels.label_blocks(points(t), cells(t), "cell", "label", 5.0)
    return pieces.select("cell", "path", "label", r6(g.area(F.col("poly"))).alias("area"))


@query()
def fill_sequential(t):
    return labels.fill_in_order(_labelled(t), spatial.touching(cells(t), "cell"), "cell", "label").select("cell", "label")


@query()
def merge_small_blocks(t):
    """Blocks merged inside each town, ten rows of cells: towns are independent tasks."""
    town = F.floor(F.col("cell") / 1000).alias("town")
    sized = cells(t).select(town, F.col("cell").alias("block"), (g.area(F.col("poly")) + F.col("cell") % 7).alias("area"))
    borders = spatial.shared_borders(cells(t), "cell").where("floor(cell / 1000) = floor(other / 1000)").select(town, F.col("cell").alias("block"), "other", "shared")
    return parcels.merge_groups(sized, borders, 60.0)


def _network(t):
    """Street lines across frames of 50 units, a frame for every 20 parts."""
    rows = t.sql(LINES)
    across = rows.select(F.array(g.point(F.col("x0"), F.col("y0")), g.point(F.col("x1"), F.col("y1"))).alias("line"))
    frame = g.rectangle(F.col("ox"), F.lit(0.0), F.col("ox") + 50, F.lit(50.0))
    return across.unionByName(rows.select("ox").distinct().select(F.get(frame, 0).alias("line")))


@query()
def polygonize_network(t):
    return parcels.polygonize(_network(t), 10.0).select("block", r6(g.area(F.col("poly"))).alias("area"), F.size("poly").alias("rings"))


@query(
    f"""WITH l AS ({plain(LINES)}), met AS (SELECT a.tile, a.y0 AS a0, a.y1 AS a1, b.y0 AS b0, b.y1 AS b1 FROM l a JOIN l b ON a.tile = b.tile AND a.y0 < b.y0 AND a.y1 > b.y1),
    x AS (SELECT tile, a0, b0, round(50 * (b0 - a0) / ((b0 - a0) + (a1 - b1)), 5) AS px, round(a0 + (a1 - a0) * (b0 - a0) / ((b0 - a0) + (a1 - b1)), 5) AS py FROM met),
    n AS (SELECT tile, px, py, count(DISTINCT y0) - 1 AS more FROM (SELECT tile, px, py, a0 AS y0 FROM x UNION ALL SELECT tile, px, py, b0 FROM x) GROUP BY tile, px, py)
    SELECT tile, (1 + count(*) + coalesce((SELECT sum(more) FROM n WHERE n.tile = l.tile), 0))::BIGINT AS faces, 2500.0::DOUBLE AS area FROM l GROUP BY tile"""
)
def network_faces(t):
    """Faces of each frame: one, one more for each line, and one for each line more through a crossing."""
    faces = parcels.polygonize(_network(t), 10.0)
    tile = F.floor(g.interior_point(F.col("poly"))["x"] / 60).alias("tile")
    return faces.groupBy(tile).agg(F.count(F.lit(1)).alias("faces"), F.round(F.sum(g.area(F.col("poly"))), 3).alias("area"))


def _voted(t):
    """Territories with ragged borders: cells with the labels of their points or neighbours, dissolved."""
    whole = parcels.dissolve(labels.vote_once(_labelled(t), spatial.touching(cells(t), "cell"), "cell", "label"), "label", 35.0)
    return materialize(whole, "territories")


@query()
def straighten_borders(t):
    smoothed = smooth.smooth_borders(_voted(t), "block", 2)
    return smoothed.select("label", r6(g.area(F.col("poly"))).alias("area"), F.size(F.get("poly", 0)).alias("corners"))


@query(
    f"""WITH c AS (SELECT cell, x0, y0, cell % 100 AS col, cell % 7 <> 0 AS side, cell % 7 > 1 AND cell % 5 = 0 AND cell % 100 > 0 AS stub FROM ({plain(CELLS)})),
    r AS (SELECT *, sum(CASE WHEN stub OR cell % 7 = 1 OR col = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY y0 ORDER BY col) AS run FROM c WHERE side)
    SELECT min(x0) AS x, y0 AS y, (5 * count(*))::DOUBLE AS length, (1 + count(*))::BIGINT AS corners FROM r GROUP BY y0, run
    UNION ALL SELECT x0, y0, 2.5::DOUBLE, 2::BIGINT FROM c WHERE stub"""
)
def merged_streets(t):
    """Sides of street along the cells, with gaps and side streets, as whole lines."""
    rows = t.sql(CELLS).withColumn("n", F.col("cell") % 7)
    x, y = F.col("x0"), F.col("y0")
    along = rows.where("n <> 0").select(g.point(x, y).alias("a"), g.point(x + 5, y).alias("b"))
    stubs = rows.where("n > 1 AND cell % 5 = 0 AND cell % 100 > 0").select(g.point(x, y + 2.5).alias("a"), g.point(x, y).alias("b"))
    lines = chains.merge_lines(along.unionByName(stubs))
    return lines.select(F.col("line")[0]["x"].alias("x"), F.col("line")[0]["y"].alias("y"), r6(g.length(F.col("line"))).alias("length"), F.size("line").cast("bigint").alias("corners"))


#: Cells whose inner borders have a bump in the middle, dr to the right and dt upward; labels are of two columns by three rows.
BUMPS = f"""SELECT *, (cell * 7 % 5 - 2) * 0.3 AS dr, (cell * 3 % 5 - 2) * 0.3 AS dt, CAST(floor(CAST(cell AS DOUBLE) / 100) AS BIGINT) AS row, cell % 100 AS col,
 (cell % 100 + 1 < 100 AND cell + 1 <= most) AS right_of, cell + 100 <= most AS above FROM ({CELLS}) CROSS JOIN (SELECT max(p_partkey) AS most FROM {{part}})"""


def _bumped(t, *more):
    x, y = F.col("x0"), F.col("y0")
    left, below = ((F.col("cell") - 1) * 7 % 5 - 2) * 0.3, ((F.col("cell") - 100) * 3 % 5 - 2) * 0.3
    ring = F.array_compact(F.array(
        g.point(x, y), F.when(F.col("row") > 0, g.point(x + 2.5, y + below)), g.point(x + 5, y), F.when(F.col("right_of"), g.point(x + 5 + F.col("dr"), y + 2.5)),
        g.point(x + 5, y + 5), F.when(F.col("above"), g.point(x + 2.5, y + 5 + F.col("dt"))), g.point(x, y + 5), F.when(F.col("col") > 0, g.point(x + left, y + 2.5)), g.point(x, y),
    ))
    return materialize(t.sql(BUMPS).select("cell", *more, F.array(ring).alias("poly")), "bumped")


@query(
    f"""WITH c AS ({plain(BUMPS)})
    SELECT cell, round(25 + 2.5 * (CASE WHEN right_of AND col % 2 = 0 THEN dr ELSE 0 END + CASE WHEN above AND row % 3 <> 2 THEN dt ELSE 0 END
      - CASE WHEN col % 2 = 1 THEN ((cell - 1) * 7 % 5 - 2) * 0.3 ELSE 0 END - CASE WHEN row % 3 <> 0 THEN ((cell - 100) * 3 % 5 - 2) * 0.3 ELSE 0 END), 6)::DOUBLE AS area, 1::BIGINT AS parts FROM c"""
)
def redistribute_borders(t):
    """Borders between labels lose their bumps, the ground behind them changes hands; those inside a label stay."""
    label = F.floor(F.col("col") / 2) + 50 * F.floor(F.col("row") / 3)
    out = redistribute.straighten(_bumped(t, label.alias("label")), "cell", "label")
    area = F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + g.area(p))
    return out.select("cell", r6(area).alias("area"), F.size("parts").cast("bigint").alias("parts"))


@query(
    f"""WITH c AS ({plain(BUMPS)}), d AS (SELECT cell, CASE WHEN right_of THEN dr ELSE 0 END AS r, CASE WHEN above THEN dt ELSE 0 END AS a,
      CASE WHEN col > 0 THEN ((cell - 1) * 7 % 5 - 2) * 0.3 ELSE 0 END AS l, CASE WHEN row > 0 THEN ((cell - 100) * 3 % 5 - 2) * 0.3 ELSE 0 END AS b FROM c),
    k AS (SELECT cell, CASE WHEN abs(r) > 0.45 THEN r ELSE 0 END AS r, CASE WHEN abs(a) > 0.45 THEN a ELSE 0 END AS a, CASE WHEN abs(l) > 0.45 THEN l ELSE 0 END AS l, CASE WHEN abs(b) > 0.45 THEN b ELSE 0 END AS b FROM d)
    SELECT cell, round(25 + 2.5 * (r + a - l - b), 6)::DOUBLE AS area, (5 + (r <> 0)::INT + (a <> 0)::INT + (l <> 0)::INT + (b <> 0)::INT)::BIGINT AS corners FROM k"""
)
def simplified_partition(t):
    """Small bumps go, large ones stay, the same for the cells on both sides."""
    out = simplify.simplify_partition(_bumped(t), "cell", 0.45, 5.0)
    return out.select("cell", r6(g.area(F.col("poly"))).alias("area"), F.size(F.get("poly", 0)).cast("bigint").alias("corners"))


@query()
def shared_border_lines(t):
    return smooth.shared_lines(_voted(t), "block").select("block", "other", F.size("lines").alias("n_lines"), r6("shared").alias("shared"))


@query()
def separator_line(t):
    """A line between the points of the first and the third strip of columns, over all rows."""
    strip = F.col("label") % 20
    p = points(t).where(strip.isin(0, 2)).select("pt", (strip == 2).cast("int").alias("side"))
    wx, wy, b = separator.fit_separator(p, "side")
    line = separator.cut_line(F.lit(wx), F.lit(wy), F.lit(b), F.struct(F.lit(0.0).alias("xmin"), F.lit(0.0).alias("ymin"), F.lit(100.0).alias("xmax"), F.lit(100.0).alias("ymax")))
    sided = p.select("side", (wx * F.col("pt.x") + wy * F.col("pt.y") + b > 0).cast("int").alias("found"))
    return sided.groupBy("side", "found").agg(F.count(F.lit(1)).alias("n")).withColumn("line", line)


@query()
def territories(t):
    """All of labelling: blocks labelled, mixed ones halved, empty pieces filled, labels dissolved."""
    whole = labels.territories(points(t), cells(t), "cell", "label", 5.0)
    return whole.select("label", "color", r6(g.area(F.col("poly"))).alias("area"), F.size("poly").alias("rings"))


# ---------------------------------------------------------------- overlay, networks, projection, mixed geometries
_OVERLAP = "greatest(0, least(x0 + 5, {2}) - greatest(x0, {0})) * greatest(0, least(y0 + 5, {3}) - greatest(y0, {1}))"


@query(
    f"""WITH a AS (SELECT cell, {_OVERLAP.format(12.5, "50 * town + 2.5", 487.5, "50 * town + 47.5")} - {_OVERLAP.format(100, "50 * town + 10", 200, "50 * town + 20")} AS area FROM ({plain(CELLS)}) JOIN ({plain(TOWNS)}) ON floor(y0 / 50) = town)
    SELECT cell, round(area, 6)::DOUBLE AS area FROM a WHERE area > 0"""
)
def cells_clipped_to_town(t):
    """What lies in the towns of every cell, cut along their boundaries and holes."""
    kept = overlay.clip_to_boundary(cells(t), _towns(t), "cell", 5.0)
    return kept.groupBy("cell").agg(r6(F.sum(g.area(F.col("poly")))).alias("area"))


_PLACES = "SELECT event_id, CAST(15 AS DOUBLE) + CAST(event_id % 600 AS DOUBLE) / 100 AS lon, CAST(45 AS DOUBLE) + CAST(event_id * 7 % 400 AS DOUBLE) / 100 AS lat FROM {events}"


def _utm_sql() -> str:
    """The third-order series, written out."""
    n = f"({projection.N!r}::DOUBLE)"
    ecc = f"(2 * sqrt({n}) / (1 + {n}))"
    a = (f"({n} / 2 - 2 * {n}^2 / 3 + 5 * {n}^3 / 16)", f"(13 * {n}^2 / 48 - 3 * {n}^3 / 5)", f"(61 * {n}^3 / 240)")
    east = " + ".join(f"{c} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(a, 1))
    north = " + ".join(f"{c} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(a, 1))
    radius = f"(6378137 / (1 + {n}) * (1 + {n}^2 / 4 + {n}^4 / 64) * 0.9996)"
    return f"""WITH p AS (SELECT event_id, floor(lon / 6)::INT + 31 AS zone, radians(lat) AS phi, radians(lon - (floor(lon / 6) * 6 + 3)) AS lam FROM ({plain(_PLACES)})),
    t AS (SELECT *, sinh(atanh(sin(phi)) - {ecc} * atanh({ecc} * sin(phi))) AS t FROM p), x AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t)
    SELECT event_id, zone, round(500000 + {radius} * (eta + {east}), 3) AS x, round({radius} * (xi + {north}), 3) AS y FROM x"""


@query(_utm_sql())
def points_to_metric(t):
    """Longitudes and latitudes to metres of their zone."""
    rows = t.sql(_PLACES).withColumn("zone", projection.zone(F.col("lon")))
    m = projection.to_metric(g.point(F.col("lon"), F.col("lat")), F.col("zone"))
    return rows.withColumn("m", m).select("event_id", "zone", F.round("m.x", 3).alias("x"), F.round("m.y", 3).alias("y"))


@query(f"SELECT event_id, round(lon, 7) AS lon, round(lat, 7) AS lat FROM ({plain(_PLACES)})")
def points_there_and_back(t):
    rows = t.sql(_PLACES).withColumn("zone", projection.zone(F.col("lon")))
    rows = rows.withColumn("b", projection.to_degrees(projection.to_metric(g.point(F.col("lon"), F.col("lat")), F.col("zone")), F.col("zone")))
    return rows.select("event_id", F.round("b.x", 7).alias("lon"), F.round("b.y", 7).alias("lat"))


def _mixed(t):
    """A geometry of some kind for each cell: a point, a line, two lines, a polygon, a collection, or none."""
    x, y, k = F.col("x0"), F.col("y0"), F.col("cell") % 7
    pt = shapes.part("Point", F.array(F.array(g.point(x, y))))
    ln = shapes.part("LineString", F.array(F.array(g.point(x, y), g.point(x + 1, y), g.point(x + 1, y + 2))))
    poly = shapes.part("Polygon", g.rectangle(x, y, x + 5, y + 5))
    none = F.array().cast(shapes.SHAPE)
    shape = F.when(k == 0, F.array(pt)).when(k == 1, F.array(ln)).when(k == 2, F.array(ln, ln)).when(k == 3, F.array(poly)).when(k == 4, F.array(pt, ln, poly)).when(k == 5, none)
    return t.sql(CELLS).select("cell", shape.alias("shape"))


_KIND = "CASE cell % 7 WHEN 0 THEN 'Point' WHEN 1 THEN 'LineString' WHEN 2 THEN 'MultiLineString' WHEN 3 THEN 'Polygon' WHEN 4 THEN 'GeometryCollection' END"


@query(f"SELECT {_KIND} AS kind, count(*) AS n FROM ({plain(CELLS)}) GROUP BY 1")
def geom_type_hist(t):
    """Kinds of geometries, counted; those without any part are null."""
    return _mixed(t).groupBy(shapes.kind(F.col("shape")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT cell FROM ({plain(CELLS)}) WHERE cell % 7 = 3")
def geom_type_filter(t):
    return _mixed(t).where(shapes.kind(F.col("shape")).isin("Polygon", "MultiPolygon")).select("cell")


@query(f"SELECT cell, cell % 7 >= 5 AS empty FROM ({plain(CELLS)})")
def geom_empty(t):
    return _mixed(t).select("cell", shapes.is_empty(F.col("shape")).alias("empty"))


@query(f"SELECT cell, i::INT AS part, 3.0::DOUBLE AS length FROM ({plain(CELLS)}), range(2) r(i) WHERE cell % 7 IN (1, 4) AND i = 0 OR cell % 7 = 2")
def lines_extracted(t):
    """The lines of all geometries, one a row."""
    return _mixed(t).select("cell", F.posexplode(shapes.lines_of(F.col("shape"))).alias("part", "line")).select("cell", "part", r6(g.length(F.col("line"))).alias("length"))


@query(
    f"""WITH c AS ({plain(CELLS)}) SELECT cell, 0 AS i, x0 AS x, y0 AS y FROM c WHERE cell % 7 IN (0, 1, 2, 4) UNION ALL SELECT cell, 1, x0 + 1, y0 + 2 FROM c WHERE cell % 7 IN (1, 2)
    UNION ALL SELECT cell, 1, x0, y0 FROM c WHERE cell % 7 = 4 UNION ALL SELECT cell, 2, x0 + 1, y0 + 2 FROM c WHERE cell % 7 = 4 UNION ALL SELECT cell, 2, x0, y0 FROM c WHERE cell % 7 = 2 UNION ALL SELECT cell, 3, x0 + 1, y0 + 2 FROM c WHERE cell % 7 = 2"""
)
def points_extracted(t):
    """Points as they are and the two ends of lines."""
    return _mixed(t).select("cell", F.posexplode(shapes.points_of(F.col("shape"))).alias("i", "p")).select("cell", "i", "p.x", "p.y")


@query(
    f"""WITH f AS (SELECT label, row_number() OVER (ORDER BY min(pid), label) AS i FROM ({plain(POINTS)}) GROUP BY label)
    SELECT label, list_extract(['{"', '".join(labels.TAB20)}'], least(i, 20)) AS color FROM f"""
)
def categorical_colours(t):
    return labels.categorical(points(t).select("label", "pid"), "label", "pid")


@query(f"SELECT cell, n::INT AS part, 12.5::DOUBLE AS area, x0 + 2.5 * n AS xmin FROM ({plain(CELLS)}), (VALUES (0), (1)) v(n)")
def halves_in_sql(t):
    """Cells cut in half by the table function."""
    tables.register(t.spark)
    cells(t).createOrReplaceTempView("cells_to_halve")
    halves = t.spark.sql("SELECT c.cell, h.part, h.poly FROM cells_to_halve c, LATERAL felez(c.poly) h")
    return halves.select("cell", "part", r6(g.area(F.col("poly"))).alias("area"), g.bounds(F.get("poly", 0))["xmin"].alias("xmin"))


@query(f"SELECT pid, round((x - 1) * 0.6::DOUBLE + (y - 2) * 0.8::DOUBLE, 6) AS along FROM ({plain(POINTS)})")
def points_along_direction(t):
    """How far each point lies along a ray from (1, 2)."""
    along = g.project(g.point(F.lit(1.0), F.lit(2.0)), F.lit(0.6), F.lit(0.8), F.col("pt"))
    return points(t).select("pid", r6(along).alias("along"))


def _town(t):
    """Nodes, edges, homes and boundary: streets between the suppliers' places on a grid, every third one cut short, in two rows of
    residential boxes of which the town's boundary cuts some."""
    k = F.col("s_suppkey")
    n = t.read("supplier").select(k.alias("osmid"), g.point(F.floor(k / 5) * 120.0, k % 5 * 120.0).alias("pt"))
    right, up = n.select(F.col("osmid").alias("u"), (F.col("osmid") + 5).alias("v")), n.where("osmid % 5 < 4 AND osmid % 3 > 0").select(F.col("osmid").alias("u"), (F.col("osmid") + 1).alias("v"))
    known = n.select(F.col("osmid").alias("v"))
    e = right.unionByName(up).join(known, "v", "left_semi").select("u", "v", F.lit(0).alias("key"), F.lit(None).cast(g.LINE).alias("line"))
    col = n.select(F.floor(F.col("osmid") / 25).alias("id")).distinct()
    homes = col.select("id", g.rectangle(F.col("id") * 600.0 - 60, F.lit(-60.0), F.col("id") * 600.0 + 540, F.lit(540.0)).alias("poly"))
    last = n.agg(F.max("pt.x").alias("x"))
    boundary = last.select(g.rectangle(F.lit(-30.0), F.lit(-100.0), F.col("x") + 30, F.lit(520.0)).alias("poly"))
    return n, e, homes, boundary


@query()
def town_blocks(t):
    """From roads to blocks."""
    blocks = network.town_blocks(*_town(t), 60.0)
    return blocks.select("block", r6(g.area(F.col("poly"))).alias("area"), F.size("poly").alias("rings"))


@query()
def town_territories(t):
    """From roads and addresses to written territories: customers live in the blocks, labels are strips of two columns."""
    most = t.read("supplier").agg((F.floor(F.max("s_suppkey") / 5)).alias("most"))
    k = F.col("c_custkey")
    at = t.read("customer").crossJoin(F.broadcast(most)).where("most > 0").select(k, (k % F.col("most")).alias("i"), (F.floor(k / 20) % 4).alias("j"))
    pts = at.select(F.floor(F.col("i") / 2).alias("label"), g.point(F.col("i") * 120 + 60 + k % 7 * 5, F.col("j") * 120 + 60 - k % 11 * 4).alias("pt"))
    whole = town.town_territories(pts, *_town(t), "label", 60.0)
    return whole.select("label", "color", r6(town.area("parts")).alias("area"), F.size("parts").alias("parts"))
