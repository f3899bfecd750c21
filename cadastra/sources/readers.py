"""Sources: registry CSV and Parquet, ragged geocoder JSON lines, towns, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import shapes
from cadastra.functions import text as tx

REGISTRY = (
    "szavazokorid BIGINT, kozteruletid BIGINT, kozteruletnevid BIGINT, kozteruletnev STRING, utcacim STRING, "
    "telepulesid BIGINT, telepulesnev STRING, eventfromid BIGINT, date STRING"
)
GEOCODES = "gid BIGINT, utca STRING, cim STRING, telepules STRING, iszam BIGINT, orszag STRING, lat DOUBLE, lon DOUBLE"
# The elections whose registries carry addresses.
ADDRESSED_DATES = ["2014-04-06", "2022-04-03"]


def registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """The registry with its declared types and its rows' places in the files (`_row`); a value that does not fit is an error."""
    rows = spark.read.schema(REGISTRY).option("header", True).option("mode", "FAILFAST").csv(path)
    place = F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("id"))
    return rows.select("*", place.alias("_row"))


def registry_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A registry table without wholly equal rows."""
    return spark.read.parquet(path).distinct()


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): the lines of a JSON-lines folder or file that are not blank."""
    return spark.read.text(path).where("trim(value) <> ''")


def parse_arrays(lines: DataFrame) -> DataFrame:
    """(a): each line's JSON array with all its members as text."""
    return lines.select(F.from_json("value", "array<string>").alias("a")).where("a IS NOT NULL")


def ragged_geocodes(lines: DataFrame) -> DataFrame:
    """(gid, cim, telepules, iszam, orszag, lat, lon) from ragged arrays.

    6 members: id, address, town, postcode and country, lat, lon. 7: a company comes second and the
    address fourth. More than 8: the last five are town, address, postcode and country, lat, lon.
    Other lengths go, and so do addresses and postcodes without a letter and a digit, postcodes
    that are not two words, and postcodes that are not numbers."""
    a, n = F.col("a"), F.size("a")
    last = lambda k: F.try_element_at(a, F.lit(-k))
    row = (
        F.when((n == 6) & (F.coalesce(F.get(a, 1), F.lit("")) != ""), a)
        .when(n == 7, F.array(*(F.get(a, i) for i in (0, 3, 2, 4, 5, 6))))
        .when((n > 8) & tx.letter_and_digit(last(4)), F.array(F.get(a, 0), last(4), last(5), last(3), last(2), last(1)))
    )
    rows = parse_arrays(lines).select(row.alias("r")).where("r IS NOT NULL")
    rows = rows.where(tx.letter_and_digit(F.get("r", 1)) & tx.letter_and_digit(F.get("r", 3)))
    place = F.split(tx.squeeze(F.get("r", 3)), " ")
    rows = rows.withColumn("place", place).where(F.size("place") == 2).withColumn("iszam", F.get("place", 0).try_cast("bigint")).where("iszam IS NOT NULL")
    get = lambda i: F.get("r", i)
    return rows.select(
        get(0).try_cast("bigint").alias("gid"), get(1).alias("cim"), get(2).alias("telepules"), "iszam", F.get("place", 1).alias("orszag"), get(4).try_cast("double").alias("lat"), get(5).try_cast("double").alias("lon")
    )


def positional_geocodes(lines: DataFrame) -> DataFrame:
    """First-generation view: members 0, 1, 2, 5 and 6 by position, coordinates repaired from the whole row."""
    get = lambda i: F.get("a", i)
    fixed = tx.repair_coordinates(F.col("a"), get(5).try_cast("double"), get(6).try_cast("double"))
    return parse_arrays(lines).select(get(0).alias("geoid"), get(1).alias("cim"), get(2).alias("telepules"), fixed.alias("at")).select("geoid", "cim", "telepules", "at.lat", "at.lon")


def clean_geocodes(lines: DataFrame) -> DataFrame:
    """Ragged lines to typed geocodes with street, number and a point (WGS84)."""
    street, number = tx.split_at_digit(F.col("cim"))
    rows = ragged_geocodes(lines).withColumn("utca", street).withColumn("cim", number)
    moved = tx.move_misplaced(tx.expand_street(F.col("utca")), F.col("cim"))
    rows = rows.select("gid", moved[0].alias("utca"), moved[1].alias("cim"), "telepules", "iszam", "orszag", F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")).alias("pt"))
    return rows.withColumn("cim", tx.standard_number(F.col("cim")))


def clean_registry(registry: DataFrame, towns: DataFrame) -> DataFrame:
    """The registry with cheap filters first, then towns in full, numbers repaired and streets expanded.

    Rows without a town or street id go. Of rows that differ in the town's name only (one town in two languages), or in
    the event, the first stays: by `_row` where the reader gives it, else by the order of the scan. The date and the
    house number 0 are among the keys, so that their filters can come before that."""
    from cadastra.operators import link, relational

    keys = ["szavazokorid", "kozteruletid", "kozteruletnevid", "kozteruletnev", "utcacim", "telepulesid", "date"]
    rows = registry if "_row" in registry.columns else registry.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.dropna(subset=["telepulesid", "kozteruletid"]).where(F.col("date").isin(ADDRESSED_DATES))
    rows = relational.keep_first(rows.where(relational.differs(F.col("utcacim"), "0")), keys, ["_row"])
    rows = link.map_towns(rows, towns, "telepulesnev", "telepulesnev_hu")
    moved = tx.move_misplaced(F.col("kozteruletnev"), tx.repair_number(F.col("utcacim")))
    rows = rows.withColumn("utca", tx.expand_street(moved[0])).withColumn("cim", tx.standard_number(moved[1]))
    return rows.select("szavazokorid", "kozteruletid", "kozteruletnevid", "utca", "cim", "telepulesid", "telepulesnev", "telepulesnev_hu", "eventfromid", "date").distinct()


def polygons_of(rows: DataFrame) -> DataFrame:
    """Rows whose shape is a polygon or several, each part in a row of its own with its number and poly instead of the shape."""
    kept = rows.where(shapes.kind(F.col("shape")).isin("Polygon", "MultiPolygon"))
    return kept.select(*(c for c in rows.columns if c != "shape"), F.posexplode("shape").alias("part", "_p")).withColumn("poly", F.col("_p.rings")).drop("_p")


def load_town(spark: SparkSession, folder: str, town: str) -> dict[str, DataFrame]:
    """nodes, edges, residential and boundary of a town, from tables partitioned by town. Residential areas and boundaries may be shapes
    of any kind: those that are no polygons are left out."""
    out = {name: spark.read.parquet(f"{folder}/{name}").where(F.col("town") == town).drop("town") for name in ("nodes", "edges", "residential", "boundary")}
    for name in ("residential", "boundary"):
        if "shape" in out[name].columns:
            out[name] = polygons_of(out[name])
    if not out["residential"].limit(1).count():
        raise RuntimeError(f"no residential area in {town}")
    return out


def town_names(spark: SparkSession, path: str) -> DataFrame:
    """(src, dst): the town-name map."""
    return spark.read.parquet(path).select("src", "dst")


def lookup_towns(answers: DataFrame) -> DataFrame:
    """(src, dst) from recorded place lookups: the first level that has a name, else the name asked for."""
    return answers.select("src", tx.first_place_name(*(F.col(c) for c in ("city", "town", "village", "municipality", "river", "src"))).alias("dst"))


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def repair_yield(lines: DataFrame) -> DataFrame:
    """Rows read, rows usable, and their share in per cent (null for no rows)."""
    each = ragged_geocodes(lines).select(F.lit(0).alias("read"), F.lit(1).alias("used")).unionByName(lines.select(F.lit(1).alias("read"), F.lit(0).alias("used")))
    sums = each.agg(F.coalesce(F.sum("read"), F.lit(0)).alias("rows_read"), F.coalesce(F.sum("used"), F.lit(0)).alias("rows_used"))
    return sums.withColumn("percent", F.round(F.col("rows_used") * 100 / F.nullif(F.col("rows_read"), F.lit(0)), 6))
