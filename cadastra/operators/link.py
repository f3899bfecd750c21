"""Linkage of a registry with geocodes: exact, by range of house numbers, by range without the letter.

Registry rows need: rid, street, number, town (and town_exact for the exact pass); geocode
rows: gid, street, number, town. All other columns travel along; a name that both have
gets the suffix _geo on the geocode's side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import text as tx
from cadastra.session import materialize


def _suffixed(geo: DataFrame, registry: DataFrame) -> DataFrame:
    taken = set(registry.columns)
    return geo.select(*(F.col(c).alias(f"{c}_geo" if c in taken else c) for c in geo.columns))


def _name(geo_column: str, registry: DataFrame) -> str:
    return f"{geo_column}_geo" if geo_column in registry.columns else geo_column


def _keys(registry: DataFrame, geo: DataFrame, pairs: list[tuple[str, str]], null_matches: bool) -> Column:
    on = F.lit(True)
    for a, b in pairs:
        x, y = registry[a], geo[b]
        on = on & (x.eqNullSafe(y) if null_matches else x == y)
    return on


def exact(registry: DataFrame, geo: DataFrame, town: str = "town", null_matches: bool = True) -> DataFrame:
    """Left join on street, number and town; null keys match each other unless told otherwise."""
    g = _suffixed(geo, registry)
    pairs = [("street", _name("street", registry)), ("number", _name("number", registry)), (town, _name("town", registry))]
    return registry.join(g, _keys(registry, g, pairs, null_matches), "left")


def exact_split(registry: DataFrame, geo: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched registry rows) of one exact pass, joined once."""
    joined = materialize(exact(registry, geo, **options), "exact")
    gid = _name("gid", registry)
    return joined.where(F.col(gid).isNotNull()), joined.where(F.col(gid).isNull()).select(*registry.columns)


def by_range(registry: DataFrame, geo: DataFrame, letters: bool = True, null_matches: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched, unmatched, unparsed): house numbers as ranges that meet, with equal letters if
    asked. An equi-join on street and town with the range as residual condition. Registry
    rows whose number does not parse are in neither of the first two."""
    parsed = registry.withColumn("_house", tx.parse_house(F.col("number")))
    able = parsed.where("_house IS NOT NULL")
    g = _suffixed(geo, registry).withColumn("_house_geo", tx.parse_house(F.col(_name("number", registry)))).where("_house_geo IS NOT NULL")
    keys = _keys(able, g, [("street", _name("street", registry)), ("town", _name("town", registry))], null_matches)
    meets = tx.houses_overlap(F.col("_house"), F.col("_house_geo"), letters)
    matched = able.join(g, keys & meets).drop("_house", "_house_geo")
    # existence, not identity of row numbers: no shuffle of a distinct id list
    unmatched = able.join(g, keys & meets, "left_anti").drop("_house")
    return matched, unmatched, parsed.where("_house IS NULL").drop("_house")


def cascade(registry: DataFrame, geo: DataFrame, town_exact: str = "town") -> DataFrame:
    """All three passes, each over what the one before left, in one table with column `pass`."""
    first, rest = exact_split(registry, geo, town=town_exact)
    second, rest, _ = by_range(rest, geo, letters=True)
    third, _, _ = by_range(rest, geo, letters=False)
    passes = [p.withColumn("pass", F.lit(i)) for i, p in enumerate((first, second, third), 1)]
    return passes[0].unionByName(passes[1], allowMissingColumns=True).unionByName(passes[2], allowMissingColumns=True)


def coverage(matched: DataFrame, registry: DataFrame) -> DataFrame:
    """How much of the registry found a geocode, in per cent (null for an empty registry)."""
    hit = matched.select("rid").distinct().withColumn("_hit", F.lit(1))
    joined = registry.select("rid").join(hit, "rid", "left")
    return joined.agg(F.count("_hit").alias("matched"), F.count(F.lit(1)).alias("registry_rows"), F.round(F.count("_hit") * 100 / F.nullif(F.count(F.lit(1)), F.lit(0)), 6).alias("percent"))


def folded(registry: DataFrame, geo: DataFrame) -> DataFrame:
    """First-generation linkage on ASCII-folded street and number keys, without the town. Nulls never match."""

    def keyed(df):
        return df.withColumn("street_key", tx.fold_ascii(tx.street_key(F.col("street")))).withColumn("number_key", tx.number_key(F.col("number")))

    g = keyed(geo)
    g = g.select("street_key", "number_key", *(F.col(c).alias(_name(c, registry)) for c in geo.columns))
    return keyed(registry).join(g, ["street_key", "number_key"])


def map_towns(df: DataFrame, names: DataFrame, column: str = "town", out: str = "town_full") -> DataFrame:
    """Town names through a map (src, dst); names without one stay. The map is a small, declared
    table: it is broadcast by Spark where its size allows, and joined by shuffle where not."""
    m = names.select(F.col("src").alias("_src"), F.col("dst").alias("_dst"))
    return df.join(m, F.col(column) == F.col("_src"), "left").withColumn(out, F.coalesce("_dst", column)).drop("_src", "_dst")
