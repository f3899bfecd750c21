"""The same cleaning and linkage over files that keep coming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadastra.functions import text as tx
from cadastra.sources import readers


def geocode_stream(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """Cleaned geocodes of JSON-lines files as they arrive in a folder; a stateless map."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_a_batch).text(folder).where("trim(value) <> ''")
    return readers.clean_geocodes(lines)


def link_stream(geocodes: DataFrame, registry: DataFrame) -> DataFrame:
    """Arriving geocodes joined to the registry (static) on street, number and town; nulls match nulls."""
    reg = registry.select(F.col("utca").alias("r_utca"), F.col("cim").alias("r_cim"), F.col("telepulesnev_hu").alias("r_town"), "szavazokorid")
    on = F.col("utca").eqNullSafe(F.col("r_utca")) & F.col("cim").eqNullSafe(F.col("r_cim")) & F.col("telepules").eqNullSafe(F.col("r_town"))
    return geocodes.join(reg, on).drop("r_utca", "r_cim", "r_town")


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to a Parquet table, exactly once, and stops when all present files are through."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def arrivals_by_town(geocodes: DataFrame, at: str = "arrived", window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Arrivals a town and window, with late rows up to a watermark."""
    return geocodes.withWatermark(at, late).groupBy(F.window(at, window), "telepules").agg(F.count(F.lit(1)).alias("n"), F.count_if(tx.is_blank(F.col("cim"))).alias("without_number"))
