"""Sinks: geometry tables by town, appended JSON lines, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_by_town(df: DataFrame, path: str, town: str = "town", mode: str = "overwrite") -> None:
    """A Parquet table with a folder for each town, so that readers of one town open no other."""
    df.write.mode(mode).partitionBy(town).parquet(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    """Rows appended as JSON lines; the commit protocol makes them durable, a job at a time."""
    df.write.mode("append").json(path)


def write_names(df: DataFrame, path: str) -> None:
    df.select("src", "dst").write.mode("overwrite").parquet(path)


def counted(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """df with counters that are filled while it is computed; read them with Observation.get."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(m.alias(k) for k, m in metrics.items())), seen
