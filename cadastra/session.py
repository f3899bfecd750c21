"""Session helpers: the shared scratch folder and tables in it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); a folder of our own only where it is unset and all
    of Spark runs in this one process."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("cadastra.scratch", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="cadastra-")
        spark.conf.set("cadastra.scratch", path)
    return path.rstrip("/")


#: Bytes of files up to which a table of ours may be broadcast.
MOST_BROADCAST = 1 << 20


def dealt(df: DataFrame) -> DataFrame:
    """df, joined by shuffle. Spark's estimates know neither what explode multiplies nor how long arrays are nor how well files are
    compressed, so that polygons by the million look small enough to be broadcast, through the driver."""
    return df.hint("shuffle_merge")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: a loop's state, computed once, that survives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    return dealt(out) if out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > MOST_BROADCAST else out
