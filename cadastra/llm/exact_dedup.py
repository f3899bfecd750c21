"""Exact dedup against a persistent digest index.

The index is a table of the catalog, bucketed and sorted by digest. New data is
deduplicated in two steps: within itself (a partial aggregation on the digest), and
against the index by a sort-merge anti-join; what is new is appended, so that later
ingests see it. A bucketed index is read by the join without a shuffle of its own.

Defined cases: null text counts as the empty text; texts are equal when identical
after lower-casing A-Z; of equal texts in one ingest the largest doc_id stays (a null
doc_id is smaller than any); texts whose digest the index already holds are copies of
the row that the index names. Repeated rows with one doc_id count as one copy each and
give one result row each. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_unique, materialize, n_partitions, scratch_path

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_digest(docs: DataFrame) -> DataFrame:
    """doc_id and the binary SHA-256 of the normalised text: texts themselves go no further."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), _UPPER, _LOWER)
    return docs.select("doc_id", F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


class DigestIndex:
    """A digest index kept as a bucketed, sorted table (digest, keep_id, group_size)."""

    SCHEMA = "digest binary, keep_id bigint, group_size bigint"

    def __init__(self, spark: SparkSession, table: str, path: str | None = None, buckets: int | None = None):
        self.spark, self.table = spark, table
        if not spark.catalog.tableExists(table):
            spark.sql(
                f"CREATE TABLE {table} ({self.SCHEMA}) USING parquet "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets or n_partitions(spark)} BUCKETS LOCATION '{path or scratch_path(spark, table)}'"
            )
        about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
        self.buckets, self.path = int(about["Num Buckets"]), about["Location"]

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def ingest(self, docs: DataFrame) -> DataFrame:
        """One row per row of docs: doc_id, digest, keep_id, group_size (copies among these
        docs), known (the index had the text before). Appends what is new."""
        rows = materialize(with_digest(docs), "digests")
        total = rows.count()
        groups = materialize(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
        old = self.read()
        fresh = groups.join(old.select("digest").hint("merge"), "digest", "left_anti")
        batch = scratch_path(self.spark, "fresh")
        fresh.write.parquet(batch)  # appending to a table that the plan reads needs a stop in between
        had = groups.join(old.select("digest", F.col("keep_id").alias("index_id")).hint("merge"), "digest", "left")
        had = materialize(had, "decided")
        (
            self.spark.read.parquet(batch)
            .repartition(self.buckets, "digest")
            .write.bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .mode("append")
            .format("parquet")
            .option("path", self.path)
            .saveAsTable(self.table)
        )
        out = join_unique(rows, had, ["digest"], "group_size", total)
        known = F.col("index_id").isNotNull()
        return out.select("doc_id", "digest", F.coalesce("index_id", "keep_id").alias("keep_id"), "group_size", known.alias("known"))


def op3_exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; one row per document."""
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")
    return index.ingest(docs).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


#: DuckDB. The same rows from the texts themselves.
OP3_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
