"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, token records.

Each stage takes (spark, docs, sf_dir) and gives the columns of documents again, the last
the token records it wrote, as read back. Extra columns travel along, whatever their names.

Defined cases: a document with a null or blank text, or without letters, has no language and goes
in the first stage; a null doc_id is a value like any other; rows of one doc_id with different texts are
different documents; wholly equal texts are copies, of which the one with the smallest doc_id stays (null last);
an empty table gives empty stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import decontaminate, language_id, minhash_dedup, mixing, token_records


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns the languages of the labelled texts; texts that the models reject go, the others
    carry the language found as `lang`."""
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    inner = {c: c if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)}  # so that no column of docs is taken for one of the model's
    found = language_id.predict(docs.toDF(*inner.values()), model).where("NOT rejected")
    return found.select(*(F.col("lang_pred" if c == "lang" else inner[c]).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id. Rows are told
    apart by doc_id and text together, so that a shared or missing doc_id costs no document."""
    inner = docs.toDF(*(f"_{i}" for i in range(len(docs.columns))))
    doc_id, text = (F.col(f"_{docs.columns.index(c)}") for c in ("doc_id", "text"))
    inner = inner.withColumn("_key", F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(text, F.lit(""))))
    marks = minhash_dedup.near_duplicates(inner.select(F.col("_key").alias("doc_id"), text.alias("text")), k=5, percent=80)
    groups = marks.select(F.col("doc_id").alias("_key"), "component_id").distinct()
    places = inner.select("_key", F.struct(doc_id.isNull().alias("none"), doc_id.alias("doc_id")).alias("place"))
    first = places.join(groups, "_key").groupBy("component_id").agg(F.min(F.struct("place", "_key"))["_key"].alias("_key")).select("_key")
    kept = inner.join(first, "_key", "left_semi").dropDuplicates(["_key"])
    return kept.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, up to twice, to temper the shares of large ones; every
    document is given out at least once."""
    return mixing.mix_documents(docs, mixing.plan(docs.select("doc_id", "source", "text")), epoch=None)


def write_token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records with their offset index; a row for each record, from the files."""
    return token_records.op7_token_records(spark, docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("mix_sources", mix_sources),
    ("token_records", write_token_records),
]

#: Language identification and the passage search are learned models: SQL has no form for them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written as Parquet and read back."""
    from cadastra.llm.common import materialize

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
