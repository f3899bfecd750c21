"""The pipeline's stages: columns are kept, decisions take effect, clean documents stay."""

from __future__ import annotations

import corpus_pipeline

from .fixture import documents, texts


def test_stages(spark, tmp_path):
    docs = documents(spark)
    leak = " ".join(texts()[10].split()[:40])
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix_sources", "token_records"]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "token_records":
            assert docs.columns == columns
        if name == "language_id":
            assert {84, 85, 86, 87} <= before - after <= {84, 85, 86, 87, 88, 94}  # no letters; one-word texts may go
        if name == "near_dedup":
            assert {89, 90} & after == set() and {3, 4, 5} <= after
        if name == "decontaminate":
            assert 10 not in after and len(before - after) <= 2
        if name in ("mix_sources", "token_records"):
            assert after == before


def test_shared_and_missing_ids_cost_no_document(spark, tmp_path):
    own = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(4)]
    rows = [(1, own[0]), (1, own[1]), (None, own[2]), (None, own[3]), (2, own[0] + " more"), (1, own[0]), (None, own[3]), (3, None), (4, ""), (5, "")]
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path)).collect()
    assert sorted(((r.doc_id or 0, r.text or "") for r in got)) == sorted([(1, own[0]), (1, own[1]), (0, own[2]), (0, own[3]), (3, ""), (4, ""), (5, "")])


def test_columns_with_the_names_of_the_operators_own(spark, tmp_path):
    from pyspark.sql import functions as F

    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = ["score", "rejected", "cross_entropy", "lang_pred", "full", "cut", "docs", "epoch", "quota", "weight", "_key", "kept", "component_id"]
    docs = documents(spark).withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in names})
    want = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == want
        assert docs.where(" OR ".join(f"{c} <> concat('{c} ', doc_id)" for c in names)).count() == 0


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0
