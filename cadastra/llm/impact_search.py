"""Ranked lexical search by NRA: impact-sorted lists, read in order, with a score interval for each document.

Every list of a query term is sorted by impact, the share of the score that its term gives a document, and stored in layers of
impacts that halve, all lists alike. A round reads one layer of all lists. What a document has got so far is its lower bound;
a list that it was not met in yet can give it no more than the layer's floor (or the list's greatest impact), which makes its upper
bound. An item is closed to new documents once one met nowhere could not reach its k-th lower bound; documents whose upper
bound is under that go; and reading goes on, for the documents left, until both bounds of each are the same, so that
membership, ties and scores are settled. Every layer is read once, and none after the last item is settled.

Terms are the maximal runs of letters, digits and anything beyond ASCII, A-Z lower-cased. They are compared by two 64-bit hashes.
Items are taken in blocks of some QUERY_TERMS terms, so that what tasks are given of them is bounded whatever the benchmark's
size; each block scans the documents once. Documents are never gathered by term or item: the lists stay where their documents were
read, a list is the rows of its term in all files of a layer.

Defined cases: null text has no terms; a document without terms counts for nothing and is never ranked; an item without terms, or
all of whose terms no document has, gives no rows; rows that repeat an item wholly count once, rows that share its item_id only are
items of their own; every row of docs is a document of its own; equal scores are in order of doc_id, null last, then of
rows; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Rolling, bounded_batches, i64, materialize, scratch_path, text_chunks, word_bounds

#: Query terms, repeats in different items counted, of a block of items: what is broadcast.
QUERY_TERMS = 200_000
#: Layers of impacts. The last takes all that is under 2**(1 - LAYERS) of the greatest.
LAYERS = 8
#: Bytes that end a term become blanks, A-Z become a-z.
_FOLD = np.full(256, 32, np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _FOLD[_first : _last + 1] = np.arange(_first, _last + 1)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)

WANTED = "item bigint, hash bigint, check bigint, q bigint"
INDEX = "row bigint, doc_id bigint, n bigint, terms array<int>, counts array<int>"


def _counted(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct pair is, in order of pairs, and how often it occurs."""
    order = np.lexsort((term, row))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(row[order]) != 0) | (term[order][1:] != term[order][:-1])
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, off in text_chunks(batches, "text"):
        folded = _FOLD[data]
        start, end, row = word_bounds(folded, off)
        hashes, checks = (Rolling(folded, seed).ranges(start, end) for seed in (1, 2))
        at, q = _counted(row, hashes)
        yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(row[at])), i64(hashes[at]), i64(checks[at]), i64(q)], ["item", "hash", "check", "q"])


def _index(shared):
    """Terms of documents that the vocabulary has, by their number in it, with counts; n counts all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, checks = shared.value
        for batch, data, off in text_chunks(batches, "text"):
            folded = _FOLD[data]
            start, end, row = word_bounds(folded, off)
            n = np.bincount(row, minlength=batch.num_rows)
            at = np.searchsorted(hashes, h := Rolling(folded).ranges(start, end))
            at[at == len(hashes)] = 0
            hit = np.flatnonzero(hashes[at] == h)
            hit = hit[Rolling(folded, 2).ranges(start[hit], end[hit]) == checks[at[hit]]]
            first, count = _counted(row[hit], at[hit])
            offsets = pa.array(np.searchsorted(row[hit][first], np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (at[hit][first], count)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id").cast(pa.int64()), i64(n), *lists], ["row", "doc_id", "n", "terms", "counts"])

    return run


def _local(spark: SparkSession, **columns: np.ndarray) -> DataFrame:
    """A small table of the driver's, to be broadcast."""
    return F.broadcast(spark.createDataFrame(pa.table(columns)))


def postings(docs: DataFrame, hashes: np.ndarray, checks: np.ndarray) -> tuple[DataFrame, list[int]]:
    """(layer, term, row, doc_id, impact) for the terms of the vocabulary, and each layer's floor."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast((hashes, checks))
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    index = materialize(rows.mapInArrow(_index(shared), INDEX), "index")
    n_docs, n_terms = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    entry = index.where("size(terms) > 0").select("row", "doc_id", "n", F.explode(F.arrays_zip("terms", "counts")).alias("e")).select("row", "doc_id", "n", F.col("e.terms").alias("term"), F.col("e.counts").cast("bigint").alias("tf"))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weights = entry.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", weight.alias("w")).toArrow()  # a row for each query term at most
    term, w = (weights.column(c).to_numpy() for c in ("term", "w"))
    most = int(w.max(initial=0)) * 1_000_000
    floors = [most >> (i + 1) for i in range(LAYERS - 1)] + [0]
    entry = entry.join(_local(spark, term=term, w=w), "term").withColumn("m", F.expr(f"100 - 25 + ((25 * n * {n_docs}L) div {max(n_terms, 1)}L)"))
    entry = entry.withColumn("impact", F.expr("w * ((1000000000L * tf) div (1000 * tf + 12 * m))")).where("impact > 0")
    layer = sum((F.col("impact") <= f).cast("int") for f in floors[:-1])
    path = scratch_path(spark, "postings")
    laid = entry.select(layer.alias("layer"), "term", "row", "doc_id", "impact").sortWithinPartitions("layer", F.desc("impact"))
    laid.write.partitionBy("layer").parquet(path)
    schema = "term int, row bigint, doc_id bigint, impact bigint, layer int"
    return spark.read.schema(schema).parquet(path), floors


def _best(scores: DataFrame, k: int, order: list) -> DataFrame:
    """The first k of each item; Spark drops what is beyond before it shuffles."""
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def _ranked(lists: DataFrame, floors: list[int], item: np.ndarray, term: np.ndarray, q: np.ndarray, most: np.ndarray, k: int) -> DataFrame:
    """(item, rank, doc_id, score) of the items' terms; most: the greatest impact of a term's list, over 0. The driver keeps a few
    numbers for each item of the block, tasks are given no more than those and its terms. Rows of settled items are carried along."""
    spark = lists.sparkSession
    n = int(item.max()) + 1
    every = np.arange(n, dtype=np.int32)
    done, closed = ~np.isin(every, item), np.zeros(n, bool)
    need, step = np.zeros(n, np.int64), np.zeros(n, np.int64)  # a document stays while lower - step * seen >= need
    state = None
    for layer, floor in enumerate(floors):
        read = lists.where(F.col("layer") == layer)
        gain = [(F.col("q") * F.col("impact")).alias("lower"), F.col("q").alias("seen")]
        parts = []
        if state is not None:
            stay = lambda of, state=state: state.join(_local(spark, item=every[of], need=need[of], step=step[of]), "item").where("lower - step * seen >= need")
            parts.append(stay(slice(None)).select("item", "row", "doc_id", "lower", "seen"))
        if (at := np.flatnonzero((~closed & ~done)[item])).size:
            parts.append(read.join(_local(spark, term=term[at], item=item[at], q=q[at]), "term").select("item", "row", "doc_id", *gain))
        if (at := np.flatnonzero((closed & ~done)[item])).size:
            known = read.select("row", "term", "impact").join(stay(closed & ~done).select("item", "row", "doc_id"), "row")
            parts.append(known.join(_local(spark, item=item[at], term=term[at], q=q[at]), ["item", "term"]).select("item", "row", "doc_id", *gain))
        state = reduce(DataFrame.unionByName, parts).groupBy("item", "row", "doc_id").agg(F.sum("lower").alias("lower"), F.sum("seen").alias("seen"))
        state = materialize(state, "bounds")
        rest, kth = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(rest, item, q * np.minimum(most, floor))
        least = _best(state, k, [F.desc("lower")]).groupBy("item").agg(F.when(F.count(F.lit(1)) == k, F.min("lower")).otherwise(0).alias("kth")).toArrow()
        kth[least.column("item").to_numpy()] = least.column("kth").to_numpy()
        closed |= (rest < kth) | (floor == 0)
        need, step = np.where(done, need, kth - rest), np.where(done, 0, floor)
        if (ask := closed & ~done).any():
            unsure = state.join(_local(spark, item=every[ask], need=need[ask], rest=rest[ask]), "item").where(f"lower - {floor}L * seen >= need AND rest > {floor}L * seen")
            ask[unsure.select("item").distinct().toArrow().column("item").to_numpy()] = False
            need[ask], step[ask] = kth[ask], 0
            done |= ask
        if done.all():
            break
    best = _best(state.where("lower > 0"), k, [F.desc("lower"), F.col("doc_id").asc_nulls_last(), "row"])
    return best.select("item", "rank", "doc_id", F.col("lower").alias("score"))


def search(docs: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best rows of docs (doc_id, text) for each row of queries (item_id, text)."""
    spark = docs.sparkSession
    items = queries.where("text IS NOT NULL").select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id())
    items = materialize(items, "items")
    wanted = materialize(items.mapInArrow(_query_terms, WANTED), "wanted")
    blocks = max(1, math.ceil(wanted.count() / QUERY_TERMS))
    parts = []
    for block in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()
        names, item = np.unique(own.column("item").to_numpy(), return_inverse=True)
        hashes, first, term = np.unique(own.column("hash").to_numpy().view(np.uint64), return_index=True, return_inverse=True)
        check, q = own.column("check").to_numpy().view(np.uint64), own.column("q").to_numpy()
        if (check != check[first][term]).any():
            raise RuntimeError("two query terms share a 64-bit hash")
        if len(hashes) == 0:
            continue
        lists, floors = postings(docs, hashes, check[first])
        tops = lists.groupBy("term").agg(F.max("impact").alias("most")).toArrow()
        most = np.zeros(len(hashes), np.int64)
        most[tops.column("term").to_numpy()] = tops.column("most").to_numpy()
        at = np.flatnonzero(most[term])
        if at.size == 0:
            continue
        best = _ranked(lists, floors, item[at].astype(np.int32), term[at].astype(np.int32), q[at], most[term[at]], k)
        parts.append(best.join(_local(spark, item=np.arange(len(names), dtype=np.int32), name=names), "item").select(F.col("name").alias("item"), "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    found = reduce(DataFrame.unionByName, parts)
    return found.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op11_impact_search(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: the 20 best documents of each benchmark item."""
    return search(docs, benchmark, 20)


OP11_SQL = """
WITH terms AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS row FROM documents)
), lengths AS (SELECT row, count(*) AS n FROM terms GROUP BY row),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
asked AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, text, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, text, term
), counts AS (SELECT row, doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), whole),
impacts AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms)))) AS impact
  FROM counts JOIN weights USING (term) JOIN lengths USING (row), whole
), scores AS (SELECT item_id, row, doc_id, sum(q * impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, row)::INT AS rank, doc_id, score FROM scores WHERE score > 0)
WHERE rank <= 20
"""
