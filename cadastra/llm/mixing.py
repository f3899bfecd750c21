"""Mixing sources to target weights.

Temperature mixing: a source with token share p gets weight p**a / sum(p**a). The exponent a
(1: as it is, 0: all sources alike) is bisected until the weights have a target entropy, or
until no source is repeated more than max_repeats times; the smaller the exponent the more
even the weights, and both bounds can hold at once. The budget is by default the least
under which every source is given out whole at least once, so that nothing is lost.

Weights are realised as block permutations: epoch e of a source is its documents in the
order of a hash of (seed, e, doc_id); the source's stream of epochs is cut at its share
of the budget, and divided among blocks of the output in equal parts, so that each
block has every source in the target weights. Where the cut falls is found in two
levels - token sums of hash buckets, then the one bucket that holds the cut - so no
task holds a whole source, however large.

Defined cases: null text has no tokens; null source is a source of its own; sources
without tokens are given out once; rows with one doc_id go the same way, each as a row;
an empty table gives an empty result; extra columns are kept by `mix_documents`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_unique, materialize

MAX_REPEATS = 2.0
BLOCK_TOKENS = 1_000_000
BUCKETS = 4096
#: Sources up to this number are joined by broadcast; beyond, hot ones alone.
BROADCAST_SOURCES = 50_000
_STEPS = 5
_KEY = "_mix_source"


def n_tokens(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_KEY, F.coalesce(F.concat(F.lit("s:"), F.col("source")), F.lit("null")))


def draw(epoch: Column, seed: int = 0) -> Column:
    """The place of a row in an epoch's permutation, from 0 to 1."""
    return F.xxhash64(F.lit(seed), epoch.cast("int"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) / F.lit(2.0**64) + 0.5


def exponent(sources: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS) -> float:
    """The smallest exponent in [0, 1] that keeps to max_repeats, and with a target entropy
    (nats) the one that meets it, if that is not smaller. Each job evaluates the 31 exponents
    that five bisections could visit."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return 1.0
    shares = sources.where("tokens > 0").select((F.col("tokens") / F.lit(float(total))).alias("p"))
    least, most = shares.agg(F.min("p"), F.max("p")).first()

    def few_repeats(points: list[float]) -> list[bool]:
        """Whether the source with the smallest share is repeated max_repeats times as often as the largest at most."""
        return [(most / least) ** (1 - a) <= max(max_repeats, 1.0) * (1 + 1e-12) for a in points]

    low = 0.0 if max_repeats is None else _bisect(0.0, 1.0, few_repeats)
    if target_entropy is None:
        return low

    def even_enough(points: list[float]) -> list[bool]:
        """Whether the entropy at each exponent is at most the target (it falls as a rises)."""
        sums = shares.agg(*(F.sum(F.pow("p", F.lit(a))) for a in points), *(F.sum(F.pow("p", F.lit(a)) * F.log("p")) for a in points)).first()
        k = len(points)
        return [math.log(sums[i]) - a * sums[k + i] / sums[i] <= target_entropy for i, a in enumerate(points)]

    return max(low, _bisect(0.0, 1.0, even_enough))


def _bisect(lo: float, hi: float, holds, jobs: int = 7) -> float:
    """The smallest x in [lo, hi] where `holds`, monotone in x, becomes true (hi if nowhere)."""
    if holds([lo])[0]:
        return lo
    n = 1 << _STEPS
    for _ in range(jobs):
        points = [lo + (hi - lo) * i / n for i in range(1, n)]
        first = next((i for i, ok in enumerate(holds(points)) if ok), n - 1)
        lo, hi = (points[first - 1] if first else lo), (points[first] if first < n - 1 else hi)
    return hi


def plan(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, budget_tokens: float | None = None, seed: int = 0) -> DataFrame:
    """One row a source: key, docs, tokens, weight, quota (tokens), full (whole epochs), cut
    (where the permutation of the last, partial epoch ends, from 0 to 1)."""
    rows = materialize(keyed(docs).select("doc_id", _KEY, n_tokens(F.col("text")).alias("n")), "token-counts")
    sources = materialize(rows.groupBy(_KEY).agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens")), "sources")
    a = exponent(sources, target_entropy, max_repeats)
    total = float(sources.agg(F.sum("tokens")).first()[0] or 0)
    raw = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total or 1.0), F.lit(a))).otherwise(0.0)
    powers = sources.withColumn("raw", raw)
    z, least_rate = powers.agg(F.sum("raw"), F.min(F.when(F.col("tokens") > 0, F.col("raw") / F.col("tokens")))).first()
    z = z or 1.0
    budget = budget_tokens if budget_tokens is not None else z / (least_rate or 1.0)
    planned = powers.withColumn("weight", F.col("raw") / F.lit(z)).withColumn("quota", F.col("weight") * F.lit(float(budget)))
    # repeats within a millionth of a whole number are that number
    repeats = F.when(F.col("tokens") > 0, F.col("quota") / F.col("tokens")).otherwise(1.0)
    planned = planned.withColumn("repeats", F.when(F.abs(repeats - F.round(repeats)) < 1e-6, F.round(repeats)).otherwise(repeats))
    planned = planned.withColumn("full", F.floor("repeats").cast("int")).withColumn("rest", (F.col("repeats") - F.col("full")) * F.col("tokens"))
    planned = materialize(planned.drop("raw"), "mix-plan")
    # the cut of the partial epoch
    partial = join_sources(rows, planned.where("rest > 0").select(_KEY, "docs", "full", "rest"), "inner")
    partial = partial.select(_KEY, "rest", "n", draw(F.col("full"), seed).alias("u")).withColumn("bucket", F.floor(F.col("u") * BUCKETS).cast("int"))
    sums = partial.groupBy(_KEY, "rest", "bucket").agg(F.sum("n").alias("n"))
    upto = sums.withColumn("before", F.sum("n").over(Window.partitionBy(_KEY).orderBy("bucket")) - F.col("n"))
    edge = upto.where("before < rest AND before + n >= rest").groupBy(_KEY).agg(F.min("bucket").alias("bucket"), F.min("before").alias("before"))
    inside = join_sources(partial, edge.withColumn("docs", F.lit(1)).withColumnRenamed("bucket", "edge"), "inner", every=True).where("bucket = edge")
    w = Window.partitionBy(_KEY).orderBy("u").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = inside.withColumn("done", F.col("before") + F.sum("n").over(w)).where("done >= rest").groupBy(_KEY).agg(F.min("u").alias("cut"))
    return materialize(planned.join(cut, _KEY, "left").select(_KEY, "docs", "tokens", "weight", "quota", "full", F.coalesce("cut", F.lit(-1.0)).alias("cut")), "mix-sources")


def join_sources(rows: DataFrame, sources: DataFrame, how: str, every: bool = False) -> DataFrame:
    """rows with their source's columns; sources go by broadcast if they are few, else the hot ones do."""
    n, docs = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("docs"), F.lit(0))).first()
    if n <= BROADCAST_SOURCES:
        out = rows.join(F.broadcast(sources), _KEY, how)
    elif every:
        out = rows.join(sources, _KEY, how)
    else:
        out = join_unique(rows, sources, [_KEY], "docs", docs, how)
    return out.drop("docs")


def mix_documents(docs: DataFrame, planned: DataFrame, seed: int = 0, epoch: str | None = "epoch") -> DataFrame:
    """docs as the plan gives them out: a row for each epoch, with all their columns and, if it has a name, the epoch's number.
    Decided row by row from the plan: texts are not shuffled."""
    inner = docs.toDF(*(f"_c{i}" for i in range(len(docs.columns))))  # so that no column of docs is taken for one of the plan's
    named = {c: F.col(f"_c{i}") for i, c in enumerate(docs.columns)}
    inner = inner.withColumns({"doc_id": named["doc_id"], "source": named["source"]})
    at = join_sources(keyed(inner), planned.select(_KEY, "docs", "full", "cut"), "inner")
    epochs = at.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("full"))))
    kept = epochs.where((F.col("_epoch") < F.col("full")) | (draw(F.col("_epoch"), seed) <= F.col("cut")))
    return kept.select(*(v.alias(c) for c, v in named.items() if c != epoch), *([F.col("_epoch").alias(epoch)] if epoch else []))


def op4_mixing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every copy that is given out: doc_id, source, epoch, n_tokens, weight (of its source),
    block and position (in the block)."""
    docs = docs.select("doc_id", "source", "text")
    planned = plan(docs)
    given = mix_documents(docs.select("doc_id", "source", n_tokens(F.col("text")).alias("n_tokens")), planned)
    given = materialize(keyed(given), "given")
    total = given.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / BLOCK_TOKENS))
    # where in its source's stream a copy starts: tokens of the epochs and buckets before, then in the bucket
    u = draw(F.col("epoch"))
    placed = given.withColumn("u", u).withColumn("bucket", F.floor(F.col("u") * BUCKETS).cast("int"))
    group = [_KEY, "epoch", "bucket"]
    sums = placed.groupBy(*group).agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("docs"))
    before = F.sum("n").over(Window.partitionBy(_KEY).orderBy("epoch", "bucket")) - F.col("n")
    sums = sums.withColumn("bucket_before", before).drop("n", "docs")
    inside = F.sum("n_tokens").over(Window.partitionBy(*group).orderBy("u", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n_tokens")
    placed = placed.withColumn("inside", inside).join(sums, group)
    weights = given.groupBy(_KEY).agg(F.sum("n_tokens").alias("given"), F.count(F.lit(1)).alias("docs"))
    weights = weights.join(planned.select(_KEY, "weight"), _KEY)
    placed = join_sources(placed, weights, "inner")
    share = (F.col("bucket_before") + F.col("inside")) / F.greatest("given", F.lit(1))
    placed = placed.withColumn("block", F.least(F.floor(share * blocks), F.lit(blocks - 1)).cast("bigint"))
    mixed = F.xxhash64(F.lit("block"), "epoch", "doc_id", _KEY)
    place = F.row_number().over(Window.partitionBy("block").orderBy(mixed, "doc_id", "epoch")) - 1
    return placed.select("doc_id", "source", "epoch", "n_tokens", "weight", "block", place.cast("bigint").alias("position"))
