"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is a set of terms, the words [^\\x20\\x09-\\x0D]+ as they are, each with its count as weight. Sample j of a term k with
weight w has r and c from Gamma(2, 1) and b from U(0, 1), all three drawn by hashes of (k, j) alone:

    t = floor(ln w / r + b)        ln a = ln c - r (t - b + 1)

The pair (k, t) with the least a is the text's sample j, so that two texts agree in it with the probability of their
generalised Jaccard similarity, sum of min(w, w') over sum of max(w, w'). A fingerprint is the hashes of SAMPLES such pairs in
hexadecimal; the likeness of two is the share of equal places.

`fingerprints` takes any rows with a text. `with_next` puts each document beside the next one by doc_id: documents are dealt
once into buckets that quantiles of doc_id bound, and the first of each bucket goes into the bucket before as well, so that no
row needs to look past its bucket. All that follows (words, counts, samples, the next document's fingerprint) keeps that
partitioning: the texts are shuffled once, nothing else is.

Defined cases: null text is empty; a text without words has the empty fingerprint, which has likeness 1 with another empty one and
0 with all others; equal texts have equal fingerprints; null doc_ids come first; rows with equal doc_ids follow each
other by text and are documents of their own; the only document of a table is followed by itself; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Samples of a fingerprint. The standard error of a likeness is 0.07 at most.
SAMPLES = 56
#: Samples taken from one row at a time: the generated code stays small enough to be compiled.
STRIDE = 4
#: See least_samples; a sample misses its least term with a chance of e**-TAIL.
TAIL = 28.0
#: Documents that a bucket has, or more where there would be more than MOST_BUCKETS.
BUCKET_DOCS = 250
MOST_BUCKETS = 40_000
_WORD_GAPS = r"[\x20\x09-\x0D]+"
_LOW = 0xFFFFFFFF


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _WORD_GAPS), lambda w: w != "")


# ---------------------------------------------------------------- samples
def _uniform(h: Column, high: bool) -> Column:
    bits = F.shiftrightunsigned(h, 32) if high else h.bitwiseAND(F.lit(_LOW))
    return (bits + F.lit(0.5)) * F.lit(2.0**-32)


def least_samples(counts: DataFrame, keys: list[str], weights: list[str]) -> DataFrame:
    """counts: (keys, term, weights..., totals...), a row for each term of a document; a weight is null where a text lacks the term,
    <weight>_total is the sum of a text's weights. Gives (keys, and for each weight an array of its samples), for documents
    with a term.

    A term's a is Exp(w), so the least of a text with total n is over TAIL / n with a chance of e**-TAIL. As y e**r >= w and
    c >= 1 - u u', a term can be under that only if (1 - u u') v v' <= TAIL w / n, with the uniforms u, u' of c and v, v' of r: one
    product that spares three of four terms the logarithms."""
    starts = F.explode(F.array(*(F.lit(i) for i in range(0, SAMPLES, STRIDE))))
    limit = F.greatest(*(F.col(w) * TAIL / F.col(f"{w}_total") for w in weights), F.lit(0.0))  # nulls are passed over
    slots = counts.select(*keys, "term", limit.alias("_limit"), *(F.ln(w).alias(w) for w in weights), starts.alias("_from"))
    slots = slots.withColumns({f"_h{i}": F.xxhash64("term", F.col("_from") + i) for i in range(STRIDE)})
    slots = slots.withColumns({f"_g{i}": F.xxhash64(f"_h{i}") for i in range(STRIDE)})
    drawn = {}
    for i in range(STRIDE):
        v, u = (_uniform(F.col(h), True) * _uniform(F.col(h), False) for h in (f"_h{i}", f"_g{i}"))
        near = (1 - u) * v <= F.col("_limit")
        drawn |= {f"_r{i}": F.when(near, -F.ln(v)), f"_c{i}": F.when(near, F.ln(-F.ln(u)))}
    slots = slots.withColumns(drawn)

    def sample(w: str, i: int) -> Column:
        """ln a, to 2**-23, in the upper half and a hash of (term, j, t) in the lower: the least is the text's sample."""
        h, g, r, log_c = (F.col(f"_{x}{i}") for x in "hgrc")
        b = _uniform(F.xxhash64(g), True)
        t = F.floor(F.col(w) / r + b)
        order = ((log_c - r * (t - b + 1) + 128) * F.lit(2.0**23)).cast("long")  # ln a is in (-93, 4)
        return F.when(r.isNotNull(), F.shiftleft(order, 32).bitwiseOR(F.xxhash64(h, t).bitwiseAND(F.lit(_LOW))))

    part = slots.groupBy(*keys, "_from").agg(*(F.min(sample(w, i)).alias(f"{w}_{i}") for w in weights for i in range(STRIDE)))
    parts = F.array_sort(F.collect_list(F.struct("_from", *(F.array(*(f"{w}_{i}" for i in range(STRIDE))).alias(w) for w in weights))))
    whole = part.groupBy(*keys).agg(parts.alias("_parts"))
    return whole.select(*keys, *(F.flatten(F.col("_parts")[w]).alias(w) for w in weights))


def as_text(samples: Column) -> Column:
    """The fingerprint of samples; of a text without words, the empty one."""
    return F.concat_ws("", F.transform(F.filter(F.coalesce(samples, F.array().cast("array<bigint>")), lambda s: s.isNotNull()), lambda s: F.lpad(F.lower(F.hex(s.bitwiseAND(F.lit(_LOW)))), 8, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Share of the places of two fingerprints that agree; two empty ones are alike, an empty one and another are not."""
    at = F.array(*(F.lit(1 + 8 * i) for i in range(SAMPLES)))
    same = F.size(F.filter(at, lambda i: F.substr(a, i, F.lit(8)) == F.substr(b, i, F.lit(8)))) / SAMPLES
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(same)


def fingerprints(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, fingerprint) of the rows whose text has a word; keys are unique."""
    split = rows.select(key, words(F.col(text)).alias("_words"))
    each = split.select(key, F.size("_words").alias("w_total"), F.explode("_words").alias("_word")).select(key, "w_total", F.xxhash64("_word").alias("term"))
    counts = each.groupBy(key, "w_total", "term").agg(F.count(F.lit(1)).alias("w"))
    return least_samples(counts, [key], ["w"]).select(key, as_text(F.col("w")).alias("fingerprint"))


# ---------------------------------------------------------------- documents and the next ones
def _bounds(docs: DataFrame) -> tuple[list[int], int | None, bool]:
    """Quantiles of doc_id (MOST_BUCKETS at most, values that occur), the least one, and whether there are nulls."""
    n, least, nulls = docs.agg(F.count(F.lit(1)), F.min("doc_id"), F.coalesce(F.bool_or(F.col("doc_id").isNull()), F.lit(False))).first()
    k = min(MOST_BUCKETS, math.ceil(n / BUCKET_DOCS))
    if k < 2 or least is None:
        return [], least, nulls
    found = docs.agg(F.percentile_approx("doc_id", [i / k for i in range(1, k)], max(10_000, 4 * k))).first()[0]
    return sorted({x for x in found if x > least}), least, nulls


def with_next(docs: DataFrame) -> DataFrame:
    """(bucket, place, guest, doc_id, text, next): docs (doc_id, text) with the text that follows; a guest is the first of the
    bucket after, there to be looked at only."""
    bounds, least, nulls = _bounds(docs.select("doc_id"))
    wide = max(1, math.isqrt(len(bounds)))
    rows = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
    doc_id = F.col("doc_id")
    longs = lambda x: F.array(*(F.lit(v) for v in x)).cast("array<bigint>")
    # how many bounds are at most doc_id: first whole rows of them, then those of one row
    full = F.size(F.filter(longs([r[0] for r in rows]), lambda b: b <= doc_id))
    inner = F.get(F.array(*(longs(r) for r in rows)).cast("array<array<bigint>>"), full - 1)
    bucket = F.when(doc_id.isNull() | (full == 0), 0).otherwise((full - 1) * wide + F.size(F.filter(inner, lambda b: b <= doc_id)))
    first_of_all = doc_id.isNull() if nulls else doc_id == F.lit(least)
    place = lambda b, wraps, guest: F.struct(b.cast("int").alias("bucket"), F.lit(wraps).alias("wraps"), F.lit(guest).alias("guest"))
    opens = F.array_contains(longs(bounds), doc_id) if len(bounds) <= wide else F.array_contains(inner, doc_id)
    places = F.array_compact(F.array(
        place(F.col("_b"), False, False),
        F.when(F.coalesce(F.col("_opens"), F.lit(False)), place(F.col("_b") - 1, False, True)),
        F.when(first_of_all, place(F.lit(len(bounds)), True, True)),
    ))
    dealt = docs.select("doc_id", "text", bucket.alias("_b"), opens.alias("_opens")).select("doc_id", "text", F.explode(places).alias("p"))
    # the filter, which Spark would infer for one side of a join only, keeps the exchange the same for both: it is done once
    dealt = dealt.select("p.bucket", "p.wraps", "p.guest", "doc_id", "text").where("bucket IS NOT NULL")
    order = Window.partitionBy("bucket").orderBy("wraps", F.col("doc_id").asc_nulls_first(), "text", "guest")
    followed = dealt.withColumns({"place": F.row_number().over(order), "next": F.lead("text").over(order)})
    return followed.select("bucket", "place", "guest", "doc_id", "text", "next")


def op12_weighted_sampling(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: a row for each document. The
    edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next document's."""
    texts = with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next", F.lit(1), half))
    texts = texts.withColumn("edited", F.coalesce(edited, F.col("text")))
    key = ["bucket", "place"]
    sides = ["own", "changed"]
    split = texts.select(*key, words(F.col("text")).alias("own"), words(F.col("edited")).alias("changed"))
    totals = [F.size(w).alias(f"{w}_total") for w in sides]
    both = F.array(*(F.struct(F.lit(s).alias("s"), F.col(w).alias("w")) for s, w in enumerate(sides)))
    each = split.select(*key, *totals, F.explode(both).alias("t")).select(*key, *(f"{w}_total" for w in sides), F.col("t.s").alias("s"), F.explode("t.w").alias("word"))
    each = each.select(*key, *(f"{w}_total" for w in sides), "s", F.xxhash64("word").alias("term"))
    counts = each.groupBy(*key, *(f"{w}_total" for w in sides), "term").agg(*(F.nullif(F.count_if(F.col("s") == s), F.lit(0)).alias(w) for s, w in enumerate(sides)))
    found = least_samples(counts, key, sides)
    whole = texts.select(*key, "guest", "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256")).join(found, key, "left")
    whole = whole.withColumns({"fingerprint": as_text(F.col("own")), "edited_fingerprint": as_text(F.col("changed"))})
    whole = whole.withColumn("after", F.lead("fingerprint").over(Window.partitionBy("bucket").orderBy("place")))
    out = whole.where("NOT guest").withColumn("after", F.coalesce("after", "fingerprint"))
    near = {"near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint")), "near_next": likeness(F.col("fingerprint"), F.col("after"))}
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *(v.alias(k) for k, v in near.items()))
