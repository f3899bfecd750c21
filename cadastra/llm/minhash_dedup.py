"""MinHash near-dedup: one-permutation hashing with optimal densification.

Every text becomes the set of its distinct word shingles (64-bit hashes). One hash
permutes them into BANDS * ROWS bins; a bin keeps its minimum, an empty bin takes the
value of the first filled bin in a pseudo-random probe order of its own (optimal
densification), so that two sets agree in a bin with a probability of their Jaccard
similarity, however small they are. ROWS bins make a band; equal bands share a bucket.

At J = 0.8, 42 bands of 6 rows miss a pair with probability (1 - 0.8**6)**42 = 3e-6.

Candidate edges are stars: the members of a bucket are linked to one centre, never all pairs,
and confirmed on the full sets. Buckets whose members have come into one component are done -
further links there change nothing. In the others every pair must be tested, or a link could be
lost: their members are tested in blocks of bounded size, each two blocks by one product of
matrices, which gives out no row for a pair. Equal sets are merged before all this.

Defined cases: null or blank text has an empty set and links with nothing; repeated rows
with one doc_id are copies of each other; extra columns are ignored; an empty table gives
an empty result; a null doc_id is a component of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, bounded_batches, i64, join_unique, materialize, mix, n_partitions, text_chunks, word_hashes

BANDS, ROWS = 42, 6
BINS = BANDS * ROWS
#: Agreeing sketch bits under which a pair can be passed over: at J = 0.8 they are 0.9 of
#: 252, with a deviation of 4.8; 200 is over 5 deviations below (one such pair in a hundred million).
LEAST_AGREEING = 200
#: Members of a block, and shingles of one step of a product: what a task holds is bounded by these.
BLOCK, COLUMNS = 2048, 2048


def shingle_hashes(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (text, shingle) pairs as two arrays. Fewer than k words: one shingle."""
    h, doc = word_hashes(ascii_lower(data), off)
    n = len(off) - 1
    count = np.bincount(doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.where(count == 0, 0, np.maximum(count - k + 1, 1))
    owner = np.repeat(np.arange(n), sizes)
    at = np.repeat(first, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    length = np.minimum(count, k)[owner]
    s = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            use = length > j
            s[use] = mix(s[use] * np.uint64(0x9E3779B97F4A7C15) + h[at[use] + j] + np.uint64(1))
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    return s[new], owner[new]


def probe_order(bins: int = BINS) -> np.ndarray:
    """For each bin a pseudo-random order of all bins, the same everywhere."""
    return np.argsort(mix(np.arange(bins * bins, dtype=np.uint64) + np.uint64(0x5DEECE66D)).reshape(bins, bins), axis=1)


_PROBES = probe_order()


def signatures(s: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """n rows of BINS minima (rows of empty sets are zero)."""
    sig = np.zeros((n, BINS), np.uint64)
    full = np.zeros((n, BINS), bool)
    b = ((s >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)  # ascending with s
    new = np.ones(len(s), bool)
    new[1:] = (b[1:] != b[:-1]) | (owner[1:] != owner[:-1])
    sig[owner[new], b[new]] = s[new]
    full[owner[new], b[new]] = True
    doc, bin_ = np.nonzero(~full & full.any(1)[:, None])
    for t in range(BINS):
        if not len(doc):
            break
        src = _PROBES[bin_, t]
        ok = full[doc, src]
        sig[doc[ok], bin_[ok]] = sig[doc[ok], src[ok]]
        doc, bin_ = doc[~ok], bin_[~ok]
    with np.errstate(over="ignore"):
        return mix(sig + np.arange(BINS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


SIG_SCHEMA = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, sketch array<bigint>"


def signer(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in text_chunks(batches, "text"):
            n = batch.num_rows
            s, owner = shingle_hashes(data, off, k)
            count = np.bincount(owner, minlength=n)
            ends = np.cumsum(count)
            with np.errstate(over="ignore"):  # order-free digests of the set
                both = []
                for seed in (1, 2):
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(s + np.uint64(seed * 0x632BE59BD9B4E019 & (2**64 - 1))))])
                    both.append(mix(sums[ends] - sums[ends - count] + count.astype(np.uint64)))
            sig = signatures(s, owner, n)
            bands = np.zeros((n, BANDS), np.uint64)
            with np.errstate(over="ignore"):
                for r in range(ROWS):
                    bands = mix(bands * np.uint64(31) + sig[:, r::ROWS] + np.uint64(r))
            bits = np.zeros((n, 256), bool)
            bits[:, :BINS] = (sig >> np.uint64(63)).astype(bool)
            sketch = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    i64(count),
                    i64(both[0]),
                    i64(both[1]),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), i64(bands.ravel())),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, n * 4 + 1, 4, dtype=np.int32)), i64(sketch.ravel())),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
            )

    return run


def set_maker(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in text_chunks(batches, "text"):
            s, owner = shingle_hashes(data, off, k)
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.ListArray.from_arrays(pa.array(ends), i64(s))], ["rep", "shingles"])

    return run


def connected_components(edges: DataFrame, parts: int | None = None, max_rounds: int = 60) -> DataFrame:
    """(node, label): label is the smallest node reachable. edges: (a, b), any order.

    Each round every node takes the smallest label around it (a partial aggregation) and
    then the label of its label; rounds fall with the logarithm of the diameter.
    parts: tasks and files of the tables in between, which are far smaller than the corpus."""
    parts = parts or n_partitions(edges.sparkSession)
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both.coalesce(parts), "edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")).coalesce(parts), "labels")
    for _ in range(max_rounds):
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select("node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = step.join(up, "label", "left").select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label"))
        step = materialize(step.coalesce(parts), "labels")
        moved = step.where("old <> label").limit(1).count()
        labels = step.select("node", "label")
        if not moved:
            return labels
    raise RuntimeError("components did not settle")


def _parts(spark: SparkSession, rows: int) -> int:
    return max(1, min(n_partitions(spark), rows // 50_000))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept, n_copies (rows with
    the same set). Two texts are linked when 100 * |A & B| >= percent * |A | B|.

    k: words in a shingle. percent: 80 or more; the bands are laid out for that."""
    if percent < 80:
        raise ValueError("the bands are laid out for a similarity of 0.8 or more")
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select("doc_id", "text")
    signed = materialize(docs.mapInArrow(signer(k), SIG_SCHEMA), "signed")
    total = signed.count()
    # equal sets: one class each, named by its smallest doc_id
    classes = (
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_copies"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    )
    classes = materialize(classes, "classes")
    members = classes.select("rep", F.posexplode("bands").alias("band", "bucket"))
    crowded = members.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    turn = (F.xxhash64("rep", "band", "bucket") / F.lit(2.0**64) + 0.5).alias("turn")  # 0 to 1
    members = members.join(crowded, ["band", "bucket"]).select("band", "bucket", "size", "rep", turn)
    members = materialize(members.join(classes.select("rep", "n", "sketch"), "rep"), "members")
    sets = docs.withColumnRenamed("doc_id", "rep").join(members.select("rep").distinct(), "rep").mapInArrow(set_maker(k), "rep bigint, shingles array<bigint>")
    if signed.groupBy("doc_id").count().where("count > 1").limit(1).count():
        sets = sets.distinct()
    sets = materialize(sets, "sets")
    links = _links(members, sets, percent)
    n_links = links.count()
    labels = connected_components(links, _parts(spark, n_links)) if n_links else None
    named = classes.select("set_a", "set_b", "rep", "n_copies")
    if labels is not None:
        named = named.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("label", "rep"))
    else:
        named = named.withColumn("component", F.col("rep"))
    named = materialize(named.select("set_a", "set_b", "component", "n_copies"), "named")
    filled = signed.select("doc_id", "n_shingles", "set_a", "set_b")
    alone = filled.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(1).cast("bigint").alias("n_copies"))
    joined = join_unique(filled.where("n_shingles > 0 AND doc_id IS NOT NULL"), named, ["set_a", "set_b"], "n_copies", total)
    out = joined.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "n_copies").unionByName(alone)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes, enough of them for all components.

    First a star in each bucket, around the member that meets most others over all bands: the text that near
    copies were made from, where there is one. What is left, buckets whose members are in several components
    still, is tested in blocks."""
    bucket = ["band", "bucket"]
    meets = members.groupBy("rep").agg(F.sum("size").alias("meets"))
    live = members.join(meets, "rep")
    agree = F.lit(0)
    for i in range(4):
        agree = agree + F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("c_sketch")[i]))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    first = live.groupBy(bucket).agg(F.max(F.struct("meets", (-F.col("rep")).alias("rep"))).alias("c")).select(*bucket, (-F.col("c.rep")).alias("rep"))
    centres = live.join(first, [*bucket, "rep"]).select(*bucket, F.col("rep").alias("c"), F.col("n").alias("c_n"), F.col("sketch").alias("c_sketch"))
    alike = (100 * F.least("n", "c_n") >= percent * F.greatest("n", "c_n")) & (agree <= BINS - LEAST_AGREEING)
    near = live.join(centres, bucket).where("rep <> c").where(alike).select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b")).distinct()
    for x in ("a", "b"):
        near = near.join(sets.select(F.col("rep").alias(x), F.col("shingles").alias(f"set_{x}")), x)
    ok = 100 * shared >= percent * (F.size("set_a") + F.size("set_b") - shared)
    links = materialize(near.where(ok).select("a", "b"), "links")
    found = links.count()
    live = live.select(*bucket, "size", "rep", "n").withColumn("label", F.col("rep"))
    if found:
        now = connected_components(links, _parts(members.sparkSession, found))
        live = live.drop("label").join(now.select(F.col("node").alias("rep"), "label"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    spread = live.groupBy(bucket).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select(*bucket, "lo")
    live = live.where("size > 2").join(spread, bucket).groupBy("rep", "n", "label").agg(F.collect_set("lo").alias("near"))  # one a band at most
    live = materialize(live, "live")
    return links.unionByName(_in_blocks(live, sets, percent))


def _in_blocks(live: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): labels of linked members. Members that share buckets, directly or through others, are a cluster; its members
    are dealt into blocks, and every two blocks of a cluster are tested by one product of matrices: all pairs of a
    cluster, those of one bucket among them, without a row for each. What is given out are labels that are one."""
    least = F.array_min("near")
    each = F.concat(F.array(F.struct(F.col("label").alias("a"), least.alias("b"))), F.transform("near", lambda x: F.struct(least.alias("a"), x.alias("b"))))
    edges = materialize(live.select(F.explode(each).alias("e")).select("e.a", "e.b").where("a <> b").distinct(), "near")
    many = edges.count()
    if not many:
        return edges
    clusters = connected_components(edges, _parts(live.sparkSession, many)).select(F.col("node").alias("label"), F.col("label").alias("cluster"))
    rows = live.select("rep", "n", "label").join(clusters, "label")
    blocks = rows.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.join(sets, "rep").withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("cluster", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "label", "n", "shingles")
    return rows.groupBy("cluster", "i", "j").applyInArrow(_tested(percent), "a bigint, b bigint").distinct()


def _tested(percent: int):
    def run(table: pa.Table) -> pa.Table:
        block, label, n = (table.column(c).to_numpy() for c in ("block", "label", "n"))
        lists = table.column("shingles").combine_chunks()
        flat, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy())
        at, often = np.unique(flat, return_inverse=True, return_counts=True)[1:]
        place = np.cumsum(often > 1) - 1  # shingles of one member only are in no intersection
        both = often[at] > 1
        column, owner = place[at[both]], owner[both]
        low = np.flatnonzero(block == block.min())
        high = np.flatnonzero(block == block.max())
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        common = np.zeros((len(low), len(high)), np.float32)
        width = int(place[-1]) + 1 if len(place) else 0
        for start in range(0, width, COLUMNS):
            part = slice(*np.searchsorted(column, [start, start + COLUMNS]))
            ones = np.zeros((len(n), min(COLUMNS, width - start)), np.float32)
            ones[owner[part], column[part] - start] = 1
            common += ones[low] @ ones[high].T
        linked = 100 * common >= percent * (n[low][:, None] + n[high][None, :] - common)
        now, moved = label.copy(), True
        none = np.iinfo(np.int64).max
        while moved:  # the smallest label along links
            before = now.copy()
            now[low] = np.minimum(now[low], np.where(linked, now[high][None, :], none).min(1))
            now[high] = np.minimum(now[high], np.where(linked, now[low][:, None], none).min(0))
            moved = bool((now != before).any())
        changed = now != label
        return pa.table({"a": label[changed], "b": now[changed]})

    return run


def op10_minhash_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, k=2, percent=80)
