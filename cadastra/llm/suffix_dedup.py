"""Suffix-array dedup: bytes covered by a LENGTH-byte string that also starts elsewhere go.

Sorting the suffixes at every byte would send some LENGTH bytes for each byte of text, so
the sorted suffixes are those at anchors. An anchor is the place, in some window of LENGTH
bytes, of its smallest-hashed SEED-byte string (the first of equals); which place that is
follows from the window's bytes alone. So two equal windows have anchors at the same place
in them, and every repeated window is found from a repeated anchor string:

1. Anchors of all texts, as (hash of SEED bytes, text, place). Those whose hash occurs once
   (counting equal texts once) go no further.
2. Each task sorts its anchors' suffixes - LENGTH bytes to the right, and with them the
   LENGTH - SEED bytes to the left - into runs, front-codes each run against its own
   predecessor, and sends it to the bucket of the anchor's hash.
3. Each bucket merges its runs with a loser tree that knows common prefixes: a contender
   carries the length it shares with the last output, so only bytes beyond the shared
   part are ever compared, and every output comes with its common prefix with the one
   before - the LCP array of the sparse suffix array.
4. In a class of equal anchor strings, x reaches l bytes to the left and r to the right
   along with y; all of it is repeated if l + r >= LENGTH. The bytes of x's windows that
   are repeated are those from its longest such l to its longest such r. Small classes are
   compared pair by pair over the LCP array; larger ones by their windows' contents, in
   time linear in the class.

Classes of more than HOT anchors are never put in one task: their windows' hashes (128
bits) are counted by an aggregation of Spark's, in the same terms. Equal texts stand for
each other: only one of them is sorted, and a text with a copy goes whole if it has
LENGTH bytes.

Defined cases: null text is empty (0 bytes, nothing removed, hash of the empty string);
texts under LENGTH bytes lose nothing; occurrences may overlap, also themselves; rows with
one doc_id and different texts are told apart by the text; equal rows are copies of each
other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Rolling, i64, join_unique, materialize, mix, n_partitions, scratch_path, text_chunks

LENGTH = 400
SEED = 200
#: Anchors of one hash that a task may hold: 600 bytes each, and some 10 KB each while they are compared.
HOT = 20_000
#: Classes up to this size are compared pair by pair.
PAIRS = 8
#: Anchors in a run.
RUN = 20_000


# ---------------------------------------------------------------- anchors
def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of w values, from block-wise running minima both ways."""
    n = len(x)
    if n < w:
        return x[:0]
    blocks = -(-n // w)
    pad = np.full(blocks * w, np.iinfo(x.dtype).max, x.dtype)
    pad[:n] = x
    pad = pad.reshape(blocks, w)
    ahead = np.minimum.accumulate(pad, 1).ravel()
    back = np.minimum.accumulate(pad[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Places of all anchors in the flat texts, and the hashes of their strings."""
    h = Rolling(data).windows(seed)
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    least = (sliding_min(key, length - seed + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text_end = np.repeat(off[1:], np.diff(off))[: len(least)]
    least = least[np.arange(len(least)) + length <= text_end]
    at = least[np.concatenate([[True], least[1:] != least[:-1]])] if len(least) else least  # they never go back
    return at, h[at]


ANCHOR_SCHEMA = "doc_id bigint, da bigint, db bigint, n_bytes bigint, sha string, places array<int>, hashes array<bigint>"


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, off in text_chunks(batches, "text"):
        n = batch.num_rows
        at, h = anchors(data, off)
        doc = np.searchsorted(off, at, "right") - 1
        ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int32)
        digests = [hashlib.sha256(data[a:b]) for a, b in pairwise(off)]
        both = np.frombuffer(b"".join(d.digest()[:16] for d in digests), np.int64).reshape(n, 2)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(both[:, 0]),
                pa.array(both[:, 1]),
                pa.array(np.diff(off)),
                pa.array([d.hexdigest() for d in digests]),
                pa.ListArray.from_arrays(pa.array(ends), pa.array((at - off[doc]).astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(ends), i64(h)),
            ],
            ["doc_id", "da", "db", "n_bytes", "sha", "places", "hashes"],
        )


# ---------------------------------------------------------------- front-coded runs
def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, of which `start` bytes are known."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    lo, step = start, 16
    while a[lo : lo + step] == b[lo : lo + step]:
        lo += step
        step *= 2
    while step > 1:
        step //= 2
        if a[lo : lo + step] == b[lo : lo + step]:
            lo += step
    return lo


def front_code(rows: list[tuple]) -> bytes:
    """rows: sorted (right, left, text number, place). Each is stored without the prefix that it
    shares with the row before."""
    shared, right, left, of, place = [], [], [], [], []
    last = b""
    for r, l, d, p in rows:
        k = common_prefix(last, r)
        shared.append(k)
        right.append(r[k:])
        left.append(l)
        of.append(d)
        place.append(p)
        last = r
    batch = pa.RecordBatch.from_arrays(
        [pa.array(shared, pa.int16()), pa.array(right, pa.binary()), pa.array(left, pa.binary()), pa.array(of, pa.int64()), pa.array(place, pa.int32())],
        ["shared", "right", "left", "of", "place"],
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_run(run: bytes) -> Iterator[tuple[bytes, int, bytes, int, int]]:
    """(right, prefix shared with the row before, left, text number, place) in order."""
    for batch in pa.ipc.open_stream(run):
        last = b""
        for k, r, l, d, p in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            last = last[:k] + r
            yield last, k, l, d, p


def merge(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Rows of all runs in order, each with its common prefix with the row before: a loser
    tree of contenders that carry the prefix which they share with the last output."""
    k = len(runs)
    rows: list = [None] * k
    known = [0] * k

    def beats(a: int, b: int) -> bool:
        """Whether contender a comes before b; the loser's known prefix becomes that with the winner."""
        if rows[a] is None or rows[b] is None:
            return rows[a] is not None
        if known[a] != known[b]:
            return known[a] > known[b]  # the longer shared prefix is the smaller; no bytes compared
        x, y = rows[a][0], rows[b][0]
        c = common_prefix(x, y, known[a])
        first = x[c : c + 1] < y[c : c + 1] or (c == len(x) == len(y) and a < b)
        known[b if first else a] = c
        return first

    for i, run in enumerate(runs):
        rows[i] = next(run, None)
    size = 1
    while size < k:
        size *= 2
    losers: list = [None] * size
    level: list = [*range(k), *[None] * (size - k)]
    node = size
    while len(level) > 1:  # play the first tournament from the leaves
        node //= 2
        up = []
        for j in range(0, len(level), 2):
            a, b = level[j], level[j + 1]
            if a is None or b is None:
                win, lose = (a, b) if b is None else (b, a)
            else:
                win, lose = (a, b) if beats(a, b) else (b, a)
            losers[node + j // 2] = lose
            up.append(win)
        level = up
    top = level[0]
    while top is not None and rows[top] is not None:
        row = rows[top]
        yield row[0], known[top], row[2], row[3], row[4]
        nxt = rows[top] = next(runs[top], None)
        known[top] = nxt[1] if nxt is not None else 0
        at = (size + top) // 2
        while at:
            rival = losers[at]
            if rival is not None and not beats(top, rival):
                losers[at], top = top, rival
            at //= 2


# ---------------------------------------------------------------- classes
_SIDE = LENGTH - SEED
_CONTENT = Rolling.table(21)


def _reaches_by_content(members: list[tuple]) -> list[tuple[int, int]]:
    """Longest left and right reach of each member of a large class, from the hashes of its windows:
    one row a member, one column for each distance of a window's start before the anchor."""
    m = len(members)
    text = b"".join(x[2][::-1].rjust(_SIDE, b"\0") + x[0].ljust(LENGTH, b"\0") for x in members)
    flat = np.frombuffer(text, np.uint8).reshape(m, _SIDE + LENGTH)
    with np.errstate(over="ignore"):
        sums = np.zeros((m, _SIDE + LENGTH + 1), np.uint64)
        np.cumsum(_CONTENT[flat] * Rolling.powers(_SIDE + LENGTH)[0][: _SIDE + LENGTH], axis=1, out=sums[:, 1:])
        h = sums[:, LENGTH : LENGTH + _SIDE + 1] - sums[:, : _SIDE + 1]  # windows that start _SIDE, ..., 0 bytes before
    before = np.arange(_SIDE, -1, -1)
    left = np.array([len(x[2]) for x in members])
    right = np.array([len(x[0]) for x in members])
    valid = (before <= left[:, None]) & (LENGTH - before <= right[:, None])
    h = np.where(valid, mix(h), np.arange(m, dtype=np.uint64)[:, None])  # no twin of an invalid window
    order = np.argsort(h, axis=0, kind="stable")
    ranked, ok = np.take_along_axis(h, order, 0), np.take_along_axis(valid, order, 0)
    twin = np.zeros((m, _SIDE + 1), bool)
    same = (ranked[1:] == ranked[:-1]) & ok[1:] & ok[:-1]
    twin[1:] |= same
    twin[:-1] |= same
    found = np.zeros_like(twin)
    np.put_along_axis(found, order, twin, 0)
    some = found.any(1)
    first, last = found.argmax(1), _SIDE - found[:, ::-1].argmax(1)
    return [(int(before[a]), LENGTH - int(before[z])) if x else (0, 0) for x, a, z in zip(some, first, last, strict=True)]


def reaches(members: list[tuple]) -> Iterator[tuple[int, int, int]]:
    """Repeated bytes (text number, start, end) around the anchors of one class, given in suffix
    order as (right, prefix shared with the one before, left, text number, place)."""
    m = len(members)
    if m < 2:
        return
    if m <= PAIRS:
        best = [[0, 0] for _ in range(m)]
        for i in range(m):
            r = LENGTH
            for j in range(i + 1, m):
                r = min(r, members[j][1])
                l = common_prefix(members[i][2], members[j][2])
                if l + r >= LENGTH:
                    for x in (best[i], best[j]):
                        x[0], x[1] = max(x[0], l), max(x[1], r)
    else:
        best = _reaches_by_content(members)
    for (_, _, _, d, p), (l, r) in zip(members, best, strict=True):
        if r:
            yield d, p - l, p + r


def bucket_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All runs of a partition's buckets: merged, split into classes, resolved."""
    runs = [x.as_py() for b in batches for x in b.column("run")]
    out: list[tuple[int, int, int]] = []
    members: list[tuple] = []

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["uid", "start", "end"])

    for row in merge([read_run(r) for r in runs]):
        if row[1] < SEED and members:
            out.extend(reaches(members))
            members = []
            if len(out) > 50_000:
                yield batch()
                out.clear()
        members.append(row)
    out.extend(reaches(members))
    yield batch()


# ---------------------------------------------------------------- the operator
def _run_writer(buckets: int):
    """(uid, text, places, hashes, hot) -> one front-coded run for each bucket and some thousand anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            got = [(t, front_code(sorted(x))) for t, x in rows.items()]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array([t for t, _ in got], pa.int32()), pa.array([r for _, r in got], pa.binary())], ["bucket", "run"])

        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py().encode()
                uid = batch.column("uid")[i].as_py()
                for p, h in zip(batch.column("places")[i].as_py(), batch.column("hashes")[i].as_py(), strict=True):
                    left = text[max(0, p - (LENGTH - SEED)) : p][::-1]
                    rows.setdefault(h % buckets, []).append((text[p : p + LENGTH], left, uid, p))
                    held += 1
                if held >= RUN:
                    yield flush()
                    held = 0
        if rows:
            yield flush()

    return run


def _hot_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window around the anchors of large classes, as two hashes."""
    for batch, data, off in text_chunks(batches, "text"):
        one, two = Rolling(data, 1), Rolling(data, 2)
        for i in range(batch.num_rows):
            at = []
            for p in batch.column("places")[i].as_py():
                lo, hi = max(0, p - (LENGTH - SEED)), min(p, int(off[i + 1] - off[i]) - LENGTH)
                at.append(np.arange(lo, hi + 1))
            w = np.unique(np.concatenate(at)) if at else np.zeros(0, np.int64)
            if len(w):
                s = w + off[i]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("uid")[i].as_py()] * len(w), pa.int64()), pa.array(w), i64(one.ranges(s, s + LENGTH)), i64(two.ranges(s, s + LENGTH))], ["uid", "start", "wa", "wb"])


FINAL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) -> what is left."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            text = (batch.column("text")[i].as_py() or "").encode()
            merged: list[list[int]] = []
            for s in sorted((x["start"], x["end"]) for x in batch.column("spans")[i].as_py()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            kept = hashlib.sha256()
            at = 0
            for a, b in merged:
                kept.update(text[at:a])
                at = b
            kept.update(text[at:])
            out.append((batch.column("doc_id")[i].as_py(), len(text), sum(b - a for a, b in merged), len(merged), kept.hexdigest()))
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def dealt_texts(docs: DataFrame) -> DataFrame:
    """The texts of LENGTH bytes or more with `sha` and `place`, the doc_id as a number (0 for null), in a table that
    is bucketed by both: texts go through one exchange, joins on both columns read them where they are."""
    spark = docs.sparkSession
    n, name = n_partitions(spark), f"dealt_texts_{uuid.uuid4().hex}"
    place, sha = F.coalesce("doc_id", F.lit(0)).cast("bigint"), F.sha2(F.col("text").cast("binary"), 256)
    long = docs.where(F.octet_length("text") >= LENGTH).select(place.alias("place"), sha.alias("sha"), "doc_id", "text")
    long.repartition(n, "place", "sha").write.bucketBy(n, "place", "sha").format("parquet").option("path", scratch_path(spark, "dealt-texts")).saveAsTable(name)
    return spark.table(name)


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, spans, dealt): texts has a row per row of docs with its digest, uid (of the one text that
    stands for its equals) and number of copies; spans has (uid, start, end), overlapping; dealt is of dealt_texts."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    dealt = dealt_texts(docs)
    scanned = materialize(docs.mapInArrow(scan, ANCHOR_SCHEMA), "anchors")
    total = scanned.count()
    plain = scanned.select("doc_id", "da", "db", "n_bytes", "sha")
    # equal texts: the smallest doc_id stands for them; its number is a digest of both
    groups = plain.groupBy("da", "db").agg(F.min("doc_id").alias("rep"), F.first("sha").alias("sha"), F.count(F.lit(1)).alias("copies"))
    groups = materialize(groups.withColumn("uid", F.xxhash64("da", "db")), "texts")
    each = scanned.select("da", "db", F.explode(F.arrays_zip("places", "hashes")).alias("x")).select("da", "db", F.col("x.places").alias("place"), F.col("x.hashes").alias("hash"))
    spot = F.xxhash64("da", "db", "place")  # equal texts have equal spots
    shared = each.groupBy("hash").agg(F.min(spot).alias("lo"), F.max(spot).alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi")
    shared = materialize(shared.select("hash", "size"), "shared-anchors")
    reps = groups.select("da", "db", "rep")
    own = scanned.join(reps, ["da", "db"]).where(F.col("doc_id").eqNullSafe(F.col("rep"))).select("da", "db", F.explode(F.arrays_zip("places", "hashes")).alias("x"))
    own = own.select("da", "db", F.col("x.places").alias("place"), F.col("x.hashes").alias("hash"))  # 28 bytes an anchor go through the exchange
    n_anchors = shared.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    lists = (
        join_unique(own, shared, ["hash"], "size", max(n_anchors, 1), "inner")
        .groupBy("da", "db")
        .agg(
            F.collect_set(F.when(F.col("size") <= HOT, F.struct("place", "hash"))).alias("cool"),
            F.collect_set(F.when(F.col("size") > HOT, F.col("place"))).alias("hot"),
        )
    )
    lists = lists.join(groups, ["da", "db"]).select("uid", F.coalesce("rep", F.lit(0)).cast("bigint").alias("place"), "sha", "cool", "hot")
    lists = materialize(lists, "anchor-lists")
    texts = dealt.join(lists, ["place", "sha"]).select("uid", "text", "cool", "hot")
    buckets = max(n_partitions(spark), int(n_anchors * 2 * LENGTH) >> 25)
    runs = texts.where(F.size("cool") > 0).select("uid", "text", F.col("cool.place").alias("places"), F.col("cool.hash").alias("hashes"))
    runs = runs.mapInArrow(_run_writer(buckets), "bucket int, run binary")
    spans = runs.repartition(buckets, "bucket").mapInArrow(bucket_ranges, "uid bigint, start bigint, end bigint")
    spans = materialize(spans, "spans")
    if lists.where(F.size("hot") > 0).limit(1).count():
        windows = texts.where(F.size("hot") > 0).select("uid", "text", F.col("hot").alias("places")).mapInArrow(_hot_windows, "uid bigint, start bigint, wa bigint, wb bigint")
        windows = materialize(windows, "hot-windows")
        counted = windows.groupBy("wa", "wb").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        n_windows = windows.count()
        hot = join_unique(windows, counted, ["wa", "wb"], "size", n_windows, "inner").select("uid", "start", (F.col("start") + LENGTH).alias("end"))
        spans = spans.unionByName(hot)
    return join_unique(plain, groups.drop("sha"), ["da", "db"], "copies", total), spans, dealt


def op9_suffix_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    texts, spans, dealt = repeated_spans(docs)
    texts = materialize(texts, "sized-texts")
    by_text = spans.groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    single = texts.where("copies = 1").join(by_text, "uid", "left")
    single = materialize(single, "single-texts")
    whole = F.col("copies").__gt__(1) & (F.col("n_bytes") >= LENGTH)
    kept = F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("sha"))

    def plain(df: DataFrame) -> DataFrame:
        return df.select("doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(0).alias("n_removed"), F.when(whole, 1).otherwise(0).cast("bigint").alias("n_spans"), kept.alias("kept_sha256"))

    touched = single.where("spans IS NOT NULL").select(F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("place"), "sha", "spans")
    rows = dealt.join(touched, ["place", "sha"])
    cut = rows.select("doc_id", "text", "spans").mapInArrow(_cut, FINAL)
    return plain(texts.where("copies > 1")).unionByName(plain(single.where("spans IS NULL"))).unionByName(cut)
