"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 32 bytes cuts every text where its top CUT_BITS bits are
zero, at least LEAST and at most MOST bytes after the cut before. A cut depends on the
bytes just before it alone, so an insertion moves the cuts around it and no others.
Chunks are compared by a 128-bit digest; of equal chunks the first one (by doc_id, then
place) stays. A later chunk is removed where it stands in a run of later chunks of
MIN_RUN bytes or more, so that short phrases that recur by chance stay.

Chunks of one digest are never gathered: the first of each comes from a partial
aggregation, and digests that many rows share are joined by a bounded broadcast.

Defined cases: null text is empty (no chunks, nothing removed); a chunk repeated inside one
text is removed there too; rows with one doc_id are told apart by a hash of their text, and
of wholly equal rows neither is the later one; null doc_ids come first; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Rolling, i64, join_unique, materialize, mix, text_chunks

LEAST, MOST, CUT_BITS = 16, 256, 5
MIN_RUN = 96
_WINDOW = 32
_GEAR = (mix(np.arange(1000, 1256, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The 32-bit gear hash after each byte: h = 2 * h + GEAR[byte], all at once by doubling."""
    h = _GEAR[data]
    span = 1
    while span < _WINDOW:
        nxt = h.copy()
        nxt[span:] += h[:-span] << np.uint32(span)
        h, span = nxt, 2 * span
    return h


def cuts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of all chunks of the flat texts."""
    may = np.flatnonzero(gear(data) >> np.uint32(32 - CUT_BITS) == 0) + 1 if len(data) else np.zeros(0, np.int64)
    starts, ends, owner = [], [], []
    first = np.searchsorted(may, off[:-1] + _WINDOW)  # the window lies in the text
    last = np.searchsorted(may, off[1:])
    for i in range(len(off) - 1):
        at, end = int(off[i]), int(off[i + 1])
        for c in may[first[i] : last[i]].tolist():
            while c - at > MOST:
                starts.append(at)
                ends.append(at + MOST)
                owner.append(i)
                at += MOST
            if c - at >= LEAST:
                starts.append(at)
                ends.append(c)
                owner.append(i)
                at = c
        while at < end:
            c = min(end, at + MOST)
            starts.append(at)
            ends.append(c)
            owner.append(i)
            at = c
    return np.array(starts, np.int64), np.array(ends, np.int64), np.array(owner, np.int64)


CHUNK_SCHEMA = "doc_id bigint, tid bigint, start array<int>, size array<smallint>, da array<bigint>, db array<bigint>"


def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text, with its chunks' places, sizes and digests."""
    for batch, data, off in text_chunks(batches, "text"):
        s, e, doc = cuts(data, off)
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))]).astype(np.int32))
        columns = [
            pa.array((s - off[doc]).astype(np.int32)) if len(s) else pa.array([], pa.int32()),
            pa.array((e - s).astype(np.int16)),
            i64(Rolling(data, 11).ranges(s, e)),
            i64(Rolling(data, 12).ranges(s, e)),
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), batch.column("tid"), *(pa.ListArray.from_arrays(ends, c) for c in columns)],
            ["doc_id", "tid", "start", "size", "da", "db"],
        )


def chunk_decisions(docs: DataFrame) -> DataFrame:
    """For each text that has a later chunk: doc_id, tid and its later chunks (start, size).

    Chunks whose first 64 bits of digest occur once go before anything wider is shuffled."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tid", F.xxhash64("text"))
    chunked = materialize(texts.mapInArrow(chunk, CHUNK_SCHEMA), "chunks")
    often = chunked.select(F.explode("da").alias("da")).groupBy("da").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    often = materialize(often, "repeated-halves")
    total = often.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    x = F.explode(F.arrays_zip("start", "size", "da", "db")).alias("x")
    each = chunked.select("doc_id", "tid", x).select("doc_id", "tid", (F.col("x.start") * F.lit(512).cast("bigint") + F.col("x.size")).alias("at"), F.col("x.da").alias("da"), F.col("x.db").alias("db"))
    chunks = materialize(join_unique(each, often, ["da"], "copies", max(total, 1), "inner").drop("copies"), "repeated-chunks")
    # a number that orders chunks within 64 bits is not at hand: the first text, then the first place in it
    nowhere = F.lit(-(2**63))
    firsts = chunks.groupBy("da", "db").agg(F.min(F.coalesce("doc_id", nowhere)).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    copies = join_unique(chunks, materialize(firsts, "first-chunks"), ["da", "db"], "copies", max(total, 1), "inner")
    copies = copies.withColumn("own", F.col("doc_id").eqNullSafe(F.nullif("first", nowhere)))
    # within the first text, its first place stays
    inside = copies.where("own").groupBy("da", "db").agg(F.min(F.struct("tid", "at")).alias("home"))
    own = copies.where("own").join(inside, ["da", "db"]).where(F.struct("tid", "at") != F.col("home"))
    later = copies.where("NOT own").select("doc_id", "tid", "at").unionByName(own.select("doc_id", "tid", "at"))
    places = F.transform(F.array_sort(F.collect_set("at")), lambda a: F.struct(F.shiftright(a, 9).cast("int").alias("start"), (a % 512).cast("int").alias("size")))
    return later.groupBy("doc_id", "tid").agg(places.alias("later"))


def repeated_spans(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, tid, spans (start, end in bytes) of the texts that lose something."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            later = batch.column("later")
            ends = later.offsets.to_numpy() - later.offsets[0].as_py()
            flat = later.flatten()
            s = flat.field("start").to_numpy().astype(np.int64)
            e = s + flat.field("size").to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != e[:-1]) | (row[1:] != row[:-1])
            a = np.flatnonzero(new)
            b = np.append(a[1:], len(s)) - 1
            long = e[b] - s[a] >= min_run if len(a) else np.zeros(0, bool)
            a, b = a[long], b[long]
            per = np.concatenate([[0], np.cumsum(np.bincount(row[a], minlength=batch.num_rows))]).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(s[a].astype(np.int32)), pa.array(e[b].astype(np.int32))], ["start", "end"])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tid"), pa.ListArray.from_arrays(pa.array(per), spans)], ["doc_id", "tid", "spans"])

    found = chunk_decisions(docs).mapInArrow(run, "doc_id bigint, tid bigint, spans array<struct<start:int,end:int>>")
    return found.where(F.size("spans") > 0)


def _border(raw: Column, at: Column, step: int) -> Column:
    """`at`, or the next place before or after it, as `step` is -1 or 1, where no character of UTF-8 is cut."""
    inside = lambda k: F.hex(F.substring(raw, at + k * step + 1, F.lit(1))).between("80", "BF")
    return F.when(~inside(0), at).when(~inside(1), at + step).when(~inside(2), at + 2 * step).otherwise(at + 3 * step)


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs with the repeated bytes taken out of text. Spans are in bytes of UTF-8; a cut inside
    a character leaves that character's other bytes out too."""
    docs = docs.withColumn("_tid", F.xxhash64(F.coalesce("text", F.lit(""))))
    marks = spans.select(F.col("doc_id").alias("_id"), F.col("tid").alias("_t"), F.col("spans").alias("_spans"))
    joined = docs.join(marks, docs.doc_id.eqNullSafe(marks._id) & (docs._tid == marks._t), "left")
    raw = F.col("text").cast("binary")
    bounds = F.concat(F.array(F.lit(0)), F.flatten(F.transform("_spans", lambda x: F.array(_border(raw, x["start"], -1), _border(raw, x["end"], 1)))), F.array(F.length(raw)))
    places = F.sequence(F.lit(0), F.size(bounds) - 2, F.lit(2))
    parts = F.transform(places, lambda i: F.substring(raw, F.get(bounds, i) + 1, F.greatest(F.get(bounds, i + 1) - F.get(bounds, i), F.lit(0))))
    kept = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p))
    return joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(kept.cast("string"))).drop("_tid", "_id", "_t", "_spans")


def op6_chunk_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: n_bytes, n_removed, n_spans and the removed spans (start, end)."""
    sizes = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).select("doc_id", F.octet_length("t").cast("bigint").alias("n_bytes"), F.xxhash64("t").alias("tid"))
    spans = repeated_spans(docs).withColumnRenamed("doc_id", "id").withColumnRenamed("tid", "t")
    joined = sizes.join(spans, sizes.doc_id.eqNullSafe(spans.id) & (sizes.tid == spans.t), "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.coalesce("spans", none)
    removed = F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return joined.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size(spans).cast("bigint").alias("n_spans"), spans.alias("spans"), (removed == 0).alias("kept_whole"))
