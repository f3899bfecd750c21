"""Helpers that the corpus operators share: shared scratch tables, Arrow text
batches as flat byte arrays, vectorised word and window hashes, skew-safe joins."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles (a single longer text is handled alone).
CHUNK_BYTES = 1 << 20
#: Bytes of the rows that Spark sends to Python at a time (one longer row is sent alone).
BATCH_BYTES = 4 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


# ---------------------------------------------------------------- shared folder
def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.
    Only where it is unset (tests, single machine) a folder of our own is set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("cadastra.scratch", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="cadastra-")
        spark.conf.set("cadastra.scratch", path)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage in a way
    that outlives lost executors, and computes df once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Whole texts make Spark's default Arrow batches large, in the JVM and in Python: lowers the session's limit
    of bytes a batch to BATCH_BYTES. Results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(doc_id: Column | str, m: int) -> Column:
    """crc32(doc_id as text) mod m; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % m


# ---------------------------------------------------------------- skew-safe join
def join_unique(left: DataFrame, unique: DataFrame, keys: list[str], size: str, total: int, how: str = "left") -> DataFrame:
    """left join unique, where keys are unique in `unique` and column `size` says how many
    rows of left have them. Keys held by more than 1/200 of all rows - fewer than 200 of
    them, so a bounded broadcast - are joined by broadcast, all others by shuffle."""
    bound = max(total // 200, 1000)
    hot = F.broadcast(unique.where(F.col(size) > bound))
    cold = unique.where(F.col(size) <= bound)
    rest = [c for c in unique.columns if c not in keys]
    marked = left.join(hot.withColumn("_hot", F.lit(True)), keys, "left")
    a = marked.where(F.col("_hot")).drop("_hot")
    b = marked.where(F.col("_hot").isNull()).drop("_hot", *rest).join(cold, keys, how)
    return a.unionByName(b)


# ---------------------------------------------------------------- Arrow text batches
def flat_text(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and n+1 offsets. Null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64)[col.offset : col.offset + n + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most `limit` bytes of text, or one row."""
    for batch in batches:
        data, off = flat_text(batch.column(column))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i), data[off[i] : off[j]], off[i : j + 1] - off[i]
            i = j


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes mod 2**64 of any byte ranges of a flat array, from prefix sums;
    bytes are first sent through a random table that the seed gives."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 1):
        self.seed = seed
        pw, self.inv = self.powers(len(data) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.empty(len(data) + 1, np.uint64)
            self.sums[0] = 0
            terms = self.sums[1:]
            np.take(self.table(seed), data, out=terms, mode="clip")  # in place: fresh pages cost more than the sums
            terms *= pw[: len(data)]
            np.cumsum(terms, out=terms)

    @staticmethod
    def table(seed: int) -> np.ndarray:
        return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64((0xD1342543DE82EF95 * (2 * seed + 1)) & _MASK))

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        size = max(CHUNK_BYTES + 1, n)
        pw, inv = cls._powers.get(0, (np.zeros(0), None))
        if len(pw) < size:
            with np.errstate(over="ignore"):
                out = []
                for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                    x = np.full(size, base, np.uint64)
                    x[0] = 1
                    out.append(np.cumprod(x))
            pw, inv = out
            if size <= 4 * CHUNK_BYTES:  # tables for a single giant text are not kept
                cls._powers[0] = (pw, inv)
        return pw, inv

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.sums[end] - self.sums[start]) * self.inv[start]
            return mix(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))

    def windows(self, k: int) -> np.ndarray:
        """Of all windows of k bytes."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            return mix((self.sums[k:] - self.sums[:-k]) * self.inv[:n])


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of all words [^\\x20\\x09-\\x0D]+; words never cross texts."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | cut[1:])) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and text number of every word of the (already lower-cased) texts."""
    start, end, doc = word_bounds(data, off)
    return Rolling(data).ranges(start, end), doc


def i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else np.asarray(x, np.int64))
