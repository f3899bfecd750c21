"""Token ids as length-delimited binary records.

A record file is a run of frames: uint64 length | masked CRC-32C of those 8 bytes |
payload | masked CRC-32C of the payload, all little-endian (the public TFRecord frame).
A payload is one document's ids as little-endian uint16, or uint32 where the
vocabulary has more than 65,536 ids. A separate offset index (Parquet) names for each
document its file, byte offset, length, place and first token, so that a reader can
open records in any order.

Documents are range-partitioned by doc_id; each task writes one file under a name that
only its attempt has, and the index, which Spark commits, names only files of tasks that
ended well: a lost executor or a repeated task leaves files that nothing points to.

Defined cases: null text counts as empty and gives a record of the end id alone;
documents with one doc_id are ordered among themselves by their row's place in its
partition; null doc_ids come first; an empty table writes no record and gives no rows.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, n_partitions, scratch_path, text_chunks

END_ID = 1
_CRC_BLOCK = 64
_MASK_DELTA = 0xA282EAD8


# ---------------------------------------------------------------- CRC-32C over many records
def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0x82F63B78), t >> 1)
    return t


_T = _crc_table()


def _shift_tables(n: int) -> np.ndarray:
    """4 x 256: what n zero bytes make of each byte of a CRC state."""
    state = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]).astype(np.uint32)
    done = 0
    out = state.copy()
    step, size = None, 1
    while n >> done:  # square and multiply on the linear map
        if step is None:
            step = _T[state & 255] ^ (state >> 8)
        if (n >> done) & 1:
            out = _apply(step, out)
        step = _apply(step, step)
        done, size = done + 1, size * 2
    return out


def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & 255] ^ tables[1][(x >> 8) & 255] ^ tables[2][(x >> 16) & 255] ^ tables[3][x >> 24]


_SHIFT_BLOCK = _shift_tables(_CRC_BLOCK)
_POWER_SHIFTS: dict[int, np.ndarray] = {}


def crc32c(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """CRC-32C of each record data[off[i]:off[i+1]], all records at once."""
    size = np.diff(off)
    blocks = -(-size // _CRC_BLOCK)
    first = np.concatenate([[0], np.cumsum(blocks)])
    flat = np.zeros(first[-1] * _CRC_BLOCK, np.uint8)  # zeros before a record don't change a zero state
    flat[np.repeat(first[1:] * _CRC_BLOCK - off[1:], size) + np.arange(off[0], off[-1])] = data[off[0] : off[-1]]
    flat = flat.reshape(-1, _CRC_BLOCK)
    c = np.zeros(len(flat), np.uint32)
    for j in range(_CRC_BLOCK):
        c = _T[(c ^ flat[:, j]) & 255] ^ (c >> 8)
    state = np.zeros(len(size), np.uint32)
    order = np.argsort(-blocks, kind="stable")
    for j in range(int(blocks.max()) if len(blocks) else 0):
        order = order[: int(np.searchsorted(-blocks[order], -j, "left"))]
        state[order] = _apply(_SHIFT_BLOCK, state[order]) ^ c[first[order] + j]
    ones = np.full(len(size), 0xFFFFFFFF, np.uint32)
    for bit in range(int(size.max()).bit_length() if len(size) else 0):
        if bit not in _POWER_SHIFTS:
            _POWER_SHIFTS[bit] = _shift_tables(1 << bit)
        has = (size >> bit) & 1 == 1
        ones[has] = _apply(_POWER_SHIFTS[bit], ones[has])
    return state ^ ones ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    c = crc.astype(np.uint32)
    with np.errstate(over="ignore"):
        return ((c >> np.uint32(15)) | (c << np.uint32(17))) + np.uint32(_MASK_DELTA)


# ---------------------------------------------------------------- tokenizing
class Encoder:
    """Encodes texts with a tokenizer file that drops white space, through tables of what
    this worker has met lately (two generations of bounded size; when the newer is
    full it becomes the older, so that frequent words stay). A word goes through
    the whole tokenizer, or, if it is Latin letters and at most one mark after them - which
    its normalizer only lower-cases and its splitter parts - straight through the model. Of such words
    the lower-cased letters alone are kept, as most new words differ from old ones in case or mark only."""

    MOST_WORDS, MOST_STEMS = 120_000, 200_000
    _PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)\\Z")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # the byte alphabet of byte-level models: printable bytes as they are, others from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.marks = {m: array("I", self.tokenizer.encode(m, add_special_tokens=False).ids).tobytes() for m in ".,;:!?"} | {"": b""}
        self.known: dict[str, bytes] = {}  # ids as uint32
        self.older: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}
        self.older_stems: dict[str, bytes] = {}

    def stem(self, letters: str) -> bytes:
        """The ids of lower-cased letters that are not in the newer generation."""
        got = self.older_stems.get(letters)
        if got is None:
            shown = letters if letters.isascii() else "".join(map(self.letters.__getitem__, letters.encode()))
            got = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        if len(self.stems) >= self.MOST_STEMS:
            self.stems, self.older_stems = {}, self.stems
        self.stems[letters] = got
        return got

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of each word."""
        match, marks, stems, table = self._PLAIN.match, self.marks, self.stems, []
        for w in words:
            if plain := match(w):
                letters, mark = plain.groups()
                letters = letters.lower()
                got = stems.get(letters)
                if got is None:
                    got, stems = self.stem(letters), self.stems
                table.append(got + marks[mark] if mark else got)
                continue
            got = self.known.get(w)
            if got is None:
                got = self.older.get(w)
                if got is None:
                    got = array("I", self.tokenizer.encode(w, add_special_tokens=False).ids).tobytes()
                if len(self.known) >= self.MOST_WORDS:
                    self.known, self.older = {}, self.known
                self.known[w] = got
            table.append(got)
        return table

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by `end`, and n+1 offsets."""
        n = len(texts)
        words = pc.split_pattern_regex(texts.fill_null(""), "[ \\n\\t\\r]+")
        coded = words.flatten().dictionary_encode()
        table = self.words(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        begin = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(table), np.uint32)
        code = coded.indices.to_numpy(zero_copy_only=False)
        per_word = sizes[code]
        counts = np.diff(words.offsets.to_numpy())
        word_ends = np.concatenate([[0], np.cumsum(per_word)])
        upto = word_ends[np.concatenate([[0], np.cumsum(counts)])]
        ids = flat[np.repeat(begin[code] - word_ends[:-1], per_word) + np.arange(word_ends[-1])]
        off = upto + np.arange(n + 1)
        out = np.full(off[-1], end, np.uint32)
        keep = np.ones(off[-1], bool)
        keep[off[1:] - 1] = False
        out[keep] = ids
        return out, off


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------- files
def _store(uri: str):
    from pyarrow import fs

    if "://" not in uri:
        uri = ("file://" if uri.startswith("/") else "") + uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


INDEX_SCHEMA = "doc_id bigint, file string, part int, nth bigint, offset bigint, length bigint, n_tokens bigint"
FRAME = 16


def write_records(docs: DataFrame, folder: str, tokenizer: str, end: int = END_ID, partitions: int | None = None) -> DataFrame:
    """Writes record files and the offset index under `folder`; gives the index as read back."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(tokenizer)
        kind = np.dtype("<u2" if enc.vocab_size <= 65536 else "<u4")
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
        store, path = _store(folder)
        out, at, nth = None, 0, 0
        try:
            for batch, _, _ in text_chunks(batches, "text", 4 << 20):  # the larger, the more words repeat
                if out is None:
                    store.create_dir(path, recursive=True)
                    out = store.open_output_stream(f"{path}/{name}")
                ids, off = enc.encode(batch.column("text"), end)
                size = np.diff(off) * kind.itemsize
                payload = ids.astype(kind).view(np.uint8)
                n = len(size)
                head = size.astype("<u8").view(np.uint8)
                head_crc = masked(crc32c(head, np.arange(0, 8 * n + 1, 8))).astype("<u4").view(np.uint8).reshape(n, 4)
                body_crc = masked(crc32c(payload, off * kind.itemsize)).astype("<u4").view(np.uint8).reshape(n, 4)
                start = np.cumsum(size + FRAME) - size - FRAME
                frames = np.zeros(int((size + FRAME).sum()), np.uint8)
                frames[start[:, None] + np.arange(8)] = head.reshape(n, 8)
                frames[start[:, None] + np.arange(8, 12)] = head_crc
                frames[np.repeat(start + 12 - off[:-1] * kind.itemsize, size) + np.arange(len(payload))] = payload
                frames[(start + 12 + size)[:, None] + np.arange(4)] = body_crc
                out.write(frames.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array([name] * n), pa.array(np.full(n, part, np.int32)), pa.array(nth + np.arange(n)), pa.array(at + start), pa.array(size + FRAME), pa.array(np.diff(off))],
                    ["doc_id", "file", "part", "nth", "offset", "length", "n_tokens"],
                )
                at, nth = at + len(frames), nth + n
        finally:
            if out is not None:
                out.close()

    ordered = docs.select("doc_id", "text").repartitionByRange(partitions or n_partitions(spark), "doc_id").sortWithinPartitions("doc_id")
    index = materialize(ordered.mapInArrow(run, INDEX_SCHEMA), "record-lengths")
    # ids before each file: one row a file
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = files.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    in_file = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("nth")) - F.col("n_tokens")
    placed = index.withColumn("in_file", in_file).join(before, "part").withColumn("start", F.col("before") + F.col("in_file")).drop("before", "in_file")
    placed.write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def _verified(batches: Iterator[pa.RecordBatch], folder: str, kind: np.dtype) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(index rows, their ids one after the other, offsets in ids), records read and checksums verified.
    Reads are sequential where the index rows of a batch are in file order."""
    store, path = _store(folder)
    name, source = None, None
    for big in batches:
        for k in range(0, big.num_rows, 1000):
            batch = big.slice(k, 1000)
            raw = []
            for f, at, size in zip(batch.column("file").to_pylist(), batch.column("offset").to_pylist(), batch.column("length").to_pylist(), strict=True):
                if f != name:
                    if source is not None:
                        source.close()
                    name, source = f, store.open_input_file(f"{path}/{f}")
                source.seek(at)
                raw.append(source.read(size))
            size = np.array([len(x) for x in raw], np.int64)
            data = np.frombuffer(b"".join(raw), np.uint8)
            start = np.cumsum(size) - size
            n = len(raw)
            head = data[start[:, None] + np.arange(8)]
            length = np.ascontiguousarray(head).view("<u8").ravel().astype(np.int64)
            if (length != size - FRAME).any():
                raise ValueError("a record's length disagrees with the index")
            take = lambda at, w: np.ascontiguousarray(data[at[:, None] + np.arange(w)])
            off = np.concatenate([[0], np.cumsum(length)])
            body = data[np.repeat(start + 12 - off[:-1], length) + np.arange(off[-1])]
            if (take(start + 8, 4).view("<u4").ravel() != masked(crc32c(head.ravel(), np.arange(0, 8 * n + 1, 8)))).any():
                raise ValueError("a record's length fails its checksum")
            if (take(start + 12 + length, 4).view("<u4").ravel() != masked(crc32c(body, off))).any():
                raise ValueError("a record fails its checksum")
            yield batch, body.view(kind), off // kind.itemsize


def _kind(vocab_size: int) -> np.dtype:
    return np.dtype("<u2" if vocab_size <= 65536 else "<u4")


_PLACES = ["doc_id", "start", "file", "offset", "length"]


def read_records(index: DataFrame, folder: str, vocab_size: int = 49408) -> DataFrame:
    """doc_id, start, n_tokens, ids of every record that the index names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, off in _verified(batches, folder, _kind(vocab_size)):
            lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(off)), lists], ["doc_id", "start", "n_tokens", "ids"])

    return index.select(_PLACES).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids array<int>")


def record_checks(index: DataFrame, folder: str, vocab_size: int = 49408) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian uint32, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, off in _verified(batches, folder, _kind(vocab_size)):
            wide = ids.astype("<u4")
            crc = [zlib.crc32(wide[off[i] : off[i + 1]]) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(off)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return index.select(_PLACES).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op7_token_records(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Encodes whole texts, appends the end id, writes the records in ascending doc_id
    order and answers from the files as read back."""
    folder = scratch_path(spark, "records")
    tokenizer = tokenizer or default_tokenizer()
    index = write_records(docs, folder, tokenizer)
    return record_checks(index, folder, encoder(tokenizer).vocab_size)  # the width of ids that was written
