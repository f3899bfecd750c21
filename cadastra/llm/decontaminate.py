"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages of up to ITEM_WORDS words, the corpus into windows of
two blocks of BLOCK words, each window overlapping the next by a block. Terms are the
words of the benchmark (by 64-bit hash), weighted by their inverse document frequency
over all documents. The latent space comes from a distributed randomised SVD of the
stacked TF-IDF matrix of corpus windows and benchmark passages: tasks multiply their
rows A with a Gaussian test matrix and add up A'(A G), Spark sums the parts, and a QR and
SVD of the small range give the factors; the benchmark's rows enter with a large weight, so
that their space is kept exactly and the corpus fills up the rest.

Windows are searched for passages with a cosine of COSINE or more in that space and a
shared weight of SHARED of the passage's own. Candidates are then checked on the words:
the longest common subsequence with the text around the window must cover LCS of the
item's passage, and ANSWER of the passage's answer words must be there - what follows the
last question mark or "answer:", else its most informative words. That admits
paraphrases that drop, add or replace words, and rejects passages that share a frame only.

The benchmark is the stated query set: it is held by every task in blocks of at most
PASSAGES passages each; one scan serves BLOCKS_A_SCAN blocks (a bound on memory), and a
larger benchmark takes more scans.

Defined cases: null or empty texts and items match nothing; repeated documents and items
are each reported; an empty benchmark or table gives an empty result; items of fewer than
LEAST_WORDS words are matched only as a whole (LCS of 1); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, text_chunks, word_hashes

BLOCK = 32
ITEM_WORDS, ITEM_STRIDE = 64, 48
LEAST_WORDS = 8
EXTRA_RANK = 32
COSINE, SHARED, LCS, ANSWER = 0.5, 0.35, 0.6, 0.5
PASSAGES = 256
BLOCKS_A_SCAN = 16


class TermIndex:
    """Finds hashes among sorted terms by their first SLOT_BITS bits; where several terms share them, by bisection."""

    SLOT_BITS = 18

    def __init__(self, terms: np.ndarray):
        self.terms, self.shift = terms, np.uint64(64 - self.SLOT_BITS)
        slot = (terms >> self.shift).astype(np.int64)
        self.first = np.zeros(1 << self.SLOT_BITS, np.int32)
        self.first[slot] = np.arange(len(terms), dtype=np.int32)
        self.crowded = np.bincount(slot, minlength=1 << self.SLOT_BITS) > 1

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers of the hashes that are terms, and where they were."""
        slot = (h >> self.shift).astype(np.int32)
        at = self.first[slot]
        if (crowd := np.flatnonzero(self.crowded[slot])).size:
            at[crowd] = np.minimum(np.searchsorted(self.terms, h[crowd]), len(self.terms) - 1)
        ok = np.flatnonzero(self.terms[at] == h)
        return at[ok].astype(np.int64), ok


class Passages:
    """A block of benchmark passages: their terms, weights and place in the latent space."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.words, self.answers = [], [], []
        answer_starts = []
        for item, text in zip(ids, texts, strict=True):
            data = ascii_lower(np.frombuffer(text.encode(), np.uint8))
            h, _ = word_hashes(data, np.array([0, len(data)]))
            lower = data.tobytes()
            mark = max(lower.rfind(b"?") + 1, lower.rfind(b"answer:") + 7 if b"answer:" in lower else 0)
            tail = len(lower[mark:].split()) if mark else 0
            for a in range(0, max(1, len(h) - (ITEM_WORDS - ITEM_STRIDE)), ITEM_STRIDE):
                part = h[a : a + ITEM_WORDS]
                if len(part):
                    self.ids.append(item)
                    self.words.append(part)
                    answer_starts.append(len(part) - min(tail, len(part)) if tail and a + ITEM_WORDS >= len(h) else len(part))
        self.answer_starts = answer_starts
        self.terms = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, np.uint64)
        self.weights = np.ones(len(self.terms))
        self.index: TermIndex | None = None

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers of the words that are terms, and where they were."""
        if self.index is None:  # made where it is used, not sent
            self.index = TermIndex(self.terms)
        return self.index.find(h)

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        self.weights = np.maximum(np.log((n_docs + 1) / (df + 1)), 0.0)
        rows = np.zeros((len(self.words), len(self.terms)))
        self.answers = []
        for i, w in enumerate(self.words):
            t = np.unique(np.searchsorted(self.terms, w))
            rows[i, t] = self.weights[t]
            tail = w[self.answer_starts[i] :]
            if not len(tail):  # the most informative words, a fifth and two at least
                k = max(2, len(t) // 5)
                tail = self.terms[t[np.argsort(-self.weights[t], kind="stable")[:k]]]
            self.answers.append(set(tail.tolist()))
        self.rows = rows
        self.norms = np.sqrt((rows**2).sum(1))

    def factor(self, corpus: np.ndarray | None) -> None:
        """The latent basis: orthonormal columns over the terms."""
        parts = [self.rows.T]
        if corpus is not None and corpus.size:
            parts.append(corpus / max(1e-9, np.abs(corpus).max()) * 1e-3)
        q, r = np.linalg.qr(np.concatenate(parts, 1))
        u, s, _ = np.linalg.svd(r, full_matrices=False)
        keep = s > s[0] * 1e-6 if len(s) and s[0] > 0 else np.zeros(len(s), bool)
        self.basis = (q @ u[:, keep]).astype(np.float32)
        self.weighted = self.basis * self.weights[:, None].astype(np.float32)
        self.points = (self.rows @ self.basis).astype(np.float32)
        self.point_norms = np.sqrt((self.points**2).sum(1))


def blocks_of(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each text's number of words, first word and first block; each block's text."""
    count = np.bincount(doc, minlength=n)
    blocks = -(-count // BLOCK)
    return count, np.cumsum(count) - count, np.cumsum(blocks) - blocks, np.repeat(np.arange(n), blocks)


def weighty_terms(p: Passages, h: np.ndarray, doc: np.ndarray, layout: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(block, term) of all words that are terms with a weight, with repeats."""
    _, first_word, first_block, _ = layout
    term, where = p.find(h)
    use = p.weights[term] > 0
    term, where = term[use], where[use]
    return first_block[doc[where]] + (where - first_word[doc[where]]) // BLOCK, term


def distinct(p: Passages, block: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = np.unique(block * len(p.terms) + term)
    return code // len(p.terms), code % len(p.terms)


def _document_frequencies(docs: DataFrame, passages: list[Passages]) -> tuple[list[np.ndarray], int]:
    terms = np.unique(np.concatenate([p.terms for p in passages]))
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, index = shared.value, TermIndex(shared.value)
        df, rows = np.zeros(len(terms), np.int64), 0
        for batch, data, off in text_chunks(batches, "text", 1 << 20):
            h, doc = word_hashes(ascii_lower(data), off)
            at, ok = index.find(h)
            if batch.num_rows * len(terms) <= 1 << 25:  # a small table is faster than sorting
                there = np.zeros((batch.num_rows, len(terms)), bool)
                there[doc[ok], at] = True
                df += there.sum(0)
            else:
                df += np.bincount(np.unique(doc[ok] * len(terms) + at) % len(terms), minlength=len(terms))
            rows += batch.num_rows
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], rows))], ["term", "n"])

    got = docs.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = got.column("term").to_numpy(), got.column("n").to_numpy()
    df = np.zeros(len(terms), np.int64)
    df[term[term >= 0]] = n[term >= 0]
    return [df[np.searchsorted(terms, p.terms)] for p in passages], int(n[term < 0].sum())


def _corpus_ranges(docs: DataFrame, passages: list[Passages]) -> list[np.ndarray]:
    """A'(A G) of all corpus windows that do not overlap, for each block of passages. A task's part
    has (terms x EXTRA_RANK) numbers, whatever its share of the corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(passages)

    def test_matrix(p: Passages) -> np.ndarray:
        return np.random.default_rng(7).standard_normal((len(p.terms), EXTRA_RANK)) * p.weights[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = shared.value
        tests = [test_matrix(p).astype(np.float32) for p in passages]
        out = [np.zeros((len(p.terms), EXTRA_RANK)) for p in passages]
        for batch, data, off in text_chunks(batches, "text"):
            h, doc = word_hashes(ascii_lower(data), off)
            for p, g, y in zip(passages, tests, out, strict=True):
                block, term = distinct(p, *weighty_terms(p, h, doc, blocks_of(h, doc, batch.num_rows)))
                if not len(block):
                    continue
                new = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
                rows = np.add.reduceat(g[term], new, 0)
                size = np.diff(np.append(new, len(block)))
                by_term = np.argsort(term, kind="stable")
                t = term[by_term]
                first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
                y[t[first]] += np.add.reduceat(rows[np.repeat(np.arange(len(new)), size)[by_term]], first, 0)
        for b, y in enumerate(out):
            at = np.flatnonzero(np.abs(y).any(1))
            if len(at):
                ends = np.arange(0, len(at) * EXTRA_RANK + 1, EXTRA_RANK, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([b] * len(at), pa.int32()), pa.array(at), pa.ListArray.from_arrays(pa.array(ends), pa.array(y[at].ravel()))], ["b", "term", "y"])

    parts = docs.select("text").mapInArrow(run, "b int, term bigint, y array<double>")
    sums = parts.groupBy("b", "term").agg(*(F.sum(F.col("y")[i]).alias(f"y{i}") for i in range(EXTRA_RANK))).toArrow()
    out = []
    for b, p in enumerate(passages):
        y = np.zeros((len(p.terms), EXTRA_RANK))
        mine = sums.column("b").to_numpy() == b
        y[sums.column("term").to_numpy()[mine]] = np.column_stack([sums.column(f"y{i}").to_numpy()[mine] for i in range(EXTRA_RANK)])
        out.append(y * p.weights[:, None])
    return out


def lcs_length(a: list[int], b: list[int]) -> int:
    """Longest common subsequence, a bit of one integer for each word of a."""
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        m = places.get(w)
        if m:
            x = row & m
            row = ((row + x) | (row - x)) & full
    return len(a) - row.bit_count()


def search(p: Passages, h: np.ndarray, doc: np.ndarray, n: int) -> Iterator[tuple[int, int, float, float, float]]:
    """(text, item, cosine, LCS share, answer share) of all confirmed windows."""
    layout = count, first_word, first_block, owner = blocks_of(h, doc, n)
    block, term = weighty_terms(p, h, doc, layout)
    if not len(block) or not len(p.ids):
        return
    # no window with less weight than this, repeats counted, can share enough with any passage
    weight = np.bincount(block, weights=p.weights[term] ** 2, minlength=len(owner))
    pair = np.sqrt(weight)
    pair[:-1] += np.where(owner[1:] == owner[:-1], np.sqrt(weight[1:]), 0)
    hopeful = pair >= SHARED * p.norms.min()
    need = hopeful.copy()
    need[1:] |= hopeful[:-1]
    use = need[block]
    block, term = distinct(p, block[use], term[use])
    if not len(block):
        return
    new = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    have = block[new]
    z = np.add.reduceat(p.weighted[term], new, 0)
    at = np.full(len(owner) + 1, -1)
    at[have] = np.arange(len(have))
    windows = np.flatnonzero(hopeful)
    for k in range(0, len(windows), 4096):
        w = windows[k : k + 4096]
        zw = np.where((at[w] >= 0)[:, None], z[at[w]], 0)
        nxt = np.append(owner, -1)[w + 1] == owner[w]
        second = (at[w + 1] >= 0) & nxt
        zw = zw + np.where(second[:, None], z[at[w + 1]], 0)
        dots = zw @ p.points.T
        cos = dots / np.maximum(p.point_norms * np.sqrt((zw**2).sum(1))[:, None], 1e-9)
        ok = (cos >= COSINE) & (dots >= SHARED * p.norms**2)
        for i, j in zip(*np.nonzero(ok), strict=True):
            d = owner[w[i]]
            q = p.words[j].tolist()
            a = first_word[d] + (w[i] - first_block[d]) * BLOCK
            lo, hi = max(first_word[d], a - len(q)), min(first_word[d] + count[d], a + 2 * BLOCK + len(q))
            around = h[lo:hi].tolist()
            share = lcs_length(q, around) / len(q)
            if share < (LCS if len(q) >= LEAST_WORDS else 1.0):
                continue
            there = set(around)
            answer = sum(x in there for x in p.answers[j]) / len(p.answers[j])
            if answer >= ANSWER:
                yield int(d), p.ids[j], float(cos[i, j]), share, answer


def _groups(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items, in portions that a task may hold."""
    items = benchmark.where("text IS NOT NULL").select("item_id", "text").orderBy("item_id", "text")
    portion: list[tuple[int, str]] = []
    for row in items.toLocalIterator():
        portion.append((row[0], row[1]))
        if len(portion) >= PASSAGES // 2 * BLOCKS_A_SCAN:
            yield portion
            portion = []
    if portion:
        yield portion


def _fitted(docs: DataFrame, portion: list[tuple[int, str]]) -> list[Passages]:
    blocks: list[list[tuple[int, str]]] = [[]]
    size = 0
    for item in portion:
        n = 1 + len(item[1].split()) // ITEM_STRIDE
        if size + n > PASSAGES and blocks[-1]:
            blocks.append([])
            size = 0
        blocks[-1].append(item)
        size += n
    passages = [Passages([i for i, _ in b], [t for _, t in b]) for b in blocks]
    passages = [p for p in passages if len(p.terms)]
    if not passages:
        return []
    frequencies, n_docs = _document_frequencies(docs, passages)
    for p, df in zip(passages, frequencies, strict=True):
        p.weigh(df, n_docs)
    for p, y in zip(passages, _corpus_ranges(docs, passages), strict=True):
        p.factor(y)
    return passages


HITS = "doc_id bigint, item_id bigint, cosine double, lcs_share double, answer_share double"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id) of every document that holds a benchmark item, with its best window's
    cosine, LCS share and answer share."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    out = spark.createDataFrame([], HITS)
    for portion in _groups(benchmark):
        passages = _fitted(docs, portion)
        if not passages:
            continue
        shared = spark.sparkContext.broadcast(passages)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch, data, off in text_chunks(batches, "text"):
                h, doc = word_hashes(ascii_lower(data), off)
                best: dict[tuple[int, int], tuple] = {}
                for p in shared.value:
                    for d, item, *found in search(p, h, doc, batch.num_rows):
                        key = (d, item)
                        best[key] = max(best.get(key, ()), (found[1], found[2], found[0]))
                if best:
                    rows = np.array([d for d, _ in best], np.int64)
                    ids = batch.column("doc_id").cast(pa.int64()).take(pa.array(rows))
                    lcs, answer, cos = (pa.array([v[i] for v in best.values()], pa.float64()) for i in range(3))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([i for _, i in best], pa.int64()), cos, lcs, answer], ["doc_id", "item_id", "cosine", "lcs_share", "answer_share"])

        out = out.unionByName(docs.mapInArrow(run, HITS))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold a benchmark item."""
    spark = docs.sparkSession
    schema = T.StructType(docs.schema.fields)
    for portion in _groups(benchmark):
        passages = _fitted(docs, portion)
        if not passages:
            continue
        shared = spark.sparkContext.broadcast(passages)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch, data, off in text_chunks(batches, "text"):
                h, doc = word_hashes(ascii_lower(data), off)
                keep = np.ones(batch.num_rows, bool)
                for p in shared.value:
                    for d, *_ in search(p, h, doc, batch.num_rows):
                        keep[d] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, schema)
    return docs


def op5_decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs, benchmark)
