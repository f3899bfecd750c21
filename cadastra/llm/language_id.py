"""Language identification by interpolated Kneser-Ney character models.

For every language in the labels one character model of order ORDER is learned: Spark
counts the n-grams of a bounded, documented sample of labelled texts (SAMPLE_DOCS whole
texts a language, drawn by a hash of doc_id), and the Kneser-Ney tables - absolute
discounts estimated from singletons and doubletons, continuation counts below the top
order - are kept as hash arrays, sorted by hash, that all languages share: one row per
n-gram with the log-probability in each language, one per context with its back-off
weight. Every whole text of the table is scored; the language with the lowest
cross-entropy per character wins. A text is rejected when that is above what held-back
labelled texts of the language show for texts of its length; a language with fewer than
LEAST_CALIBRATION of them rejects nothing, and one whose texts are all held back is learned
from these.

Characters: lower-cased letters; every run of anything else is one space.

Defined cases: a null text, or one without a letter, is `und` with score 0 and rejected;
without any labelled text every text is `und`; lang, source and doc_id never enter a
prediction; repeated rows are each scored; of languages with equal entropy the
alphabetically first wins; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, crc_mod, mix

ORDER = 4
#: Labelled texts a language that the counts use at most, and as many again for calibration.
SAMPLE_DOCS = 1200
CALIBRATION_DOCS = 400
#: Held-back texts under which nothing is known of what is usual in a language: it rejects no text.
LEAST_CALIBRATION = 5
#: A text is rejected when its cross-entropy is this many nats a character above what is
#: usual in its language, and over Z deviations for its length.
SLACK, Z = 0.9, 6.0
_CHUNK_CHARS = 400_000
_SPACE = 32


class HashArray:
    """Sorted 64-bit hashes with a directory on their first bits, and a row of values each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float32)
        self.bits = max(1, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - self.bits)
        self.starts = np.searchsorted(self.keys >> self.shift, np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.longest = int(np.diff(self.starts).max()) if len(keys) else 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The row of each hash, or -1."""
        out = np.full(len(h), -1, np.int32)
        if not len(self.keys):
            return out
        cell = (h >> self.shift).astype(np.int32)
        at, end = self.starts[cell], self.starts[cell + 1]
        live = None
        for _ in range(self.longest):
            if live is None:
                ok = (at < end) & (self.keys[np.minimum(at, len(self.keys) - 1)] == h)
                out[ok] = at[ok]
                live = np.flatnonzero(~ok & (at + 1 < end))
            else:
                ok = self.keys[at[live]] == h[live]
                out[live[ok]] = at[live[ok]]
                live = live[~ok & (at[live] + 1 < end[live])]
            if not len(live):
                break
            at[live] += 1
        return out


_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(i).isalpha() for i in range(0x110000)], bool))
    return _LETTER[0]


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' symbols one after the other, each text led by ORDER - 1 spaces; the number
    of symbols of each text without these; its number of letters."""
    lower = [(" " * (ORDER - 1) + t.lower() + " ") if t else "" for t in texts]
    size = np.array([len(t) for t in lower], np.int64)
    cp = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cp]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    ends = np.cumsum(size)
    starts = ends - size
    lead = np.zeros(len(cp) + ORDER, bool)
    has = size > 0
    for j in range(ORDER - 1):
        lead[starts[has] + j] = True
    keep |= lead[: len(cp)]
    sym = np.where(letter, cp, _SPACE).astype(np.uint64)[keep]
    total = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(letter)])
    n = total[ends] - total[starts]
    return sym, n, letters[ends] - letters[starts]


def gram_hash(parts: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(parts[0]), len(parts), np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ p) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return mix(h)


def _scored_positions(n: np.ndarray) -> np.ndarray:
    """Places of the symbols that are scored: all but each text's leading spaces."""
    ends = np.cumsum(n)
    ok = np.ones(int(n.sum()), bool)
    for j in range(ORDER - 1):
        at = (ends - n)[n > 0] + j
        ok[at] = False
    return np.flatnonzero(ok)


def count_grams(sample: DataFrame) -> DataFrame:
    """lang, the symbols of the n-gram, count."""
    names = [f"s{j}" for j in range(ORDER)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            texts = batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                sym, n, _ = characters([t for t, x in zip(texts, langs, strict=True) if x == lang])
                i = _scored_positions(n)
                grams = np.stack([sym[i - ORDER + 1 + j] for j in range(ORDER)], 1)
                h = gram_hash([grams[:, j] for j in range(ORDER)])
                _, first, count = np.unique(h, return_index=True, return_counts=True)
                g = grams[first]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), *(pa.array(g[:, j].astype(np.int32)) for j in range(ORDER)), pa.array(count)], ["lang", *names, "n"])

    schema = "lang string, " + ", ".join(f"{x} int" for x in names) + ", n bigint"
    return sample.select("lang", "text").mapInArrow(run, schema).groupBy("lang", *names).agg(F.sum("n").alias("n"))


class KneserNey:
    """Tables of all languages together."""

    def __init__(self, langs: list[str], of: np.ndarray, grams: np.ndarray, count: np.ndarray):
        self.langs = langs
        self.grams: list[HashArray] = []
        self.contexts: list[HashArray] = []
        L = len(langs)
        # counts by order: the top as they are, below the number of kinds to the left
        by_order = {ORDER: (of, grams, count)}
        for o in range(ORDER - 1, 0, -1):
            of_, g, _ = by_order[o + 1]
            rows, n = np.unique(np.column_stack([of_, g[:, 1:]]), axis=0, return_counts=True)
            by_order[o] = (rows[:, 0], rows[:, 1:], n)
        vocabulary = len(np.unique(grams)) + 1
        lower = np.full((1, L), 1.0 / vocabulary)
        lower_at = HashArray(np.zeros(1, np.uint64), np.zeros((1, 1)))
        for o in range(1, ORDER + 1):
            of_, g, n = by_order[o]
            keys = gram_hash([g[:, j].astype(np.uint64) for j in range(o)])
            ctx = gram_hash([g[:, j].astype(np.uint64) for j in range(o - 1)]) if o > 1 else np.zeros(len(g), np.uint64)
            uk, first, ki = np.unique(keys, return_index=True, return_inverse=True)
            uc, ci = np.unique(ctx, return_inverse=True)
            disc = np.zeros(L)
            for l in range(L):
                n1, n2 = (n[of_ == l] == 1).sum(), (n[of_ == l] == 2).sum()
                disc[l] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.75
            total, kinds = np.zeros((len(uc), L)), np.zeros((len(uc), L))
            np.add.at(total, (ci, of_), n)
            np.add.at(kinds, (ci, of_), 1)
            gamma = np.where(total > 0, disc * kinds / np.maximum(total, 1), 1.0)
            p = np.zeros((len(uk), L))
            np.add.at(p, (ki, of_), (n - disc[of_]) / total[ci, of_])
            head = g[first]
            suffix = lower_at.find(gram_hash([head[:, j].astype(np.uint64) for j in range(1, o)])) if o > 1 else np.zeros(len(uk), np.int32)
            p += gamma[ci[first]] * lower[suffix]
            self.grams.append(HashArray(uk, np.log(p)))
            self.contexts.append(HashArray(uc, np.log(gamma)))
            lower, lower_at = p[np.argsort(uk)], self.grams[-1]
        # an unknown symbol: what the lowest order leaves to all symbols alike
        self.unknown = (self.contexts[0].values[0] - np.log(vocabulary)).astype(np.float32)

    def log_probabilities(self, sym: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the symbols at these places, in every language."""
        part = [sym[at - ORDER + 1 + j] for j in range(ORDER)]
        out = np.zeros((len(at), len(self.langs)), np.float32)
        left = np.arange(len(at))
        for o in range(ORDER, 0, -1):
            table = self.grams[o - 1]
            tail = [x[left] for x in part[ORDER - o :]] if o < ORDER else part
            row = table.find(gram_hash(tail))
            hit = row >= 0
            out[left[hit]] += table.values[row[hit]]
            miss = ~hit
            left = left[miss]
            if not len(left):
                return out
            if o > 1:
                ctx = self.contexts[o - 1]
                crow = ctx.find(gram_hash([x[miss] for x in tail[:-1]]))
                ok = crow >= 0
                out[left[ok]] += ctx.values[crow[ok]]
        out[left] += self.unknown
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy a character in every language, scored symbols and letters, by text."""
        sym, n, letters = characters(texts)
        at = _scored_positions(n)
        scored = np.maximum(n - (ORDER - 1), 0)
        lp = self.log_probabilities(sym, at)
        ends = np.concatenate([[0], np.cumsum(scored)])
        h = np.zeros((len(texts), len(self.langs)))
        for l in range(len(self.langs)):
            sums = np.concatenate([[0.0], np.cumsum(lp[:, l], dtype=np.float64)])
            h[:, l] = -(sums[ends[1:]] - sums[ends[:-1]]) / np.maximum(scored, 1)
        return h, scored, letters


class LanguageModel:
    def __init__(self, kn: KneserNey | None):
        self.kn = kn
        self.usual = self.spread = None

    def calibrate(self, lang: np.ndarray, h: np.ndarray, n: np.ndarray) -> None:
        """The usual entropy of a language, and its variance times the length."""
        L = len(self.kn.langs)
        self.usual, self.spread = np.zeros(L), np.zeros(L)
        for l in range(L):
            x, m = h[lang == l], n[lang == l]
            if len(x) < LEAST_CALIBRATION:
                self.usual[l] = np.inf
                continue
            self.usual[l] = np.median(x)
            self.spread[l] = np.median((x - self.usual[l]) ** 2 * m) / 0.455  # 0.455: median of chi-square 1

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, rejected, cross-entropy of each text."""
        n = len(texts)
        if self.kn is None or not n:
            return ["und"] * n, np.zeros(n), np.ones(n, bool), np.zeros(n)
        h, size, letters = self.kn.entropies(texts)
        best = h.argmin(1)
        own = h[np.arange(n), best]
        gap = np.exp(-np.minimum((h - own[:, None]) * np.minimum(size, 200)[:, None], 700)).sum(1)
        excess = own - self.usual[best] - np.maximum(SLACK, Z * np.sqrt(self.spread[best] / np.maximum(size, 1)))
        score = 1 / gap / (1 + np.exp(np.clip(excess * 8, -50, 50)))
        empty = letters == 0
        names = ["und" if e else self.kn.langs[b] for e, b in zip(empty, best, strict=True)]
        return names, np.where(empty, 0.0, score), empty | (excess > 0), np.where(empty, 0.0, own)


def _samples(docs: DataFrame, wanted: Column, each: int, part: str, whole: bool = False) -> DataFrame:
    """At most about `each` labelled texts a language, by a hash of doc_id: the rate of each
    language comes from its number of labelled texts that are wanted. whole: where a language
    has none of these, from all its texts."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("wanted", wanted)
    rates = labelled.groupBy("lang").agg(F.count_if("wanted").alias("some"), F.count(F.lit(1)).alias("all"))
    none = F.col("some") == 0
    rates = rates.select("lang", none.alias("none"), (float(each) / F.when(none, F.col("all")).otherwise(F.col("some"))).alias("rate"))
    labelled = labelled.join(F.broadcast(rates), "lang").where(F.col("wanted") | F.col("none") if whole else F.col("wanted"))
    draw = F.xxhash64(F.lit(part), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) / F.lit(2.0**64) + 0.5
    return labelled.where(draw < F.col("rate")).select("lang", "text")


def fit(labelled: DataFrame) -> LanguageModel:
    """labelled: doc_id, text, lang. One in eight labelled texts calibrates, the rest count."""
    spark = labelled.sparkSession
    held = crc_mod(F.concat(F.lit("calibration "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 8) == 0
    bounded_batches(spark)
    table = count_grams(_samples(labelled, ~held, SAMPLE_DOCS, "count", whole=True)).toArrow()
    if not table.num_rows:
        return LanguageModel(None)
    names = np.array(table.column("lang").to_pylist())
    langs = sorted(set(names))
    of = np.searchsorted(np.array(langs), names)
    grams = np.column_stack([table.column(f"s{j}").to_numpy() for j in range(ORDER)]).astype(np.int64)
    model = LanguageModel(KneserNey([str(x) for x in langs], of, grams, table.column("n").to_numpy()))
    shared = spark.sparkContext.broadcast(model.kn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                b = batch.slice(k, 200)
                h, n, _ = shared.value.entropies(b.column("text").to_pylist())
                lang = np.searchsorted(np.array(shared.value.langs), np.array(b.column("lang").to_pylist()))
                lang = np.minimum(lang, len(shared.value.langs) - 1)
                yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(h[np.arange(len(n)), lang]), pa.array(n)], ["lang", "h", "n"])

    got = _samples(labelled, held, CALIBRATION_DOCS, "calibrate").mapInArrow(run, "lang int, h double, n bigint").where("n > 0").toArrow()
    model.calibrate(*(got.column(c).to_numpy() for c in ("lang", "h", "n")))
    return model


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs with lang_pred, score, rejected, cross_entropy (names that docs has are replaced)."""
    new = ["lang_pred", "score", "rejected", "cross_entropy"]
    docs = docs.drop(*new)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, n = 0, batch.num_rows
            texts = batch.column("text").to_pylist()
            size = np.cumsum([len(t) if t else 0 for t in texts])
            while i < n:
                j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + _CHUNK_CHARS, "right")))
                names, score, rejected, h = shared.value.predict(texts[i:j])
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(score), pa.array(rejected), pa.array(h)], [*part.schema.names, *new])
                i = j

    schema = T.StructType(docs.schema.fields + [T.StructField(x, t) for x, t in zip(new, (T.StringType(), T.DoubleType(), T.BooleanType(), T.DoubleType()), strict=True)])
    return docs.mapInArrow(run, schema)


def op2_language_id(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Learns from documents whose crc32(doc_id) mod 5 is not 0 and predicts all."""
    docs = docs.withColumn("held_out", crc_mod("doc_id", 5) == 0)
    model = fit(docs.where(~F.col("held_out")).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "held_out", "text"), model).drop("text")
