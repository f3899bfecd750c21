"""LM scoring with a probabilistic suffix tree over words.

Symbols are all words and the end of a text, by 64-bit hashes. Contexts of up to DEPTH
symbols are states of the tree if they occur MIN_CONTEXT times, if their longest proper
suffix is a state, and if their next-symbol distribution diverges from that suffix's: some
symbol seen MIN_SYMBOL times has a probability ratio of at least RATIO either way and a
log-likelihood gain over the pruning bound. No bound depends on the corpus: what is a state
stays one as the corpus grows. A state's distribution is interpolated with its parent's (absolute
discounting), the root's is that of the smoothed word counts. A token is scored in the longest
suffix state of what came before it in its text.

The tree is never in one place. A context and all its extensions to the left share their last
word, so the tokens of all texts are dealt once, by the word before them, and each task has
whole branches: it counts them, prunes them and scores its tokens in them. What a text gets from
the tasks is added up. A word before more than SPLIT tokens has its branch dealt on by the word
before that, each part with the counts of the one-word context, which are added up beforehand.
In a task, Spark sorts the compressed tokens by turns of about TASK tokens, and one turn at a time is
opened. A word before more than TASK tokens has turns of its own, by the word before that; the counts
of its one-word context come ahead of them.

What every task holds has a fixed size: the MOST_COUNTS most frequent words with their counts.
Of other words the count is not known where they are scored: their probability is kept as a
linear form of the root's and finished after a join with the word counts; in the divergence
test the root gives them the least probability of a word that is held.

Defined cases: null text is empty and scores its end token; a document's own repeated
rows are each scored; a null doc_id counts as the empty text for its crc32; without
training tokens every probability is that of an unseen word; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, bounded_batches, crc_mod, i64, materialize, mix, n_partitions, text_chunks, word_hashes

DEPTH = 3
MIN_CONTEXT = 2
MIN_SYMBOL = 2
RATIO = 1.05
GAIN = 6.0
DISCOUNT = 0.75
#: Words whose counts every task holds, 16 bytes each; of these the first _CODES have codes of three bytes between tasks.
MOST_COUNTS = 1 << 18
_CODES = 1 << 18
#: Tokens after one word that one task takes.
SPLIT = 1 << 22
#: Tokens whose branches are in memory together.
TASK = 1 << 19
#: Tokens that a task gathers before it sends them on.
_FLUSH = 1 << 20
_END_HASH = int(mix(np.array([0xE0D0], np.uint64))[0])
_NONE, _SPELT = 0xFFFFFE, 0xFFFFFF


def token_stream(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of all tokens, each text's words and then its end."""
    h, doc = word_hashes(ascii_lower(data), off)
    n = len(off) - 1
    ends = np.cumsum(np.bincount(doc, minlength=n))
    return np.insert(h, ends, np.uint64(_END_HASH)), np.insert(doc, ends, np.arange(n))


class SortedTable:
    """A map from 64-bit keys to values as sorted arrays."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], [v[order] for v in values]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key is, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


@dataclass
class Root:
    """What every task knows: n and kinds of the training tokens, counts of the frequent words, which of them have
    codes (their ranks), into how many parts the branches of some are dealt, how many turns a task has for words that
    share turns, and of words with several turns of their own how many and the first, which is that of their counts."""

    n: int
    kinds: int
    counts: SortedTable
    codes: SortedTable
    ranked: np.ndarray
    parts: SortedTable
    turns: int
    large: SortedTable

    @property
    def unit(self) -> float:
        return self.n + 0.1 * (self.kinds + 1)

    def known(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of words, and whether they are held."""
        at, ok = self.counts.find(words)
        return np.where(ok, self.counts.values[0][at], 0) if len(self.counts.keys) else np.zeros(len(words), np.int64), ok

    @property
    def places(self) -> int:
        """Turns of all kinds."""
        return self.turns + int(self.large.values[0].sum()) + len(self.large.keys)

    @property
    def least(self) -> float:
        """Of a word that is held; without any, of one that was never seen."""
        return ((self.counts.values[0].min() if len(self.counts.keys) else 0) + 0.1) / self.unit


def chained(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a context with one more word to its left, or of a context with a next symbol."""
    with np.errstate(over="ignore"):
        return mix(key * np.uint64(0x9E3779B97F4A7C15) + mix(word + np.uint64(1)))


def branches(root: Root, words: list[np.ndarray], length: np.ndarray, weight: np.ndarray, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, prunes and scores whole branches. words[0] are next symbols, words[k] what stands k before them, where
    `length` is k or more; weight is how often a row counts as training, `first` the same for its one-word context.
    Gives (a, b, depth): the probability of each row's symbol in its longest state is a + b * (the root's),
    where b is 0 for symbols whose counts are held."""
    count, held = root.known(words[0])
    a = np.where(held, (count + 0.1) / root.unit, 0.0)
    b = np.where(held, 0.0, 1.0)
    depth = np.zeros(len(a), np.int64)
    rows, context = np.arange(len(a)), np.zeros(len(a), np.uint64)
    for k in range(1, DEPTH + 1):
        go = length[rows] >= k
        rows, context = rows[go], context[go]
        if not len(rows):
            break
        context = chained(context, words[k][rows])
        key, at, gram = np.unique(chained(context, words[0][rows]), return_index=True, return_inverse=True)
        of, state = np.unique(context[at], return_inverse=True)
        n = np.bincount(gram, weights=(first if k == 1 and first is not None else weight)[rows], minlength=len(key))
        total = np.bincount(state, weights=n, minlength=len(of))
        kinds = np.bincount(state, weights=n > 0, minlength=len(of))
        pa_, pb = a[rows[at]], b[rows[at]]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = n / total[state] / (pa_ + pb * root.least)
            strong = ((ratio >= RATIO) | (ratio <= 1 / RATIO)) & (n >= MIN_SYMBOL) & (n * np.abs(np.log(ratio)) >= GAIN)
            is_state = (total >= MIN_CONTEXT) & (np.bincount(state, weights=strong, minlength=len(of)) > 0)
            rest = DISCOUNT * kinds / total
            ok = is_state[state]
            new_a = np.where(ok, np.maximum(n - DISCOUNT, 0) / total[state] + rest[state] * pa_, pa_)
            new_b = np.where(ok, rest[state] * pb, pb)
        a[rows], b[rows] = new_a[gram], new_b[gram]
        ok = ok[gram]
        rows, context = rows[ok], context[ok]  # a longer context is a state only if this one is
        depth[rows] = k
    return a, b, depth


# ---------------------------------------------------------------- blocks of tokens between tasks
def _planes(x: np.ndarray, width: int) -> bytes:
    """The low bytes of all numbers, then the next: the higher ones are mostly zero, and compress away."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()


def _from_planes(raw: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 4), np.uint8)
    out[:, :width] = raw.reshape(width, -1).T
    return out.view("<u4").ravel()


def pack(root: Root, words: list[np.ndarray], length: np.ndarray, row: np.ndarray, extra: np.ndarray) -> bytes:
    """Rows as compressed columns: a code of three bytes a word or its hash, the row of its text, and `extra`."""
    parts, sizes = [], [len(row)]
    for k, w in enumerate(words):
        at, ok = root.codes.find(w)
        code = np.full(len(w), _SPELT, np.uint32)
        code[ok] = root.codes.values[0][at[ok]] if ok.any() else 0
        code[length < k] = _NONE
        spelt = w[code == _SPELT]
        sizes.append(len(spelt))
        parts += [_planes(code, 3), spelt.tobytes()]
    low = int(row.min()) if len(row) else 0
    body = b"".join([*parts, _planes(row - low, 4), extra.tobytes()])
    head = np.array([*sizes, low, extra.dtype.itemsize, len(body)], np.int64).tobytes()
    return head + pa.Codec("zstd", 3).compress(body, asbytes=True)


def unpack(root: Root, block: bytes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """words, length, row and extra of a block."""
    *sizes, low, width, size = np.frombuffer(block, np.int64, DEPTH + 5).tolist()
    body = memoryview(pa.Codec("zstd").decompress(block[8 * (DEPTH + 5) :], size, asbytes=True))
    n, at = sizes[0], 0

    def take(dtype, count):
        nonlocal at
        out = np.frombuffer(body, dtype, count, at)
        at += out.nbytes
        return out

    words, length = [], np.zeros(n, np.int64)
    for k in range(DEPTH + 1):
        code, spelt = _from_planes(take(np.uint8, 3 * n), 3), take(np.uint64, sizes[k + 1])
        word = np.zeros(n, np.uint64)
        coded = code < _NONE
        word[coded] = root.ranked[code[coded]]
        word[code == _SPELT] = spelt
        words.append(word)
        if k:
            length += code != _NONE
    return words, length, _from_planes(take(np.uint8, 4 * n), 4).astype(np.int64) + low, take(np.dtype(f"<i{width}"), n)


def _bucket(root: Root, words: list[np.ndarray], length: np.ndarray, buckets: int) -> np.ndarray:
    """Where a token goes: by the word before it; of long branches by the word before that too."""
    key = mix(np.where(length >= 1, words[1], words[0]))
    at, ok = root.parts.find(words[1])
    if ok.any():
        ok &= length >= 1
        second = mix(np.where(length >= 2, words[2], np.uint64(0)) ^ np.uint64(0x5BD1E995))
        key[ok] += second[ok] % root.parts.values[0][at[ok]]
    return (key % np.uint64(buckets)).astype(np.int64)


def _turns(root: Root, words: list[np.ndarray], length: np.ndarray) -> np.ndarray:
    """In which turn of its task a token is scored: by the word before it; of large branches by the word before that too."""
    turn = (mix(np.where(length >= 1, words[1], words[0]) ^ np.uint64(0xA5A5A5A5)) >> np.uint64(20)) % np.uint64(root.turns)
    at, own = root.large.find(words[1])
    own &= length >= 1
    if own.any():
        many, first = (v[at[own]] for v in root.large.values)
        second = mix(np.where(length >= 2, words[2], np.uint64(0))[own] ^ np.uint64(0xC3C3C3C3)) >> np.uint64(20)
        turn[own] = first + 1 + (second % many.astype(np.uint64)).astype(np.int64)
    return turn.astype(np.int64)


BLOCKS = "bucket int, turn bigint, kind int, block binary"
_TOKENS, _COUNTS, _TEXTS = 0, 1, 2


def _blocks(buckets: np.ndarray, turns: np.ndarray, kind: int, make) -> pa.RecordBatch:
    """A block of the rows of each turn of each bucket. Turns are -1 or more."""
    places = int(turns.max(initial=0)) + 2
    key = buckets * places + turns + 1
    order = np.argsort(key, kind="stable")
    found, starts = np.unique(key[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    made = [make(order[i:j]) for i, j in zip(starts, ends, strict=True)]
    columns = [pa.array(found // places, pa.int32()), pa.array(found % places - 1, pa.int64()), pa.array(np.full(len(found), kind, np.int32)), pa.array(made, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "turn", "kind", "block"])


def _dealt(shared, buckets: int):
    """The tokens of all texts, in blocks by bucket, and which document each row number is."""

    def send(root, held):
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        *words, length, row, train = columns
        at, turn = _bucket(root, words, length, buckets), _turns(root, words, length)
        key = at * root.places + turn
        order = np.lexsort((words[1], key))  # equal words next to each other
        at, turn = at[order], turn[order]
        yield _blocks(at, turn, _TOKENS, lambda i: pack(root, [w[order[i]] for w in words], length[order[i]], row[order[i]], train[order[i]]))
        use = np.flatnonzero((length >= 1) & (train > 0) & root.large.find(words[1])[1] & ~root.parts.find(words[1])[1])
        if len(use):  # what comes after large words that are in one bucket each
            before, sym, n = _merged(words[1][use], words[0][use], np.ones(len(use), np.int64))
            yield _count_blocks(root, before, sym, n, (mix(before) % np.uint64(buckets)).astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        root = shared.value
        at_row = (TaskContext.get().partitionId() + 1) << 33
        held, size = [], 0
        for batch, data, off in text_chunks(batches, "text"):
            h, doc = token_stream(data, off)
            words, length = [h], np.zeros(len(h), np.int8)
            for k in range(1, DEPTH + 1):
                w = np.zeros(len(h), np.uint64)
                same = np.zeros(len(h), bool)
                w[k:], same[k:] = h[:-k], doc[k:] == doc[:-k]
                length += same
                words.append(w)
            ids = batch.column("doc_id").cast(pa.int64())
            held_out = batch.column("held_out").to_numpy(zero_copy_only=False)
            held.append((*words, length, at_row + doc, (~held_out[doc]).astype(np.int8)))
            size += len(h)
            count, held_word = root.known(h)
            base = np.where(held_word, np.log10((count + 0.1) / root.unit), 0.0)
            n_tokens, n_known, base = (np.bincount(doc, weights=x, minlength=batch.num_rows) for x in (None, held_word, base))
            null = ids.is_null().to_numpy(zero_copy_only=False)
            at = np.arange(batch.num_rows)
            texts = np.stack([at_row + at, ids.fill_null(0).to_numpy(), null * 2 + held_out, n_tokens, n_known.astype(np.int64), base.view(np.int64)])
            yield _blocks(at % buckets, np.full(len(at), -1), _TEXTS, lambda i, texts=texts: texts[:, i].tobytes())
            at_row += batch.num_rows
            if size > _FLUSH:
                yield from send(root, held)
                held, size = [], 0
        if held:
            yield from send(root, held)

    return run


def _merged(before: np.ndarray, sym: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of pairs, added up."""
    _, at, pair = np.unique(chained(before, sym), return_index=True, return_inverse=True)
    return before[at], sym[at], np.bincount(pair, weights=n, minlength=len(at)).astype(np.int64)


def _count_blocks(root: Root, before: np.ndarray, sym: np.ndarray, n: np.ndarray, to: np.ndarray) -> pa.RecordBatch:
    """Counts of next symbols of large words, for their first turn in buckets `to`."""
    none, one = np.zeros(len(n), np.uint64), np.ones(len(n), np.int64)
    words = [sym, before, *(none for _ in range(DEPTH - 1))]
    turn = root.large.values[1][root.large.find(before)[0]]
    return _blocks(to, turn, _COUNTS, lambda i: pack(root, [w[i] for w in words], one[i], one[i], n[i]))


def _split_counts(shared, buckets: int):
    """Counts of next symbols of contexts of one word that are dealt in parts: to each of the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = shared.value
        for batch in batches:
            before, sym, n = (batch.column(c).to_numpy().view(np.uint64) for c in ("before", "sym", "n"))
            at, _ = root.parts.find(before)
            parts = np.minimum(root.parts.values[0][at], np.uint64(buckets)).astype(np.int64)
            i = np.repeat(np.arange(len(at)), parts)
            part = np.arange(len(i)) - np.repeat(np.cumsum(parts) - parts, parts)
            to = ((mix(before[i]) + part.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            yield _count_blocks(root, before[i], sym[i], n[i].astype(np.int64), to)

    return run


PARTS = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, sym bigint, a double, b double"


def _scored(shared):
    """Partial sums of texts, and a row for each token whose count is not held."""

    types = {"row": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "score": pa.float64(), "sym": pa.int64(), "a": pa.float64(), "b": pa.float64()}

    def output(row, **columns):
        return pa.RecordBatch.from_arrays([columns.get(c, row if c == "row" else pa.nulls(len(row), t)) for c, t in types.items()], list(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = shared.value
        counts, of = [], -1  # what comes after the word whose turns begin at `of`
        sums, size, least = [], 0, _FLUSH
        blocks = (b for batch in batches for b in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
        for (_, turn, kind), group in groupby(blocks, key=lambda b: b[:3]):
            if kind == _TEXTS:
                for *_, block in group:
                    row, ids, flags, n_tokens, n_known, base = np.frombuffer(block, np.int64).reshape(6, -1)
                    yield output(pa.array(row), doc_id=pa.array(ids, mask=flags >= 2), held_out=pa.array(flags % 2 == 1), n_tokens=pa.array(n_tokens), n_known=pa.array(n_known), base=pa.array(base.view(np.float64)))
            elif kind == _COUNTS:
                counts, of = added_counts(root, (b[3] for b in group)), turn
            else:
                own = root.turns <= of < turn <= of + root.large.values[0][np.searchsorted(root.large.values[1], of)]
                part, rest = score_turn(root, [unpack(root, b[3]) for b in group], counts if own else [])
                if rest is not None:
                    yield rest
                sums.append(part)
                size += len(part[0])
                if size > least:  # texts that were in several turns are added up, and given out where most were in few
                    sums = [added(*(np.concatenate(x) for x in zip(*sums, strict=True)))]
                    size = len(sums[0][0])
                    if 2 * size > least:
                        yield text_sums(*sums[0])
                        sums, size = [], 0
        if sums:
            yield text_sums(*added(*(np.concatenate(x) for x in zip(*sums, strict=True))))

    def added_counts(root, blocks):
        """Counts of pairs of all blocks as one opened block."""
        held, size, least = [], 0, _FLUSH
        for block in blocks:
            words, _, _, n = unpack(root, block)
            held.append((words[1], words[0], n))
            size += len(n)
            if size > least:
                held = [_merged(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                size = len(held[0][0])
                least = max(least, 2 * size)
        before, sym, n = _merged(*(np.concatenate(x) for x in zip(*held, strict=True)))
        none = np.zeros(len(n), np.uint64)
        return [([sym, before, *(none for _ in range(DEPTH - 1))], np.ones(len(n), np.int64), np.zeros(len(n), np.int64), n)]

    def score_turn(root, tokens, counts):
        """Whole branches, or parts of one with the counts after its word: sums of texts, and tokens whose count is not held."""
        opened = tokens + counts
        words = [np.concatenate([o[0][k] for o in opened]) for k in range(DEPTH + 1)]
        length, row, weight = (np.concatenate([o[i] for o in opened]) for i in (1, 2, 3))
        token = np.arange(len(row)) < sum(len(o[1]) for o in tokens)
        split = root.large.find(words[1])[1] & token & (length >= 1)
        a, b, _ = branches(root, words, length, np.where(token, weight, 0), np.where(split, 0, weight))
        words, row, a, b = words[0][token], row[token], a[token], b[token]
        held = b == 0
        score = np.log10(np.where(held, a, 1.0))
        rest = None if held.all() else output(pa.array(row[~held]), sym=i64(words[~held]), a=pa.array(a[~held]), b=pa.array(b[~held]))
        return added(row, score), rest

    def text_sums(row, score):
        return output(pa.array(row), score=pa.array(score))

    def added(row, score):
        texts, at = np.unique(row, return_inverse=True)
        return texts, np.bincount(at, weights=score, minlength=len(texts))

    return run


# ---------------------------------------------------------------- counts
class _Sums:
    """Counts of keys over a partition, given out when they grow large and at the end."""

    def __init__(self) -> None:
        self.parts, self.size = [], 0

    def add(self, *keys: np.ndarray) -> bool:
        if len(keys) == 1:
            key, n = np.unique(keys[0], return_counts=True)
            self.parts.append((key, n))
        else:
            _, at, n = np.unique(chained(*keys), return_index=True, return_counts=True)
            self.parts.append((*(k[at] for k in keys), n))
        self.size += len(self.parts[-1][0])
        return self.size > 3_000_000

    def take(self, names: list[str]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)] if self.parts else [np.zeros(0, np.uint64) for _ in names[:-1]] + [np.zeros(0, np.int64)]
        self.parts, self.size = [], 0
        *keys, n = columns
        _, at, of = np.unique(keys[0] if len(keys) == 1 else chained(*keys), return_index=True, return_inverse=True)
        return pa.RecordBatch.from_arrays([*(i64(k[at]) for k in keys), pa.array(np.bincount(of, weights=n, minlength=len(at)).astype(np.int64))], names)


def _count(docs: DataFrame, names: list[str], columns_of) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for _, data, off in text_chunks(batches, "text"):
            if sums.add(*columns_of(data, off)):
                yield sums.take([*names, "n"])
        yield sums.take([*names, "n"])

    schema = ", ".join(f"{c} bigint" for c in [*names, "n"])
    return docs.select("text").mapInArrow(run, schema).groupBy(*names).agg(F.sum("n").alias("n"))


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _largest(rows: DataFrame, room: int) -> DataFrame:
    """The rows of the largest n, at most `room` of them, from a histogram of n."""
    level = F.floor(64 * F.log("n"))
    least = float("inf")
    for lv, many in rows.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        if many > room:
            break
        room, least = room - many, lv
    return rows.where(level >= F.lit(least))


def count_words(train: DataFrame) -> tuple[Root, DataFrame]:
    """What every task knows but the turns, and the counts of all words (code, n)."""
    counts = materialize(_count(train, ["code"], lambda d, o: token_stream(d, o)[:1]), "word-counts")
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = _largest(counts, MOST_COUNTS).toArrow()
    words, n = _column(top, "code").view(np.uint64), _column(top, "n")
    order = np.lexsort((words, -n))
    coded = words[order[:_CODES]]
    long_ = (n > SPLIT) & (words != np.uint64(_END_HASH))
    none = np.zeros(0, np.int64)
    coded_ = SortedTable(coded, np.arange(len(coded), dtype=np.uint32))
    parts = SortedTable(words[long_], (-(-n[long_] // SPLIT)).astype(np.uint64))
    return Root(int(total), int(kinds), SortedTable(words, n), coded_, coded, parts, 1, SortedTable(none.view(np.uint64), none, none)), counts


def with_turns(root: Root, docs: DataFrame, buckets: int) -> Root:
    """The turns of tasks that score all tokens of docs, as many for a byte as the training texts have."""
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    whole, learned = docs.agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in (size, F.when(~F.col("held_out"), size)))).first()
    share = whole / learned if learned else 1.0
    words, n = root.counts.keys, root.counts.values[0]
    parts = np.where(n > SPLIT, -(-n // SPLIT), 1)
    many = np.ceil(n * share / parts / TASK).astype(np.int64)
    large = ((many > 1) | (n > SPLIT)) & (words != np.uint64(_END_HASH))
    turns = 1 + int((root.n * share if learned else whole) / buckets / TASK)
    many = many[large]
    return replace(root, turns=turns, large=SortedTable(words[large], many, turns + np.cumsum(many + 1) - (many + 1)))


def score(docs: DataFrame) -> DataFrame:
    """Scores whole texts; docs has doc_id, text, held_out. Texts that are not held out are the training texts."""
    spark = docs.sparkSession
    bounded_batches(spark)
    train = docs.where(~F.col("held_out"))
    buckets = n_partitions(spark)
    root, counts = count_words(train)
    root = with_turns(root, docs, buckets)
    shared = spark.sparkContext.broadcast(root)
    blocks = docs.select("doc_id", "text", "held_out").mapInArrow(_dealt(shared, buckets), BLOCKS)
    if len(root.parts.keys):

        def after_long(data, off):
            h, doc = token_stream(data, off)
            use = np.flatnonzero((doc[1:] == doc[:-1]) & shared.value.parts.find(h[:-1])[1])
            return h[use], h[use + 1]

        split = _count(train, ["before", "sym"], after_long)
        blocks = blocks.unionByName(split.mapInArrow(_split_counts(shared, buckets), BLOCKS))
    parts = materialize(blocks.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "turn").mapInArrow(_scored(shared), PARTS), "scored")
    n = F.coalesce("n", F.lit(0))
    p0 = (n + 0.1) / F.lit(root.unit)
    rest = parts.where("sym IS NOT NULL").select("row", "sym", "a", "b").join(counts.withColumnRenamed("code", "sym"), "sym", "left")
    null = lambda t: F.lit(None).cast(t)
    finished = rest.select(
        "row", null("bigint").alias("doc_id"), null("boolean").alias("held_out"), null("bigint").alias("n_tokens"), (n > 0).cast("bigint").alias("n_known"), F.log10(p0).alias("base"), F.log10(F.col("a") + F.col("b") * p0).alias("score")
    )
    sums = parts.where("sym IS NULL").drop("sym", "a", "b").unionByName(finished).groupBy("row")
    added = sums.agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")))
    return added.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(root.n).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def op1_suffix_tree_lm(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Learns from documents whose crc32(doc_id) mod 10 is not 0 and scores all."""
    return score(docs.select("doc_id", "text", (crc_mod("doc_id", 10) == 0).alias("held_out")))
