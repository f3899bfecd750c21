"""Every operator against a brute-force version on a small corpus with nulls, blanks, copies and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import (
    chunk_dedup,
    decontaminate,
    exact_dedup,
    language_id,
    line_dedup,
    minhash_dedup,
    mixing,
    suffix_dedup,
    suffix_tree_lm,
    token_records,
)

from .fixture import SCHEMA, crc, documents, texts, words

OPERATORS = {
    1: suffix_tree_lm.op1_suffix_tree_lm,
    2: language_id.op2_language_id,
    3: exact_dedup.op3_exact_dedup,
    4: mixing.op4_mixing,
    6: chunk_dedup.op6_chunk_dedup,
    7: token_records.op7_token_records,
    8: line_dedup.op8_line_dedup,
    9: suffix_dedup.op9_suffix_dedup,
    10: minhash_dedup.op10_minhash_dedup,
}


def by_id(df):
    rows = {r.doc_id: r for r in df.collect()}
    assert set(rows) == set(texts())
    return rows


@pytest.mark.parametrize("n", OPERATORS)
def test_empty_table(spark, n):
    assert OPERATORS[n](spark, spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 9, 10])
def test_repeated_rows_give_a_row_each(spark, n):
    assert OPERATORS[n](spark, documents(spark, 5)).count() == len(texts()) + 5


def test_op1(spark):
    got = by_id(OPERATORS[1](spark, documents(spark)))
    count = collections.Counter()
    for i, t in texts().items():
        if crc(i, 10):
            count.update(words(t))
            count["end"] += 1
    total, kinds = sum(count.values()), len(count)
    for i, t in texts().items():
        w = [*words(t), "end"]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(i, 10) == 0, len(w), sum(count[x] > 0 for x in w), total)
        assert math.isclose(r.base_score, sum(math.log10((count[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in w), rel_tol=1e-9)
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())


def test_op1_states_are_distributions(spark):
    root, counts = suffix_tree_lm.count_words(documents(spark).select("doc_id", "text"))
    vocabulary = np.append(np.array([r.code for r in counts.select("code").collect()]).view(np.uint64), np.uint64(1))  # and an unseen word
    seen = [t for t in texts().values() if t]
    h, doc = suffix_tree_lm.token_stream(np.frombuffer("".join(seen).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in seen)]))
    context = [h[7], h[6], h[5]]
    rows = [np.concatenate([h, vocabulary])]
    length = np.concatenate([np.zeros(len(h), np.int64), np.full(len(vocabulary), 3)])
    for k in range(1, 4):
        before = np.zeros(len(h), np.uint64)
        before[k:] = h[:-k]
        length[: len(h)] += np.concatenate([np.zeros(k, bool), doc[k:] == doc[:-k]])
        rows.append(np.concatenate([before, np.full(len(vocabulary), context[k - 1])]))
    weight = np.concatenate([np.ones(len(h)), np.zeros(len(vocabulary))])
    a, b, depth = suffix_tree_lm.branches(root, rows, length, weight)
    assert depth[len(h) :].max() >= 1
    assert (a + b * 0.1 / root.unit)[len(h) :].sum() == pytest.approx(1)


def suffix_tree_scores(train, all_texts):
    """Brute force: log10 probabilities of all texts in a tree of all of train's contexts."""
    depth, least, discount = suffix_tree_lm.DEPTH, 2, 0.75
    after = [collections.defaultdict(collections.Counter) for _ in range(depth + 1)]
    for w in train:
        for i, x in enumerate(w):
            for k in range(min(i, depth) + 1):
                after[k][tuple(w[i - k : i])][x] += 1
    count = after[0][()]
    unit = sum(count.values()) + 0.1 * (len(count) + 1)
    states = {()}

    def p(context, x):
        if not context:
            return (count[x] + 0.1) / unit
        c = after[len(context)][context]
        return (max(c[x] - discount, 0) + discount * len(c) * p(context[1:], x)) / sum(c.values())

    for k in range(1, depth + 1):
        for context, c in after[k].items():
            total = sum(c.values())
            ratio = {x: n / total / p(context[1:], x) for x, n in c.items() if n >= 2}
            if context[1:] in states and total >= least and any((r >= 1.05 or r <= 1 / 1.05) and c[x] * abs(math.log(r)) >= 6 for x, r in ratio.items()):
                states.add(context)

    def longest(w, i):
        return max((tuple(w[i - k : i]) for k in range(min(i, depth) + 1) if tuple(w[i - k : i]) in states), key=len)

    return [sum(math.log10(p(longest(w, i), x)) for i, x in enumerate(w)) for w in all_texts], states


CHAINS = {1000 + i: ("p one two x", "q one two y", "r two z")[i % 3] for i in range(60)}


@pytest.mark.parametrize(("split", "task"), [(1 << 22, 1 << 18), (20, 1000), (20, 10), (1 << 22, 10)])
def test_op1_is_the_whole_tree(spark, monkeypatch, split, task):
    """Also where branches of frequent words are dealt in parts, or have several turns in a task."""
    monkeypatch.setattr(suffix_tree_lm, "SPLIT", split)
    monkeypatch.setattr(suffix_tree_lm, "TASK", task)
    all_texts = texts() | CHAINS
    got = {r.doc_id: r.score for r in OPERATORS[1](spark, spark.createDataFrame(list(all_texts.items()), "doc_id bigint, text string")).collect()}
    tokens = {i: [*words(t), "end"] for i, t in all_texts.items()}
    want, states = suffix_tree_scores([w for i, w in tokens.items() if crc(i, 10)], tokens.values())
    assert {len(x) for x in states} == {0, 1, 2, 3}
    assert [got[i] for i in tokens] == pytest.approx(want, rel=1e-9)


def test_op1_words_beyond_those_that_are_held(spark, monkeypatch):
    """Counts and base do not depend on how many words every task holds; fewer contexts are kept, but they still tell."""
    docs = spark.createDataFrame(list((texts() | CHAINS).items()), "doc_id bigint, text string")
    whole = {r.doc_id: r for r in OPERATORS[1](spark, docs).collect()}
    monkeypatch.setattr(suffix_tree_lm, "MOST_COUNTS", 8)
    got = OPERATORS[1](spark, docs).collect()
    assert sum(r.base_score for r in got) < sum(r.score for r in got) < 0
    for r in got:
        w = whole[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (w.n_tokens, w.n_known, w.train_tokens)
        assert r.base_score == pytest.approx(w.base_score, rel=1e-9)


def test_op1_contexts_count_as_the_corpus_grows(spark):
    """A context seen 12 times in a million tokens still tells what comes next."""
    own = [(i, "alpha beta gamma" if i % 2 else "omega beta delta") for i in range(24)]
    filler = [(100 + i, " ".join(f"w{(i * 7919 + j) % 6000}" for j in range(10_000))) for i in range(100)]
    docs = spark.createDataFrame(own + filler, "doc_id bigint, text string")
    got = {r.doc_id: r for r in OPERATORS[1](spark, docs).where("doc_id < 24").collect()}
    assert all(r.score > r.base_score + 6 for r in got.values())


def test_op2(spark):
    got = by_id(OPERATORS[2](spark, documents(spark)))
    for i in (84, 85, 86, 87):
        assert got[i].lang_pred == "und" and got[i].score == 0
    held = [i for i in range(60) if crc(i, 5) == 0]
    assert all(got[i].held_out for i in held) and all(0 <= r.score <= 1 for r in got.values())
    assert sum(got[i].lang_pred == ("fr" if i % 3 == 0 else "en") for i in held) >= 0.9 * len(held)


def test_op3(spark):
    got = by_id(OPERATORS[3](spark, documents(spark)))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    norm = {i: (t or "").translate(str.maketrans(upper, lower)) for i, t in texts().items()}
    for i, r in got.items():
        same = [j for j in norm if norm[j] == norm[i]]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(same), len(same), i == max(same), hashlib.sha256(norm[i].encode()).hexdigest())


def test_op3_index_is_kept_between_ingests(spark):
    index = exact_dedup.DigestIndex(spark, "digests_test", buckets=4)
    first = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], "doc_id bigint, text string")
    assert {r.doc_id: r.known for r in index.ingest(first).collect()} == {1: False, 2: False, 3: False}
    second = spark.createDataFrame([(9, "B"), (10, "c")], "doc_id bigint, text string")
    assert {r.doc_id: (r.known, r.keep_id) for r in exact_dedup.DigestIndex(spark, "digests_test").ingest(second).collect()} == {9: (True, 3), 10: (False, 10)}
    assert index.read().count() == 3


def test_op4(spark):
    docs = documents(spark)
    got = OPERATORS[4](spark, docs).collect()
    copies = collections.Counter(r.doc_id for r in got)
    assert set(copies) == set(texts()) and max(copies.values()) <= 2
    assert len({(r.block, r.position) for r in got}) == len(got)
    tokens = {i: len(words(t)) for i, t in texts().items()}
    assert all(r.n_tokens == tokens[r.doc_id] for r in got)
    plan = {r._mix_source: r for r in mixing.plan(docs).collect()}
    for name, p in plan.items():
        given = sum(r.n_tokens for r in got if ("null" if r.source is None else "s:" + r.source) == name)
        longest = max(tokens.values())
        assert abs(given - max(p.quota, p.tokens)) <= longest
    assert sum(p.weight for p in plan.values()) == pytest.approx(1)


def test_mixing_meets_a_target_entropy(spark):
    sources = spark.createDataFrame([("a", 1, 900), ("b", 1, 90), ("c", 1, 10)], "_mix_source string, docs int, tokens bigint")
    a = mixing.exponent(sources, target_entropy=0.8, max_repeats=None)
    w = np.array([0.9, 0.09, 0.01]) ** a
    w /= w.sum()
    assert -(w * np.log(w)).sum() == pytest.approx(0.8, abs=1e-6)


def test_op5(spark):
    items = [(1, texts()[4]), (2, " ".join(texts()[60].split()[30:80])), (3, None), (4, ""), (5, "nothing of this is anywhere in these texts at all, ever or never")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.op5_decontaminate(spark, documents(spark), bench).collect()}
    exact = {(i, k) for i, t in texts().items() for k, x in items if x and " ".join(x.lower().split()) in " ".join((t or "").lower().split())}
    assert exact <= got and not {k for _, k in got} & {3, 4, 5}
    assert {i for i, k in got if k == 2} <= {*range(60, 76)}
    assert decontaminate.find_leaks(documents(spark), bench.limit(0)).count() == 0


def test_op5_terms_are_found_in_slots():
    """Terms that share their first bits, hashes that only begin like a term, and the ends of the range."""
    rnd = np.random.default_rng(4)
    near = np.uint64(5 << 46) + np.arange(9, dtype=np.uint64)
    terms = np.unique(np.concatenate([rnd.integers(0, 2**64, 5000, dtype=np.uint64), near[::2], np.array([0, 2**64 - 1], np.uint64)]))
    h = np.concatenate([rnd.permutation(terms), near, rnd.integers(0, 2**64, 5000, dtype=np.uint64), terms + np.uint64(1)])
    at, where = decontaminate.TermIndex(terms).find(h)
    assert where.tolist() == np.flatnonzero(np.isin(h, terms)).tolist() and (terms[at] == h[where]).all()


def test_lcs():
    assert decontaminate.lcs_length([1, 2, 3, 4], [2, 9, 4, 1]) == 2 and decontaminate.lcs_length([], [1]) == 0


def _gear_cuts(b: bytes) -> list[tuple[int, int]]:
    at, out, table = 0, [], [int(x) for x in chunk_dedup._GEAR]
    for n in range(1, len(b) + 1):
        v = 0
        for c in b[max(0, n - 32) : n]:
            v = ((v << 1) + table[c]) & 0xFFFFFFFF
        if (v >> (32 - chunk_dedup.CUT_BITS) == 0 and n >= 32 and n - at >= chunk_dedup.LEAST) or n - at == chunk_dedup.MOST:
            out.append((at, n))
            at = n
    return out + [(at, len(b))] * (at < len(b))


def test_op6(spark):
    got = by_id(OPERATORS[6](spark, documents(spark)))
    first, chunks = {}, {}
    for i, t in sorted(texts().items()):
        b = (t or "").encode()
        chunks[i] = _gear_cuts(b)
        for s, e in chunks[i]:
            first.setdefault(b[s:e], (i, s))
    for i, t in texts().items():
        b, runs = (t or "").encode(), []
        for s, e in chunks[i]:
            if first[b[s:e]] != (i, s):
                if runs and runs[-1][1] == s:
                    runs[-1][1] = e
                else:
                    runs.append([s, e])
        runs = [tuple(r) for r in runs if r[1] - r[0] >= chunk_dedup.MIN_RUN]
        assert [tuple(x) for x in got[i].spans] == runs and got[i].n_removed == sum(e - s for s, e in runs) and got[i].n_bytes == len(b)
    assert all(got[i].n_removed > 0 for i in range(61, 76))


def test_op6_removal(spark):
    docs = documents(spark)
    left = {r.doc_id: r.text for r in chunk_dedup.remove_spans(docs, chunk_dedup.repeated_spans(docs)).collect()}
    got = by_id(OPERATORS[6](spark, docs))
    for i in range(60, 76):
        assert len(left[i].encode()) == got[i].n_bytes - got[i].n_removed


def test_op6_removal_at_characters(spark):
    """Cuts inside characters take the whole characters; characters of the text's own, U+FFFD too, stay."""
    text = "ab\ufffd\u00e9\u20ac\U0001f600z\ufffd"
    raw = text.encode()
    cases = [[(a, b)] for a in range(len(raw)) for b in range(a + 1, len(raw) + 1)] + [[(1, 6), (8, 9)], [(4, 6), (7, 10)]]
    docs = spark.createDataFrame([(i, text) for i in range(len(cases))], "doc_id bigint, text string")
    tid = docs.selectExpr("xxhash64(text)").first()[0]
    spans = spark.createDataFrame([(i, tid, c) for i, c in enumerate(cases)], "doc_id bigint, tid bigint, spans array<struct<start:int,end:int>>")
    left = {r.doc_id: r.text for r in chunk_dedup.remove_spans(docs, spans).collect()}
    place = np.cumsum([0, *(len(x.encode()) for x in text)])
    for i, case in enumerate(cases):
        want = "".join(x for x, s, e in zip(text, place, place[1:]) if not any(s < b and e > a for a, b in case))
        assert left[i] == want, case


def test_op7_stems_serve_other_cases_and_marks(monkeypatch):
    """A word in another case or with another mark is not sent through the model again, however small the tables."""
    from tokenizers import Tokenizer

    enc, tok = token_records.Encoder(token_records.default_tokenizer()), Tokenizer.from_file(token_records.default_tokenizer())
    forms = ["garden", "Garden,", "GARDEN!", "Été.", "été", "ÉTÉ?", "x1", "don't", "İI", "garden", "."]
    want = [tok.encode(w, add_special_tokens=False).ids for w in forms]
    assert [np.frombuffer(x, np.uint32).tolist() for x in enc.words(forms)] == want and sorted(enc.stems) == ["garden", "été"]
    monkeypatch.setattr(token_records.Encoder, "MOST_WORDS", 2)
    monkeypatch.setattr(token_records.Encoder, "MOST_STEMS", 1)
    small = token_records.Encoder(token_records.default_tokenizer())
    for _ in range(2):
        assert [np.frombuffer(x, np.uint32).tolist() for x in small.words(forms)] == want


def test_op7(spark):
    from tokenizers import Tokenizer

    got = by_id(OPERATORS[7](spark, documents(spark)))
    tok, at = Tokenizer.from_file(token_records.default_tokenizer()), 0
    for i, t in sorted(texts().items()):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_crc32c_known_values():
    data = np.frombuffer(b"123456789" + bytes(32) + b"" + b"\xff" * 32 + bytes(range(200)), np.uint8)
    got = token_records.crc32c(data, np.array([0, 9, 41, 41, 73, 273]))
    assert [hex(x) for x in got[:4]] == ["0xe3069283", "0x8a9136aa", "0x0", "0x62a8ab43"]
    slow = 0xFFFFFFFF
    for b in range(200):
        slow = int(token_records._T[(slow ^ b) & 255]) ^ (slow >> 8)
    assert int(got[4]) == slow ^ 0xFFFFFFFF


def test_broken_record_is_noticed(spark, tmp_path):
    folder = f"file://{tmp_path}/r"
    index = token_records.write_records(documents(spark), folder, token_records.default_tokenizer(), partitions=1)
    name = next((tmp_path / "r").glob("*.rec"))
    raw = bytearray(name.read_bytes())
    raw[40] ^= 1
    name.write_bytes(raw)
    with pytest.raises(Exception, match="checksum|length"):
        token_records.record_checks(index, folder).collect()


def test_op8(spark):
    got = by_id(OPERATORS[8](spark, documents(spark)))
    lines, first, gone = [], {}, collections.defaultdict(set)
    for i, t in sorted(texts().items()):
        for j, line in enumerate((t or "").split("\n")):
            w = tuple(x for x in re.split("[ \t\x0b\x0c\r]+", line) if x)
            if w:
                lines.append((i, j, w))
    for i, j, w in lines:
        near = any(p < (i, j) and len(v) >= 5 and len(w) >= 5 and _one_edit(v, w) for v, p in first.items())
        if w in first or near:
            gone[i].add(j)
        first.setdefault(w, (i, j))
    for i, t in texts().items():
        parts = (t or "").split("\n") if t is not None else []
        kept = "\n".join(x for j, x in enumerate(parts) if j not in gone[i])
        assert (got[i].n_lines, got[i].n_removed, got[i].kept_sha256) == (len(parts), len(gone[i]), hashlib.sha256(kept.encode()).hexdigest())


def test_op8_variants_and_map(spark):
    """A variant's hash is that of the line without the word, also for a line of 30,000 words; the map of bits loses no marked row."""
    lines = spark.createDataFrame([(0, "a b a a c".split()), (1, ["x"]), (2, [str(i % 7) for i in range(30_000)])], "uid bigint, words array<string>")
    got = {(r.uid, r.i): (r.n, r.v) for r in line_dedup.deletion_hashes(lines).collect()}
    assert len(got) == 30_006
    some = [(u, i, [w for j, w in enumerate(ws) if j != i]) for u, ws in lines.collect() for i in (range(len(ws)) if u < 2 else (0, 15_000, 29_999))]
    want = spark.createDataFrame(some, "uid bigint, i int, words array<string>").withColumn("v", line_dedup.sequence_hash(F.col("words")))
    assert all(got[r.uid, r.i] == (len(r.words) + 1, r.v) for r in want.collect())
    rows = spark.range(20_000).selectExpr("nullif(id, 5) AS doc_id", "id * 7 AS tid")
    marked = rows.where("tid % 20 = 0 OR doc_id IS NULL")
    left = line_dedup.perhaps_in(rows, line_dedup.marked_bits(marked, "doc_id", "tid"), "doc_id", "tid")
    assert marked.exceptAll(left).count() == 0 and left.count() < marked.count() + 100


def _one_edit(a: tuple, b: tuple) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def _removed(raw: dict[int, bytes], length: int) -> dict[int, np.ndarray]:
    count = collections.Counter(x[p : p + length] for x in raw.values() for p in range(len(x) - length + 1))
    out = {}
    for i, x in raw.items():
        mask = np.zeros(len(x) + 2, bool)
        for p in range(len(x) - length + 1):
            if count[x[p : p + length]] > 1:
                mask[p + 1 : p + 1 + length] = True
        out[i] = mask
    return out


@pytest.mark.parametrize("hot", [4000, 3])
def test_op9(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = by_id(OPERATORS[9](spark, documents(spark)))
    raw = {i: (t or "").encode() for i, t in texts().items()}
    for i, mask in _removed(raw, suffix_dedup.LENGTH).items():
        kept = np.frombuffer(raw[i], np.uint8)[~mask[1:-1]].tobytes()
        want = (len(raw[i]), int(mask.sum()), int((mask[1:] & ~mask[:-1]).sum()), hashlib.sha256(kept).hexdigest())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want


def test_op9_deals_texts_once(spark, capsys):
    """Texts are joined where they lie, in the plan of the result too; rows without doc_id and of doc_id 0 keep apart."""
    kept = texts()
    rows = [(None, kept[60]), (0, kept[61]), (0, kept[92] + "!"), (None, kept[93]), (7, None)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = OPERATORS[9](spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
        out.explain()
        got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.doc_id is None) for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert "Bucketed: true" in plan and "sha2(" not in plan.split("dealt_texts")[1].split("\n")[0]
    raw = {i: (t or "").encode() for i, (_, t) in enumerate(rows)}
    masks = _removed(raw, suffix_dedup.LENGTH)
    assert got == sorted((len(raw[i]), int(m.sum()), int((m[1:] & ~m[:-1]).sum()), rows[i][0] is None) for i, m in masks.items())


def test_op9_planted_passages(spark):
    """Passages of over 50 words in two documents each: of LENGTH bytes they go, whole; of a byte less they stay, as the contract counts bytes."""
    import random

    rnd = random.Random(9)
    word = lambda low, high: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(low, high)))
    rows, sizes = [], {}
    for k, size in enumerate((330, 399, 400, 401, 470) * 2):
        passage = (" ".join(word(3, 6) for _ in range(120)))[: size - 1] + "."
        assert len(passage.split()) > 50
        for i in (2 * k, 2 * k + 1):
            before, after = ([word(3, 9) for _ in range(rnd.randint(20, 90))] for _ in range(2))
            rows.append((i, " ".join(before) + f" <{i}" + passage + f"{i % 2}> " + " ".join(after)))
            sizes[i] = size
    rows += [(i, " ".join(word(3, 9) for _ in range(150))) for i in range(100, 110)]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in OPERATORS[9](spark, spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: (sizes[i], 1) if sizes.get(i, 0) >= suffix_dedup.LENGTH else (0, 0) for i, _ in rows}


def test_loser_tree_merges_front_coded_runs():
    import random

    rnd = random.Random(3)
    rows = [(bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(1, 12))), b"", k, 0) for k in range(300)]
    runs = [suffix_dedup.front_code(sorted(rows[k::7])) for k in range(7)]
    out = list(suffix_dedup.merge([suffix_dedup.read_run(r) for r in runs]))
    assert [r[0] for r in out] == sorted(r[0] for r in rows) and sorted(r[3] for r in out) == list(range(300))
    last = b""
    for r in out:
        assert r[1] == suffix_dedup.common_prefix(last, r[0])
        last = r[0]


def test_op10(spark):
    got = by_id(OPERATORS[10](spark, documents(spark)))
    sets = {}
    for i, t in texts().items():
        w = words(t)
        sets[i] = set(zip(w, w[1:], strict=False)) if len(w) > 1 else {tuple(w)} if w else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    for i, r in got.items():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[i]), root(i), root(i) == i)


def test_op10_near_misses_in_blocks(spark, monkeypatch):
    """Texts that share buckets but are mostly under the threshold with the rest: no link is lost, in one block or many."""
    rnd = np.random.default_rng(3)
    base = [f"b{i}" for i in range(120)]
    docs = []
    for i in range(70):
        w = list(base)
        for j in rnd.choice(120, 7 + i % 3, replace=False):
            w[j] = f"{i}-{j}" if i % 7 else f"{i - i % 14}-{j}"
        docs.append((i, " ".join(w)))
    sets = {i: {*zip(t.split(), t.split()[1:], strict=False)} for i, t in docs}
    label = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = min(label[i], label[j])
    assert len(set(label.values())) > 1
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for block in (2048, 8):
        monkeypatch.setattr(minhash_dedup, "BLOCK", block)
        assert {r.doc_id: r.component_id for r in OPERATORS[10](spark, df).collect()} == label


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    assert {(r.node, r.label) for r in minhash_dedup.connected_components(edges).collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


def test_op2_keeps_languages_with_few_labelled_texts(spark):
    """A language whose only labelled text would calibrate is learned, and without enough of these rejects nothing."""
    few = {i: "Őrült írógép, széles küszöb és mély tó fölött húz el a gólya: szép őszi reggel." for i in range(5000, 5040)}
    alone = next(i for i in few if crc(f"calibration {i}", 8) == 0)
    rows = [(i, t, "en" if i % 3 else "fr") for i, t in texts().items() if i < 60] + [(alone, few[alone], "hu")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert list(model.kn.langs) == ["en", "fr", "hu"]
    got = language_id.predict(spark.createDataFrame([(1, few[alone] * 20), (2, None)], "doc_id bigint, text string"), model).collect()
    assert {r.doc_id: (r.lang_pred, r.rejected) for r in got} == {1: ("hu", False), 2: ("und", True)}
    assert all(0 <= r.score <= 1 for r in got)
