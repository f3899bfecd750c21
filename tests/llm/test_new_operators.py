"""Lexical search, weighted sampling and conversation repair against brute-force versions."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from cadastra.llm import conversation_repair, impact_search, weighted_sampling

from .fixture import SCHEMA, documents, texts

# ---------------------------------------------------------------- op11
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def best(docs, items, k):
    """(item_id, rank, doc_id, score) by the formula, over all pairs."""
    bags = [(d, collections.Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        q = collections.Counter(terms(text))
        scores = []
        for d, b in bags:
            m = 100 - 25 + (25 * sum(b.values()) * n_docs) // max(total, 1)
            score = sum(n * w[t] * ((1000000000 * b[t]) // (1000 * b[t] + 12 * m)) for t, n in q.items() if t in b)
            if score:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def found(spark, docs, items, k=20):
    got = impact_search.search(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), k).collect()
    return sorted(map(tuple, got), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_op11(spark):
    bench = [(i, texts()[i]) for i in (1, 5, 60, 84, 85, 95, 93)] + [(7, "Ünïcode, unknown words only"), (8, "river RIVER river stone 7")]
    got = impact_search.op11_impact_search(spark, documents(spark), spark.createDataFrame([(*b, "x") for b in bench], "item_id bigint, text string, doc_id string"))
    assert sorted(map(tuple, got.collect())) == best(texts().items(), bench, 20)


@pytest.mark.parametrize("seed", [1])
def test_op11_ties_and_many_documents(spark, seed):
    """Skewed words, many equal scores, copies, repeated and null ids; more documents than k."""
    rnd = random.Random(seed)
    word = lambda: f"w{int(rnd.paretovariate(0.7)) % 60}"
    docs = [(i % 150 if i % 50 else None, " ".join(word() for _ in range(rnd.choice([1, 2, 3, 30])))) for i in range(400)]
    items = [(i, " ".join(word() for _ in range(rnd.choice([1, 2, 8, 25])))) for i in range(12)]
    assert found(spark, docs, items, 5) == best(docs, items, 5)


def test_op11_stops_before_the_last_layer(spark, monkeypatch):
    """An item whose best documents have all of its terms is settled by the first layers."""
    read = []
    once = impact_search._best
    monkeypatch.setattr(impact_search, "_best", lambda scores, k, order: (read.append(1), once(scores, k, order))[1])
    docs = [(i, "alpha beta gamma delta") for i in range(4)] + [(i, f"filler{i} words alpha" if i % 9 == 0 else f"filler{i} words more") for i in range(4, 400)]
    assert found(spark, docs, [(0, "beta gamma delta")], 3) == best(docs, [(0, "beta gamma delta")], 3)
    assert len(read) - 1 < impact_search.LAYERS


def test_op11_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(impact_search, "QUERY_TERMS", 60)
    bench = [(i, texts()[i]) for i in range(0, 40, 7)]
    assert found(spark, list(texts().items()), bench) == best(texts().items(), bench, 20)


def test_op11_takes_few_jobs(spark):
    """Rounds are few jobs and broadcasts: each leaves the driver with tables, threads and plans, whatever the input's size."""
    jobs = lambda: spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    bench = [(i, texts()[i]) for i in (1, 5, 60, 84, 85, 95, 93)]
    before = jobs()
    assert found(spark, list(texts().items()), bench) == best(texts().items(), bench, 20)
    assert jobs() - before <= 125


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None), (2, "")], [(1, "a"), (2, None)])])
def test_op11_empty(spark, docs, items):
    assert found(spark, docs, items) == []


# ---------------------------------------------------------------- op12
def jaccard(a, b):
    a, b = collections.Counter(words_of(a)), collections.Counter(words_of(b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def words_of(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]


def following(rows):
    """(doc_id, text, edited, next) in order of doc_id, null first, then text."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        yield d, t, t[: len(t) - half] + after[:half], after


@pytest.mark.parametrize("bucket", [7, 1500])
def test_op12(spark, monkeypatch, bucket):
    monkeypatch.setattr(weighted_sampling, "BUCKET_DOCS", bucket)
    got = {r.doc_id: r for r in weighted_sampling.op12_weighted_sampling(spark, documents(spark)).collect()}
    want = list(following(texts().items()))
    assert len(got) == len(want)
    prints = {}
    for i, (d, t, edited, after) in enumerate(want):
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        share = lambda a, b: float(a == b) if "" in (a, b) else sum(a[j : j + 8] == b[j : j + 8] for j in range(0, len(a), 8)) / weighted_sampling.SAMPLES
        assert r.near_edited == share(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == share(r.fingerprint, got[want[(i + 1) % len(want)][0]].fingerprint)
        if t == edited:
            assert r.fingerprint == r.edited_fingerprint
        assert (r.fingerprint == "") == (not words_of(t))


def test_op12_collision_rate_is_generalised_jaccard(spark):
    """Pairs of every likeness, with weights from 1 to 30: the mean error is small, no error is far out."""
    rnd = random.Random(3)
    pairs = []
    for i in range(300):
        bag = [f"t{i}x{k}" for k in range(40) for _ in range(rnd.choice([1, 1, 1, 2, 7, 30]))]
        other = [w for w in bag if rnd.random() > i / 300] + [f"o{i}x{k}" for k in range(i % 9) for _ in range(rnd.choice([1, 12]))]
        pairs.append((" ".join(bag), " ".join(other)))
    rows = [(2 * i + s, p[s]) for i, p in enumerate(pairs) for s in (0, 1)]
    prints = dict(weighted_sampling.fingerprints(spark.createDataFrame(rows, "id bigint, t string"), "id", "t").collect())
    off = []
    for i, (a, b) in enumerate(pairs):
        x, y = prints[2 * i], prints.get(2 * i + 1, "")
        off.append((sum(x[j : j + 8] == y[j : j + 8] for j in range(0, len(x), 8)) / weighted_sampling.SAMPLES if y else 0.0) - jaccard(a, b))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.09 and np.abs(off).max() < 0.36


def test_op12_early_test_changes_nothing(spark, monkeypatch):
    rows = spark.createDataFrame([(i, t) for i, t in texts().items()], "id bigint, t string")
    early = dict(weighted_sampling.fingerprints(rows, "id", "t").collect())
    monkeypatch.setattr(weighted_sampling, "TAIL", 1e12)
    assert dict(weighted_sampling.fingerprints(rows, "id", "t").collect()) == early


def test_op12_repeated_rows_null_ids_and_single_rows(spark, monkeypatch):
    monkeypatch.setattr(weighted_sampling, "BUCKET_DOCS", 3)
    rows = [(5, "a b c d"), (5, "a b c d"), (5, "e f"), (None, "x y z"), (None, None), (-4, ""), (9, "q r s t u"), (8, "one two"), (7, "three"), (6, "four five"), (2**60, "long id")]
    got = weighted_sampling.op12_weighted_sampling(spark, spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    key = lambda x: tuple((v is not None, v) if v is not None else (False, 0) for v in x)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(((d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in following(rows)), key=key)
    alone = weighted_sampling.op12_weighted_sampling(spark, spark.createDataFrame([(1, "a b c d")], "doc_id bigint, text string")).collect()
    assert [(r.edited_sha256, r.near_next) for r in alone] == [(hashlib.sha256(b"a b a b").hexdigest(), 1.0)]
    assert weighted_sampling.op12_weighted_sampling(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_op12_needs_no_python_workers(spark):
    plan = weighted_sampling.op12_weighted_sampling(spark, documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---------------------------------------------------------------- op13
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for c, turn, role, text in rows:
        say = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{say(c)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        if kind:
            row = (c, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row] * (2 if kind == 3 else 1)
    return out


def repair(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, hash of one conversation's damaged rows, by a plain DP over whole audits."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, fault = set(), []
    for _, _, role, text in rows:
        solid = text.strip(SPACES)
        fault.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    best = {s: (0, "", ()) if s in (0, 3) else None for s in range(4)}

    def inserts(best):
        for _ in range(3):
            for s in range(4):
                letter = "a" if s == 2 else "u"
                then = best[NEXT[s][letter]]
                if then:
                    new = (then[0] + 3, "I" + then[1], (("user:" if letter == "u" else "assistant:"), *then[2]))
                    best[s] = min(best[s], new) if best[s] else new
        return best

    best = inserts(best)
    for (_, _, role, text), f in reversed(list(zip(rows, fault, strict=True))):
        now = {}
        for s in range(4):
            options = []
            if best[s]:
                options.append((best[s][0] + 4, "D" + best[s][1], best[s][2]))
            if f not in ("blank", "duplicate"):
                extra = 3 * (f == "truncated")
                letter = "a" if s == 2 else "u"
                for cost, sign, initial, as_role in ((0, "K", role[:1], role), (3, "R", letter, "user" if letter == "u" else "assistant")):
                    to = NEXT[s].get(initial)
                    if to and best[to]:
                        options.append((best[to][0] + cost + extra, sign + best[to][1], (f"{as_role}:{text}", *best[to][2])))
            now[s] = min(options) if options else None
        best = inserts(now)
    cost, audit, lines = best[0]
    return gaps, *(fault.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def held_against_brute_force(spark, rows):
    got = conversation_repair.op13_conversation_repair(spark, spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, v string, g int")).collect()
    by = collections.defaultdict(list)
    for r in damaged(rows):
        by[r[0]].append(r)
    want = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in {r[0] for r in rows}} | {c: repair(own) for c, own in by.items()}
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def conversation(rnd, c, n):
    text = lambda: rnd.choice(["", " ", None, "Yes.", "Yes", "no!", "why? ", "x" * 50 + ".", f"{rnd.random()}."])
    return [(c, rnd.choice([t, t, t, None, t + 3]), rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "upper"]), text()) for t in range(n)]


@pytest.mark.parametrize("block", [16, 8192])
def test_op13(spark, monkeypatch, block):
    """Conversations of none to 60 rows; blocks so small that products go through several levels."""
    monkeypatch.setattr(conversation_repair, "BLOCK", block)
    rnd = random.Random(block)
    rows = [r for c in [*range(60), None] for r in conversation(rnd, c, rnd.choice([1, 1, 2, 3, 5, 8, 13]) if c != 7 else 80)]
    held_against_brute_force(spark, rows)


def test_op13_empty(spark):
    assert conversation_repair.op13_conversation_repair(spark, spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_op13_paths_with_equal_letters(spark):
    """Least paths of random graphs in which arcs of one node share letters, over more letters than a packed rank holds."""
    rnd = random.Random(4)
    n = 90
    arcs = [(v, rnd.choice([1, 1, 1, 2]), v + rnd.choice([1, 1, 2])) for v in range(n) for _ in range(3)]
    arcs = [(v, c, min(w, n)) for v, c, w in arcs]
    out = collections.defaultdict(list)
    for v, c, w in arcs:
        out[v].append((c, w))
    word = {n: ()}
    for v in range(n - 1, -1, -1):
        word[v] = min((c, *word[w]) for c, w in out[v])
    got = conversation_repair.least_paths(spark.createDataFrame(arcs, "v bigint, letter int, w bigint"), spark.createDataFrame([(0,), (11,)], "v bigint")).collect()
    for source in (0, 11):
        path = sorted((r["at"], r.letter, r.v) for r in got if r.source == source)
        assert tuple(c for _, c, _ in path) == word[source] and [a for a, _, _ in path] == list(range(len(path)))


# ---------------------------------------------------------------- very long texts
def test_texts_longer_than_a_chunk(spark):
    """Texts of more than a chunk of bytes among short ones, in all three operators."""
    rnd = random.Random(6)
    long = " ".join(f"w{rnd.randrange(3000)}" for _ in range(230_000))
    assert len(long) > 1 << 20
    docs = [(1, "w1 w2 w3 rare"), (2, long), (3, long + " rare"), (4, None), (5, "w1 w1 w7")]
    items = [(1, "rare w1 w7"), (2, long[:5000])]
    assert found(spark, docs, items, 3) == best(docs, items, 3)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r for r in weighted_sampling.op12_weighted_sampling(spark, frame).collect()}
    for d, t, edited, _ in following(docs):
        assert (got[d].n_chars, got[d].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
    assert got[2].near_next > 0.9
    held_against_brute_force(spark, [(1, 0, "user", long), (1, 1, "assistant", long + "."), (1, 2, "user", long), (2, 0, "system", "x.")])
