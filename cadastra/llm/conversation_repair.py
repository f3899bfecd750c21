"""Conversation structure repair: the cheapest edits that make roles alternate, by prefix-doubling path ranking.

Rows of all conversations are numbered in one order (conversation, turn, role, text). A conversation is a path of layers, one before
each row and one after the last, with four states: nothing yet, after s, after u, after a. An edit is an arc with a letter: Keep,
Rerole and Delete lead over a row, Insert stays in its layer. A node's arcs have different letters.

Costs: a row is a 4 x 4 matrix of least costs (min, +), so costs from the start and to the end come from products. Blocks of BLOCK
rows are one task's work each; a conversation that goes beyond a block gives its part's product, products are multiplied in blocks of
their own, level by level, and the costs at the parts' ends come back down. No conversation is ever in one task for this.

Audits: the arcs that lie on a cheapest path are kept (`optimal_arcs`). Their nodes are ranked by the least 1, 2, 4, 8, ... letters
that lead on from them (`rank_nodes`): a rank of twice the length is the pair of a node's rank and the least rank of the nodes that
its least letters lead to, as numbers of two letters' bits while these fit in 62 bits and by a distributed sort beyond. The
ranks of whole audits then pick the next node through the doubled pointers, from the longest to the shortest (`least_paths`).
Rounds are logarithmic in the longest audit; nodes whose audit is shorter drop out. This holds for any arcs without a
cycle, also where arcs of one node share a letter.

The hash of a repaired conversation is of one text, so its lines pass through one task, in Arrow batches in order; only a hash state and
the audit are held.

Defined cases: a null conversation id, turn, role or text is one space where text is made of it; null turns come first; rows of
one turn are in order of role, then text; repeated rows are rows; a role's initial is its first character, of an empty
role none; rows with roles that have other initials cannot be kept; the damage may leave a conversation without rows: zeros, an empty
audit and the hash of nothing; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, i64, materialize, n_partitions

#: Rows, or products of rows, that one task multiplies at a time.
BLOCK = 8192
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANK, DUPLICATE, CUT = 1, 2, 3
#: Letters in ASCII order from 1; 0 is the end.
LETTERS = "DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
_BITS = 3
_INF = 1 << 40
#: The state after an inserted or rerolled turn; after a kept one, by initial (s, u, a, other) and state, -1: not allowed.
_ON = np.array([2, 2, 3, 2])
_KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
_START = np.array([0, _INF, _INF, _INF])
_ACCEPT = np.array([0, _INF, _INF, 0])
_INSERTS = np.full((4, 4), _INF)
for _s in range(4):
    _INSERTS[_s, _ON[_ON[_s]]] = 2 * INSERT
    _INSERTS[_s, _ON[_s]] = INSERT
    _INSERTS[_s, _s] = 0


# ---------------------------------------------------------------- rows
def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows dropped, emptied, left without sentence ends, repeated or given to the user, by crc32 of
    `conv_id:turn` mod 20 (0 to 4)."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def numbered(rows: DataFrame) -> DataFrame:
    """rows with g, their place in the order of (conv_id, turn, role, text), from 0 on."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    dealt = rows.repartitionByRange(n_partitions(rows.sparkSession), *order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    kept = materialize(dealt.withColumn("at", F.monotonically_increasing_id()), "rows")
    part = F.shiftrightunsigned("at", 33)
    sizes = {p: n for p, n in kept.groupBy(part.alias("p")).count().collect()}  # a row for each partition
    before, starts = 0, []
    for p in range(max(sizes, default=-1) + 1):
        starts.append((p, before))
        before += sizes.get(p, 0)
    offsets = F.broadcast(rows.sparkSession.createDataFrame(starts, "p bigint, before bigint"))
    return kept.withColumn("p", part).join(offsets, "p").withColumn("g", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("p", "before", "at")


def faults(rows: DataFrame) -> DataFrame:
    """(g, conv_id, turn, initial, fault, start, end, illegal) of numbered rows."""
    solid = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    initial = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.substring("role", 1, 1)), F.lit(0)), F.lit(4)) - 1
    initial = F.when(F.length("role") == 0, 3).otherwise(initial)
    slim = rows.select("g", "conv_id", "turn", initial.cast("int").alias("initial"), F.when(solid == "", BLANK).when(~F.substring(solid, -1, 1).isin(".", "!", "?"), CUT).otherwise(0).alias("own"), F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2"))
    slim = materialize(slim, "slim")
    first = slim.groupBy("conv_id", "h1", "h2").agg(F.min("g").alias("g")).select("g", F.lit(True).alias("new"))
    ends = slim.groupBy("conv_id").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).select(F.explode(F.array(F.struct(F.col("lo").alias("g"), F.lit(True).alias("start"), F.lit(False).alias("end")), F.struct(F.col("hi").alias("g"), F.lit(False).alias("start"), F.lit(True).alias("end")))).alias("e"))
    ends = ends.select("e.*").groupBy("g").agg(F.bool_or("start").alias("start"), F.bool_or("end").alias("end"))
    before = slim.select((F.col("g") + 1).alias("g"), F.col("initial").alias("before"))
    whole = slim.join(first, "g", "left").join(ends, "g", "left").join(before, "g", "left")
    start, end = (F.coalesce(c, F.lit(False)) for c in ("start", "end"))
    fault = F.when(F.col("own") == BLANK, BLANK).when(F.col("new").isNull(), DUPLICATE).otherwise(F.col("own"))
    legal = F.concat("before", "initial").isin("01", "12", "21")
    return materialize(whole.select("g", "conv_id", "turn", "initial", fault.alias("fault"), start.alias("start"), end.alias("end"), (~start & ~legal).alias("illegal")), "faults")


# ---------------------------------------------------------------- costs
def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products (min, +) of matrices, or of rows or columns and matrices."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), _INF)


class _Parts:
    """Elements in order, cut into runs that belong to one conversation; products of all that is before or after inside a run."""

    def __init__(self, start: np.ndarray, end: np.ndarray, m: np.ndarray):
        n = len(start)
        head = start.copy()
        head[0] = True
        head[1:] |= end[:-1]
        self.m, self.first = m, np.flatnonzero(head)
        self.last = np.append(self.first[1:], n) - 1
        self.run = np.cumsum(head) - 1
        self.starts, self.ends = start[self.first], end[self.last]
        self.upto, self.onward = m.copy(), m.copy()  # through i from its run's first; from i through its run's last
        at, d = np.arange(n), 1
        while d < (self.last - self.first).max(initial=0) + 1:
            back, ahead = np.flatnonzero(at - d >= self.first[self.run]), np.flatnonzero(at + d <= self.last[self.run])
            upto = _times(self.upto[back - d], self.upto[back])
            onward = _times(self.onward[ahead], self.onward[ahead + d])
            self.upto[back], self.onward[ahead] = upto, onward
            d *= 2

    def costs(self, entry: np.ndarray, leave: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least costs from the conversation's start to before each element, and from before and from after each to its end, given
        those before and after each run."""
        n = len(self.m)
        before, after = np.empty((n, 4), np.int64), np.empty((n, 4), np.int64)
        before[self.first] = entry
        inner = np.flatnonzero(np.arange(n) != self.first[self.run])
        before[inner] = _times(entry[self.run[inner]][:, None, :], self.upto[inner - 1])[:, 0]
        toward = _times(self.onward, leave[self.run][:, :, None])[:, :, 0]
        after[self.last] = leave
        inner = np.flatnonzero(np.arange(n) != self.last[self.run])
        after[inner] = toward[inner + 1]
        return before, toward, after


def _edits(initial: np.ndarray, fault: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(letter, target state or -1, cost) of each row and state."""
    stays = np.where((fault == BLANK) | (fault == DUPLICATE), _INF, np.where(fault == CUT, TRUNCATED, 0))[:, None]
    n = len(initial)
    return [
        (_D, np.tile(np.arange(4), (n, 1)), np.full((n, 4), DELETE)),
        (_K, _KEPT[initial], np.broadcast_to(stays + KEEP, (n, 4))),
        (_R, np.tile(_ON, (n, 1)), np.broadcast_to(stays + REROLE, (n, 4))),
    ]


def _matrices(initial: np.ndarray, fault: np.ndarray) -> np.ndarray:
    m = np.full((len(initial), 4, 4), _INF)
    for _, to, cost in _edits(initial, fault):
        i, s = np.nonzero(to >= 0)
        m[i, s, to[i, s]] = np.minimum(m[i, s, to[i, s]], cost[i, s])
    return _times(np.broadcast_to(_INSERTS, m.shape), m)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _read(table: pa.Table) -> tuple[pa.Table, np.ndarray, _Parts]:
    table = table.sort_by("g")
    m = _matrices(_column(table, "initial"), _column(table, "fault")) if "initial" in table.column_names else np.array(table.column("m").to_pylist(), np.int64).reshape(-1, 4, 4)
    return table, _column(table, "g"), _Parts(_column(table, "start"), _column(table, "end"), m)


PARTS = "g bigint, start boolean, end boolean, m array<bigint>"
ENDS = "block bigint, g bigint, entry array<bigint>, leave array<bigint>"
ARCS = "v bigint, letter int, w bigint, cost bigint"


def _lists(values: np.ndarray) -> pa.Array:
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), i64(values.reshape(-1)))


def _open_parts(table: pa.Table) -> pa.Table:
    """The product of the first run of a block, if its conversation began before, and of the last, if it goes on."""
    table, _, p = _read(table)
    runs = np.flatnonzero(~(p.starts & p.ends))
    place = 2 * _column(table, "block")[0] + (p.starts[runs] | (runs > 0))
    return pa.table([i64(place), pa.array(p.starts[runs]), pa.array(p.ends[runs]), _lists(p.onward[p.first[runs]].reshape(-1, 16))], ["g", "start", "end", "m"])


def _bounds(p: _Parts, g: np.ndarray, ends: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    entry, leave = np.tile(_START, (len(p.first), 1)), np.tile(_times(_INSERTS, _ACCEPT[:, None])[:, 0], (len(p.first), 1))
    for row in ends.to_pylist():
        run = 0 if row["g"] % 2 == 0 else len(p.first) - 1
        entry[run], leave[run] = row["entry"], row["leave"]
    return entry, leave


def _pass_down(table: pa.Table, ends: pa.Table) -> pa.Table:
    """What comes before and after each part, for the level below."""
    _, g, p = _read(table)
    before, _, after = p.costs(*_bounds(p, g, ends))
    return pa.table({"block": i64(g // 2), "g": i64(g), "entry": _lists(before), "leave": _lists(after)})


def _tight_arcs(table: pa.Table, ends: pa.Table) -> pa.Table:
    """The arcs of a block that lie on cheapest paths. Node 8 g + s is before row g in state s, 8 g + 4 + s after the
    conversation's last row g. cost is the conversation's, at its first node's arcs, else null."""
    table, g, p = _read(table)
    start = _column(table, "start")
    before, toward, after = p.costs(*_bounds(p, g, ends))
    reach = _times(before[:, None, :], _INSERTS)[:, 0]
    least = (before + toward).min(1)
    last = np.zeros(len(g), bool)
    last[p.last[p.ends]] = True
    onto = np.where(last, 8 * g + 4, 8 * (g + 1))
    out = []
    for letter, to, cost in _edits(_column(table, "initial"), _column(table, "fault")):
        i, s = np.nonzero((to >= 0) & (reach + cost + np.take_along_axis(after, np.maximum(to, 0), 1) == least[:, None]))
        out.append((8 * g[i] + s, np.full(len(i), letter), onto[i] + to[i, s], np.where(start[i] & (s == 0), least[i], -1)))
    i, s = np.nonzero(reach + INSERT + toward[:, _ON] == least[:, None])
    out.append((8 * g[i] + s, np.full(len(i), _I), 8 * g[i] + _ON[s], np.where(start[i] & (s == 0), least[i], -1)))
    f = np.flatnonzero(last)
    done = _times(_times(before[f][:, None, :], p.m[f]), _INSERTS)[:, 0]
    i, s = np.nonzero(done + INSERT + _times(_INSERTS, _ACCEPT[:, None])[_ON, 0] == least[f][:, None])
    out.append((8 * g[f[i]] + 4 + s, np.full(len(i), _I), 8 * g[f[i]] + 4 + _ON[s], np.full(len(i), -1)))
    v, letter, w, cost = (np.concatenate([x[k] for x in out]) for k in range(4))
    return pa.table([i64(v), pa.array(letter, pa.int32()), i64(w), pa.array(cost, pa.int64(), mask=cost < 0)], ["v", "letter", "w", "cost"])


def optimal_arcs(rows: DataFrame) -> DataFrame:
    """(v, letter, w, cost): see _tight_arcs; rows as of `faults`."""
    block = F.floor(F.col("g") / BLOCK).cast("bigint").alias("block")
    levels = [rows.select(block, "g", "start", "end", "initial", "fault")]
    while True:
        parts = materialize(levels[-1].groupBy("block").applyInArrow(_open_parts, PARTS), "parts")
        if not parts.limit(1).count():
            break
        levels.append(parts.select(block, "*"))
    ends = rows.sparkSession.createDataFrame([], ENDS)
    for level in levels[:0:-1]:
        ends = materialize(level.groupBy("block").cogroup(ends.groupBy("block")).applyInArrow(_pass_down, ENDS), "ends")
    return materialize(levels[0].groupBy("block").cogroup(ends.groupBy("block")).applyInArrow(_tight_arcs, ARCS), "arcs")


# ---------------------------------------------------------------- audits
def _renumbered(pairs: DataFrame) -> DataFrame:
    """(rank, low, number): numbers from 1 in the order of the distinct pairs, by a distributed sort."""
    dealt = pairs.select("rank", "low").distinct().repartitionByRange(n_partitions(pairs.sparkSession), "rank", "low").sortWithinPartitions("rank", "low")
    return materialize(dealt.withColumn("number", F.monotonically_increasing_id() + 1), "numbers")


def rank_nodes(arcs: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """arcs: (v, letter, w), letters from 1 below 2**_BITS. For each power of two 2**i, (v, w): the nodes w that the least 2**i
    letters from v lead to, where there are as many; and (v, rank): all nodes by their least audits."""
    ranks = materialize(arcs.groupBy("v").agg(F.min("letter").cast("bigint").alias("rank")), "ranks")
    steps = [materialize(arcs.join(ranks, "v").where("letter = rank").select("v", "w").distinct(), "steps")]
    bits = _BITS
    while True:
        ahead = ranks.select(F.col("v").alias("w"), F.col("rank").alias("next"))
        onward = steps[-1].join(ahead, "w", "left").select("v", "w", F.coalesce("next", F.lit(0)).alias("next"))
        low = onward.groupBy("v").agg(F.min("next").alias("low"))
        pairs = ranks.join(low, "v", "left").select("v", "rank", F.coalesce("low", F.lit(0)).alias("low"))
        if 2 * bits <= 62:
            new = pairs.select("v", F.shiftleft("rank", bits).bitwiseOR(F.col("low")).alias("rank"))
            bits *= 2
        else:
            pairs = materialize(pairs, "pairs")
            new = pairs.join(_renumbered(pairs), ["rank", "low"]).select("v", F.col("number").alias("rank"))
            bits = 63
        kept = onward.join(low, "v").where("next = low").select("v", F.col("w").alias("mid"))
        doubled = kept.join(steps[-1].select(F.col("v").alias("mid"), "w"), "mid").select("v", "w").distinct()
        ranks, doubled = materialize(new, "ranks"), materialize(doubled, "steps")
        if not doubled.limit(1).count():
            return steps, ranks
        steps.append(doubled)


def least_paths(arcs: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, at, v, letter): the path from each source (v) whose letters are least, at from 0."""
    steps, ranks = rank_nodes(arcs)
    marks = materialize(sources.select(F.col("v").alias("source"), F.lit(0).cast("bigint").alias("at"), "v"), "marks")
    ahead = ranks.select(F.col("v").alias("w"), "rank")
    for i in reversed(range(len(steps))):
        to = marks.join(steps[i], "v").join(ahead, "w", "left")
        to = to.groupBy("source", "at").agg(F.min(F.struct(F.coalesce("rank", F.lit(0)).alias("rank"), "w")).alias("m"))
        marks = materialize(marks.unionByName(to.select("source", (F.col("at") + 2**i).alias("at"), F.col("m.w").alias("v"))), "marks")
    first = arcs.groupBy("v").agg(F.min("letter").alias("letter"))
    return marks.join(first, "v").select("source", "at", "v", "letter")


REPAIRED = "source bigint, audit string, repaired_sha256 string"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (source, at): each source's letters together, and the hash of its lines."""
    source, letters, digest, lines = None, [], hashlib.sha256(), 0

    def row():
        return pa.RecordBatch.from_arrays([pa.array([source], pa.int64()), pa.array(["".join(letters)]), pa.array([digest.hexdigest()])], ["source", "audit", "repaired_sha256"])

    for batch in batches:
        for s, letter, line in zip(*(batch.column(c).to_pylist() for c in ("source", "letter", "line")), strict=True):
            if s != source:
                if source is not None:
                    yield row()
                source, letters, digest, lines = s, [], hashlib.sha256(), 0
            letters.append(LETTERS[letter - 1])
            if line is not None:
                digest.update((b"\n" if lines else b"") + line.encode())
                lines += 1
    if source is not None:
        yield row()


def repaired(rows: DataFrame, path: DataFrame) -> DataFrame:
    """(source, audit, repaired_sha256) of numbered rows and paths over them."""
    bounded_batches(rows.sparkSession)
    given = F.when(F.col("v").bitwiseAND(F.lit(3)) == 2, "assistant").otherwise("user")
    edits = path.withColumn("given", given)
    inserted = edits.where(F.col("letter") == _I).select("source", "at", "letter", F.concat("given", F.lit(":")).alias("line"))
    deleted = edits.where(F.col("letter") == _D).select("source", "at", "letter", F.lit(None).cast("string").alias("line"))
    stay = edits.where(F.col("letter").isin(_K, _R)).withColumn("g", F.floor(F.col("v") / 8).cast("bigint"))
    role = F.when(F.col("letter") == _K, F.col("role")).otherwise(F.col("given"))
    stay = stay.join(rows.select("g", "role", "text"), "g").select("source", "at", "letter", F.concat(role, F.lit(":"), "text").alias("line"))
    every = inserted.unionByName(deleted).unionByName(stay)
    return every.repartition(n_partitions(rows.sparkSession), "source").sortWithinPartitions("source", "at").select("source", "letter", "line").mapInArrow(_hashed, REPAIRED)


def op13_conversation_repair(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: a row for each conversation of the table."""
    conversations = conversations.select("conv_id", "turn", "role", "text")
    rows = numbered(damage(conversations))
    marked = faults(rows)
    arcs = optimal_arcs(marked)
    costs = arcs.where("cost IS NOT NULL").groupBy(F.col("v").alias("source")).agg(F.max("cost").alias("cost"))
    done = repaired(rows, least_paths(arcs.select("v", "letter", "w"), costs.select(F.col("source").alias("v"))))
    count = lambda f: F.count_if(F.col("fault") == f)
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    stats = marked.groupBy("conv_id").agg(
        gaps.cast("bigint").alias("gaps"), count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(CUT).alias("truncated"), F.count_if("illegal").alias("illegal"), (8 * F.min("g")).alias("source")
    )
    whole = stats.join(costs, "source").join(done, "source").withColumnRenamed("conv_id", "_conv")
    out = conversations.select("conv_id").distinct()
    out = out.join(whole, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
