"""Border redistribution: colours, the one-by-one pass, area, and who owns the ground."""

from __future__ import annotations

import collections
import itertools
import random

import pytest

from cadastra.operators import redistribute as rd

SQUARES = "key bigint, label bigint, poly array<array<struct<x:double,y:double>>>"


def tiling(seed, n=3, off=0):
    """n x n cells with ragged borders: (key, label, poly)."""
    rnd = random.Random(seed)
    corner = {(i, j): (10.0 * i + rnd.uniform(-1.2, 1.2), 10.0 * j + rnd.uniform(-1.2, 1.2)) for i in range(n + 1) for j in range(n + 1)}
    border = {}

    def line(a, b):
        if (a, b) not in border:
            (x0, y0), (x1, y1) = corner[a], corner[b]
            ts = sorted(rnd.uniform(0.1, 0.9) for _ in range(rnd.randrange(6)))
            length = ((x1 - x0) ** 2 + (y1 - y0) ** 2) ** 0.5
            off = [rnd.uniform(-1, 1) * min(0.9, 1.6 * min(t, 1 - t)) / length for t in ts]  # across the border and little near corners, so that none cross
            border[a, b] = [(x0, y0), *((x0 + t * (x1 - x0) - d * (y1 - y0), y0 + t * (y1 - y0) + d * (x1 - x0)) for t, d in zip(ts, off, strict=True)), (x1, y1)]
        return border[a, b]

    out = []
    for i in range(n):
        for j in range(n):
            low, high = line((i, j), (i + 1, j)), line((i, j + 1), (i + 1, j + 1))
            left, right = line((i, j), (i, j + 1)), line((i + 1, j), (i + 1, j + 1))
            ring = [*low[:-1], *right[:-1], *high[:0:-1], *left[::-1]]
            out.append((off + n * i + j, rnd.randrange(3), [[(x + 1000.0 * off, y) for x, y in ring]]))
    return out


def area(parts):
    return sum(rd._area(rd._sides([p])) for p in parts)


def neighbours(cells):
    at = collections.defaultdict(set)
    for k, _, poly in cells:
        for s in rd._sides([poly]):
            at[min(s), max(s)].add(k)
    label = {k: v for k, v, _ in cells}
    return sorted({tuple(sorted(x)) for x in at.values() if len(x) == 2 and len({label[k] for k in x}) == 2})


def crosses(p, q, r, s):
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return turn(p, q, r) * turn(p, q, s) < 0 and turn(r, s, p) * turn(r, s, q) < 0


@pytest.mark.parametrize("seed", range(0, 400, 20))
def test_tilings_are_valid(seed):
    sides = sorted({(min(s), max(s)) for k in range(seed, seed + 20) for _, _, p in tiling(k, 3, 10 * k) for s in rd._sides([p])})
    assert not any(crosses(*a, *b) for a, b in itertools.combinations(sides, 2) if not {*a} & {*b} and abs(a[0][0] - b[0][0]) < 20)


@pytest.mark.parametrize("first", range(0, 200, 50))
def test_area_is_kept_and_no_ground_is_anyones_twice(first):
    """200 random tilings, one pair after the other in random order."""
    for seed in range(first, first + 50):
        cells = tiling(seed)
        now = {k: [poly] for k, _, poly in cells}
        whole, pairs = sum(area(p) for p in now.values()), neighbours(cells)
        random.Random(seed).shuffle(pairs)
        for a, b in pairs:
            made = rd._straighten(now[a], now[b], 1.0, 2)
            if made:
                assert abs(area(made[0]) + area(made[1]) - area(now[a]) - area(now[b])) < 1e-6
                now[a], now[b] = made
        assert abs(sum(area(p) for p in now.values()) - whole) < 1e-6
        rnd = random.Random(seed)
        for _ in range(40):
            v = (rnd.uniform(3, 27), rnd.uniform(3, 27))
            assert sum(rd._holds(rd._sides(p), v) for p in now.values()) == 1


def test_pieces_go_where_their_inner_point_was():
    """A border with one tooth of area 2 to each side: the straight one gives both back."""
    a = [[[(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (5.0, 3.0), (4.0, 4.0), (3.0, 5.0), (4.0, 6.0), (4.0, 8.0), (0.0, 8.0), (0.0, 0.0)]]]
    b = [[[(8.0, 0.0), (8.0, 8.0), (4.0, 8.0), (4.0, 6.0), (3.0, 5.0), (4.0, 4.0), (5.0, 3.0), (4.0, 2.0), (4.0, 0.0), (8.0, 0.0)]]]
    new_a, new_b = rd._straighten(a, b, 1.0, 2)
    assert [[sorted(set(r)) for r in p] for p in new_a] == [[[(0.0, 0.0), (0.0, 8.0), (4.0, 0.0), (4.0, 8.0)]]]
    assert (area(new_a), area(new_b)) == (32.0, 32.0)


def test_an_enclave_keeps_its_own_ground():
    hole = [(4.0, 4.0), (4.0, 6.0), (6.0, 6.0), (6.0, 4.0), (4.0, 4.0)]
    a = [[[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)], hole]]
    b = [[[(10.0, 0.0), (20.0, 0.0), (20.0, 10.0), (10.0, 10.0), (10.0, 0.0)]]]
    new_a, new_b = rd._straighten(a, b, 1.0, 2)
    assert (area(new_a), area(new_b), len(new_a[0])) == (96.0, 100.0, 2)
    assert rd._straighten(a, [[hole[::-1]]], 0.1, 0)[1] and rd._straighten(a, [[[(50.0, 0.0), (51.0, 0.0), (51.0, 1.0), (50.0, 0.0)]]], 1.0, 2) is None


def test_merged_lines():
    sides = {((0.0, 0.0), (1.0, 0.0)), ((1.0, 0.0), (2.0, 0.0)), ((1.0, 0.0), (1.0, 1.0)), ((5.0, 5.0), (6.0, 5.0)), ((6.0, 5.0), (6.0, 6.0)), ((5.0, 5.0), (6.0, 6.0))}
    got = sorted(rd.merged_lines(sides))
    assert [len(x) for x in got] == [2, 2, 2, 4] and got[3][0] == got[3][-1] == (5.0, 5.0)


def test_equals_the_pass_one_by_one(spark):
    """Twelve tilings in one table, coloured and straightened by Spark, against a loop over the pairs in the order of their hashes."""
    cells = [c for i in range(12) for c in tiling(300 + i, 3, 100 * i)]
    df = spark.createDataFrame([(k, v, [[{"x": x, "y": y} for x, y in r] for r in poly]) for k, v, poly in cells], SQUARES)
    pairs = spark.createDataFrame(neighbours(cells), "a bigint, b bigint")
    order = [(r.a, r.b) for r in pairs.selectExpr("a", "b", "xxhash64(a, b) AS h").orderBy("h", "a", "b").collect()]
    now = {k: [poly] for k, _, poly in cells}
    for a, b in order:
        now[a], now[b] = rd._straighten(now[a], now[b], 1.0, 2) or (now[a], now[b])
    got = {r.key: rd._from_rows([[[p.asDict() for p in ring] for ring in poly] for poly in r.parts]) for r in rd.straighten(df, "key", "label").collect()}
    assert got == now
    colours = [c.collect() for c in rd.edge_colours(pairs)]
    assert sum(map(len, colours)) == len(order) and all(len({k for r in c for k in r}) == 2 * len(c) for c in colours)
