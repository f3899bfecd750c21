"""Simplified partitions: no crossing, no lost ring, every removed corner within reach."""

from __future__ import annotations

import itertools
import random

import pytest

from cadastra.operators import redistribute as rd
from cadastra.operators import simplify

from .test_redistribute import SQUARES, tiling


def as_rows(cells):
    return [(k, v, [[{"x": x, "y": y} for x, y in r] for r in poly]) for k, v, poly in cells]


def simple(spark, cells, tol):
    got = simplify.simplify_partition(spark.createDataFrame(as_rows(cells), SQUARES), "key", tol, 5.0).collect()
    return {r.key: rd._from_rows([[[p.asDict() for p in ring] for ring in r.poly]])[0] for r in got}


def sound(cells, new, tol):
    sides = {(min(s), max(s)) for p in new.values() for s in rd._sides([p])}
    for (p, q), (r, s) in itertools.combinations(sorted(sides), 2):
        turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        if not {p, q} & {r, s}:
            assert not (turn(p, q, r) * turn(p, q, s) <= 0 and turn(r, s, p) * turn(r, s, q) <= 0), (p, q, r, s)
    for k, _, poly in cells:
        assert len(new[k]) == len(poly)
        for old, ring in zip(poly, new[k], strict=True):
            assert len(ring) >= 4 and rd._area(list(itertools.pairwise(ring))) * rd._area(list(itertools.pairwise(old))) > 0
            at, n = [old.index(v) for v in ring[:-1]], len(old) - 1
            for i, j in zip(at, [*at[1:], at[0]], strict=True):
                for m in range(i + 1, i + (j - i) % n):
                    assert rd._off(old[m % n], old[i], old[j]) <= tol + 1e-9
    assert abs(sum(rd._area(rd._sides([p])) for p in new.values())) > 0


@pytest.mark.parametrize("seed,tol", [(1, 0.3), (2, 1.5)])
def test_irregular_tilings(spark, seed, tol):
    cells = tiling(seed, 4)
    new = simple(spark, cells, tol)
    sound(cells, new, tol)
    assert sum(len(r) for p in new.values() for r in p) < sum(len(r) for _, _, p in cells for r in p)
    rnd = random.Random(seed)
    for _ in range(100):  # still a partition
        v = (rnd.uniform(4, 36), rnd.uniform(4, 36))
        assert sum(rd._holds(rd._sides([p]), v) for p in new.values()) == 1


def test_islands_and_lenses_are_kept(spark):
    """An island in a bay that a straight side would sweep over; a lens between two chains with the same ends."""
    shell = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (6.0, 10.0), (5.0, 8.0), (4.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    island = [(4.9, 9.0), (5.1, 9.0), (5.0, 9.3), (4.9, 9.0)]
    lens = [(20.0, 0.0), (25.0, 0.4), (30.0, 0.0), (25.0, -0.4), (20.0, 0.0)]
    below = [(20.0, 0.0), (25.0, -0.4), (30.0, 0.0), (30.0, -9.0), (20.0, -9.0), (20.0, 0.0)]
    cells = [(1, 0, [shell]), (2, 0, [island]), (3, 0, [lens]), (4, 0, [below])]
    new = simple(spark, cells, 3.0)
    assert (5.0, 8.0) in new[1][0] and len(set(new[3][0])) >= 3
    sound(cells, new, 3.0)
