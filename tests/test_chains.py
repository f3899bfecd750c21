"""Line merging against a walk over plain sets."""

from __future__ import annotations

import random

import pytest

from cadastra.operators import chains
from cadastra.operators.redistribute import merged_lines

SIDES = "a struct<x:double,y:double>, b struct<x:double,y:double>"


def merged(spark, sides):
    return sorted([tuple((p.x, p.y) for p in r.line) for r in chains.merge_lines(spark.createDataFrame(sides, SIDES)).collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_networks(spark, seed):
    """Sides of a grid, chosen at random: chains, junctions, rings, rings through a junction; given twice and both ways."""
    rnd = random.Random(seed)
    at = lambda i, j: (float(i), float(j))
    grid = [(at(i, j), at(i + di, j + dj)) for i in range(14) for j in range(14) for di, dj in ((1, 0), (0, 1), (1, 1))]
    sides = {s for s in grid if rnd.random() < 0.3}
    for k in range(4):  # rings apart from all else
        ring = [(100.0 + 10 * k, 0.0), (102.0 + 10 * k, rnd.random()), (101.0 + 10 * k, 3.0)]
        sides |= {(ring[i], ring[i - 1]) for i in range(3)}
    given = [s if rnd.random() < 0.5 else s[::-1] for s in sides for _ in range(rnd.choice([1, 1, 2]))] + [((0.0, 0.0), (0.0, 0.0))]
    want = merged_lines({(min(s), max(s)) for s in sides})
    canonical = lambda line: tuple(line if line[0] != line[-1] or line[1] < line[-2] else line[::-1])
    assert merged(spark, given) == sorted(map(canonical, want))


def test_a_long_chain(spark):
    """Three thousand sides in one line: some twelve rounds, not thousands."""
    pts = [(float(i), float(i % 7)) for i in range(3001)]
    sides = list(zip(pts, pts[1:], strict=False))
    random.Random(1).shuffle(sides)
    assert merged(spark, sides) == [tuple(pts)]


def test_no_sides(spark):
    assert merged(spark, []) == []
