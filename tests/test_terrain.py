"""Filled depressions and directions across flats, by brute force on grids of several tiles."""

import heapq
import random
from collections import deque

import pytest

from thalweg.operators import terrain

STEPS = [(0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1), (1, 0), (1, 1)]  # codes 1 to 8


def grid(seed, rows, cols, heights, gaps=0.0):
    rng = random.Random(seed)
    return {(r, c): float(rng.choice(heights)) for r in range(rows) for c in range(cols) if rng.random() >= gaps}


def table(spark, z):
    return spark.createDataFrame([(r, c, h, "x") for (r, c), h in z.items()] + [(0, 10_000, None, "x")], "row int, col int, z double, note string")


def brute_fill(z):
    near = lambda k: [(k[0] + r, k[1] + c) for r, c in STEPS]
    edge = [(h, k) for k, h in z.items() if any(n not in z for n in near(k))]
    heapq.heapify(edge)
    out = {}
    while edge:
        h, k = heapq.heappop(edge)
        if k not in out:
            out[k] = h
            for n in near(k):
                if n in z and n not in out:
                    heapq.heappush(edge, (max(h, z[n]), n))
    return out


def breadth_first(cells, starts, z):
    far, todo = {k: 1 for k in starts}, deque(starts)
    while todo:
        k = todo.popleft()
        for r, c in STEPS:
            n = (k[0] + r, k[1] + c)
            if n in cells and z[n] == z[k] and n not in far:
                far[n] = far[k] + 1
                todo.append(n)
    return far


def brute_directions(z):
    fdr, inner = {}, {}
    for k, h in z.items():
        near = [(i + 1, (k[0] + r, k[1] + c)) for i, (r, c) in enumerate(STEPS)]
        drops = [((h - z[n]) / (2**0.5 if i % 2 == 0 else 1.0), -i) for i, n in near if n in z and z[n] < h]
        fdr[k] = -max(drops)[1] if drops else 0
        inner[k] = all(n in z for _, n in near)
    still = {k for k in z if fdr[k] == 0 and inner[k]}
    around = lambda k: [(i + 1, (k[0] + r, k[1] + c)) for i, (r, c) in enumerate(STEPS)]
    outlets = {k: min(i for i, n in around(k) if n not in still and z[n] == z[k]) for k in still if any(n not in still and z[n] == z[k] for _, n in around(k))}
    low = breadth_first(still, list(outlets), z)
    away = breadth_first(still, [k for k in still if any(z[n] > z[k] for _, n in around(k))], z)
    over = {k: 2 * low[k] - away.get(k, 0) for k in low}
    for k in low:
        ways = [(over[n], i) for i, n in around(k) if n in over and z[n] == z[k] and over[n] < over[k]]
        fdr[k] = outlets[k] if k in outlets else min(ways)[1]
    return fdr, inner


CASES = [(1, 21, 17, range(4), 0.0, 5), (2, 30, 26, range(40), 0.03, 8), (3, 18, 33, (1, 9), 0.0, 4), (4, 12, 12, (7,), 0.0, 64), (5, 25, 25, range(3), 0.1, 7)]


@pytest.mark.parametrize(("seed", "rows", "cols", "heights", "gaps", "size"), CASES)
def test_filled_and_directed(spark, seed, rows, cols, heights, gaps, size):
    z = grid(seed, rows, cols, list(heights), gaps)
    filled = terrain.fill_pits(table(spark, z), size)
    want = brute_fill(z)
    assert {(r.row, r.col): r.z for r in filled.collect()} == want
    got = {(r.row, r.col): r.fdr for r in terrain.directions(filled, size).collect()}
    fdr, inner = brute_directions(want)
    assert got == fdr
    assert all(got[k] > 0 for k in got if inner[k])
    for k in got:  # every walk ends at the edge
        steps = 0
        while got[k]:
            k = (k[0] + STEPS[got[k] - 1][0], k[1] + STEPS[got[k] - 1][1])
            steps += 1
            assert steps <= len(got)
        assert not inner[k]


def test_a_flat_that_winds_over_many_tiles(spark):
    """A corridor of one height that doubles back through tiles, walled off but for one end."""
    z = {(r, c): 9.0 for r in range(22) for c in range(22)}
    way = [(r, c) for r in range(2, 20, 2) for c in range(2, 20)] + [(r, 19 if (r // 2) % 2 else 2) for r in range(3, 18, 2)]
    z |= dict.fromkeys(way, 1.0)
    z[18, 20] = z[18, 21] = 1.0
    filled = {(r.row, r.col): r.z for r in terrain.fill_pits(table(spark, z), 6).collect()}
    assert filled == brute_fill(z)
    got = {(r.row, r.col): r.fdr for r in terrain.directions(table(spark, z), 6).collect()}
    assert got == brute_directions(z)[0]


def test_depressions_keep_no_direction_and_empty_grids(spark):
    z = {(r, c): 5.0 - (2 < r < 6 and 2 < c < 6) for r in range(9) for c in range(9)}
    got = {(r.row, r.col): r.fdr for r in terrain.directions(table(spark, z), 4).collect()}
    assert all(got[r, c] == 0 for r in range(3, 6) for c in range(3, 6)) and got == brute_directions(z)[0]
    none = table(spark, z).where("false")
    assert terrain.fill_pits(none).count() == 0 and terrain.directions(none).count() == 0
    one = spark.createDataFrame([(3, 4, 2.0)], "row int, col int, z double")
    assert [tuple(r) for r in terrain.fill_pits(one).collect()] == [(3, 4, 2.0)]
    assert [tuple(r) for r in terrain.directions(one).collect()] == [(3, 4, 0)]


def test_spill_levels_of_random_graphs(spark):
    rng = random.Random(4)
    for n, m in ((2, 1), (40, 70), (120, 400)):
        edges = [(i, rng.choice([-1, *range(i)]) if i else -1, float(rng.randint(1, 9))) for i in range(n)]
        edges += [(rng.randrange(n), rng.randrange(n), float(rng.randint(1, 9))) for _ in range(m)]
        ways = {}
        for a, b, h in edges:
            ways.setdefault(a, []).append((b, h))
            ways.setdefault(b, []).append((a, h))
        level, todo = {}, [(0.0, -1)]
        while todo:
            h, k = heapq.heappop(todo)
            if k not in level:
                level[k] = h
                for b, x in ways.get(k, []):
                    heapq.heappush(todo, (max(h, x), b))
        got = dict(terrain.spill_levels(spark.createDataFrame(edges, "a long, b long, level double")).collect())
        assert got == {k: h for k, h in level.items() if k != -1}
