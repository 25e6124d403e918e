"""Outlets of lakes: rays, breakouts, carving and the order in which they are tried, on hand-worked windows; geometry."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from thalweg.functions import geometry as G
from thalweg.operators import dissolve, routing, spatial


def lake(*rows):
    return np.array([[c == "#" for c in row] for row in rows])


def test_ray_leaves_the_middle_of_the_other_cells():
    mask = lake(".......", ".......", "..###..", "..###..", "..###..", ".......", ".......")
    # from the middle of the upper side straight up, of a corner along the diagonal by unit steps
    assert list(routing.ray(mask, (2, 3))) == [(1, 3), (0, 3)]
    corner = list(routing.ray(mask, (2, 2)))
    middle = np.mean([(r, c) for r, c in np.argwhere(mask) if (r, c) != (2, 2)], 0)
    way = (np.array([2, 2]) - middle) / np.hypot(*(np.array([2, 2]) - middle))
    assert corner == [tuple(int(x) for x in np.round(np.array([2, 2]) + k * way)) for k in range(1, len(corner) + 1)]
    assert list(routing.ray(lake("...", ".#.", "..."), (1, 1))) == []
    assert list(routing.ray(lake(".....", ".###.", "....."), (1, 2))) == []  # the middle is the cell itself


def test_breakout_needs_as_many_cells_as_the_flow_comes_back_from():
    mask = lake(".......", ".###...", ".###...", ".###...", ".......")
    west, upwards, none = 5, 4, 0
    fdr = np.full(mask.shape, west)  # all flows back into the lake from the east,
    fdr[2] = upwards
    fdr[2, 6] = none  # until here
    path, ok = routing.breakout(mask, fdr, (2, 3))
    assert ok and path == [(2, 3), (2, 4), (2, 5), (2, 6)]
    fdr[2, 6] = upwards
    assert routing.breakout(mask, fdr, (2, 3)) == ([(2, 3), (2, 4), (2, 5), (2, 6)], False)  # out of the window
    wide = np.pad(mask, ((0, 0), (0, 6)))
    back = np.full(wide.shape, west)
    back[2] = upwards
    path, ok = routing.breakout(wide, back, (2, 3))
    assert not ok and len(path) == 6  # the shore and five cells outside
    # the flow of an earlier cell of the path is what the path says, not what it was
    back[2, 5] = west
    path, ok = routing.breakout(wide, back, (2, 3))
    assert ok and path == [(2, 3), (2, 4), (2, 5)]


def test_carving_reaches_another_basin():
    mask = lake("........", ".##.....", ".##.....", "........")
    basin = np.full(mask.shape, 4)
    basin[:, 6:] = 9
    path, ok = routing.carve(mask, basin, (1, 2), routing.Routing(carve_steps=100))
    assert not ok or basin[path[-1]] == 9
    basin[mask] = -1
    basin[2, 1] = 9
    assert routing.home_basin(mask, basin, (1, 2)) == 9
    short = routing.carve(lake("........", ".###....", "........"), np.array([[4] * 8] * 3), (1, 3), routing.Routing(carve_steps=2))
    assert short == ([(1, 3), (1, 4), (1, 5)], False)


def windows_of(spark, lakes):
    rows = []
    for k, (mask, fdr, w) in lakes.items():
        rows += [(k, r, 100 * k + c, bool(mask[r, c]), int(fdr[r, c]), int(w[r, c])) for r in range(mask.shape[0]) for c in range(mask.shape[1])]
    return spark.createDataFrame(rows, "lake_id long, row int, col int, inside boolean, fdr int, w int")


def test_outlets_by_tier(spark):
    mask = lake("........", ".###....", ".###....", ".###....", "........")
    west = np.full(mask.shape, 5)
    free, back = west.copy(), west.copy()
    free[2, 4] = 0
    back[2] = 4
    basin = np.full(mask.shape, 4)
    other = basin.copy()
    other[:, 5:] = 9
    lakes = {
        1: (mask, west, basin),  # no override: best of two exits
        2: (mask, west, basin),  # override by an exit: snaps
        3: (mask, free, other),  # override in a basin of its own: breaks out
        4: (mask, back, basin),  # breakout fails: falls back on the exit
        5: (mask, west, other),  # override in a basin of the lake: carves
        6: (mask, west, basin),  # carving fails, no exit: isolated
        7: (mask, west, basin),  # no exit, no override
    }
    win = windows_of(spark, lakes)
    exits = [(1, 1, 101, 11, math.inf, 5.0, 3.0, 0, 1), (1, 3, 103, 12, 9.0, 9.0, 1.0, 0, 2), (2, 1, 201, 13, math.inf, 1.0, 1.0, 0, 3), (2, 3, 203, 14, math.inf, 0.0, 9.0, 0, 4), (4, 1, 401, 15, 1.0, 1.0, 1.0, 1, 5)]
    exits = spark.createDataFrame(exits, "lake_id long, row int, col int, link_no long, gauge_dist double, doutend double, local_accum double, dscontarea long, seq long")
    shore = win.where("inside and not (row = 2 and col % 100 = 2)").select("lake_id", "row", "col")
    at = [(2, 1.4, 201.2), (3, 2.0, 306.0), (4, 2.0, 406.0), (5, 2.0, 505.0), (6, 2.0, 606.0)]
    at = spark.createDataFrame(at, "lake_id long, row double, col double")
    cells = win.select("row", "col", "w")
    through = spark.createDataFrame([(5, 9), (6, 4)], "lake_id long, w int")
    plans = routing.plan_outlets(win.select("lake_id").distinct(), exits, shore, at, cells, through)
    got = {r.lake_id: r for r in routing.edit_lakes(win, plans).collect()}
    kinds = {k: (r.sel_type, r.trow, r.tcol, r.link_no) for k, r in got.items()}
    assert kinds == {
        1: ("algorithmic_stream", 3, 103, 12), 2: ("override_snapped", 1, 201, 13), 3: ("override_direct_ds", 2, 303, -1), 4: ("algorithmic_stream", 1, 401, 15),
        5: ("override_carved", 2, 503, -1), 6: ("skipped_isolated", None, None, None), 7: ("skipped_isolated", None, None, None),
    }
    assert got[6].edits == got[7].edits == []
    edits = {k: {(e.row, e.col): e.new_fdr for e in r.edits} for k, r in got.items()}
    assert edits[3][2, 303] == 1 and (2, 304) not in edits[3]  # out to the east; the cell after ends as it did
    assert [edits[5].get((2, c)) for c in (503, 504)] == [1, 1]
    assert (1, 201) not in edits[2]  # outlets on streams keep their own direction


def test_clipped_rings_and_lines(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        n, cx, cy = rng.randint(3, 9), rng.uniform(0, 10), rng.uniform(0, 10)
        turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        ring = [(cx + 4 * math.cos(a), cy + 4 * math.sin(a)) for a in turns]
        line = [(rng.uniform(-2, 12), rng.uniform(-2, 12)) for _ in range(3)]
        rows.append((i, [*ring, ring[0]], line))
    kind = "array<struct<x: double, y: double>>"
    df = spark.createDataFrame(rows, f"id long, ring {kind}, line {kind}")
    clipped = G.clip_box(F.col("ring"), 2.0, 3.0, 8.0, 9.0)
    got = df.select("id", F.when(F.size(clipped) > 3, G.ring_area(clipped)).otherwise(0.0).alias("area"), G.length_inside(F.col("line"), F.col("ring")).alias("within"), G.line_meets(F.col("line"), F.col("ring")).alias("meets"))

    def inside(p, ring):
        return sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:])) % 2 == 1

    for r in got.collect():
        _, ring, line = rows[r.id]
        n = 300
        fine = [(2 + 6 * (i + 0.5) / n, 3 + 6 * (j + 0.5) / n) for i in range(n) for j in range(n)]
        assert r.area == pytest.approx(36 * sum(inside(p, ring) for p in fine) / n**2, abs=0.25)
        steps = [(a, b, (k + 0.5) / 4000) for a, b in zip(line, line[1:]) for k in range(4000)]
        within = sum(math.dist(a, b) / 4000 for a, b, t in steps if inside((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])), ring))
        assert r.within == pytest.approx(within, abs=0.02)
        assert r.meets or r.within == 0
        assert r.meets == (within > 0) or r.within < 0.02


def test_unions_cancel_inner_edges(spark):
    cells = [(1, r, c) for r in range(3) for c in range(3)] + [(2, r, c) for r in range(3) for c in range(3, 6) if (r, c) != (1, 4)]
    df = spark.createDataFrame(cells, "unit long, row int, col int")
    one = spark.createDataFrame([(1, 7), (2, 7)], "unit long, label long")
    rings = dissolve.union_outlines(df, one).collect()
    assert sorted((r.sense, len(r.vertices) - 1) for r in rings) == [(-1, 4), (1, 18)]
    got = dissolve.cell_area(dissolve.merged_cells(df, one)).first()
    assert (got.area, got.perimeter) == (17.0, 22.0)


def test_attributes_by_rule(spark):
    df = spark.createDataFrame([(1, 5, None, 2.0), (1, 6, "b", 3.0), (1, 7, "c", None), (None, 1, "x", 1.0), (2, 9, None, None)], "k long, o long, s string, v double")
    got = {r.k: tuple(r)[1:] for r in dissolve.dissolve(df, "k", {"s": "first", "v": "sum", "o": "max"}, "o").collect()}
    assert got == {1: ("b", 5.0, 7), 2: (None, None, 9)}


def test_lines_and_polygons_across_buckets(spark):
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    lines = {1: [(-5.0, 5.0), (15.0, 5.0)], 2: [(2.0, 2.0), (3.0, 3.0)], 3: [(20.0, 20.0), (30.0, 30.0)], 4: [(10.0, -5.0), (10.0, 15.0)]}
    kind = "array<struct<x: double, y: double>>"
    left = spark.createDataFrame(list(lines.items()), f"LINKNO long, line {kind}")
    right = spark.createDataFrame([(1, square)], f"lake_id long, ring {kind}")
    for cell in (1.0, 7.0, 100.0):
        got = {r.LINKNO: (round(r.overlap, 6), r.mid_inside, r.tips_inside) for r in spatial.lines_in_polygons(left, right, cell).collect()}
        assert got == {1: (10.0, True, False), 2: (round(2**0.5, 6), True, True), 4: (0.0, False, False)}


def test_balanced_batches():
    assert dissolve.balanced_batches([("a", 5), ("b", 4), ("c", 3), ("d", 3)], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}
