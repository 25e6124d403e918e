"""Routing over tiles against the kernel that takes a lake at a time."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from thalweg.operators import centerline, raster, routing


def blob(rng, rows, cols):
    """A winding lake with islands, and a part that hangs together with nothing."""
    mask = np.zeros((rows, cols), bool)
    r, c = rows // 2, 2
    for _ in range(rows * 4):
        k = rng.randint(1, 3)
        mask[max(1, r - k) : r + k, max(1, c - k) : c + k] = True
        r, c = min(rows - 4, max(3, r + rng.randint(-3, 3))), min(cols - 4, max(3, c + rng.randint(-1, 3)))
    for _ in range(3):
        r, c = rng.randrange(rows), rng.randrange(cols)
        mask[r : r + 2, c : c + 2] = False
    mask[[0, -1]] = mask[:, [0, -1]] = False
    mask[0, 0] = True
    return mask


def table(spark, lakes):
    rows, targets = [], []
    for k, (mask, fdr, (r0, c0), target) in lakes.items():
        rows += [(k, r + r0, c + c0, bool(mask[r, c]), int(fdr[r, c])) for r in range(mask.shape[0]) for c in range(mask.shape[1])]
        targets.append((k, target[0] + r0, target[1] + c0))
    return spark.createDataFrame(rows, "lake_id long, row int, col int, inside boolean, fdr int"), spark.createDataFrame(targets, "lake_id long, trow int, tcol int")


@pytest.fixture(scope="module")
def lakes():
    rng = random.Random(8)
    out = {}
    for k in range(3):
        mask = blob(rng, rng.randint(16, 30), rng.randint(20, 40))
        cells = np.argwhere(mask)[1:]
        fdr = np.array([[rng.randint(1, 8) for _ in range(mask.shape[1])] for _ in range(mask.shape[0])])
        out[k] = (mask, fdr, (rng.randint(0, 50), rng.randint(0, 50)), tuple(int(x) for x in cells[rng.randrange(len(cells))]))
    full = np.ones((5, 9), bool)  # fills its window
    out[7] = (full, np.ones((5, 9), int), (4, 4), (0, 8))
    out[8] = (np.array([[False, True]]), np.array([[3, 3]]), (0, 0), (0, 1))  # one cell
    return out


def test_bank_distances(spark, lakes):
    windows, _ = table(spark, lakes)
    got = {(r.lake_id, r.row, r.col): r.bank for r in centerline.bank_distances(windows).collect()}
    want = {}
    for k, (mask, _, (r0, c0), _) in lakes.items():
        bank = routing.bank_distance(mask)
        want |= {(k, r + r0, c + c0): bank[r, c] for r, c in np.argwhere(mask).tolist()}
    assert got == want


@pytest.mark.parametrize("size", [7, 64])
def test_routes_over_tiles(spark, lakes, size):
    windows, targets = table(spark, lakes)
    got = sorted(map(tuple, centerline.route_lakes(windows, targets, size=size).collect()))
    want = []
    for k, (mask, fdr, (r0, c0), target) in lakes.items():
        new = routing.route(mask, fdr, target, True)
        want += [(k, r + r0, c + c0, int(new[r, c])) for r, c in np.argwhere(new != fdr).tolist()]
    assert got == sorted(want)


def test_windows_are_dealt_out_by_tiles(spark):
    """A generator's rows are unknown to the planner: cells of windows must not be what it broadcasts."""
    cells = spark.range(300 * 300).select((F.col("id") / 300).cast("int").alias("row"), (F.col("id") % 300).cast("int").alias("col"), "id")
    boxes = [(1, (3, 60, 200, 130)), (2, (0, 0, 1, 1)), (3, (64, 64, 64, 64)), (4, (290, 290, 10, 10))]
    values = ", ".join(f"({k}L, named_struct('xoff', {x}, 'yoff', {y}, 'xsize', {n}, 'ysize', {m}))" for k, (x, y, n, m) in boxes)
    windows = spark.sql(f"SELECT * FROM VALUES {values} AS t(lake_id, w)")  # of a size that the planner knows
    got = raster.window_cells(windows, cells)
    assert {tuple(r) for r in got.select("lake_id", "row", "col", "id").collect()} == {
        (k, r, c, r * 300 + c) for k, (x, y, n, m) in boxes for r in range(y, y + m) for c in range(x, x + n)
    }
    assert 0 < sum(_broadcasts(got)) < 100


def _broadcasts(df):
    """Rows of each broadcast of a plan, which it runs."""
    df.collect()
    plan, found = [df._jdf.queryExecution().executedPlan()], []
    while plan:
        p = plan.pop()
        if "BroadcastExchange" in p.nodeName():
            found.append(p.metrics().apply("numOutputRows").value())
        plan += [p.finalPhysicalPlan()] if p.nodeName().startswith("AdaptiveSparkPlan") else [p.plan()] if "QueryStage" in p.nodeName() else []
        plan += [p.children().apply(i) for i in range(p.children().size())]
    return found


def test_edited_lakes_over_tiles(spark, lakes):
    windows, _ = table(spark, lakes)
    windows = windows.withColumn("w", ((F.col("col") / 9).cast("int") + 1))
    rows, kinds = [], {0: routing.CARVED, 1: routing.DIRECT, 2: routing.SNAPPED, 7: routing.CARVED, 8: routing.NO_SHORE}
    for k, (mask, _, (r0, c0), target) in lakes.items():
        shore = tuple(int(x) for x in np.argwhere(mask)[-1] + (r0, c0)) if k != 8 else (None, None)
        rows.append((k, kinds[k], *shore, 9, target[0] + r0, target[1] + c0, 5))
    plans = spark.createDataFrame(rows, "lake_id long, try_ string, trow int, tcol int, link_no long, arow int, acol int, alink long")
    want = {r.lake_id: r for r in routing.edit_lakes(windows, plans).collect()}
    outlets, edits = centerline.edit_lakes(windows, plans, size=16)
    assert {r.lake_id: tuple(r) for r in outlets.collect()} == {k: tuple(r)[:5] for k, r in want.items()}
    assert sorted(map(tuple, edits.collect())) == sorted((k, *e) for k, r in want.items() for e in r.edits)
