"""Tables of cells: neighbours without multiplying rows, and sizes that joins are planned by."""

import random

import pytest
from pyspark.sql import functions as F

from thalweg.functions import d8
from thalweg.operators import raster, spatial
from thalweg.operators.store import settled


def test_cells_in_order_are_never_small_to_the_planner(spark):
    df = spark.range(0, 2_000_000, 1, 1).select(F.lit(1).cast("long").alias("lake_id"), F.floor(F.col("id") / 2000).cast("int").alias("row"), (F.col("id") % 2000).cast("int").alias("col"))
    size = lambda table: int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size(settled(df, plain=True)) > 2_000_000 * 16
    assert settled(df, plain=True).rdd.getNumPartitions() > 1


def test_neighbours_by_windows_are_those_by_offsets(spark):
    at = {(lake, r, c): r * 7 + c * c for lake in (1, 2) for r in range(6) for c in range(6) if (r * 5 + c * 3 + lake) % 4}
    cells = spark.createDataFrame([(*k, v) for k, v in at.items()], "lake_id long, row int, col int, v int")
    for r in d8.with_around(cells, F.col("v"), ("lake_id",)).collect():
        for code, dr, dc in d8.OFFSETS:
            assert r[f"n{code}"] == at.get((r.lake_id, r.row + dr, r.col + dc))


def test_shoreline_and_arrivals(spark):
    cells = spark.createDataFrame([(1, r, c) for r in range(4) for c in range(4)], "lake_id long, row int, col int")
    shore = raster.shoreline(cells)
    assert sorted((r.row, r.col) for r in cells.exceptAll(shore).collect()) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    flows = spark.createDataFrame([(-1, 0, 7, 1), (0, 0, 7, 1), (0, 2, 0, 1)], "row int, col int, fdr int, src int")
    into = raster.inflows(shore, cells, flows)
    assert [(r.row, r.col) for r in into.collect()] == [(0, 0)]


def test_steepest_drop_over_a_gap(spark):
    cells = spark.createDataFrame([(0, 1, 5.0), (1, 0, 9.0), (2, 1, 1.0)], "row int, col int, z double")
    assert {(r.row, r.col): r.fdr for r in raster.steepest(cells).collect()} == {(0, 1): 0, (1, 0): 8, (2, 1): 0}


def test_narrow_lines_gather_only_points_beside_them(spark):
    at = lambda x, y: F.struct(x.cast("double").alias("x"), F.lit(y).alias("y"))
    lines = spark.range(2000).select(F.col("id").alias("LINKNO"), F.array(at(F.col("id"), 0.0), at(F.col("id"), 1000.0)).alias("line"))
    points = spark.range(0, 2000, 10).select(F.col("id").alias("pt"), at(F.col("id"), 500.0).alias("p"))
    assert spatial._fitted(points, lines, 5.0, 5000.0).count() < 200 * 60
    near = spatial.lines_near_points(points, lines, "pt", 5.0, 5000.0)
    assert near.groupBy("pt", "LINKNO").count().where("count > 1").isEmpty()
    assert near.count() == sum(0 <= x < 2000 for p in range(0, 2000, 10) for x in range(p - 5, p + 6))


def test_accumulation_within_tiles_first(spark, monkeypatch):
    """Over the whole grid only the last cells of ways in a tile are accumulated by joins, not all cells."""
    rng, n = random.Random(4), 31
    step = {code: (dr, dc) for code, dr, dc in d8.OFFSETS}
    high = {(r, c): rng.random() + (r + c) / 9 for r in range(n) for c in range(n) if rng.random() < 0.97}
    fdr, to = {}, {}
    for r, c in high:
        near = [(high[k], code, k) for code, dr, dc in d8.OFFSETS if (k := (r + dr, c + dc)) in high and high[k] < high[r, c]]
        fdr[r, c], to[r, c] = rng.choice(near)[1:] if near else (rng.choice([0, 3]), None)
        if to[r, c] is None and fdr[r, c] and (r - 1, c) in high:
            fdr[r, c] = 0
    want, edge = {}, {}
    for k in high:
        rim = sum((k[0] + dr, k[1] + dc) in high for dr, dc in step.values()) < 8
        at = k
        while at is not None:
            want[at], edge[at] = want.get(at, 0) + 1, edge.get(at, False) or rim
            at = to[at]
    sizes, all_ = [], raster.network.accumulate
    monkeypatch.setattr(raster.network, "accumulate", lambda nodes, *a, **b: (sizes.append(nodes.count()), all_(nodes, *a, **b))[1])
    cells = spark.createDataFrame([(*k, v) for k, v in fdr.items()], "row int, col int, fdr int")
    got = {(r.row, r.col): r.ad8 for r in raster.contributing(cells, n, size=8).collect()}
    assert got == want and sizes[0] < len(high) / 2
    clear = {(r.row, r.col): r.ad8 for r in raster.contributing(cells, n, check_edges=True, size=8).collect()}
    assert clear == {k: None if edge[k] else v for k, v in want.items()}


def test_accumulation_refuses_rings(spark):
    cells = spark.createDataFrame([(1, 1, 1), (1, 2, 5), (2, 2, 3)], "row int, col int, fdr int")
    with pytest.raises(ValueError, match="cycle"):
        raster.contributing(cells, 4)


def test_walk_ends_within_tiles_first(spark, monkeypatch):
    rng, n = random.Random(6), 25
    down = {i: None if rng.random() < 0.03 else rng.choice([i + 1, i + n, i + n + 1]) for i in range(n * n) if rng.random() < 0.98}
    sizes, all_ = [], raster.network.path_folds
    monkeypatch.setattr(raster.network, "path_folds", lambda nodes, *a, **b: (sizes.append(nodes.count()), all_(nodes, *a, **b))[1])
    got = raster.walk_ends(spark.createDataFrame(list(down.items()), "id long, down long"), n, size=8).collect()

    def end(i):
        while down[i] in down:
            i = down[i]
        return i

    assert {r.row * n + r.col: r.end for r in got} == {i: end(i) for i in down} and sizes[0] < len(down) / 2
