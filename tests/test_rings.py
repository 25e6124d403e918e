"""Rings of random cells against a walk around them, for tiles of several sizes."""

import random
from collections import Counter

import pytest

from thalweg.operators import rings


def walked(cells):
    """Rings of a set of cells as sets of edges, by a walk that turns right where it can."""
    out = {}
    for r, c in cells:
        for (dr, dc), a, b in [((-1, 0), (r, c), (r, c + 1)), ((0, 1), (r, c + 1), (r + 1, c + 1)), ((1, 0), (r + 1, c + 1), (r + 1, c)), ((0, -1), (r + 1, c), (r, c))]:
            if (r + dr, c + dc) not in cells:
                out.setdefault(a, set()).add(b)
    found = []
    while out:
        at = start = min(out)
        way, ring = (0, 0), []
        while True:
            right = (way[1], -way[0])  # of (row, column) steps: east to south
            options = out[at]
            step = next((n for n in [(at[0] + right[0], at[1] + right[1]), (at[0] + way[0], at[1] + way[1])] if n in options), min(options))
            options.discard(step)
            if not options:
                del out[at]
            ring.append((at, step))
            way, at = (step[0] - at[0], step[1] - at[1]), step
            if at == start:
                break
        found.append(frozenset(ring))
    return Counter(found)


@pytest.mark.parametrize(("seed", "size", "density"), [(1, 4, 0.5), (2, 7, 0.75), (3, 64, 0.6), (4, 3, 0.95)])
def test_rings_of_random_cells(spark, seed, size, density):
    rng = random.Random(seed)
    labels = {label: {(r, c) for r in range(19) for c in range(23) if rng.random() < density} for label in (1, 2)}
    rows = [(label, r, c) for label, cells in labels.items() for r, c in cells]
    df = spark.createDataFrame([*rows, rows[0]], "label long, row int, col int")
    found = rings.outlines(df, size).collect()
    for label, cells in labels.items():
        mine = [r for r in found if r.label == label]
        edges = [frozenset(zip([(v.y, v.x) for v in r.vertices], [(v.y, v.x) for v in r.vertices][1:], strict=False)) for r in mine]
        assert Counter(edges) == walked(cells)
        assert all(r.vertices[0] == r.vertices[-1] for r in mine)
        area = {r.ring: sum(a.x * b.y - b.x * a.y for a, b in zip(r.vertices, r.vertices[1:], strict=False)) / 2 for r in mine}
        assert sum(area.values()) == len(cells) and all((area[r.ring] > 0) == (r.sense == 1) for r in mine)
        sizes = {r.ring: (r.area, r.perimeter) for r in rings.measures(df, size).where(f"label = {label}").collect()}
        assert sizes == {r.ring: (area[r.ring], len(r.vertices) - 1.0) for r in mine}


def test_no_cells_and_one(spark):
    df = spark.createDataFrame([(5, 2, 3)], "label long, row int, col int")
    one = rings.outlines(df).collect()
    assert [(r.label, r.sense, [(v.y, v.x) for v in r.vertices]) for r in one] == [(5, 1, [(2, 3), (2, 4), (3, 4), (3, 3), (2, 3)])]
    assert rings.outlines(df.where("false")).count() == 0 and rings.measures(df.where("false")).count() == 0


def test_cells_are_dealt_out_by_their_number(spark, monkeypatch):
    """However well cells in order shrink, tasks hold a bounded number of them; and no cell gets a row for each side."""
    from thalweg.operators import store

    assert [store.tasks(n) for n in (0, 499_999, 500_000, 7_000_000)] == [1, 1, 2, 15]
    monkeypatch.setattr(rings, "tasks", lambda n: 7)
    square = spark.createDataFrame([(1, r, c) for r in range(30) for c in range(30)], "label long, row int, col int")
    made = []
    monkeypatch.setattr(rings, "settled", lambda df, plain=False: made.append(df) or df)
    assert rings.boundary_edges(square).count() == 120
    assert made[0].rdd.getNumPartitions() == 7 and made[0].count() == 120


def test_units_are_dealt_out_by_their_number(spark, monkeypatch):
    from thalweg.operators import dissolve

    monkeypatch.setattr(dissolve, "tasks", lambda n: 7)
    cells = spark.createDataFrame([(u, r, c) for u in (1, 2) for r in range(9) for c in range(4)], "unit long, row int, col int")
    made = []
    monkeypatch.setattr(dissolve, "settled", lambda df, plain=False: made.append(df) or df)
    groups = cells.select("unit").distinct().selectExpr("unit", "0L as label")
    assert dissolve.merged_cells(cells, groups).count() == 36 and made[0].rdd.getNumPartitions() == 7
    links = spark.createDataFrame([(5, 1), (5, 2)], "lake_id long, LINKNO long")
    mask, lakes = cells.where("unit = 1").selectExpr("5L as lake_id", "row", "col"), spark.createDataFrame([(5, 2.0)], "lake_id long, Lake_area double")
    basins = spark.createDataFrame([(1,), (2,), (3,)], "DN long")
    df = dissolve.reservoir_basins(basins, cells.withColumnRenamed("unit", "DN"), links, links.where("LINKNO = 1"), mask, lakes)
    assert {(r.DN, r.lake_id, r.frac_lake, r.n_cells) for r in df.collect()} == {(1, 5, 1.0, 36), (3, -1, 0.0, 0)}
    assert df._jdf.queryExecution().toString().count(", 7), REPARTITION_BY_NUM") >= 2
