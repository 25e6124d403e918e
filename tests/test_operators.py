"""Operators on hand-made networks, lakes and files, against plain Python."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from thalweg.functions import geometry as G
from thalweg.functions import rules
from thalweg.operators import network, raster, rings, routing, terrain
from thalweg.sources import shapefile, tables


def links(spark, pairs):
    return spark.createDataFrame(pairs, "LINKNO long, DSLINKNO long")


def test_closure_of_random_trees_and_a_cycle(spark):
    random.seed(3)
    pairs = [(i, random.randint(1, i - 1)) if i > 1 else (1, -1) for i in range(1, 60)]
    down = dict(pairs)
    want = set()
    for i in down:
        at, hops = down[i], 1
        while at > 0:
            want.add((i, at, hops))
            at, hops = down[at], hops + 1
    got = {tuple(r) for r in network.closure(network.edges(links(spark, pairs))).collect()}
    assert got == want
    ring = network.closure(network.edges(links(spark, [(1, 2), (2, 3), (3, 1)])))
    assert ring.count() == 9


def test_accumulate_and_path_sums(spark):
    chain = spark.createDataFrame([(i, i - 1 if i > 1 else None, i) for i in range(1, 41)], "id long, down long, w long")
    total = dict(network.accumulate(chain, "w").collect())
    assert total == {i: sum(range(i, 41)) for i in range(1, 41)}
    below = dict(network.path_sums(chain, "w").collect())
    assert below == {i: sum(range(1, i)) for i in range(1, 41)}
    with pytest.raises(ValueError):
        network.accumulate(spark.createDataFrame([(1, 2, 1), (2, 1, 1)], "id long, down long, w long"), "w", 6)
    with pytest.raises(ValueError):
        network.path_folds(spark.createDataFrame([(1, 2, 1), (2, 1, 1)], "id long, down long, w long"), ["w"])


def test_zero_ends_walks_only_where_it_is_an_end(spark):
    zero = links(spark, [(5, 0), (0, -1)])
    assert network.closure(network.edges(zero)).count() == 0
    assert network.closure(network.edges(zero, ends=(-1,))).count() == 1


def test_phantom_chain_is_absorbed(spark):
    streams = spark.createDataFrame(
        [(1, 2, 10.0, 1.0, 50.0, 9.0), (2, 3, 5.0, 1.0, 40.0, 8.0), (3, 4, 2.0, 1.0, 60.0, 7.0), (4, -1, 1.0, 0.0, 70.0, 6.0)],
        "LINKNO long, DSLINKNO long, Length double, strmDrop double, DSContArea double, DOUTEND double",
    )
    at = lambda x: F.struct(x.cast("double").alias("x"), F.lit(0.0).alias("y"))
    line = F.array(at(-F.col("LINKNO") - 1), at(-F.col("LINKNO")))
    streams = streams.withColumns({"line": line, "DOUTSTART": F.col("DOUTEND") + F.col("Length")})
    basins = spark.createDataFrame([(1,), (4,)], "DN long")
    got = {r.LINKNO: r for r in network.bypass_phantoms(streams, basins).collect()}
    assert (got[1].DSLINKNO, got[1].Length, got[1].DSContArea, got[1].DOUTEND, got[1].n_absorbed) == (4, 17.0, 40.0, 7.0, 2)
    assert got[4].DSLINKNO == -1 and got[4].n_absorbed == 0


def test_validation_names_dangling_links(spark):
    with pytest.raises(ValueError, match="2 -> 9"):
        network.validate(links(spark, [(1, 2), (2, 9)]), spark.createDataFrame([(1,), (2,)], "id long"))


def test_slopes_and_rounding(spark):
    values = [(0.0,), (1e-9,), (0.5,), (1.0,), (2.0,), (None,)]
    got = [r[0] for r in spark.createDataFrame(values, "s double").select(rules.clamp_slope(F.col("s"), 0.001)).collect()]
    assert got == [0.001, 0.001, 0.5, 0.001, 0.001, 0.001]
    odd = spark.createDataFrame([(0.0005,), (2.5,), (-2.5,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in rules.export(odd, 3).collect()] == [0.0, 2.5, -2.5, 0.0, 0.0]


def test_polygon_with_a_hole_and_its_boundary(spark):
    ring = lambda k: [(k, k), (10 - k, k), (10 - k, 10 - k), (k, 10 - k), (k, k)]
    as_sql = lambda r: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in r])
    p = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    row = spark.range(1).select(
        G.polygon_area(F.array(as_sql(ring(0)), as_sql(ring(2)))).alias("area"),
        G.contains(as_sql(ring(0)), p(5, 5)).alias("inside"),
        G.contains(as_sql(ring(0)), p(0, 5)).alias("edge"),
        G.contains(as_sql(ring(0)), p(11, 5)).alias("outside"),
        G.from_mercator(G.to_mercator(F.lit(12.0), F.lit(47.0))["x"], G.to_mercator(F.lit(12.0), F.lit(47.0))["y"]).alias("back"),
    ).first()
    assert (row.area, row.inside, row.edge, row.outside) == (64.0, True, False, False)
    assert math.isclose(row.back.x, 12.0) and math.isclose(row.back.y, 47.0)


def test_bank_distance_is_exact():
    rng = np.random.default_rng(1)
    mask = rng.random((9, 11)) < 0.8
    other = np.argwhere(~mask)
    want = np.array([[0 if not mask[r, c] else np.hypot(other[:, 0] - r, other[:, 1] - c).min() for c in range(11)] for r in range(9)])
    assert np.allclose(routing.bank_distance(mask), want)


@pytest.mark.parametrize("hole", [False, True])
def test_routes_end_at_the_target(hole):
    mask = np.zeros((9, 9), bool)
    mask[1:8, 1:8] = True
    if hole:
        mask[3:6, 3:6] = False
    out = routing.route(mask, np.zeros((9, 9), int), (7, 4), True)
    for cell in map(tuple, np.argwhere(mask)):
        seen = set()
        while cell != (7, 4):
            assert cell not in seen and mask[cell]
            seen.add(cell)
            r, c = routing.STEPS[out[cell] - 1]
            cell = (cell[0] + r, cell[1] + c)
    assert (out[~mask] == 0).all()


def test_disconnected_cells_keep_their_direction():
    mask = np.zeros((5, 9), bool)
    mask[1:4, 1:4] = mask[1:4, 6:8] = True
    out = routing.route(mask, np.full((5, 9), 7), (2, 1), False)
    assert (out[1:4, 6:8] == 7).all()


def test_aggregation_keeps_protected_units():
    n = 12
    tree = pd.DataFrame({"id": range(1, n + 1), "down": [-9999, *range(1, n)], "unit": 30.0, "mask": [1, *[0] * (n - 1)]})
    tree.loc[5, "mask"], tree.loc[8, "mask"] = 3, 2
    tree["uparea"] = [30.0 * (n - i) for i in range(n)]
    tree["tree"] = 1
    final = pd.Series(routing.aggregate_tree(tree)[-1][1])
    assert final.notna().all() and final.loc[6] == 6 and final.loc[9] == 9
    assert (final == 6).sum() == 1  # a lake stays alone
    sums = tree.set_index("id").unit.groupby(final).sum()
    assert sums.sum() == tree.unit.sum() and len(sums) < n


def test_lookups_with_defaults(spark):
    cells = spark.createDataFrame([(0, 0, 5, "x"), (0, 1, None, "y"), (0, 2, 9, "z")], "row int, col int, w long, area string")
    links = spark.createDataFrame([(5, 50, None), (5, 51, 2.0), (None, 1, 1.0)], "w long, link long, area double")
    got = raster.lookup(cells, "w", links, {"link": -1, "area": float("inf")}).orderBy("col")
    assert got.columns == ["row", "col", "w", "link", "area"]
    assert [tuple(r)[2:] for r in got.collect()] == [(5, 51, 2.0), (None, -1, float("inf")), (9, -1, float("inf"))]


def test_pits_are_filled(spark):
    z = [[9, 9, 9, 9], [9, 1, 2, 9], [9, 9, 5, 9], [9, 9, 4, 9]]
    cells = spark.createDataFrame([(r, c, float(h)) for r, row in enumerate(z) for c, h in enumerate(row)], "row int, col int, z double")
    got = {(r.row, r.col): r.z for r in terrain.fill_pits(cells).collect()}
    assert got[1, 1] == got[1, 2] == 5.0 and got[3, 2] == 4.0


def test_outlines_of_a_ring_of_cells(spark):
    cells = spark.createDataFrame([(1, r, c) for r in range(3) for c in range(3) if (r, c) != (1, 1)], "label long, row int, col int")
    got = sorted((r.sense, r.area) for r in rings.outlines(cells).select("sense", G.ring_area(F.col("vertices")).alias("area")).collect())
    assert sorted(a for _, a in got) == [1.0, 9.0] and got[0][0] != got[1][0]


def test_shapefile_round_trip(spark, tmp_path):
    fields = [("Hylak_id", "long"), ("Lake_area", "double"), ("Lake_name_long", "string")]
    square = lambda k: [[{"x": float(x), "y": float(y)} for x, y in ((k, k), (k + 1, k), (k + 1, k + 1), (k, k))]]
    rows = [{"Hylak_id": k, "Lake_area": k / 4, "Lake_name_long": f"n{k}", "geometry": square(k)} for k in range(5)]
    assert shapefile.write_shapefile(iter(rows), fields, str(tmp_path / "lakes.shp"), "polygon") == 5
    shapefile.register(spark)
    df = spark.read.format("shapefile").option("rowsPerTask", 2).load(str(tmp_path / "lakes.shp"))
    got = {r.Hylak_id: r for r in df.collect()}
    assert len(got) == 5 and got[3].Lake_area == 0.75 and got[3].Lake_name_ == "n3"
    assert (got[2].minx, got[2].maxy) == (2.0, 3.0) and got[2].geometry[0][1].x == 3.0


def test_missing_tables_are_empty(spark, tmp_path):
    assert tables.read_overrides(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "o.csv").write_text("lake_id,lat,lon\n 589 ,53.6653,-103.3974\n")
    assert tables.read_overrides(spark, str(tmp_path / "o.csv")).first().lake_id == "589"


def test_tiled_raster_window(spark, tmp_path):
    cells = spark.createDataFrame([(r, c, r * 100 + c) for r in range(20) for c in range(20)], "row int, col int, v int")
    tables.write_cells(cells, str(tmp_path / "raster"), tile=8)
    got = tables.read_window(spark, str(tmp_path / "raster"), 6, 3, 5, 4, tile=8)
    assert sorted(r.v for r in got.collect()) == sorted(r * 100 + c for r in range(3, 7) for c in range(6, 11))


def test_gauge_stream(spark, tmp_path):
    from thalweg.streaming import gauges

    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0))])
    lakes = spark.range(1).select(F.lit(7).cast("long").alias("lake_id"), ring.alias("ring"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a", 1.0, 1.0), ("b", 9.0, 9.0)], "id string, x double, y double").write.parquet(source)
    df = gauges.located(gauges.incoming(spark, source, "id string, x double, y double"), lakes, 2.0)
    gauges.into_table(df, out, str(tmp_path / "mark")).awaitTermination()
    assert [(r.id, r.lake_id) for r in spark.read.parquet(out).collect()] == [("a", 7)]


def test_pits_across_tiles(spark):
    rng = np.random.default_rng(3)
    n = 40
    z = np.round(rng.random((n, n)) * 20)
    z[6:30, 6:30] = 3.0  # a basin over several tiles, behind a wall with one low pass
    z[5, 5:31] = z[30, 5:31] = z[5:31, 5] = z[5:31, 30] = 50.0
    z[5, 17] = 30.0
    want = np.where(np.pad(np.zeros((n - 2, n - 2), bool), 1, constant_values=True), z, np.inf)
    while True:
        around = np.pad(want, 1, constant_values=np.inf)
        low = np.min([around[1 + r : n + 1 + r, 1 + c : n + 1 + c] for r in (-1, 0, 1) for c in (-1, 0, 1)], axis=0)
        new = np.minimum(want, np.maximum(z, low))
        if (new == want).all():
            break
        want = new
    cells = [(r, c, float(z[r, c])) for r in range(n) for c in range(n)]
    got = terrain.fill_pits(spark.createDataFrame(cells, "row int, col int, z double"), 8).collect()
    assert len(got) == n * n
    assert all(x.z == want[x.row, x.col] for x in got)


def test_closure_writes_each_pair_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(network, "settled", lambda df, *a, **k: written.append(df.count()) or df.localCheckpoint())
    found = network.closure(network.edges(links(spark, [(i, i + 1) for i in range(1, 40)])))
    assert sum(written) == found.count() == 39 * 40 // 2
