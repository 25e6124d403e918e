"""Queries over all links against plain Python."""

import math

import duckdb
import pytest

from thalweg.plans import registry
from thalweg.plans.fixtures import TABLES, Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def streams(spark):
    return {r.LINKNO: r for r in Tables(spark, SF).streams.collect()}


def walk(streams, k, go=lambda n: True):
    out = [k]
    while (n := streams[out[-1]].DSLINKNO) in streams and go(n):
        out.append(n)
    return out


def test_traces_start_at_every_link(spark, streams):
    want = set()
    for k in streams:
        for hops, at in enumerate(walk(streams, k)):
            want.add((k, at, hops))
            if at % 5 == 0:
                break
    assert {tuple(r) for r in registry.QUERIES["T3_trace_downstream"](spark, SF).collect()} == want


def test_longest_paths_cover_all_links(spark, streams):
    lake = {k: k >> int(s.lvl - 4) if s.lvl >= 4 else 0 for k, s in streams.items()}
    best = {}
    for k, s in streams.items():
        if lake.get(s.USLINKNO1) != lake[k]:
            path = walk(streams, k, lambda n, k=k: lake[n] == lake[k])
            best.setdefault(lake[k], []).append(sum(streams[i].Length for i in path))
    got = registry.QUERIES["T5_longest_path"](spark, SF).collect()
    assert {r.lake_id for r in got} == set(best)
    assert all(math.isclose(r.Length, max(best[r.lake_id]), abs_tol=1e-5) for r in got)


def test_points_of_every_stream_connect(spark, streams):
    want = {}
    for k, p in streams.items():
        px, py, near = p.x1 + 1, p.y1 - 2, []
        for i, s in streams.items():
            dx, dy = s.x1 - s.x0, s.y1 - s.y0
            f = max(0, min(1, ((px - s.x0) * dx + (py - s.y0) * dy) / (dx * dx + dy * dy)))
            if math.hypot(px - s.x0 - f * dx, py - s.y0 - f * dy) <= 5:
                end = (s.x1, s.y1) if k % 2 == 0 else (s.x0, s.y0)
                near.append((math.hypot(px - end[0], py - end[1]), i))
        if near:
            want[k] = min(near)[1]
    assert {r.pt: r.LINKNO for r in registry.QUERIES["J7_connect_nodes"](spark, SF).collect()} == want


def test_routed_lakes_whose_edges_lie_between_cells(spark, tmp_path):
    """At 20 cells a row: edges of lakes lie on those of cells, and the SQL counts the cells on both sides."""
    for name in TABLES:
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        (df.where("o_orderkey < 400") if name == "orders" else df).write.parquet(f"{tmp_path}/{name}.parquet")
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = db.execute(f"SELECT lake_id, n, n_to_outlet, outlet FROM ({registry.ORACLE_SQL['R11_paths_to_outlets']})").fetchall()
    got = registry.QUERIES["R11_paths_to_outlets"](spark, str(tmp_path)).collect()
    assert want and sorted(map(tuple, got)) == sorted(want)
