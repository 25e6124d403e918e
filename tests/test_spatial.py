"""Links nearest to points against all pairs in plain Python."""

import math
import random

import numpy as np
import pyarrow as pa

from thalweg.operators import spatial


def off(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    square = dx * dx + dy * dy
    t = max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / square)) if square else 0
    return math.sqrt((p[0] - a[0] - t * dx) ** 2 + (p[1] - a[1] - t * dy) ** 2)


def test_nodes_connect_over_tiles(spark):
    """Winding links, some with the same ends, lengths of zero, or of several tiles; points with no link in reach."""
    rng = random.Random(5)
    at = lambda scale: (round(rng.uniform(-scale, scale)), round(rng.uniform(-scale, scale)))
    lines = {}
    for k in range(120):
        line = [at(200)]
        for _ in range(rng.randint(1, 4)):
            line.append((line[-1][0] + rng.randint(-30, 30), line[-1][1] + rng.randint(-30, 30)))
        lines[k] = line[:1] * 2 if k % 40 == 0 else line
        lines[1000 - k] = list(lines[k])
    lines[2000], lines[2001] = [(-300, -300), (300, 310)], [(0, 0)]
    points = {k: (("inflow", "outflow", None)[k % 3], at(230)) for k in range(400)}
    want = {}
    for k, (kind, p) in points.items():
        end = -1 if kind == "inflow" else 0
        near = [(math.sqrt((p[0] - v[end][0]) ** 2 + (p[1] - v[end][1]) ** 2), n) for n, v in lines.items() if len(v) > 1 and min(off(p, *s) for s in zip(v, v[1:])) <= 5]
        if near:
            want[k] = min(near)
    pts = spark.createDataFrame([(k, kind, tuple(map(float, p))) for k, (kind, p) in points.items()] + [(-1, "inflow", None)], "pt long, point_type string, p struct<x:double,y:double>")
    links = spark.createDataFrame([(n, [tuple(map(float, v)) for v in line]) for n, line in lines.items()] + [(3000, None)], "LINKNO long, line array<struct<x:double,y:double>>")
    assert 50 < len(want) < 400
    for cell, most in ((1.0, 50_000), (5000.0, 30), (7.0, 40)):
        got = spatial.connect_nodes(pts, links, 5.0, cell, most).collect()
        assert {r.pt: (r.d, r.LINKNO) for r in got} == want


def test_dense_links_are_not_met_in_pairs(monkeypatch):
    """All of 20,000 links are in reach of all points, and only few a point are tested."""
    n, tested = 20_000, []
    x = np.random.default_rng(3).permutation(np.arange(n) / n)
    lists = lambda a, b: pa.array(np.stack([a, b], 1).tolist())
    links = pa.table({"LINKNO": np.arange(n), "xs": lists(x, x), "ys": lists(np.zeros(n), np.full(n, 900.0))})
    points = pa.table({"up": np.arange(n) % 2 == 0, "x": x + 0.2 / n, "y": np.full(n, 898.0)})
    own = spatial._line_distances
    monkeypatch.setattr(spatial, "_line_distances", lambda p, *more: tested.append(len(p)) or own(p, *more))
    found, d = spatial._nearest_ends(points, links, 5.0)
    assert found.tolist() == list(range(n))
    assert np.allclose(d, np.where(np.arange(n) % 2 == 0, 2.0, 898.0))
    assert sum(tested) < 30 * n
