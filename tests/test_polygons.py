"""Polygons of many rings: joins against loops over all pairs, overlay against points by the thousand."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from thalweg.operators import polygons, raster


def star(rng, x, y, n, reach):
    """A ring around a point, its directions spread over the whole circle."""
    turns = sorted([rng.random() * 2 * math.pi for _ in range(n)] + [0.3, 2.4, 4.5])
    at = [(x + (q := reach * rng.uniform(0.3, 1)) * math.cos(t), y + q * math.sin(t)) for t in turns]
    return np.array([*at, at[0]])


def box(x, y, w, h=None):
    h = h or w
    return np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)], float)


def inside(point, rings):
    n = 0
    for r in rings:
        for (ax, ay), (bx, by) in zip(r, r[1:], strict=False):
            if (ay > point[1]) != (by > point[1]) and point[0] < (bx - ax) * (point[1] - ay) / (by - ay) + ax:
                n += 1
    return n % 2 == 1


def shapes(rng, k):
    if k % 4 == 0:
        return [star(rng, 5, 5, rng.randint(0, 15), 6)], [star(rng, 6, 5, rng.randint(0, 15), 5)]
    if k % 4 == 1:  # edges and corners in common
        return [box(rng.randint(0, 5), rng.randint(0, 5), rng.randint(1, 6))], [box(rng.randint(0, 5), rng.randint(0, 5), rng.randint(1, 6))]
    if k % 4 == 2:  # a hole with an island
        return [box(0, 0, 10), box(2, 2, 6), box(3, 3, 2)], [star(rng, 5, 5, rng.randint(2, 12), 6)]
    hole = box(rng.randint(1, 3), rng.randint(1, 3), rng.randint(2, 4))
    return [box(0, 0, 10)[::-1], hole], [box(rng.randint(-2, 5), rng.randint(0, 5), rng.randint(1, 6)), box(11, 11, 1)]


@pytest.mark.parametrize("seed", range(3))
def test_overlay_of_any_shapes(seed):
    rng = random.Random(seed)
    points = [(rng.uniform(-3, 13), rng.uniform(-3, 13)) for _ in range(250)]
    for k in range(80):
        a, b = shapes(rng, k)
        in_a, in_b = [inside(p, a) for p in points], [inside(p, b) for p in points]
        wanted = {"intersection": lambda x, y: x and y, "union": lambda x, y: x or y, "difference": lambda x, y: x and not y}
        for operation, rule in wanted.items():
            rings = polygons.overlaid(a, b, operation)
            assert all(r[0] == r[-1] and len(r) > 3 for r in rings)
            assert [inside(p, rings) for p in points] == [rule(x, y) for x, y in zip(in_a, in_b, strict=True)], (k, operation)


def test_overlay_of_equal_nested_apart_and_empty():
    a, within, beside, far = box(0, 0, 4), box(1, 1, 2), box(4, 0, 4), box(9, 9, 1)
    area = lambda rings: sum((np.array(r)[:-1, 0] * np.array(r)[1:, 1] - np.array(r)[1:, 0] * np.array(r)[:-1, 1]).sum() / 2 for r in rings)
    for b, both, either, first in (([a], 16, 16, 0), ([within], 4, 16, 12), ([beside], 0, 32, 16), ([far], 0, 17, 16), ([], 0, 16, 16)):
        got = tuple(area(polygons.overlaid([a], b, o)) for o in ("intersection", "union", "difference"))
        assert got == (both, either, first)
    assert polygons.overlaid([], []) == [] and polygons.overlaid([], [a]) == []


KINDS = f"id long, rings {polygons.RINGS}"


def table(spark, rows):
    as_rings = lambda rings: None if rings is None else [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]
    return spark.createDataFrame([(i, as_rings(rings)) for i, rings in rows], KINDS)


@pytest.fixture(scope="module")
def many():
    """Polygons from tiny to huge, some with holes, and rows without any."""
    rng = random.Random(9)
    rows = [(i, [star(rng, rng.uniform(-40, 40), rng.uniform(-40, 40), rng.randint(0, 6), 2.0 ** rng.randint(-3, 6))]) for i in range(60)]
    rows += [(100, [box(-30, -30, 60), box(-10, -10, 20), box(-5, -5, 3)]), (101, None), (102, []), (103, [box(-1e5, -1e5, 2e5)])]
    return rows


def test_points_in_polygons_of_all_sizes(spark, many):
    rng = random.Random(2)
    points = [(k, rng.uniform(-45, 45), rng.uniform(-45, 45)) for k in range(300)] + [(900, -30.0, 0.0), (901, -10.0, 3.0), (902, 1e7, 0.0)]
    df = spark.createDataFrame(points, "k long, x double, y double").select("k", F.struct("x", "y").alias("p"))
    got = {(r.k, r.id) for r in polygons.points_in_polygons(df, table(spark, many)).select("k", "id").collect()}
    want = {(k, i) for k, x, y in points for i, rings in many if rings and inside((x, y), rings)}
    assert got == want - {(900, 100), (901, 100)}  # these lie on a ring
    assert polygons.points_in_polygons(df, table(spark, [(1, None)])).count() == 0
    boxed = polygons._boxed(table(spark, many))
    per = polygons._on(boxed, polygons._buckets(F.col("__box"), polygons._level(F.col("__box")))).groupBy("id").count()
    assert per.agg(F.max("count")).first()[0] <= 4


def test_pairs_that_meet_and_their_areas(spark, many):
    left = table(spark, many)
    right = left.select(F.col("id").alias("b"), F.col("rings").alias("others"))
    boxes = {i: (min(v[0] for r in g for v in r), min(v[1] for r in g for v in r), max(v[0] for r in g for v in r), max(v[1] for r in g for v in r)) for i, g in many if g}
    near = lambda a, b: a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]
    want = sorted((i, j) for i, a in boxes.items() for j, b in boxes.items() if near(a, b))
    assert sorted((r.id, r.b) for r in polygons.box_pairs(left, right).select("id", "b").collect()) == want
    cut = polygons.overlay(polygons.box_pairs(left, right).where("id < b"))
    areas = {(r.id, r.b): r.area for r in cut.select("id", "b", polygons.area(F.col("rings")).alias("area")).collect()}
    met = {(r.id, r.b) for r in polygons.meeting(left, right).where("id < b").select("id", "b").collect()}
    assert {k for k, a in areas.items() if a > 1e-9} <= met
    shapes_of = dict(many)
    for k in [k for k in areas if k not in met][:40]:
        assert polygons.overlaid(shapes_of[k[0]], shapes_of[k[1]]) == []


def test_burned_islands_and_bands(spark):
    rings = [box(2.5, 3.5, 30, 40), box(10.2, 10.2, 12), box(14.5, 14.5, 2)]
    want = set()
    for r in range(60):
        for c in range(50):
            cell = box(c, r, 1)
            touched = polygons.overlaid([cell], rings) or any(_crosses(cell, ring) for ring in rings)
            if touched:
                want.add((r, c))
    df = table(spark, [(7, rings)]).withColumnRenamed("id", "lake_id")
    for band in (4, 256):
        assert {(x.row, x.col) for x in raster.burn(df, 60, 50, band).collect()} == want


def _crosses(cell, ring):
    """An edge of a ring of boxes with a point in a cell."""
    x0, y0, x1, y1 = cell[:, 0].min(), cell[:, 1].min(), cell[:, 0].max(), cell[:, 1].max()
    return any(min(ax, bx) <= x1 and max(ax, bx) >= x0 and min(ay, by) <= y1 and max(ay, by) >= y0 for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False))
