"""Chains of phantom links, paths through lakes, contraction: hand-worked networks."""

import pytest
from pyspark.sql import functions as F

from thalweg.functions import geometry as G
from thalweg.operators import network

LINE = "array<struct<x: double, y: double>>"


def line(*at):
    return [{"x": float(x), "y": float(y)} for x, y in at]


def streams(spark, rows):
    """Rows (link, down, up, length, drop, area, dout, line)."""
    kinds = f"LINKNO long, DSLINKNO long, USLINKNO1 long, Length double, strmDrop double, DSContArea double, DOUTEND double, line {LINE}"
    df = spark.createDataFrame(rows, kinds)
    return df.withColumn("DOUTSTART", F.col("DOUTEND") + F.col("Length")).withColumn("note", F.lit("own"))


def points(vertices):
    return [(v.x, v.y) for v in vertices]


@pytest.mark.parametrize(
    ("lines", "want"),
    [
        ([[(5, 0), (9, 0)], [(2, 0), (5, 0)], [(0, 0), (2, 0)]], [[(0, 0), (2, 0), (5, 0), (9, 0)]]),
        ([[(5, 0), (9, 0)], [(5, 0.005), (2, 0)], [(0, 0), (2, 0)]], [[(0, 0), (2, 0), (5, 0), (9, 0)]]),  # one is reversed
        ([[(5, 0), (9, 0)], [(2, 0), (4.9, 0)]], [[(2, 0), (4.9, 0)], [(5, 0), (9, 0)]]),  # too far apart
        ([[(5, 0), (9, 0)], None, [], [(9, 0), (9, 4)]], [[(5, 0), (9, 0), (9, 4)]]),
        ([[(5, 0), (9, 0)], [(7, 7), (9, 0)]], [[(5, 0), (9, 0), (7, 7)]]),
        ([[], None], []),
    ],
)
def test_lines_strung(spark, lines, want):
    df = spark.createDataFrame([([None if x is None else line(*x) for x in lines],)], f"lines array<{LINE}>")
    assert [points(p) for p in df.select(G.strung(F.col("lines")).alias("p")).first().p] == want


def test_phantom_chains(spark):
    rows = [
        (1, 2, -1, 10.0, 1.0, 50.0, 30.0, line((4, 0), (9, 0))),
        (2, 3, 1, 4.0, 2.0, 40.0, 26.0, line((2, 0), (4, 0))),  # phantom
        (3, 8, 2, 0.0, 9.0, 1.0, 0.0, line((2, 0), (2, 0))),  # phantom without a length
        (8, 4, 3, 3.0, 1.0, 60.0, 23.0, line((2, 0), (0, 0))),  # phantom the other way round
        (4, -1, 8, 5.0, 0.0, 70.0, 18.0, line((-5, 0), (0, 0))),
        (5, 3, -1, 6.0, 3.0, 20.0, 22.0, line((2, 0), (2, 6))),  # a second link into the chain
        (6, 7, -1, 1.0, 0.0, 5.0, 2.0, line((0, 0), (1, 0))),
        (7, -1, 6, 1.0, 1.0, 9.0, 0.0, None),  # a phantom without a line, at the end
    ]
    basins = spark.createDataFrame([(k,) for k in (1, 4, 5, 6, 6)], "DN long")
    got = {r.LINKNO: r for r in network.bypass_phantoms(streams(spark, rows), basins).collect()}
    assert set(got) == {1, 4, 5, 6} and got[1].note == "own"
    assert {k: (r.DSLINKNO, r.Length, r.strmDrop, r.DSContArea, r.DOUTEND, r.n_absorbed) for k, r in got.items()} == {
        1: (4, 17.0, 4.0, 40.0, 23.0, 2), 4: (-1, 5.0, 0.0, 70.0, 18.0, 0), 5: (4, 9.0, 4.0, 20.0, 23.0, 1), 6: (-1, 1.0, 0.0, 5.0, 2.0, 0),
    }
    assert [points(p) for p in got[1].parts] == [[(0, 0), (2, 0), (4, 0), (9, 0)]]
    assert [points(p) for p in got[5].parts] == [[(0, 0), (2, 0), (2, 6)]]
    assert (got[1].StraightL, got[1].Slope, got[1].DOUTMID) == (9.0, 4 / 17, (40.0 + 23.0) / 2)
    none = network.bypass_phantoms(streams(spark, rows).where("false"), basins)
    assert none.count() == 0


def test_paths_through_lakes(spark):
    rows = [(k, d, u, n, 1.0, 0.0, 10.0 * k, line((k, 0), (k, 2))) for k, d, u, n in [(1, 3, -1, 5.0), (2, 3, -1, 7.0), (3, 4, 1, 2.0), (4, 5, 3, 2.0), (5, -1, 4, 9.0), (6, 5, -1, 0.0)]]
    inside = spark.createDataFrame([(1, k) for k in (1, 2, 3, 4, 5)] + [(2, 1), (2, 3), (2, 5), (3, 6)], "lake_id long, LINKNO long")
    winners = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "lake_id long, LINKNO long")
    got = {r.lake_id: tuple(r)[1:] for r in network.path_metrics(inside, streams(spark, rows), winners).collect()}
    straight = lambda a, b: ((a - b) ** 2 + 4) ** 0.5
    assert got[1] == (4, 2, 11.0, 3.0, straight(2, 4), 20.0, 31.0, 25.5)  # stops at its winner
    assert got[2] == (5, 5, 9.0, 1.0, 2.0, 50.0, 59.0, 54.5)  # link 4 is outside, so paths from 1 leave at 3
    assert got[3] == (6, None, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_contraction_by_the_last_lake(spark):
    rows = [(k, d, -1, float(k), 1.0, 0.0, 0.0, line((0, 0), (0, 1))) for k, d in [(1, 2), (2, 3), (3, 4), (4, 5), (5, -1), (6, 2)]]
    links = streams(spark, rows).drop("line", "note").withColumn("Slope", F.lit(0.5))
    swallowed = spark.createDataFrame([(1, 1, 2), (1, 2, 2), (2, 2, 3), (2, 3, 3)], "lake_id long, LINKNO long, winner long")
    m = spark.createDataFrame([(2, 3, 8.0, 2.0, 0.0, 0.0, 8.0, 4.0)], "lake_id long, winner long, Length double, strmDrop double, StraightL double, DOUTEND double, DOUTSTART double, DOUTMID double")
    got = {r.LINKNO: (r.DSLINKNO, r.Length, r.Slope) for r in network.contract(links, swallowed, m).collect()}
    # 2 went to the second lake, so link 1 is alone under the name of 2, and flows where 2 did, mapped
    assert got == {2: (3, 1.0, 0.5), 3: (4, 8.0, 0.25), 4: (5, 4.0, 0.5), 5: (-1, 5.0, 0.5), 6: (3, 6.0, 0.5)}
