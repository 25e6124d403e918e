"""Projections against published points and there and back again."""

import math

import pytest
from pyspark.sql import functions as F

from thalweg.functions.projections import Ellipsoid, LambertConformal, TransverseMercator, utm

AIRY = Ellipsoid(6377563.396, 299.32496)
CLARKE = Ellipsoid(6378206.4, 294.9786982)
CLARKE_FEET = Ellipsoid(20925832.16, 294.9786982)  # US survey feet

#: Published worked examples: projection, longitude, latitude, x, y, and how near: those were worked with rounded steps.
PUBLISHED = [
    (TransverseMercator(-2.0, 49.0, 0.9996012717, 400_000.0, -100_000.0, AIRY), 0.5, 50.5, 577274.99, 69740.50, 0.02),
    (TransverseMercator(-75.0, 0.0, 0.9996, 0.0, 0.0, CLARKE), -73.5, 40.5, 127106.5, 4484124.4, 0.1),
    (LambertConformal(-99.0, 27 + 50 / 60, 28 + 23 / 60, 30 + 17 / 60, 2_000_000.0, 0.0, CLARKE_FEET), -96.0, 28.5, 2963503.91, 254759.80, 0.01),
    (LambertConformal(-96.0, 23.0, 33.0, 45.0, 0.0, 0.0, CLARKE), -75.0, 35.0, 1894410.9, 1564649.5, 0.1),
]


@pytest.mark.parametrize(("projection", "lon", "lat", "x", "y", "place"), PUBLISHED)
def test_published_points(spark, projection, lon, lat, x, y, place):
    df = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    r = df.select(projection.forward(F.col("lon"), F.col("lat")).alias("p")).first().p
    assert abs(r.x - x) <= 0.6 * place and abs(r.y - y) <= 0.6 * place


@pytest.mark.parametrize("projection", [p[0] for p in PUBLISHED] + [utm(17), utm(56, south=True), LambertConformal(10.0, -40.0, -30.0, -30.0)])
def test_there_and_back(spark, projection):
    south = projection.lat0 < 0 or projection.y0 > 1e6
    rows = [(projection.lon0 + d, (-1 if south else 1) * lat) for d in (-8.0, -1.0, 0.0, 0.5, 8.0) for lat in (0.0, 1.0, 30.0, 45.0, 70.0)]
    df = spark.createDataFrame([*rows, (None, None)], "lon double, lat double").withColumn("p", projection.forward(F.col("lon"), F.col("lat")))
    got = df.select("lon", "lat", projection.inverse(F.col("p.x"), F.col("p.y")).alias("q")).collect()
    assert got[-1].q.x is None and got[-1].q.y is None
    for r in got[:-1]:
        assert abs(r.q.x - r.lon) < 1e-8 and abs(r.q.y - r.lat) < 1e-8  # about a millimetre


def classic(p, lon, lat):
    """Transverse Mercator by the older series in powers of the longitude, good to a millimetre near the meridian."""
    a, f = p.ellipsoid.a, 1 / p.ellipsoid.inverse_flattening
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)

    def arc(q):
        return a * (
            (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * q - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * q)
            + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * q) - 35 * e2**3 / 3072 * math.sin(6 * q)
        )

    q, d = math.radians(lat), math.radians(lon - p.lon0)
    t, c, w = math.tan(q) ** 2, ep2 * math.cos(q) ** 2, d * math.cos(q)
    nu = a / math.sqrt(1 - e2 * math.sin(q) ** 2)
    x = nu * (w + (1 - t + c) * w**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * w**5 / 120)
    rise = w * w / 2 + (5 - t + 9 * c + 4 * c * c) * w**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * w**6 / 720
    return p.x0 + p.k0 * x, p.y0 + p.k0 * (arc(q) - arc(math.radians(p.lat0)) + nu * math.tan(q) * rise)


def test_transverse_mercator_within_a_millimetre(spark):
    for p in (PUBLISHED[0][0], utm(33)):
        rows = [(p.lon0 + d, lat) for d in (-3.0, -1.2, 0.0, 2.5) for lat in (5.0, 37.0, 50.5, 66.0)]
        df = spark.createDataFrame(rows, "lon double, lat double")
        for r in df.select("lon", "lat", p.forward(F.col("lon"), F.col("lat")).alias("p")).collect():
            x, y = classic(p, r.lon, r.lat)
            assert abs(r.p.x - x) < 1e-3 and abs(r.p.y - y) < 1e-3
