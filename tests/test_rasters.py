"""GeoTIFF, SQLite and pushed-down boxes."""

import random
import sqlite3
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from thalweg.operators import spatial
from thalweg.sources import geotiff, tables


def pack_lzw(data):
    """An encoder for the test: 9 to 12 bits, cleared before the table is full."""
    out, bits, n = 0, 0, 9
    table = {bytes([i]): i for i in range(256)}

    def put(code):
        nonlocal out, bits
        out, bits = out << n | code, bits + n

    put(256)
    w = b""
    size = 258
    for b in data:
        x = w + bytes([b])
        if x in table:
            w = x
            continue
        put(table[w])
        table[x] = size
        size += 1
        if size + 1 > 4095:
            put(256)
            table, size, n = {bytes([i]): i for i in range(256)}, 258, 9
        else:
            n = max(9, (size).bit_length())
        w = bytes([b])
    put(table[w])
    n = max(9, (size + 1).bit_length())
    put(257)
    pad = -bits % 8
    return (out << pad).to_bytes((bits + pad) // 8, "big")


@pytest.mark.parametrize("size", [1, 50, 700, 5000, 40_000])
def test_lzw(size):
    rng = random.Random(size)
    data = bytes(rng.choice(b"aabbbcd\x00") for _ in range(size))
    assert geotiff.unpack_lzw(pack_lzw(data)) == data


def classic(path, grid, order, compression, strip, predictor=1):
    """A small classic file in strips, written by hand."""
    rows, cols = grid.shape
    kind = grid.dtype.kind
    strips = []
    for r in range(0, rows, strip):
        part = grid[r : r + strip]
        if predictor == 2:
            part = np.diff(part, axis=1, prepend=part.dtype.type(0))
        raw = part.astype(grid.dtype.newbyteorder(order)).tobytes()
        strips.append({1: lambda x: x, 5: pack_lzw, 8: zlib.compress}[compression](raw))
    at = 8 + sum(map(len, strips))
    offsets, here = [], 8
    for s in strips:
        offsets.append(here)
        here += len(s)
    n = len(strips)
    later = struct.pack(f"{order}{n}I", *offsets) + struct.pack(f"{order}{n}I", *map(len, strips)) + struct.pack(f"{order}3d", 30.0, 30.0, 0.0) + struct.pack(f"{order}6d", 0, 0, 0, 500.0, 9000.0, 0)
    place = at + 2 + 13 * 12 + 4
    tags = [(256, 3, 1, cols), (257, 3, 1, rows), (258, 3, 1, grid.dtype.itemsize * 8), (259, 3, 1, compression), (273, 4, n, place if n > 1 else offsets[0]), (277, 3, 1, 1), (278, 3, 1, strip), (279, 4, n, place + 4 * n if n > 1 else len(strips[0])), (317, 3, 1, predictor), (339, 3, 1, {"u": 1, "i": 2, "f": 3}[kind]), (33550, 12, 3, place + 8 * n), (33922, 12, 6, place + 8 * n + 24)]
    tags.append((34735, 3, 0, 0))
    body = struct.pack(f"{order}H", len(tags))
    for tag, t, count, value in tags:
        body += struct.pack(f"{order}HHI", tag, t, count) + (struct.pack(f"{order}HH", value, 0) if t == 3 and count == 1 else struct.pack(f"{order}I", value))
    with open(path, "wb") as f:
        f.write((b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, at) + b"".join(strips) + body + struct.pack(f"{order}I", 0) + later)


@pytest.mark.parametrize(("order", "compression", "predictor", "dtype"), [("<", 1, 1, "i2"), (">", 8, 2, "i4"), ("<", 5, 2, "u1"), (">", 5, 1, "f4")])
def test_strips_of_other_writers(spark, tmp_path, order, compression, predictor, dtype):
    grid = np.random.default_rng(1).integers(0, 90, (23, 17)).astype(dtype)
    path = str(tmp_path / "a.tif")
    classic(path, grid, order, compression, 5, predictor)
    raster = geotiff.describe(path)
    assert (raster.rows, raster.cols, raster.transform) == (23, 17, (500.0, 30.0, 0.0, 9000.0, 0.0, -30.0))
    got = {(r.row, r.col): r.value for r in geotiff.read_raster(spark, f"file://{path}").collect()}
    assert got == {(r, c): float(grid[r, c]) for r in range(23) for c in range(17)}
    some = geotiff.read_raster(spark, path, "z", (3, 7, 5, 6)).collect()
    assert {(r.row, r.col): r.z for r in some} == {(r, c): float(grid[r, c]) for r in range(7, 13) for c in range(3, 8)}


def test_written_rasters_read_back(spark, tmp_path):
    path, t = str(tmp_path / "b.tif"), (10.0, 2.5, 0.0, 99.0, 0.0, -2.5)
    rows = [(r, c, float(r * 100 + c)) for r in range(40) for c in range(70) if (r + c) % 7]
    cells = spark.createDataFrame([*rows, (1, 0, None), (99, 5, 1.0)], "row int, col int, value double")
    cells = cells.where("row <> 1 or col <> 0 or value is null")
    geotiff.write_raster(cells, path, 40, 70, t, epsg=3857, tile=16)
    raster = geotiff.describe(path)
    assert (raster.rows, raster.cols, raster.transform, raster.epsg, raster.nodata, raster.block) == (40, 70, t, 3857, -9999.0, (16, 16))
    got = {(r.row, r.col): r.value for r in geotiff.read_raster(spark, path).collect()}
    assert got == {(r, c): v for r, c, v in rows if (r, c) != (1, 0)}
    empty = str(tmp_path / "c.tif")
    geotiff.write_raster(cells.where("false"), empty, 5, 5, t)
    assert geotiff.read_raster(spark, empty).count() == 0


def test_sqlite_tables(spark, tmp_path):
    path = str(tmp_path / "g.sqlite")
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE stations (id TEXT, n INTEGER, x REAL)")
    db.executemany("INSERT INTO stations VALUES (?, ?, ?)", [(f"s{i}", i if i % 4 else None, i / 2) for i in range(100)])
    db.execute("CREATE TABLE none (a INTEGER)")
    db.commit()
    db.close()
    df = tables.read_sqlite(spark, path, "stations", "x >= 10")
    assert sorted(map(tuple, df.collect())) == sorted((f"s{i}", i if i % 4 else None, i / 2) for i in range(20, 100))
    assert tables.read_sqlite(spark, path, "none").count() == 0


def test_boxes_reach_the_file(spark, tmp_path):
    boxes = spark.range(1000).select("id", *[F.col("id").cast("double").alias(c) for c in ("minx", "maxx", "miny", "maxy")])
    boxes.write.parquet(str(tmp_path / "boxes"))
    found = spatial.boxes_in_window(spark.read.parquet(str(tmp_path / "boxes")), 10.0, 10.0, 20.0, 20.0)
    assert found.count() == 11
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert all(f"LessThanOrEqual({c},20.0)" in plan for c in ("minx", "miny")) and "GreaterThanOrEqual(maxx,10.0)" in plan
