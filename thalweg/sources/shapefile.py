"""Shapefiles: a Spark data source, ``spark.read.format("shapefile")``, and a writer for one part of a table.

A file is split into runs of records by its index (.shx), so tasks read only their part. Geometry becomes an array of
parts, each an array of struct<x, y>; box columns come along, so windows prune before geometry is looked at.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Fixed values of the format: shape types that are read.
KINDS = {0: "null", 1: "point", 3: "line", 5: "polygon"}
GEOMETRY = "array<array<struct<x: double, y: double>>>"


def _attributes(path: str) -> tuple[int, int, list[tuple[str, str, int, int]]]:
    """Header size, record size, and (name, type, length, decimals) of the attribute table."""
    with open(path, "rb") as f:
        head = f.read(32)
        size, record = struct.unpack("<HH", head[8:12])
        fields = []
        while (raw := f.read(1)) not in (b"\r", b""):
            raw += f.read(31)
            fields.append((raw[:11].split(b"\0")[0].decode(), chr(raw[11]), raw[16], raw[17]))
    return size, record, fields


def _kind(letter: str, decimals: int) -> str:
    return {"N": "double" if decimals else "long", "F": "double", "L": "boolean"}.get(letter, "string")


def _value(raw: str, kind: str):
    raw = raw.strip("\0 ")
    if not raw or set(raw) == {"*"}:
        return None if kind != "string" else ""
    if kind == "boolean":
        return raw in "YyTt"
    return raw if kind == "string" else float(raw) if kind == "double" else int(float(raw))


def _shape(raw: bytes) -> tuple[list[list[tuple[float, float]]], tuple | None]:
    kind = struct.unpack("<i", raw[:4])[0]
    if KINDS.get(kind) == "point":
        x, y = struct.unpack("<2d", raw[4:20])
        return [[(x, y)]], (x, y, x, y)
    if KINDS.get(kind) not in ("line", "polygon"):
        return [], None
    box = struct.unpack("<4d", raw[4:36])
    parts, points = struct.unpack("<2i", raw[36:44])
    starts = [*struct.unpack(f"<{parts}i", raw[44 : 44 + 4 * parts]), points]
    flat = struct.unpack(f"<{2 * points}d", raw[44 + 4 * parts : 44 + 4 * parts + 16 * points])
    xy = list(zip(flat[::2], flat[1::2], strict=True))
    return [xy[a:b] for a, b in zip(starts, starts[1:], strict=False)], box


class Run(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class ShapefileReader(DataSourceReader):
    def __init__(self, path: str, rows_per_task: int):
        self.path, self.rows = path, rows_per_task

    def partitions(self) -> list[Run]:
        n = (os.path.getsize(f"{self.path}.shx") - 100) // 8
        return [Run(i, min(n, i + self.rows)) for i in range(0, max(n, 1), self.rows)]

    def read(self, partition: Run) -> Iterator[tuple]:
        size, record, fields = _attributes(f"{self.path}.dbf")
        kinds = [_kind(k, d) for _, k, _, d in fields]
        with open(f"{self.path}.shx", "rb") as index, open(f"{self.path}.shp", "rb") as shapes, open(f"{self.path}.dbf", "rb") as table:
            index.seek(100 + 8 * partition.first)
            table.seek(size + record * partition.first)
            for _ in range(partition.first, partition.last):
                at, words = struct.unpack(">2i", index.read(8))
                shapes.seek(2 * at + 8)
                parts, box = _shape(shapes.read(2 * words))
                raw, values, i = table.read(record), [], 1
                for (_, _, n, _), kind in zip(fields, kinds, strict=True):
                    values.append(_value(raw[i : i + n].decode("utf-8", "replace"), kind))
                    i += n
                points = [[{"x": x, "y": y} for x, y in part] for part in parts]
                yield (*values, points, *(box or (None,) * 4))


class ShapefileSource(DataSource):
    """Options: path (without or with .shp), rowsPerTask."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def _base(self) -> str:
        return self.options["path"].removeprefix("file://").removesuffix(".shp")

    def schema(self) -> str:
        fields = [f"`{n}` {_kind(k, d)}" for n, k, _, d in _attributes(f"{self._base()}.dbf")[2]]
        return ", ".join([*fields, f"geometry {GEOMETRY}", *(f"{c} double" for c in ("minx", "miny", "maxx", "maxy"))])

    def reader(self, schema: StructType) -> ShapefileReader:
        return ShapefileReader(self._base(), int(self.options.get("rowsPerTask", 50_000)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ShapefileSource)


def write_shapefile(rows: Iterator[dict], fields: list[tuple[str, str]], path: str, kind: str) -> int:
    """Writes rows (attributes and geometry as parts) as one shapefile, a row at a time; fields are (name, type) with
    type long, double or string. Names are cut to ten letters, floats have three places. Returns the number of rows."""
    code = {v: k for k, v in KINDS.items()}[kind]
    width = {"long": (b"N", 18, 0), "double": (b"F", 24, 3), "string": (b"C", 80, 0)}
    base, n, box = path.removesuffix(".shp"), 0, [float("inf")] * 2 + [float("-inf")] * 2
    with open(f"{base}.shp", "wb") as shapes, open(f"{base}.shx", "wb") as index, open(f"{base}.dbf", "wb") as table:
        shapes.write(bytes(100)), index.write(bytes(100))
        table.write(bytes(32))
        for name, t in fields:
            letter, size, places = width[t]
            table.write(struct.pack("<11sc4xBB14x", name[:10].encode(), letter, size, places))
        table.write(b"\r")
        for row in rows:
            parts = [[(p["x"], p["y"]) for p in part] for part in row["geometry"]]
            flat = [p for part in parts for p in part]
            own = [min(x for x, _ in flat), min(y for _, y in flat), max(x for x, _ in flat), max(y for _, y in flat)]
            box = [*map(min, box[:2], own[:2]), *map(max, box[2:], own[2:])]
            if kind == "point":
                body = struct.pack("<i2d", code, *flat[0])
            else:
                starts = [sum(map(len, parts[:i])) for i in range(len(parts))]
                body = struct.pack(f"<i4d2i{len(parts)}i", code, *own, len(parts), len(flat), *starts)
                body += struct.pack(f"<{2 * len(flat)}d", *(v for p in flat for v in p))
            index.write(struct.pack(">2i", shapes.tell() // 2, len(body) // 2))
            n += 1
            shapes.write(struct.pack(">2i", n, len(body) // 2) + body)
            out = b" "
            for name, t in fields:
                v, size = row[name], width[t][1]
                text = "" if v is None else f"{v:.3f}" if t == "double" else str(v)
                raw = text.encode()[:size]
                out += raw.ljust(size) if t == "string" else raw.rjust(size)
            table.write(out)
        for f, words in ((shapes, shapes.tell() // 2), (index, index.tell() // 2)):
            f.seek(0)
            f.write(struct.pack(">7i", 9994, 0, 0, 0, 0, 0, words) + struct.pack("<2i4d4d", 1000, code, *(box if n else [0.0] * 4), 0, 0, 0, 0))
        table.seek(0)
        table.write(struct.pack("<4BIHH20x", 3, 100, 1, 1, n, 32 + 32 * len(fields) + 1, 1 + sum(width[t][1] for _, t in fields)))
    return n
