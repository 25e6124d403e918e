"""GeoTIFF rasters: blocks of a file are the rows of a table, read and decoded where they are needed.

The driver reads the directory of the file, a few numbers for each block; tasks read the bytes of their own blocks by
range and turn them into cells (row, col, value). Files are opened through Arrow's file systems (file, hdfs, s3, gs).
A raster is written by one stream, as the format is one file: tasks encode the tiles, the driver only passes them on.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import settled
from .files import file_system

#: Fixed values of the format: bytes and struct codes of field types, sample formats, and the tags used here.
FIELDS = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 11: (4, "f"), 12: (8, "d"), 13: (4, "I"), 16: (8, "Q")}
KINDS = {1: "u", 2: "i", 3: "f"}
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, BANDS, ROWS, COUNTS, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, FORMAT = 322, 323, 324, 325, 339
PIXEL_SCALE, TIEPOINT, TRANSFORM, GEO_KEYS, NODATA = 33550, 33922, 34264, 34735, 42113
PLAIN, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946


@dataclass(frozen=True)
class Raster:
    """What a file's directory says: size, affine transform, EPSG code, value of no data, and how blocks are kept."""

    rows: int
    cols: int
    transform: tuple[float, ...]
    epsg: int | None
    nodata: float | None
    dtype: str
    block: tuple[int, int]
    compression: int
    predictor: int
    offsets: tuple[int, ...]
    counts: tuple[int, ...]


def unpack_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the highest bit first; 256 clears the table, 257 ends."""
    out, table, size, last = bytearray(), [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
    buffer = bits = 0
    for byte in data:
        buffer, bits = (buffer << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < size:
            continue
        bits -= size
        code = buffer >> bits & (1 << size) - 1
        if code == 257:
            break
        if code == 256:
            del table[258:]
            size, last = 9, b""
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        if last:
            table.append(last + entry[:1])
        out += entry
        last = entry
        size = min(12, max(9, (len(table) + 1).bit_length()))
    return bytes(out)


def describe(uri: str) -> Raster:
    """The first directory of the file, classic or large."""
    fs, path = file_system(uri)
    with fs.open_input_file(path) as f:
        head = f.read_at(16, 0)
        end = {b"II": "<", b"MM": ">"}[head[:2]]
        large = struct.unpack(end + "H", head[2:4])[0] == 43
        at = struct.unpack(end + ("Q" if large else "I"), head[8:16] if large else head[4:8])[0]
        wide = "Q" if large else "I"
        n = struct.unpack(end + ("Q" if large else "H"), f.read_at(8 if large else 2, at))[0]
        at += 8 if large else 2
        step, tags = (20 if large else 12), {}
        body = f.read_at(n * step, at)
        for i in range(n):
            entry = body[i * step : (i + 1) * step]
            tag, kind, count = struct.unpack(end + "HH" + wide, entry[: 12 if large else 8])
            size, code = FIELDS.get(kind, (1, "B"))
            raw = entry[12 if large else 8 :]
            if size * count > len(raw):
                raw = f.read_at(size * count, struct.unpack(end + wide, raw)[0])
            raw = raw[: size * count]
            tags[tag] = raw.rstrip(b"\0").decode("latin-1") if kind == 2 else struct.unpack(f"{end}{count}{code}" if len(code) == 1 else f"{end}{count * 2}I", raw)
    one = lambda tag, default: tags.get(tag, (default,))[0]
    if one(BANDS, 1) != 1:
        raise ValueError("rasters of one band are read")
    rows, cols = one(HEIGHT, 0), one(WIDTH, 0)
    tiled = TILE_OFFSETS in tags
    block = (one(TILE_HEIGHT, 0), one(TILE_WIDTH, 0)) if tiled else (min(one(ROWS, rows), rows), cols)
    if TRANSFORM in tags:
        m = tags[TRANSFORM]
        transform = (m[3], m[0], m[1], m[7], m[4], m[5])
    elif PIXEL_SCALE in tags:
        (sx, sy, *_), (i, j, _, x, y, *_) = tags[PIXEL_SCALE], tags[TIEPOINT]
        transform = (x - i * sx, sx, 0.0, y + j * sy, 0.0, -sy)
    else:
        transform = (0.0, 1.0, 0.0, 0.0, 0.0, 1.0)
    keys = tags.get(GEO_KEYS, ())
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    return Raster(
        rows, cols, transform, codes.get(3072, codes.get(2048)), float(tags[NODATA]) if NODATA in tags else None,
        f"{end}{KINDS[one(FORMAT, 1)]}{one(BITS, 8) // 8}", block, one(COMPRESSION, PLAIN), one(PREDICTOR, 1),
        tags[TILE_OFFSETS if tiled else OFFSETS], tags[TILE_COUNTS if tiled else COUNTS],
    )


def decode(data: bytes, raster: Raster, rows: int) -> np.ndarray:
    """The cells of a block of ``rows`` rows."""
    if raster.compression in (DEFLATE, OLD_DEFLATE):
        data = zlib.decompress(data)
    elif raster.compression == LZW:
        data = unpack_lzw(data)
    elif raster.compression != PLAIN:
        raise ValueError(f"compression {raster.compression} isn't known")
    cells = np.frombuffer(data, raster.dtype, rows * raster.block[1]).reshape(rows, -1)
    if raster.predictor == 2:
        cells = np.cumsum(cells, 1, dtype=cells.dtype.newbyteorder("="))
    elif raster.predictor != 1:
        raise ValueError(f"predictor {raster.predictor} isn't known")
    return cells


def read_raster(spark: SparkSession, uri: str, name: str = "value", window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """(row, col, ``name`` as a double) of the cells with data; of ``window`` (xoff, yoff, xsize, ysize) only its blocks are read."""
    raster = describe(uri)
    high, wide = raster.block
    across = -(-raster.cols // wide)
    x0, y0, xs, ys = window or (0, 0, raster.cols, raster.rows)
    blocks = [
        (i // across * high, i % across * wide, o, n)
        for i, (o, n) in enumerate(zip(raster.offsets, raster.counts, strict=True))
        if n and i // across * high < y0 + ys and (i // across + 1) * high > y0 and i % across * wide < x0 + xs and (i % across + 1) * wide > x0
    ]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = file_system(uri)
        with fs.open_input_file(path) as f:
            for frame in frames:
                for r0, c0, at, n in frame.itertuples(index=False):
                    whole = raster.offsets is not None and raster.block[1] != raster.cols or r0 + high <= raster.rows
                    cells = decode(f.read_at(int(n), int(at)), raster, high if whole else raster.rows - r0)
                    rows, cols = np.indices(cells.shape)
                    rows, cols, values = rows.ravel() + r0, cols.ravel() + c0, cells.ravel().astype("f8")
                    keep = (rows >= y0) & (rows < min(y0 + ys, raster.rows)) & (cols >= x0) & (cols < min(x0 + xs, raster.cols))
                    if raster.nodata is not None:
                        keep &= values != raster.nodata
                    yield pd.DataFrame({"row": rows[keep].astype("i4"), "col": cols[keep].astype("i4"), name: values[keep]})

    listed = spark.createDataFrame(blocks, "r0 long, c0 long, at long, n long")
    return listed.repartition(max(1, min(len(blocks), 4096))).mapInPandas(run, f"row int, col int, `{name}` double")


def _directory(entries: dict[int, tuple[int, list]], at: int) -> bytes:
    """A large file's directory that begins at ``at``, its longer values behind it."""
    n, later, head = len(entries), b"", b""
    for tag, (kind, values) in sorted(entries.items()):
        size, code = FIELDS[kind]
        raw = values.encode() + b"\0" if kind == 2 else struct.pack(f"<{len(values)}{code}", *values)
        if len(raw) > 8:
            place = struct.pack("<Q", at + 8 + 20 * n + 8 + len(later))
            later += raw + b"\0" * (-len(raw) % 8)
        else:
            place = raw.ljust(8, b"\0")
        head += struct.pack("<HHQ", tag, kind, len(raw) // size) + place
    return struct.pack("<Q", n) + head + struct.pack("<Q", 0) + later


def write_raster(
    cells: DataFrame, uri: str, rows: int, cols: int, transform: tuple[float, ...], name: str = "value", dtype: str = "f4",
    nodata: float = -9999.0, epsg: int | None = None, tile: int = 256,
) -> None:
    """Cells (row, col, ``name``) as one file of deflated tiles; cells that are absent or null have no data.

    Tiles are encoded by tasks and written once; then their sizes are known, and the file is their concatenation.
    """
    across = -(-cols // tile)

    def encode(part: pd.DataFrame) -> pd.DataFrame:
        block = np.full((tile, tile), nodata, f"<{dtype}")
        block[part.row.to_numpy() % tile, part.col.to_numpy() % tile] = part.value.to_numpy()
        return pd.DataFrame({"tile": [int(part.tile.iloc[0])], "data": [zlib.compress(block.tobytes(), 6)]})

    number = F.floor(F.col("row") / tile) * across + F.floor(F.col("col") / tile)
    inside = F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1) & F.col(name).isNotNull()
    tiles = cells.where(inside).select(number.cast("long").alias("tile"), "row", "col", F.col(name).cast("double").alias("value"))
    tiles = settled(tiles.groupBy("tile").applyInPandas(encode, "tile long, data binary"))
    sizes = {r["tile"]: r["n"] for r in tiles.select("tile", F.octet_length("data").alias("n")).collect()}  # a number a tile
    empty = zlib.compress(np.full((tile, tile), nodata, f"<{dtype}").tobytes(), 6)
    counts = [sizes.get(i, len(empty)) for i in range(across * -(-rows // tile))]
    entries = {
        WIDTH: (4, [cols]), HEIGHT: (4, [rows]), BITS: (3, [8 * np.dtype(dtype).itemsize]), COMPRESSION: (3, [DEFLATE]), BANDS: (3, [1]),
        PLANAR: (3, [1]), 262: (3, [1]), TILE_WIDTH: (3, [tile]), TILE_HEIGHT: (3, [tile]), TILE_COUNTS: (16, counts),
        FORMAT: (3, [{v: k for k, v in KINDS.items()}[np.dtype(dtype).kind]]), NODATA: (2, repr(nodata)),
        TRANSFORM: (12, [transform[1], transform[2], 0.0, transform[0], transform[4], transform[5], 0.0, transform[3], 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]),
    }
    if epsg is not None:
        entries[GEO_KEYS] = (3, [1, 1, 0, 2, 1024, 0, 1, 1 if epsg != 4326 else 2, 3072 if epsg != 4326 else 2048, 0, 1, epsg])
    first = 16 + len(_directory(entries | {TILE_OFFSETS: (16, counts)}, 16))
    begins = (first + np.cumsum([0, *counts[:-1]])).tolist()
    fs, path = file_system(uri)
    with fs.open_output_stream(path) as out:
        out.write(b"II" + struct.pack("<HHHQ", 43, 8, 0, 16) + _directory(entries | {TILE_OFFSETS: (16, begins)}, 16))
        at = 0
        for r in tiles.sort("tile").toLocalIterator():
            out.write(empty * (r["tile"] - at))
            out.write(bytes(r["data"]))
            at = r["tile"] + 1
        out.write(empty * (len(counts) - at))
