"""Plain tables: overrides, optional layers, a relational gauge database, rasters as cell tables by tile."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from contextlib import closing

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OVERRIDES = "lake_id string, lat double, lon double"
GAUGES = "STATION_NU string, STATION_NA string, x double, y double"


def read_overrides(spark: SparkSession, path: str | None) -> DataFrame:
    """Manual outlets with trimmed ids; none where there is no such file."""
    return optional(spark, path, OVERRIDES, "csv").withColumn("lake_id", F.trim("lake_id"))


def optional(spark: SparkSession, path: str | None, schema: str, kind: str = "parquet") -> DataFrame:
    """The table at ``path``, or an empty one of the schema where it is missing."""
    if path is not None:
        try:
            return spark.read.schema(schema).option("header", True).format(kind).load(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)


def active_flow_stations(stations: DataFrame, ranges: DataFrame) -> DataFrame:
    """Active stations that have flow data, once each."""
    flow = ranges.where("DATA_TYPE = 'Q'")
    return stations.where("HYD_STATUS = 'A'").join(flow, "STATION_NUMBER", "left_semi").distinct()


def read_database(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of a relational database by JDBC; filters and columns are pushed down."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()


def read_sqlite(spark: SparkSession, path: str, table: str, where: str | None = None, parts: int = 8) -> DataFrame:
    """A table of a SQLite file that all executors see (``where``: a condition in its own SQL): ranges of row ids are tasks."""
    query = f' FROM "{table}"' + (f" WHERE ({where})" if where else "")
    with closing(sqlite3.connect(f"file:{path}?mode=ro", uri=True)) as db:
        columns = [(r[1], r[2].upper()) for r in db.execute(f'PRAGMA table_info("{table}")')]
        low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{table}"').fetchone()
    kind = lambda t: "long" if "INT" in t else "double" if any(x in t for x in ("REAL", "FLOA", "DOUB", "NUM")) else "binary" if "BLOB" in t else "string"
    schema = ", ".join(f"`{n}` {kind(t)}" for n, t in columns)
    step = max(1, -(-((high or 0) - (low or 0) + 1) // parts))
    ranges = [(a, a + step) for a in range(low, high + 1, step)] if low is not None else []

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ", ".join(f'"{n}"' for n, _ in columns)
        with closing(sqlite3.connect(f"file:{path}?mode=ro", uri=True)) as db:
            for frame in frames:
                for a, b in frame.itertuples(index=False):
                    rows = db.execute(f"SELECT {names}{query} {'AND' if where else 'WHERE'} rowid >= ? AND rowid < ?", (int(a), int(b)))
                    while some := rows.fetchmany(10_000):
                        yield pd.DataFrame(some, columns=[n for n, _ in columns], dtype=object)

    return spark.createDataFrame(ranges, "a long, b long").repartition(max(1, len(ranges))).mapInPandas(run, schema)


def write_cells(cells: DataFrame, path: str, tile: int = 256) -> None:
    """A raster as Parquet by tile: windows then read only the folders that they meet."""
    tiled = cells.withColumn("tile_row", F.floor(F.col("row") / tile)).withColumn("tile_col", F.floor(F.col("col") / tile))
    tiled.write.partitionBy("tile_row", "tile_col").parquet(path)


def read_window(spark: SparkSession, path: str, xoff: int, yoff: int, xsize: int, ysize: int, tile: int = 256) -> DataFrame:
    """The cells of a window of a raster written by tile."""
    df = spark.read.parquet(path)
    in_tiles = F.col("tile_row").between(yoff // tile, (yoff + ysize - 1) // tile) & F.col("tile_col").between(xoff // tile, (xoff + xsize - 1) // tile)
    inside = F.col("row").between(yoff, yoff + ysize - 1) & F.col("col").between(xoff, xoff + xsize - 1)
    return df.where(in_tiles & inside).drop("tile_row", "tile_col")
