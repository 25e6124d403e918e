"""Shared pieces: tables, temporary results in the shared folder, ranges of a key, ranks within hot keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word is a run of anything but ASCII white space.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``; unset, a temporary one in local mode only."""
    sc = spark.sparkContext
    where = sc.getCheckpointDir()
    if where is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="thalweg-"))
        where = sc.getCheckpointDir()
    return where


_INNER: ContextVar[str | None] = ContextVar("folder of the tables of the operator that runs", default=None)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut, columns still pruned when it is read."""
    path = f"{_INNER.get() or shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidied(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, written; the tables that it has ``written`` on its way are deleted."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    token = _INNER.set(folder)
    try:
        made = make()
    finally:
        _INNER.reset(token)
    out = written(made)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return out


def need(df: DataFrame, *names: str) -> None:
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; null keys give null."""
    return F.crc32(key.cast("string").cast("binary")) % n


def range_bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """At most ``n`` ascending values that occur in the long column ``key`` and part its rows into about equal ranges.

    One aggregation over that column alone; the first bound is its minimum. Nulls take no part.
    """
    n = max(1, n)
    row = df.agg(
        F.min(key).alias("low"),
        F.percentile_approx(key, F.lit([i / n for i in range(n)]), F.lit(max(10_000, 20 * n))).alias("at"),
    ).first()
    return sorted({row["low"], *row["at"]}) if row["low"] is not None else []


def _longs(values: Sequence[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def range_of(key: Column, bounds: Sequence[int], fan: int = 32) -> Column:
    """Index of the last bound that is not above ``key`` (0 below all), by a search tree of ``fan`` branches a level."""
    levels = [list(bounds)]
    while len(levels[0]) > fan:
        levels.insert(0, levels[0][::fan])
    found = F.lit(0)
    for level in levels:
        cells = F.array(*[_longs(level[i : i + fan]) for i in range(0, max(1, len(level)), fan)])
        found = let(found, _descend(cells, key, fan))
    return found


def _descend(cells: Column, key: Column, fan: int):
    return lambda at: at * F.lit(fan) + F.greatest(F.size(F.filter(F.get(cells, at), lambda b: b <= key)) - 1, F.lit(0))


def running_before(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column], weight: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of the long ``weight`` over earlier rows of the same ``keys``, by ``bucket`` and then ``order``.

    Sums of buckets are ranged first, so a task holds one bucket of a key and never a whole hot key.
    Keys and bucket must not be null.
    """
    keys = list(keys)
    sums = df.groupBy(*keys, bucket).agg(F.sum(weight).alias("__sum"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, bucket, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(starts, [*keys, bucket])
        .withColumn(name, F.col("__offset") + F.coalesce(F.sum(weight).over(within), F.lit(0)))
        .drop("__offset")
    )
