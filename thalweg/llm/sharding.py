"""Sharding by jump consistent hashing: a stable key and the number of shards decide; one more shard takes rows only into
itself.

The key seeds the linear congruential sequence of the published algorithm, in exact decimal arithmetic; its jumps are
followed by a fold that ends as soon as they leave the range. Slots number the rows of a shard by key: ranges of the key
are counted first, so no task holds a whole shard.

Nulls: a null key counts as 0 and ranks first; a null text has no bytes. Equal keys share a shard and tie by size and
checksum; rows equal in all are interchangeable. An empty table gives an empty result. Clashing names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, need, range_bounds, range_of, running_before
from .text_stats import fields

#: Fixed values of the published algorithm.
MULTIPLIER, SHIFT, SCALE = 2862933555777941757, 1 << 33, float(1 << 31)


def jumps(key: Column, shards: int) -> Column:
    """A struct of the shards of a long ``key`` among ``shards`` (now) and one more (grown)."""
    dec = lambda x: F.lit(str(x)).cast("decimal(20,0)")
    whole = F.coalesce(key.cast("decimal(20,0)"), dec(0))
    seed = F.when(whole < 0, whole + dec(1 << 64)).otherwise(whole).cast("decimal(20,0)")
    start = F.struct(
        seed.alias("k"), F.lit(0).cast("long").alias("j"), F.lit(0).cast("long").alias("now"), F.lit(0).cast("long").alias("grown")
    )

    def step(s: Column) -> Column:
        """From the bucket ``j``, which is below the number of shards: note it, and jump."""
        k = (s["k"] * dec(MULTIPLIER) + dec(1)) % dec(1 << 64)

        def jump(nxt: Column) -> Column:
            draw = ((nxt - nxt % dec(SHIFT)) / dec(SHIFT)).cast("double") + 1.0
            j = F.floor((s["j"] + 1).cast("double") * (F.lit(SCALE) / draw)).cast("long")
            return F.struct(
                nxt.alias("k"),
                j.alias("j"),
                F.when(s["j"] < shards, s["j"]).otherwise(s["now"]).alias("now"),
                s["j"].alias("grown"),
            )

        return let(k.cast("decimal(20,0)"), jump)

    done = F.aggregate(
        F.sequence(F.lit(1), F.lit(shards + 1)), start, lambda s, _: F.when(s["j"] > shards, s).otherwise(step(s))
    )
    return let(done, lambda s: F.struct(s["now"].cast("int").alias("now"), s["grown"].cast("int").alias("grown")))


def assign(
    docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", rows_per_range: int = 20_000, most_ranges: int = 32_768,
) -> DataFrame:
    """``docs`` without ``text`` and with size, text_crc32, law, shard, slot and grown_shard.

    Slots are counted by ranges of the key, at most ``most_ranges``: their bounds go through the driver. Beyond that ranges
    hold more rows; a task holds those of one range and shard.
    """
    need(docs, key, text)
    made = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    bounds = range_bounds(docs, key, min(most_ranges, -(-docs.count() // rows_per_range)))
    df = docs.select(
        F.struct(*[c for c in docs.columns if c not in (text, *made)]).alias("__doc"),
        F.col(key).alias("key"),
        (F.octet_length(whole) + 8).cast("long").alias("size"),
        F.crc32(whole).alias("text_crc32"),
        F.lit("key").alias("law"),
        jumps(F.col(key), shards).alias("__to"),
        F.coalesce(range_of(F.col(key), bounds), F.lit(0)).alias("__range"),
        F.lit(1).cast("long").alias("__one"),
    )
    df = df.select("*", F.col("__to.now").alias("shard"), F.col("__to.grown").alias("grown_shard")).drop("__to")
    order = [F.asc_nulls_first("key"), F.col("size"), F.col("text_crc32")]
    df = running_before(df, ["shard"], "__range", order, "__one", "slot")
    return df.select(*fields(df, "__doc"), *made)


def write_shards(docs: DataFrame, path: str, shards: int = 24, key: str = "doc_id") -> None:
    """Whole rows of ``docs``, written as one Parquet folder for each shard."""
    docs.withColumn("shard", jumps(F.col(key), shards)["now"]).write.partitionBy("shard").parquet(path)
