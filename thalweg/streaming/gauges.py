"""Gauges that arrive as files over time: the same point-in-polygon join, on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import spatial


def incoming(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """New Parquet files of gauges (with x and y) in a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def located(gauges: DataFrame, polygons: DataFrame, cell: float) -> DataFrame:
    """Each arriving gauge with the polygons that contain it: a stream-static join by grid bucket, without state."""
    return spatial.points_in_polygons(gauges.withColumn("p", F.struct("x", "y")), polygons, cell)


def into_table(located: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what is located, exactly once, until no new files are left."""
    out = located.drop("p", "ring").writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return out.outputMode("append").trigger(availableNow=True).start()
