"""Cutting the lineage of iterative operators by tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


#: Parquet as long as its rows: what is written so is read by many tasks, and no join takes millions of rows for a small table.
_PLAIN = {"compression": "none", "parquet.enable.dictionary": "false", "parquet.block.size": str(16 << 20)}


def settled(df: DataFrame, plain: bool = False) -> DataFrame:
    """``df`` as a table under ``spark.checkpoint.dir``, computed once; where that is unset, in local mode only, under a
    temporary folder. Cells in order, or of few values, shrink to a small part of their size in Parquet, by which Spark
    judges whether a join may broadcast them: write such tables ``plain``."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="thalweg-"))
    path = f"{sc.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.options(**(_PLAIN if plain else {})).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def tasks(rows: int, most: int = 500_000) -> int:
    """How many tasks ``rows`` narrow rows go to. Adaptive execution joins partitions by their bytes, and cells in order shrink so
    that 64 MB hold some ten million, which a sort or join then has at once: deal out tables of cells by this number."""
    return rows // most + 1


def release(*tables: DataFrame) -> None:
    """Deletes tables that ``settled`` has made; nothing that is still to be read may rest on them."""
    for table in tables:
        spark, path = table.sparkSession, table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
