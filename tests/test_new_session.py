"""A step that once failed as the first of a session, though not after others: in a process of its own."""

import os
import subprocess
import sys

import duckdb

from thalweg.plans.fixtures import sql

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from thalweg.functions import geometry as G
from thalweg.operators import spatial
from thalweg.plans.fixtures import Tables
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
t = Tables(spark, sys.argv[1])
met = spatial.lines_in_polygons(t.lines().select("LINKNO", "line"), t.wide_rings(), 5000.0)
up, low = G.contains(F.col("ring"), G.last_vertex(F.col("line"))), G.contains(F.col("ring"), G.first_vertex(F.col("line")))
print("out", met.where(up & ~low).count(), "in", met.where(low & ~up).count())
"""


def test_tests_on_met_pairs_stay_behind_the_join(tmp_path):
    done = subprocess.run([sys.executable, "-c", RUN, SF, str(tmp_path)], cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True)
    con = duckdb.connect()
    for t in "nation part orders".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    upper, lower = "(x1 > xl AND x1 < xh AND y1 > yl AND y1 < yh)", "(x0 > xl AND x0 < xh AND y0 > yl AND y0 < yh)"
    found = con.execute(sql(f"SELECT count(*) FILTER (WHERE {upper} AND NOT {lower}), count(*) FILTER (WHERE {lower} AND NOT {upper}) FROM met")).fetchall()[0]
    assert "out {} in {}".format(*found) in done.stdout, done.stderr[-2000:]
