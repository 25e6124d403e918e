"""Networks, grids, lakes and gauges derived from the test tables by one SQL text that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = "region nation customer supplier part orders lineitem events".split()

W = "CAST(floor(sqrt((SELECT count(*) FROM orders))) AS BIGINT)"

#: Common table expressions in order; each may use those before it.
CTES = {
    "nodes": """
  SELECT CAST(p_partkey + 1 AS BIGINT) AS k, CAST(p_retailprice AS DOUBLE) AS len, CAST(p_size AS BIGINT) AS sz,
    CAST(length(bin(CAST(p_partkey + 1 AS BIGINT))) - 1 AS BIGINT) AS lvl, (SELECT CAST(count(*) AS BIGINT) FROM part) AS n FROM part""",
    "streams": """
  SELECT k AS LINKNO, k AS WSNO, CASE WHEN k = 1 THEN CAST(-1 AS BIGINT) ELSE CAST(floor(k / 2) AS BIGINT) END AS DSLINKNO,
    CASE WHEN 2 * k <= n THEN 2 * k ELSE CAST(-1 AS BIGINT) END AS USLINKNO1,
    CASE WHEN 2 * k + 1 <= n THEN 2 * k + 1 ELSE CAST(-1 AS BIGINT) END AS USLINKNO2,
    len AS Length, CAST(sz AS DOUBLE) AS strmDrop, sz / len AS Slope, len * 9e-1 AS StraightL, sz * 1e6 AS unit_area, sz,
    lvl, CAST(length(bin(n)) - lvl AS BIGINT) AS strmOrder, CAST(k * 7 % 1000 AS DOUBLE) AS DOUTEND, CAST(k * 31 % 5000 AS DOUBLE) AS DSContArea,
    (k - power(2e0, lvl) + 5e-1) / power(2e0, lvl) * 1e5 AS x1, lvl * 1e3 AS y1,
    CASE WHEN k = 1 THEN 5e4 ELSE (floor(k / 2) - power(2e0, lvl - 1) + 5e-1) / power(2e0, lvl - 1) * 1e5 END AS x0,
    (lvl - 1) * 1e3 AS y0
  FROM nodes""",
    "basins": """
  SELECT LINKNO AS DN, DSLINKNO, sz, unit_area, CASE WHEN LINKNO % 50 = 0 THEN 1 ELSE 0 END AS is_lake,
    CASE WHEN LINKNO % 23 = 0 THEN CAST(LINKNO AS VARCHAR(20)) ELSE '' END AS STATION_NU
  FROM streams WHERE LINKNO % 7 <> 3""",
    "grid": f"""
  SELECT CAST(floor(o_orderkey / {W}) AS BIGINT) AS r, CAST(o_orderkey % {W} AS BIGINT) AS c,
    o_totalprice / 1e3 + 2e1 * floor(o_orderkey / {W}) AS z, CASE WHEN o_orderkey % 3 <> 0 THEN 1 ELSE 0 END AS src,
    CAST(o_totalprice AS DOUBLE) AS fac, CAST(o_orderkey % 97 - 5 AS BIGINT) AS w, {W} AS wide
  FROM orders WHERE floor(o_orderkey / {W}) < {W}""",
    "lakes": f"""
  SELECT CAST(n_nationkey AS BIGINT) AS lake_id, CAST(n_nationkey % 3 + 1 AS INT) AS Lake_type,
    (n_nationkey % 5 + 5e-1) * {W} / 5e0 AS cx, (floor(n_nationkey / 5) + 5e-1) * {W} / 5e0 AS cy,
    {W} / 1e1 * (5e-1 + 25e-2 * (n_nationkey % 4)) AS hw,
    power(2 * ({W} / 1e1 * (5e-1 + 25e-2 * (n_nationkey % 4))), 2) / 1e2 AS Lake_area
  FROM nation""",
    "stations": f"""
  SELECT CAST(s_suppkey AS VARCHAR(20)) AS STATION_NUMBER, s_name AS STATION_NAME,
    CASE WHEN s_acctbal >= 0 THEN 'A' ELSE 'D' END AS HYD_STATUS, CAST(s_suppkey AS BIGINT) AS sid,
    ((s_suppkey * 37 % 100) + 3e-1) / 1e2 * {W} AS x, ((s_suppkey * 61 % 100) + 7e-1) / 1e2 * {W} AS y
  FROM supplier""",
    "data_range": """
  SELECT DISTINCT CAST(user_id AS VARCHAR(20)) AS STATION_NUMBER, CASE WHEN event_type = 'purchase' THEN 'Q' ELSE 'H' END AS DATA_TYPE
  FROM events""",
    "overrides": """
  SELECT CAST(r_regionkey * 6 AS VARCHAR(20)) AS lake_id, l.cx + l.hw AS x, l.cy AS y
  FROM region JOIN lakes l ON l.lake_id = r_regionkey * 6""",
    "exits": """
  SELECT CAST(LINKNO % 25 AS BIGINT) AS lake_id, CASE WHEN LINKNO % 11 = 0 THEN CAST(-1 AS BIGINT) ELSE CAST(floor(LINKNO / 3) AS BIGINT) END AS link_no,
    LINKNO AS seq, sz AS local_accum, DOUTEND AS doutend, DSContArea AS dscontarea,
    CASE WHEN LINKNO % 5 = 0 THEN CAST(LINKNO % 700 AS DOUBLE) ELSE 1e9 END AS gauge_dist
  FROM streams WHERE LINKNO % 3 = 0""",
}

#: Only for DuckDB: the mask of all lakes and the flow directions, which Spark computes with operators.
ORACLE_CTES = CTES | {
    "offsets": "SELECT * FROM (VALUES (1,0,1),(2,-1,1),(3,-1,0),(4,-1,-1),(5,0,-1),(6,1,-1),(7,1,0),(8,1,1)) t(code, dr, dc)",
    "mask": """
  SELECT l.lake_id, g.r, g.c FROM lakes l JOIN grid g
    ON g.c <= l.cx + l.hw AND g.c + 1 >= l.cx - l.hw AND g.r <= l.cy + l.hw AND g.r + 1 >= l.cy - l.hw""",
    "drops": """
  SELECT a.r, a.c, o.code, (a.z - b.z) / CASE WHEN o.code % 2 = 0 THEN sqrt(2e0) ELSE 1e0 END AS fall
  FROM grid a, offsets o, grid b WHERE b.r = a.r + o.dr AND b.c = a.c + o.dc""",
    "d8": """
  SELECT g.r, g.c, g.z, g.src, g.fac, g.w, g.wide, CAST(coalesce(b.code, 0) AS INT) AS fdr, g.r + coalesce(o.dr, 0) AS tr, g.c + coalesce(o.dc, 0) AS tc
  FROM grid g LEFT JOIN (SELECT * FROM (SELECT r, c, code, row_number() OVER (PARTITION BY r, c ORDER BY fall DESC, code) AS k
    FROM drops WHERE fall > 0) WHERE k = 1) b ON b.r = g.r AND b.c = g.c LEFT JOIN offsets o ON o.code = b.code""",
    "shore": """
  SELECT m.lake_id, m.r, m.c FROM mask m JOIN offsets o ON true LEFT JOIN mask n
    ON n.lake_id = m.lake_id AND n.r = m.r + o.dr AND n.c = m.c + o.dc
  GROUP BY ALL HAVING count(n.r) < 8""",
    "wide": f"""
  SELECT lake_id, (cx - hw) * 1e5 / {W} AS xl, (cx + hw) * 1e5 / {W} AS xh, (cy - hw) * 15e3 / {W} AS yl, (cy + hw) * 15e3 / {W} AS yh FROM lakes""",
    "met": """
  SELECT *, greatest(t1 - t0, 0e0) * sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS overlap,
    (x0 + x1) / 2 > xl AND (x0 + x1) / 2 < xh AND (y0 + y1) / 2 > yl AND (y0 + y1) / 2 < yh AS mid_inside,
    x0 > xl AND x0 < xh AND y0 > yl AND y0 < yh AND x1 > xl AND x1 < xh AND y1 > yl AND y1 < yh AS tips_inside
  FROM (SELECT l.lake_id, s.LINKNO, s.WSNO, s.x0, s.x1, s.y0, s.y1, l.xl, l.xh, l.yl, l.yh,
    greatest(0e0, (yl - y0) / (y1 - y0), CASE WHEN x1 > x0 THEN (xl - x0) / (x1 - x0) WHEN x1 < x0 THEN (xh - x0) / (x1 - x0) WHEN x0 BETWEEN xl AND xh THEN 0e0 ELSE 2e0 END) AS t0,
    least(1e0, (yh - y0) / (y1 - y0), CASE WHEN x1 > x0 THEN (xh - x0) / (x1 - x0) WHEN x1 < x0 THEN (xl - x0) / (x1 - x0) ELSE 1e0 END) AS t1
    FROM streams s, wide l) WHERE t0 <= t1""",
    "reach": """
  SELECT LINKNO AS id, CAST(floor(LINKNO / power(2e0, h)) AS BIGINT) AS anc, CAST(h AS BIGINT) AS hops
  FROM streams, (SELECT unnest(range(1, 40)) AS h) WHERE floor(LINKNO / power(2e0, h)) >= 1""",
}

#: What DuckDB is to compute once.
ONCE = ("grid", "mask", "drops", "d8", "shore")


def sql(query: str) -> str:
    """The query for DuckDB, with the expressions that it names."""
    return _with(ORACLE_CTES, query, ONCE)


def _with(ctes: dict[str, str], query: str, once: tuple[str, ...] = ()) -> str:
    names = list(ctes)
    used: set[str] = set()
    todo = [query]
    while todo:
        text = todo.pop()
        for name in names:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                todo.append(ctes[name])
    kind = lambda n: "AS MATERIALIZED" if n in once else "AS"
    parts = ", ".join(f"{n} {kind(n)} ({ctes[n]})" for n in names if n in used)
    lead = query.lstrip()
    if lead.upper().startswith("WITH "):
        return f"WITH {parts + ', ' if parts else ''}{lead[5:]}"
    return f"WITH {parts} {query}" if parts else query


class Tables:
    """The derived tables of one scale as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        for name in TABLES:
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.sql(_with(CTES, f"SELECT * FROM {name}"))

    def cells(self) -> DataFrame:
        """The grid with row and column names and integer keys."""
        cols = [F.col("r").cast("int").alias("row"), F.col("c").cast("int").alias("col")]
        return self.grid.select(*cols, "z", "src", "fac", "w")

    def width(self) -> int:
        if "width_" not in self.__dict__:
            self.__dict__["width_"] = self.spark.sql(f"SELECT {W} AS w").first()["w"]
        return self.__dict__["width_"]

    def lake_rings(self) -> DataFrame:
        v = lambda sx, sy: F.struct((F.col("cx") + sx * F.col("hw")).alias("x"), (F.col("cy") + sy * F.col("hw")).alias("y"))
        return self.lakes.withColumn("ring", F.array(v(-1, -1), v(1, -1), v(1, 1), v(-1, 1), v(-1, -1)))

    def ringed_lakes(self) -> DataFrame:
        """The lakes with an island of half their width, in which lies a pond of a quarter."""
        v = lambda k, sx, sy: F.struct((F.col("cx") + sx * k * F.col("hw")).alias("x"), (F.col("cy") + sy * k * F.col("hw")).alias("y"))
        square = lambda k: F.array(v(k, -1, -1), v(k, 1, -1), v(k, 1, 1), v(k, -1, 1), v(k, -1, -1))
        return self.lakes.withColumn("rings", F.array(square(1.0), square(0.5), square(0.25)))

    def boundary(self) -> DataFrame:
        """(others): a boundary like an L, with a hole."""
        n = float(self.width())
        ring = lambda *at: F.array(*[F.struct(F.lit(x * n / 10).alias("x"), F.lit(y * n / 10).alias("y")) for x, y in [*at, at[0]]])
        outer = ring((1, 1), (9, 1), (9, 4), (6, 4), (6, 9), (1, 9))
        return self.spark.range(1).select(F.array(outer, ring((2, 5), (4, 5), (4, 7), (2, 7))).alias("others"))

    def catchments(self) -> DataFrame:
        """(DN, rings): the plane of the streams parted among all basins, a strip for each level."""
        x = lambda k: (F.col("DN") - F.pow(F.lit(2.0), "lvl") + k) / F.pow(F.lit(2.0), "lvl") * 1e5
        v = lambda k, up: F.struct(x(k).alias("x"), (F.col("lvl") * 1e3 + up * 500.0).alias("y"))
        ring = F.array(v(0, -1), v(1, -1), v(1, 1), v(0, 1), v(0, -1))
        return self.basins.join(self.streams.select(F.col("LINKNO").alias("DN"), "lvl"), "DN").select("DN", F.array(ring).alias("rings"))

    def gauges(self) -> DataFrame:
        return self.stations.withColumn("p", F.struct("x", "y"))

    def lines(self) -> DataFrame:
        v = lambda i: F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y"))
        return self.streams.withColumn("line", F.array(v(0), v(1)))

    def wide_rings(self) -> DataFrame:
        """The lakes stretched over the extent of the streams."""
        n = self.width()
        ring = F.transform("ring", lambda p: F.struct((p["x"] * 1e5 / n).alias("x"), (p["y"] * 1.5e4 / n).alias("y")))
        return self.lake_rings().select("lake_id", ring.alias("ring"))
