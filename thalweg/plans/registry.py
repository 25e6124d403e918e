"""All registered queries of the library, by name, with the SQL that each must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import d8, projections, rules
from ..functions import geometry as G
from ..operators import centerline, dissolve, network, polygons, raster, reservoirs, rings, routing, spatial, terrain
from ..operators.store import settled
from .fixtures import Tables, sql

FLAGSHIP = "J2_gauges_in_lakes"

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, oracle: str | None = None):
    """Registers a function of the derived tables; ``oracle`` may use their names."""

    def add(f):
        def run(spark, sf_dir) -> DataFrame:
            return f(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE_SQL[name] = sql(oracle)
        return f

    return add


def six(c):
    """Six places, half to even, after all sums."""
    return rules.rounded(c, 6)


SIX = "round_even(({0}) * 1e6, 0) / 1e6".format

# ---- relational -------------------------------------------------------------------------------------------------


@query("J1_active_flow_stations", """
SELECT DISTINCT s.STATION_NUMBER, s.STATION_NAME FROM stations s JOIN data_range d ON s.STATION_NUMBER = d.STATION_NUMBER
WHERE s.HYD_STATUS = 'A' AND d.DATA_TYPE = 'Q'""")
def _(t):
    flow = t.data_range.where("DATA_TYPE = 'Q'")
    return t.stations.where("HYD_STATUS = 'A'").join(flow, "STATION_NUMBER", "left_semi").select("STATION_NUMBER", "STATION_NAME")


@query("J2_gauges_in_lakes", """
SELECT l.lake_id, s.STATION_NUMBER FROM lakes l JOIN stations s
ON s.x > l.cx - l.hw AND s.x < l.cx + l.hw AND s.y > l.cy - l.hw AND s.y < l.cy + l.hw""")
def _(t):
    cell = max(1.0, t.width() / 10)
    found = spatial.points_in_polygons(t.gauges().select("STATION_NUMBER", "p"), t.lake_rings().select("lake_id", "ring"), cell)
    return found.select("lake_id", "STATION_NUMBER")


@query("J3_lakes_meeting_window", """
SELECT lake_id FROM lakes WHERE cx - hw <= 5e1 AND cx + hw >= 1e1 AND cy - hw <= 5e1 AND cy + hw >= 1e1""")
def _(t):
    box = G.bounds(F.col("ring"))
    win = F.struct(F.lit(10.0).alias("minx"), F.lit(10.0).alias("miny"), F.lit(50.0).alias("maxx"), F.lit(50.0).alias("maxy"))
    return t.lake_rings().where(G.boxes_meet(box, win)).select("lake_id")


@query("S2_box_scan", "SELECT lake_id, cx - hw AS minx, cy + hw AS maxy FROM lakes WHERE cx - hw <= 3e1 AND cx + hw >= 0 AND cy - hw <= 3e1 AND cy + hw >= 0")
def _(t):
    boxed = t.lakes.select("lake_id", (F.col("cx") - F.col("hw")).alias("minx"), (F.col("cx") + F.col("hw")).alias("maxx"), (F.col("cy") - F.col("hw")).alias("miny"), (F.col("cy") + F.col("hw")).alias("maxy"))
    return spatial.boxes_in_window(boxed, 0.0, 0.0, 30.0, 30.0).select("lake_id", "minx", "maxy")


@query("A7_stations_per_lake", """
SELECT l.lake_id, string_agg(s.STATION_NUMBER, ', ' ORDER BY s.sid) AS stations FROM lakes l JOIN stations s
ON s.x > l.cx - l.hw AND s.x < l.cx + l.hw AND s.y > l.cy - l.hw AND s.y < l.cy + l.hw GROUP BY l.lake_id""")
def _(t):
    found = spatial.points_in_polygons(t.gauges().select("STATION_NUMBER", "sid", "p"), t.lake_rings().select("lake_id", "ring"), max(1.0, t.width() / 10))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("sid", "STATION_NUMBER"))), lambda s: s["STATION_NUMBER"])
    return found.groupBy("lake_id").agg(F.array_join(ordered, ", ").alias("stations"))


@query("P1_lake_filter", "SELECT lake_id, Lake_type FROM lakes WHERE Lake_area > 5e0 OR Lake_type <> 1")
def _(t):
    return t.lakes.where((F.col("Lake_area") > 5.0) | ~F.col("Lake_type").eqNullSafe(1)).select("lake_id", "Lake_type")


@query("P3_subset_rename", "SELECT LINKNO AS link_id, Length AS length_m, DSLINKNO AS next_down FROM streams")
def _(t):
    return t.streams.select("LINKNO", "Length", "DSLINKNO").withColumnsRenamed({"LINKNO": "link_id", "Length": "length_m", "DSLINKNO": "next_down"})


@query("P4_required_columns", "SELECT LINKNO, DSLINKNO FROM streams")
def _(t):
    rules.require(t.streams, ["LINKNO", "DSLINKNO", "Length"], "streams")
    return t.streams.select("LINKNO", "DSLINKNO")


@query("P15_default_columns", "SELECT DN, is_lake, CAST(-1 AS INT) AS lake_id, '' AS gauge FROM basins")
def _(t):
    return rules.with_defaults(t.basins.select("DN", "is_lake"), {"is_lake": 0, "lake_id": -1, "gauge": ""})


@query("P17_arithmetic", f"SELECT LINKNO, {SIX('sqrt(Length)')} AS root, {SIX('abs(Slope - 1e-2)')} AS off, CAST(round_even(Length / 25, 0) AS BIGINT) AS cells FROM streams")
def _(t):
    return t.streams.select("LINKNO", six(F.sqrt("Length")).alias("root"), six(F.abs(F.col("Slope") - 0.01)).alias("off"), F.rint(F.col("Length") / 25).cast("long").alias("cells"))


@query("R19_estimated_cells", "SELECT LINKNO, CAST(greatest(1, round_even(unit_area / 9e2, 0)) AS BIGINT) AS n FROM streams")
def _(t):
    return t.streams.select("LINKNO", dissolve.estimated_cells(F.col("unit_area"), 30.0).alias("n"))


@query("P5_area_length_units", f"SELECT LINKNO, {SIX('unit_area * 1e-6')} AS area_km2, {SIX('Length * 1e-3')} AS length_km FROM streams")
def _(t):
    return t.streams.select("LINKNO", six(rules.number(F.col("unit_area")) * 1e-6).alias("area_km2"), six(rules.number(F.col("Length")) * 1e-3).alias("length_km"))


@query("P6_outlets", "SELECT LINKNO, (DSLINKNO <= 0 OR DSLINKNO = -9999) AS outlet FROM streams")
def _(t):
    return t.streams.select("LINKNO", rules.is_outlet(F.col("DSLINKNO")).alias("outlet"))


@query("P7_semi_anti", """
SELECT LINKNO, 'semi' AS kind FROM streams WHERE LINKNO IN (SELECT DN FROM basins WHERE is_lake = 1)
UNION ALL SELECT LINKNO, 'anti' AS kind FROM streams WHERE LINKNO NOT IN (SELECT DN FROM basins)""")
def _(t):
    b = t.basins.select(F.col("DN").alias("LINKNO"), "is_lake")
    semi = t.streams.join(b.where("is_lake = 1"), "LINKNO", "left_semi").select("LINKNO", F.lit("semi").alias("kind"))
    return semi.union(t.streams.join(b, "LINKNO", "left_anti").select("LINKNO", F.lit("anti").alias("kind")))


@query("P8_clamped_slope", f"SELECT LINKNO, {SIX('CASE WHEN Slope * 60 >= 1e0 THEN 1e-2 ELSE greatest(Slope * 60, 1e-2) END')} AS slope FROM streams")
def _(t):
    return t.streams.select("LINKNO", six(rules.clamp_slope(F.col("Slope") * 60, 0.01)).alias("slope"))


@query("P8_clamped_length_and_share", f"SELECT LINKNO, {SIX('greatest(Length - 1e3, 1e2)')} AS len, {SIX('greatest(0e0, least(1e0, Slope * 60 - 5e-1))')} AS share FROM streams")
def _(t):
    return t.streams.select("LINKNO", six(rules.clamp_length(F.col("Length") - 1000.0, 100.0)).alias("len"), six(rules.unit_interval(F.col("Slope") * 60 - 0.5)).alias("share"))


@query("P9_value_map", "SELECT s.LINKNO, coalesce(m.DN + 1000000, s.DSLINKNO) AS mapped FROM streams s LEFT JOIN (SELECT DN FROM basins WHERE is_lake = 1) m ON m.DN = s.DSLINKNO")
def _(t):
    m = t.basins.where("is_lake = 1").select(F.col("DN").alias("DSLINKNO"), (F.col("DN") + 1000000).alias("to"))
    return t.streams.join(m, "DSLINKNO", "left").select("LINKNO", F.coalesce("to", "DSLINKNO").alias("mapped"))


@query("P10_lake_names", """
SELECT lake_id, CASE WHEN lake_id % 2 = 0 THEN 'Lake_' || CAST(lake_id AS VARCHAR) ELSE 'Basin' END AS name,
CASE WHEN lake_id % 2 = 0 THEN lake_id ELSE -1 END AS parsed FROM lakes""")
def _(t):
    name = F.when(F.col("lake_id") % 2 == 0, F.concat(F.lit("Lake_"), F.col("lake_id").cast("string"))).otherwise("Basin")
    return t.lakes.select("lake_id", name.alias("name"), rules.lake_id(name).alias("parsed"))


@query("P14_role_mask", """
SELECT DN, CASE WHEN is_lake = 1 THEN 3 WHEN trim(STATION_NU) <> '' THEN 2 WHEN DSLINKNO <= 0 THEN 1 ELSE 0 END AS mask FROM basins""")
def _(t):
    return t.basins.select("DN", rules.role_mask(rules.is_outlet(F.col("DSLINKNO")), rules.has_text(F.col("STATION_NU")), F.col("is_lake") == 1).alias("mask"))


@query("P16_link_derivatives", f"""
SELECT LINKNO, {SIX('sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))')} AS straight, {SIX('(DOUTEND + DOUTEND + Length) / 2')} AS doutmid,
{SIX('CASE WHEN Length > 0 THEN strmDrop / Length ELSE 0e0 END')} AS slope FROM streams""")
def _(t):
    line = F.col("line")
    slope = F.when(F.col("Length") > 0, F.try_divide("strmDrop", "Length")).otherwise(0.0)
    return t.lines().select("LINKNO", six(G.distance(G.first_vertex(line), G.last_vertex(line))).alias("straight"), six((F.col("DOUTEND") * 2 + F.col("Length")) / 2).alias("doutmid"), six(slope).alias("slope"))


@query("P18_d8_decode", "SELECT r, c, fdr, tr, tc FROM d8")
def _(t):
    cells = raster.steepest(t.cells())
    df = raster.flow_targets(cells)
    return df.select(F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), "fdr", F.col("trow").cast("long").alias("tr"), F.col("tcol").cast("long").alias("tc"))


@query("P19_d8_encode", "SELECT code, dr * 3 AS dr, dc * 2 AS dc, code AS encoded, (code + 3) % 8 + 1 AS opposite FROM offsets")
def _(t):
    df = d8.offsets(t.spark).select("code", (F.col("dr") * 3).alias("dr"), (F.col("dc") * 2).alias("dc"))
    return df.select("*", d8.encode(F.col("dr"), F.col("dc")).alias("encoded"), d8.opposite(F.col("code")).alias("opposite"))


@query("S11_export_rule_a", "SELECT LINKNO, round_even(Length / 7e0 * 1e3, 0) / 1e3 AS Length, Slope, CASE WHEN LINKNO % 4 = 0 THEN -1 ELSE DSLINKNO END AS DSLINKNO FROM streams")
def _(t):
    df = t.streams.select("LINKNO", (F.col("Length") / 7.0).alias("Length"), "Slope", F.when(F.col("LINKNO") % 4 != 0, F.col("DSLINKNO")).alias("DSLINKNO"))
    return rules.export(df, 3)


@query("S11_export_rule_b", "SELECT LINKNO, round_even(Length / 7e0 * 1e6, 0) / 1e6 AS Length, round_even(Slope * 1e6, 0) / 1e6 AS Slope FROM streams")
def _(t):
    return rules.export(t.streams.select("LINKNO", (F.col("Length") / 7.0).alias("Length"), "Slope"), 6, ())


@query("G1_lake_area", f"SELECT lake_id, {SIX('power(2 * hw, 2)')} AS area FROM lakes")
def _(t):
    return t.lake_rings().select("lake_id", six(G.polygon_area(F.array("ring"))).alias("area"))


@query("G2_line_length", f"SELECT LINKNO, {SIX('sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))')} AS len, {SIX('(x0 + x1) / 2')} AS mx, {SIX('(y0 + y1) / 2')} AS my FROM streams")
def _(t):
    mid = G.midpoint(F.col("line"))
    return t.lines().select("LINKNO", six(G.length(F.col("line"))).alias("len"), six(mid["x"]).alias("mx"), six(mid["y"]).alias("my"))


@query("G3_total_bounds", f"SELECT {SIX('min(cx - hw)')} AS minx, {SIX('max(cy + hw)')} AS maxy FROM lakes")
def _(t):
    b = t.lake_rings().select(G.bounds(F.col("ring")).alias("b"))
    return b.agg(six(F.min("b.minx")).alias("minx"), six(F.max("b.maxy")).alias("maxy"))


@query("G8_clipped_lakes", f"""
SELECT lake_id, {SIX('greatest(least(cx + hw, 5e1) - greatest(cx - hw, 1e1), 0e0) * greatest(least(cy + hw, 5e1) - greatest(cy - hw, 1e1), 0e0)')} AS area FROM lakes""")
def _(t):
    """J11 too: the part of each lake within a boundary."""
    clipped = t.lake_rings().select("lake_id", G.clip_box(F.col("ring"), 10.0, 10.0, 50.0, 50.0).alias("ring"))
    return clipped.select("lake_id", six(F.when(F.size("ring") > 3, G.ring_area(F.col("ring"))).otherwise(0.0)).alias("area"))


@query("G12_joined_lines", "SELECT s.LINKNO, 1 AS parts, CAST(3 AS INT) AS n FROM streams s JOIN streams d ON d.LINKNO = s.DSLINKNO")
def _(t):
    """Each stream and the one downstream, from its upper end to its lower end."""
    down = t.lines().select(F.col("LINKNO").alias("DSLINKNO"), F.reverse("line").alias("next"))
    both = t.lines().select("LINKNO", "DSLINKNO", F.reverse("line").alias("line")).join(down, "DSLINKNO")
    parts = G.joined(F.col("line"), F.col("next"))
    return both.select("LINKNO", F.size(parts).alias("parts"), F.size(F.get(parts, F.lit(0))).alias("n"))


@query("G13_least_step", f"SELECT LINKNO, {SIX('sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))')} AS step FROM streams")
def _(t):
    return t.lines().select("LINKNO", six(G.least_step(F.col("line"))).alias("step"))


@query("G15_wkt", f"SELECT LINKNO, 2 AS n, {SIX('x0')} AS x, {SIX('y1')} AS y FROM streams")
def _(t):
    back = t.lines().select("LINKNO", G.from_wkt(G.to_wkt("LINESTRING", F.col("line"))).alias("v"))
    return back.select("LINKNO", F.size("v").alias("n"), six(F.get("v", F.lit(0))["x"]).alias("x"), six(F.get("v", F.lit(1))["y"]).alias("y"))


@query("G17_cell_centres", f"SELECT r, c, {SIX('1e3 + (c + 5e-1) * 25e-1')} AS x, {SIX('5e3 - (r + 5e-1) * 25e-1')} AS y FROM grid")
def _(t):
    p = G.cell_xy([1000.0, 2.5, 0.0, 5000.0, 0.0, -2.5], F.col("r"), F.col("c"), 0.5)
    return t.grid.select("r", "c", six(p["x"]).alias("x"), six(p["y"]).alias("y"))


# ---- polygons of many rings ---------------------------------------------------------------------------------------

_BOUNDARY = [((1, 6), (1, 9), 1), ((6, 9), (1, 4), 1), ((2, 4), (5, 7), -1)]  # two boxes and a hole, in tenths of the width


def _shared_area(half: str) -> str:
    """SQL of the area that a square around (cx, cy) has in common with the boundary."""
    side = lambda c, lo, hi: f"greatest(0e0, least({c} + {half}, {hi}e-1 * w) - greatest({c} - {half}, {lo}e-1 * w))"
    return "(" + " + ".join(f"{sign}e0 * {side('cx', *xs)} * {side('cy', *ys)}" for xs, ys, sign in _BOUNDARY) + ")"


FIVE = "round_even(({0}) * 1e5, 0) / 1e5".format


def _side():
    """The side of a square of the polygon's area; areas themselves would lie on ties of rounding."""
    return rules.rounded(F.sqrt(F.greatest(polygons.area(F.col("rings")), F.lit(0.0))), 5).alias("side")


_SIZED = "FROM lakes, (SELECT CAST(max(wide) AS DOUBLE) AS w FROM grid)"


@query("J2_gauges_in_ringed_lakes", """
SELECT l.lake_id, s.STATION_NUMBER FROM (SELECT lake_id, cx, cy, hw FROM lakes) l JOIN stations s ON greatest(abs(s.x - l.cx), abs(s.y - l.cy)) < hw
WHERE greatest(abs(s.x - l.cx), abs(s.y - l.cy)) > hw / 2 OR greatest(abs(s.x - l.cx), abs(s.y - l.cy)) < hw / 4""")
def _(t):
    """Gauges within lakes that have islands, and ponds on these."""
    found = polygons.points_in_polygons(t.gauges().select("STATION_NUMBER", "p"), t.ringed_lakes().select("lake_id", "rings"))
    return found.select("lake_id", "STATION_NUMBER")


_PLACED = """SELECT b.DN, s.STATION_NUMBER, s.sid FROM basins b JOIN streams k ON k.LINKNO = b.DN JOIN (SELECT *, x * 1e5 / w AS px, y * 12e3 / w AS py FROM stations, (SELECT CAST(max(wide) AS DOUBLE) AS w FROM grid)) s
ON s.px > (b.DN - power(2e0, k.lvl)) / power(2e0, k.lvl) * 1e5 AND s.px < (b.DN - power(2e0, k.lvl) + 1) / power(2e0, k.lvl) * 1e5 AND s.py > k.lvl * 1e3 - 500 AND s.py < k.lvl * 1e3 + 500"""


def _placed(t):
    n = t.width()
    at = F.struct((F.col("x") * 1e5 / n).alias("x"), (F.col("y") * 12e3 / n).alias("y"))
    points = t.stations.select("STATION_NUMBER", "sid", at.alias("p"))
    return polygons.points_in_polygons(points, t.catchments()).select("DN", "STATION_NUMBER", "sid")


@query("J4_gauges_in_basins", f"SELECT DN, STATION_NUMBER FROM ({_PLACED})")
def _(t):
    """Each gauge and the basin that it lies in, by place."""
    return _placed(t).select("DN", "STATION_NUMBER")


@query("J4_basins_with_their_gauges", f"SELECT b.DN, coalesce(g.names, '') AS names FROM basins b LEFT JOIN (SELECT DN, string_agg(STATION_NUMBER, ', ' ORDER BY sid) AS names FROM ({_PLACED}) GROUP BY DN) g ON g.DN = b.DN")
def _(t):
    """All basins with the gauges that lie in them, in the gauges' order."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("sid", "STATION_NUMBER"))), lambda s: s["STATION_NUMBER"])
    g = _placed(t).groupBy("DN").agg(F.array_join(listed, ", ").alias("names"))
    return t.basins.select("DN").join(g, "DN", "left").withColumn("names", F.coalesce("names", F.lit("")))


@query("J11_lakes_within_boundary", f"SELECT lake_id, {FIVE('sqrt(area)')} AS side FROM (SELECT lake_id, {_shared_area('hw')} - {_shared_area('hw / 2')} + {_shared_area('hw / 4')} AS area {_SIZED}) WHERE area > 1e-9")
def _(t):
    """Lakes with islands cut to a boundary with a corner and a hole, by the side of a square of their area."""
    cut = polygons.clipped(t.ringed_lakes().select("lake_id", "rings"), t.boundary())
    return cut.select("lake_id", _side())


@query("G8_outside_boundary", f"SELECT lake_id, {FIVE('sqrt(greatest(4 * hw * hw - area, 0e0))')} AS side FROM (SELECT lake_id, hw, {_shared_area('hw')} AS area {_SIZED})")
def _(t):
    """What the boundary leaves out of each lake: a difference of polygons."""
    lakes = t.lake_rings().select("lake_id", F.array("ring").alias("rings"))
    apart = polygons.overlay(lakes.crossJoin(t.boundary()), "difference")  # the boundary is one row
    return apart.select("lake_id", _side())


@query("J3_lakes_meeting_boundary", f"""
SELECT lake_id {_SIZED} WHERE ((cx + hw >= 1e-1 * w AND cx - hw <= 6e-1 * w AND cy + hw >= 1e-1 * w AND cy - hw <= 9e-1 * w)
  OR (cx + hw >= 6e-1 * w AND cx - hw <= 9e-1 * w AND cy + hw >= 1e-1 * w AND cy - hw <= 4e-1 * w))
  AND NOT (cx - hw > 2e-1 * w AND cx + hw < 4e-1 * w AND cy - hw > 5e-1 * w AND cy + hw < 7e-1 * w)""")
def _(t):
    return polygons.meeting(t.ringed_lakes().select("lake_id", "rings"), t.boundary()).select("lake_id")


@query("J10_overlapping_lakes", f"""
SELECT a, b, {FIVE('sqrt(dx * dy)')} AS side FROM (SELECT x.lake_id AS a, y.lake_id AS b, least(x.cx + x.hw, y.cx + y.hw) - greatest(x.cx - x.hw, y.cx - y.hw) AS dx,
  least(x.cy + x.hw, y.cy + y.hw) - greatest(x.cy - x.hw, y.cy - y.hw) AS dy FROM lakes x JOIN lakes y ON x.lake_id < y.lake_id) WHERE dx > 0 AND dy > 0""")
def _(t):
    """Pairs of lakes with the area that they have in common."""
    lakes = t.lake_rings().select("lake_id", F.array("ring").alias("rings"))
    pairs = polygons.box_pairs(lakes.withColumnRenamed("lake_id", "a"), lakes.select(F.col("lake_id").alias("b"), F.col("rings").alias("others")))
    both = polygons.overlay(pairs.where("a < b")).where(F.size("rings") > 0)
    return both.select("a", "b", _side())


@query("R3_burned_islands", """
SELECT l.lake_id, count(*) AS n, CAST(sum(g.r * 31 + g.c) AS BIGINT) AS s FROM lakes l JOIN grid g ON g.c <= l.cx + l.hw AND g.c + 1 >= l.cx - l.hw AND g.r <= l.cy + l.hw AND g.r + 1 >= l.cy - l.hw
WHERE NOT (g.c > l.cx - l.hw / 2 AND g.c + 1 < l.cx + l.hw / 2 AND g.r > l.cy - l.hw / 2 AND g.r + 1 < l.cy + l.hw / 2)
  OR (g.c <= l.cx + l.hw / 4 AND g.c + 1 >= l.cx - l.hw / 4 AND g.r <= l.cy + l.hw / 4 AND g.r + 1 >= l.cy - l.hw / 4) GROUP BY l.lake_id""")
def _(t):
    """Cells of lakes with islands, and ponds on these."""
    n = t.width()
    mask = raster.burn(t.ringed_lakes().select("lake_id", "rings"), n, n)
    return mask.groupBy("lake_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("row").cast("long") * 31 + F.col("col")).alias("s"))


# ---- joins and rankings -----------------------------------------------------------------------------------------


@query("J6_basin_river_join", "SELECT b.DN, b.is_lake, s.Length, s.strmOrder FROM basins b LEFT JOIN streams s ON s.LINKNO = b.DN")
def _(t):
    basin, river = t.basins.drop("DSLINKNO", "sz", "unit_area", "STATION_NU"), t.streams
    more = [c for c in ("Length", "strmOrder") if c not in basin.columns]
    return basin.join(river.select(F.col("LINKNO").alias("DN"), *more), "DN", "left").select("DN", "is_lake", *more)


@query("J8_nearest_gauge", f"""
SELECT e.sid, {SIX('coalesce(min(sqrt((e.x - s.x) * (e.x - s.x) + (e.y - s.y) * (e.y - s.y))), -1e0)')} AS d
FROM stations e LEFT JOIN stations s ON s.sid <> e.sid AND s.HYD_STATUS = 'A' AND sqrt((e.x - s.x) * (e.x - s.x) + (e.y - s.y) * (e.y - s.y)) <= 1e0
WHERE e.HYD_STATUS = 'D' GROUP BY e.sid""")
def _(t):
    here = t.gauges().where("HYD_STATUS = 'D'").select("sid", "p")
    there = t.gauges().where("HYD_STATUS = 'A'").select(F.col("p").alias("q"))
    near = spatial.nearest_distance(here, there, "sid", 1.0)
    return near.select("sid", six(F.when(F.col("d") == float("inf"), -1.0).otherwise(F.col("d"))).alias("d"))


_POINTS = """SELECT LINKNO AS pt, CASE WHEN LINKNO % 2 = 0 THEN 'inflow' ELSE 'outflow' END AS point_type,
  x1 + 1e0 AS px, y1 - 2e0 AS py FROM streams"""


@query("J7_connect_nodes", f"""
WITH pts AS ({_POINTS}), near AS (
  SELECT p.pt, s.LINKNO, sqrt(power(px - CASE WHEN point_type = 'inflow' THEN x1 ELSE x0 END, 2) + power(py - CASE WHEN point_type = 'inflow' THEN y1 ELSE y0 END, 2)) AS d,
    greatest(0e0, least(1e0, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS f, px, py, x0, y0, x1, y1
  FROM pts p JOIN streams s ON s.y0 <= p.py + 5e0 AND s.y1 >= p.py - 5e0)
SELECT pt, min_by(LINKNO, (d, LINKNO)) AS LINKNO, {SIX('min(d)')} AS d FROM near
WHERE sqrt(power(px - (x0 + f * (x1 - x0)), 2) + power(py - (y0 + f * (y1 - y0)), 2)) <= 5e0 GROUP BY pt""")
def _(t):
    t.streams.createOrReplaceTempView("streams")
    pts = t.spark.sql(_POINTS).select("pt", "point_type", F.struct(F.col("px").alias("x"), F.col("py").alias("y")).alias("p"))
    return spatial.connect_nodes(pts, t.lines().select("LINKNO", "line"), 5.0, 1000.0).select("pt", "LINKNO", six(F.col("d")).alias("d"))


@query("J9_nearest_stream", """
SELECT LINKNO FROM (SELECT *, greatest(0e0, least(1e0, ((3e4 - x0) * (x1 - x0) + (25e2 - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS f FROM streams)
ORDER BY sqrt(power(3e4 - (x0 + f * (x1 - x0)), 2) + power(25e2 - (y0 + f * (y1 - y0)), 2)), LINKNO LIMIT 1""")
def _(t):
    """The link whose line is nearest to a point, the least on ties."""
    p = F.struct(F.lit(30000.0).alias("x"), F.lit(2500.0).alias("y"))
    return spatial.nearest_line(t.lines().select("LINKNO", "line"), p).select("LINKNO")


@query("J5_streams_through_lakes", "SELECT l.lake_id, coalesce(string_agg(DISTINCT CAST(m.WSNO AS VARCHAR), ','  ORDER BY CAST(m.WSNO AS VARCHAR)), '') AS basins FROM wide l LEFT JOIN met m ON m.lake_id = l.lake_id GROUP BY l.lake_id")
def _(t):
    found = spatial.through_basins(t.wide_rings(), t.lines().select("WSNO", "line"), 5000.0)
    names = F.array_sort(F.transform("basins", lambda b: b.cast("string")))
    return found.select("lake_id", F.array_join(names, ",").alias("basins"))


@query("G8_streams_in_lakes", f"SELECT lake_id, LINKNO, {SIX('overlap')} AS overlap, mid_inside, tips_inside FROM met")
def _(t):
    met = spatial.lines_in_polygons(t.lines().select("LINKNO", "line"), t.wide_rings(), 5000.0)
    return met.select("lake_id", "LINKNO", six(F.col("overlap")).alias("overlap"), "mid_inside", "tips_inside")


@query("J13_parents_of_units", """
WITH unit AS (SELECT CASE WHEN LINKNO % 2 = 1 THEN LINKNO - 1 ELSE LINKNO END AS agg, min(CASE WHEN LINKNO % 2 = 0 THEN DSLINKNO END) AS aggdown, sum(sz) AS sz FROM streams GROUP BY 1)
SELECT s.agg, s.aggdown, p.aggdown AS parent_down FROM unit s LEFT JOIN unit p ON p.agg = s.aggdown WHERE s.sz < 50""")
def _(t):
    """Small units and where the unit downstream of them flows: a self left join on the aggregate."""
    agg = F.when(F.col("LINKNO") % 2 == 1, F.col("LINKNO") - 1).otherwise(F.col("LINKNO"))
    even = F.when(F.col("LINKNO") % 2 == 0, F.col("DSLINKNO"))
    unit = t.streams.groupBy(agg.alias("agg")).agg(F.min(even).alias("aggdown"), F.sum("sz").alias("sz"))
    parent = unit.select(F.col("agg").alias("aggdown"), F.col("aggdown").alias("parent_down"))
    return unit.where("sz < 50").join(parent, "aggdown", "left").select("agg", "aggdown", "parent_down")


@query("J14_basins_with_gauges", """
SELECT b.DN, coalesce(g.names, '') AS names FROM basins b LEFT JOIN (SELECT sid % 50 + 1 AS DN, string_agg(STATION_NUMBER, ', ' ORDER BY sid) AS names FROM stations GROUP BY 1) g ON g.DN = b.DN""")
def _(t):
    listed = F.transform(F.sort_array(F.collect_list(F.struct("sid", "STATION_NUMBER"))), lambda s: s["STATION_NUMBER"])
    g = t.stations.groupBy((F.col("sid") % 50 + 1).alias("DN")).agg(F.array_join(listed, ", ").alias("names"))
    return t.basins.select("DN").join(g, "DN", "left").withColumn("names", F.coalesce("names", F.lit("")))


@query("J16_pour_point_attributes", """
SELECT u.agg AS DN, b.is_lake, b.STATION_NU, u.n FROM (SELECT lvl, min(LINKNO) AS agg, count(*) AS n FROM streams GROUP BY lvl) u LEFT JOIN basins b ON b.DN = u.agg""")
def _(t):
    unit = t.streams.groupBy("lvl").agg(F.min("LINKNO").alias("DN"), F.count(F.lit(1)).alias("n"))
    return unit.join(t.basins.select("DN", "is_lake", "STATION_NU"), "DN", "left").select("DN", "is_lake", "STATION_NU", "n")


@query("W6_sorted_links", "SELECT LINKNO, row_number() OVER (ORDER BY Length DESC, LINKNO) AS place FROM streams ORDER BY Length DESC LIMIT 20")
def _(t):
    """The 20 longest links in order: a sort with a limit keeps 20 rows a task."""
    top = t.streams.orderBy(F.desc("Length"), "LINKNO").limit(20)
    return top.select("LINKNO", F.row_number().over(Window.orderBy(F.desc("Length"), "LINKNO")).cast("long").alias("place"))


@query("W2_ranked_exits", "SELECT lake_id, link_no, seq FROM (SELECT *, row_number() OVER (PARTITION BY lake_id ORDER BY gauge_dist, doutend, local_accum DESC, dscontarea DESC, seq) AS k FROM exits) WHERE k = 1")
def _(t):
    return spatial.rank_exits(t.exits, "local_accum").select("lake_id", "link_no", "seq")


@query("W5_best_cell_per_link", "SELECT lake_id, link_no, max(local_accum) AS most, min(local_accum) AS least FROM exits GROUP BY lake_id, link_no")
def _(t):
    df = t.exits.select("lake_id", "link_no", F.col("seq").alias("row"), F.lit(0).alias("col"), "local_accum")
    most = raster.best_per_link(df, "local_accum", False).select("lake_id", "link_no", F.col("local_accum").alias("most"))
    least = raster.best_per_link(df, "local_accum", True).select("lake_id", "link_no", F.col("local_accum").alias("least"))
    return most.join(least, ["lake_id", "link_no"])


@query("W8_union_points", "SELECT lake_id AS id, CAST(NULL AS VARCHAR) AS name FROM lakes UNION ALL SELECT sid, STATION_NAME FROM stations")
def _(t):
    lakes = t.lakes.select(F.col("lake_id").alias("id"))
    return lakes.unionByName(t.stations.select(F.col("sid").alias("id"), F.col("STATION_NAME").alias("name")), allowMissingColumns=True)


@query("W9_set_difference", "SELECT LINKNO FROM streams WHERE LINKNO % 2 = 0 EXCEPT SELECT DN FROM basins UNION SELECT lake_id FROM lakes")
def _(t):
    odd = t.streams.where("LINKNO % 2 = 0").select("LINKNO").join(t.basins, F.col("LINKNO") == F.col("DN"), "left_anti")
    return odd.union(t.lakes.select("lake_id")).distinct()


# ---- aggregations -----------------------------------------------------------------------------------------------


@query("A2_dissolve_first", """
SELECT lvl, arg_min(v, LINKNO) FILTER (v IS NOT NULL) AS v, max(Length) AS Length, CAST(sum(sz) AS BIGINT) AS sz
FROM (SELECT *, CASE WHEN LINKNO % 3 <> 0 THEN LINKNO * 2 END AS v FROM streams) GROUP BY lvl""")
def _(t):
    """Attributes by rule: the first known value by id, the greatest, the sum."""
    some = t.streams.withColumn("v", F.when(F.col("LINKNO") % 3 != 0, F.col("LINKNO") * 2))
    return dissolve.dissolve(some, "lvl", {"v": "first", "Length": "max", "sz": "sum"}, "LINKNO")


def _basin_cells(t):
    return t.grid.where("w > 0").select(F.col("w").alias("DN"), F.col("r").cast("int").alias("row"), F.col("c").cast("int").alias("col"))


@query("A1_dissolved_lakes", """
WITH u AS (SELECT DISTINCT r, c FROM mask) SELECT (SELECT count(*) FROM u) + 0e0 AS area,
(SELECT 4 * count(*) FROM u) - 2e0 * ((SELECT count(*) FROM u JOIN u v ON v.r = u.r + 1 AND v.c = u.c) + (SELECT count(*) FROM u JOIN u v ON v.r = u.r AND v.c = u.c + 1)) AS perimeter""")
def _(t):
    """One geometry of all lakes, by its rings: area less holes, and length."""
    cells = _mask(t).withColumnRenamed("lake_id", "unit")
    merged = dissolve.merged_cells(cells, cells.select("unit", F.lit(0).cast("long").alias("label")).distinct())
    return rings.measures(merged).agg(F.sum("area").alias("area"), F.sum("perimeter").alias("perimeter"))


@query("A3_dissolved_basins", """
WITH u AS (SELECT DISTINCT w % 7 AS label, r, c FROM grid WHERE w > 0) SELECT u.label, count(*) + 0e0 AS area, 4e0 * count(*) - 2 * (count(a.r) + count(b.r)) AS perimeter
FROM u LEFT JOIN u a ON a.label = u.label AND a.r = u.r + 1 AND a.c = u.c LEFT JOIN u b ON b.label = u.label AND b.r = u.r AND b.c = u.c + 1 GROUP BY u.label""")
def _(t):
    """Basins merged by group: area and perimeter of the union."""
    cells = _basin_cells(t).withColumnRenamed("DN", "unit")
    groups = cells.select("unit", (F.col("unit") % 7).alias("label")).distinct()
    return dissolve.cell_area(dissolve.merged_cells(cells, groups))


@query("A3_dissolve_max", "SELECT DSLINKNO AS unit, max(Length) AS Length, max(strmOrder) AS strmOrder FROM streams GROUP BY DSLINKNO")
def _(t):
    return t.streams.groupBy(F.col("DSLINKNO").alias("unit")).agg(F.max("Length").alias("Length"), F.max("strmOrder").alias("strmOrder"))


@query("A4_unit_area", f"SELECT lvl, {SIX('sum(unit_area) * 1e-6')} AS area FROM streams GROUP BY lvl")
def _(t):
    return t.streams.groupBy("lvl").agg(six(F.sum("unit_area") * 1e-6).alias("area"))


@query("A5_weighted_slope", f"SELECT lvl, {SIX('sum(Slope * Length) / nullif(sum(Length), 0)')} AS slope FROM streams GROUP BY lvl")
def _(t):
    return t.streams.groupBy("lvl").agg(six(F.try_divide(F.sum(F.col("Slope") * F.col("Length")), F.sum("Length"))).alias("slope"))


@query("A6_group_without_nulls", "SELECT DSLINKNO, lvl, CAST(sum(sz) AS BIGINT) AS area FROM streams WHERE DSLINKNO > 0 GROUP BY DSLINKNO, lvl")
def _(t):
    keyed = t.streams.withColumn("DSLINKNO", F.when(F.col("DSLINKNO") > 0, F.col("DSLINKNO")))
    return keyed.where("DSLINKNO is not null and lvl is not null").groupBy("DSLINKNO", "lvl").agg(F.sum("sz").alias("area"))


@query("A12_argmax", "SELECT DSLINKNO, arg_min(LINKNO, (-sz, LINKNO)) AS largest FROM streams GROUP BY DSLINKNO")
def _(t):
    return t.streams.groupBy("DSLINKNO").agg(F.min(F.struct((-F.col("sz")).alias("s"), "LINKNO")).alias("b")).select("DSLINKNO", F.col("b.LINKNO").alias("largest"))


@query("A14_counts", "SELECT HYD_STATUS, count(*) AS n FROM stations GROUP BY HYD_STATUS")
def _(t):
    return t.stations.groupBy("HYD_STATUS").agg(F.count(F.lit(1)).alias("n"))


# ---- network ----------------------------------------------------------------------------------------------------


def _reach(t):
    return network.closure(network.edges(t.streams))


def _spans(t):
    return network.intervals(network.as_nodes(network.edges(t.streams), t.streams.select("LINKNO")))


@query("T1_closure", "SELECT id, anc, hops FROM reach")
def _(t):
    return _reach(t)


@query("T2_duplicate_exits", """
SELECT a.lake_id, a.link_no, a.seq FROM exits a WHERE a.link_no = -1 OR NOT EXISTS (
  SELECT 1 FROM exits b WHERE b.lake_id = a.lake_id AND b.link_no <> -1 AND b.link_no = a.link_no AND b.local_accum > a.local_accum)
  AND NOT EXISTS (SELECT 1 FROM exits b JOIN reach q ON q.anc = b.link_no WHERE b.lake_id = a.lake_id AND q.id = a.link_no)""")
def _(t):
    return network.drop_duplicate_exits(t.exits, _spans(t), "local_accum").select("lake_id", "link_no", "seq")


@query("T3_trace_downstream", """
WITH walk AS (
  SELECT LINKNO AS start, LINKNO AS id, CAST(0 AS BIGINT) AS hops FROM streams UNION ALL SELECT id, anc, hops FROM reach)
SELECT w.start, w.id, w.hops FROM walk w LEFT JOIN (SELECT start, min(hops) AS e FROM walk WHERE id % 5 = 0 GROUP BY start) s ON s.start = w.start
WHERE e IS NULL OR w.hops <= e""")
def _(t):
    """From every link down to the first stop."""
    stops = t.streams.where("LINKNO % 5 = 0").select(F.col("LINKNO").alias("stop"))
    return network.trace_downstream(t.streams.select(F.col("LINKNO").alias("start")), network.edges(t.streams), stops)


@query("T4_internal_links", """
WITH starts AS (SELECT LINKNO % 25 AS lake_id, LINKNO FROM streams WHERE lvl = 6
  UNION SELECT lake_id, LINKNO FROM met WHERE (mid_inside OR tips_inside OR overlap > 180) AND LINKNO NOT IN (SELECT DSLINKNO FROM streams)),
walk AS (SELECT s.lake_id, s.LINKNO AS start, r.anc AS id, r.hops FROM starts s JOIN reach r ON r.id = s.LINKNO
  UNION ALL SELECT lake_id, LINKNO, LINKNO, 0 FROM starts),
ends AS (SELECT lake_id, start, min(hops) AS e FROM walk WHERE id % 3 = 0 AND id % 25 = lake_id GROUP BY lake_id, start)
SELECT DISTINCT w.lake_id, w.id AS LINKNO FROM walk w LEFT JOIN ends e ON e.lake_id = w.lake_id AND e.start = w.start WHERE e IS NULL OR w.hops <= e.e""")
def _(t):
    """Links that lakes swallow: down from their inflow links, and from headwaters that lie in them, to the first outflow link."""
    met = spatial.lines_in_polygons(t.lines().select("LINKNO", "line"), t.wide_rings(), 5000.0)
    inflow = t.streams.where("lvl = 6").select((F.col("LINKNO") % 25).alias("lake_id"), "LINKNO")
    stops = t.streams.where("LINKNO % 3 = 0").select((F.col("LINKNO") % 25).alias("lake_id"), "LINKNO")
    starts = inflow.union(spatial.swallowed_starts(met, t.streams)).distinct()
    return network.internal_links(starts, network.edges(t.streams), stops)


@query("T6_contraction", """
WITH into_ AS (SELECT LINKNO % 13 AS lake_id, LINKNO, CAST(floor(LINKNO / 2) AS BIGINT) AS winner FROM streams WHERE LINKNO % 9 = 0
  UNION SELECT LINKNO % 13, CAST(floor(LINKNO / 2) AS BIGINT), CAST(floor(LINKNO / 2) AS BIGINT) FROM streams WHERE LINKNO % 9 = 0
  UNION SELECT 13, LINKNO, CAST(floor(LINKNO / 2) AS BIGINT) FROM streams WHERE LINKNO % 18 = 4), one AS (
  SELECT LINKNO, arg_max(winner, (lake_id, winner)) AS winner FROM into_ GROUP BY LINKNO), unit AS (
  SELECT coalesce(o.winner, s.LINKNO) AS unit, s.* FROM streams s LEFT JOIN one o ON o.LINKNO = s.LINKNO)
SELECT u.unit AS LINKNO, coalesce(any_value(m.winner), any_value(s.DSLINKNO)) AS DSLINKNO, max(u.Length) AS Length, max(u.sz) AS sz
FROM unit u JOIN streams s ON s.LINKNO = u.unit LEFT JOIN one m ON m.LINKNO = s.DSLINKNO GROUP BY u.unit""")
def _(t):
    """Links become the winner of the last lake that swallows them."""
    half = F.floor(F.col("LINKNO") / 2)
    some = t.streams.where("LINKNO % 9 = 0").select((F.col("LINKNO") % 13).alias("lake_id"), "LINKNO", half.alias("winner"))
    late = t.streams.where("LINKNO % 18 = 4").select(F.lit(13).cast("long").alias("lake_id"), "LINKNO", half.alias("winner"))
    swallowed = some.union(some.select("lake_id", "winner", "winner")).union(late)
    links = t.streams.select("LINKNO", "DSLINKNO", "USLINKNO1", "USLINKNO2", "Length", "sz")
    return network.contract(links, swallowed)


_SUBTREES = "SELECT LINKNO, CASE WHEN lvl >= 4 THEN CAST(floor(LINKNO / power(2e0, lvl - 4)) AS BIGINT) ELSE 0 END AS lake_id FROM streams"


@query("T5_longest_path", f"""
WITH lake AS ({_SUBTREES}), inside AS (SELECT l.lake_id, s.* FROM streams s JOIN lake l ON l.LINKNO = s.LINKNO),
tops AS (SELECT a.lake_id, a.LINKNO AS start FROM inside a LEFT JOIN inside b ON b.lake_id = a.lake_id AND b.LINKNO = a.USLINKNO1 WHERE b.LINKNO IS NULL),
walk AS (SELECT lake_id, start, start AS cur, 0 AS hops FROM tops UNION ALL SELECT t.lake_id, t.start, r.anc, r.hops FROM tops t JOIN reach r ON r.id = t.start JOIN lake l ON l.LINKNO = r.anc AND l.lake_id = t.lake_id),
stops AS (SELECT start, min(hops) AS stop FROM walk WHERE cur % 6 = 0 AND cur = lake_id GROUP BY start),
each AS (SELECT w.lake_id, w.start, sum(Length) AS Length, sum(strmDrop) AS strmDrop, min(DOUTEND) AS DOUTEND, arg_max(x0, hops) AS ex, arg_max(y0, hops) AS ey
  FROM walk w JOIN inside i ON i.LINKNO = w.cur LEFT JOIN stops p ON p.start = w.start WHERE p.stop IS NULL OR w.hops <= p.stop GROUP BY w.lake_id, w.start),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lake_id ORDER BY round_even(Length * 1e6, 0) DESC, start) AS k FROM each) WHERE k = 1)
SELECT b.lake_id, CASE WHEN b.lake_id % 6 = 0 AND b.lake_id > 0 THEN b.lake_id END AS winner, b.start, {SIX('b.Length')} AS Length, {SIX('b.strmDrop')} AS strmDrop, {SIX('sqrt(power(s.x1 - ex, 2) + power(s.y1 - ey, 2))')} AS StraightL,
  {SIX('b.DOUTEND')} AS DOUTEND, {SIX('b.DOUTEND + b.Length')} AS DOUTSTART, {SIX('b.DOUTEND + b.Length / 2')} AS DOUTMID FROM best b JOIN streams s ON s.LINKNO = b.start""")
def _(t):
    """Over all links: lakes are the whole subtrees below the fourth level, and the links above them one more; every sixth
    lake has a winner, its top, at which paths stop."""
    top = F.when(F.col("lvl") >= 4, F.floor(F.col("LINKNO") / F.pow(F.lit(2.0), F.col("lvl") - 4)).cast("long")).otherwise(F.lit(0).cast("long"))
    inside = t.streams.select(top.alias("lake_id"), "LINKNO")
    best = network.path_metrics(inside, t.lines(), inside.where("LINKNO = lake_id and LINKNO % 6 = 0"))
    return best.select("lake_id", "winner", "start", *[six(F.col(c)).alias(c) for c in network.PATH_METRICS])


@query("T8_phantom_bypass", f"""
WITH chain AS (SELECT * FROM (WITH RECURSIVE w(id, cur, hops) AS (SELECT s.LINKNO, s.DSLINKNO, 1 FROM streams s WHERE s.LINKNO % 7 <> 3 AND s.DSLINKNO % 7 = 3 AND s.DSLINKNO > 0 UNION ALL
  SELECT w.id, s.DSLINKNO, w.hops + 1 FROM w JOIN streams s ON s.LINKNO = w.cur WHERE s.DSLINKNO % 7 = 3 AND s.DSLINKNO > 0) SELECT * FROM w)),
gain AS (SELECT id, sum(p.Length) AS l, sum(p.strmDrop) AS d, min(p.DSContArea) AS a, arg_max(p.DOUTEND, hops) AS e, arg_max(p.DSLINKNO, hops) AS n, count(*) AS k,
  arg_max(p.x0, hops) AS ex, arg_max(p.y0, hops) AS ey FROM chain c JOIN streams p ON p.LINKNO = c.cur GROUP BY id)
SELECT s.LINKNO, coalesce(n, s.DSLINKNO) AS DSLINKNO, {SIX('s.Length + coalesce(l, 0e0)')} AS Length, s.strmDrop + coalesce(d, 0e0) AS strmDrop,
  least(s.DSContArea, coalesce(a, s.DSContArea)) AS DSContArea, coalesce(e, s.DOUTEND) AS DOUTEND, coalesce(k, 0) AS n_absorbed,
  {SIX('(s.strmDrop + coalesce(d, 0e0)) / (s.Length + coalesce(l, 0e0))')} AS Slope, {SIX('sqrt(power(s.x1 - coalesce(ex, s.x0), 2) + power(s.y1 - coalesce(ey, s.y0), 2))')} AS StraightL,
  {SIX('(s.DOUTEND + s.Length + coalesce(e, s.DOUTEND)) / 2')} AS DOUTMID, 1 AS n_parts, CAST(coalesce(k, 0) + 2 AS INT) AS n_vertices
FROM streams s LEFT JOIN gain g ON g.id = s.LINKNO WHERE s.LINKNO % 7 <> 3""")
def _(t):
    """Real links with the phantom links below them, as one line each."""
    links = t.lines().select("LINKNO", "DSLINKNO", "Length", "strmDrop", "DSContArea", "DOUTEND", (F.col("DOUTEND") + F.col("Length")).alias("DOUTSTART"), "line")
    df = network.bypass_phantoms(links, t.basins)
    shape = [F.size("parts").alias("n_parts"), F.size(F.get("parts", F.lit(0))).alias("n_vertices")]
    rounded = [six(F.col(c)).alias(c) for c in ("Length", "Slope", "StraightL", "DOUTMID")]
    return df.select("LINKNO", "DSLINKNO", "strmDrop", "DSContArea", "DOUTEND", "n_absorbed", *rounded, *shape)


@query("T9_upstream_of_point", """
WITH near AS (SELECT LINKNO FROM (SELECT *, greatest(0e0, least(1e0, ((3e4 - x0) * (x1 - x0) + (25e2 - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS f FROM streams)
ORDER BY sqrt(power(3e4 - (x0 + f * (x1 - x0)), 2) + power(25e2 - (y0 + f * (y1 - y0)), 2)), LINKNO LIMIT 1),
up AS (SELECT r.id FROM reach r JOIN near n ON n.LINKNO = r.anc UNION SELECT LINKNO FROM near)
SELECT s.LINKNO, s.Length, b.DN IS NULL AS no_basin FROM streams s JOIN up u ON u.id = s.LINKNO LEFT JOIN basins b ON b.DN = s.LINKNO""")
def _(t):
    """The streams upstream of the link nearest to a point, and whether their basin is missing."""
    p = F.struct(F.lit(30000.0).alias("x"), F.lit(2500.0).alias("y"))
    target = spatial.nearest_line(t.lines().select("LINKNO", "line"), p).first()["LINKNO"]
    up = network.upstream_of(_spans(t), target).withColumnRenamed("id", "LINKNO")
    some = t.streams.join(up, "LINKNO", "left_semi").join(t.basins.select(F.col("DN").alias("LINKNO"), F.lit(True).alias("there")), "LINKNO", "left")
    return some.select("LINKNO", "Length", F.col("there").isNull().alias("no_basin"))


@query("T11_survivors", """
SELECT LINKNO AS id, CASE WHEN LINKNO = 1 THEN -9999 WHEN LINKNO < 16 THEN -9999 ELSE CAST(floor(LINKNO / power(2e0, lvl - 3)) AS BIGINT) END AS down FROM streams""")
def _(t):
    alive = t.streams.where("lvl = 3").select(F.col("LINKNO").alias("id"))
    moved = t.streams.where("lvl <> 3").select(F.col("LINKNO").alias("id"), F.col("DSLINKNO").alias("agg")).where("agg > 0")
    return network.remap_to_survivors(t.streams.select(F.col("LINKNO").alias("id"), F.col("DSLINKNO").alias("down")), moved, alive)


@query("T12_main_stem", """
SELECT DISTINCT cur AS LINKNO FROM (WITH RECURSIVE best(down, up) AS MATERIALIZED (SELECT DSLINKNO, arg_min(LINKNO, (-sz, LINKNO)) FROM streams WHERE DSLINKNO > 0 GROUP BY DSLINKNO),
  w(cur) AS (SELECT arg_min(LINKNO, (-DSContArea, LINKNO)) FROM streams GROUP BY LINKNO % 50 UNION ALL SELECT b.up FROM w JOIN best b ON b.down = w.cur) SELECT * FROM w)""")
def _(t):
    """Links on the way up from the largest link of every unit, units being links of one remainder."""
    rivers = t.streams.select("LINKNO", "DSLINKNO", F.col("sz").alias("area"))
    seeds = t.streams.groupBy(F.col("LINKNO") % 50).agg(F.min(F.struct(-F.col("DSContArea"), "LINKNO")).alias("s")).select(F.col("s.LINKNO").alias("id"))
    return network.main_stems(rivers, seeds)


@query("T13_dangling", "SELECT s.LINKNO, s.DSLINKNO FROM streams s WHERE s.DSLINKNO > 0 AND s.DSLINKNO NOT IN (SELECT DN FROM basins)")
def _(t):
    return network.dangling(t.streams, t.basins.select(F.col("DN").alias("id")))


@query("T_contributing_area", "SELECT a.LINKNO AS id, CAST(a.sz + coalesce(sum(b.sz), 0) AS BIGINT) AS total FROM streams a LEFT JOIN reach q ON q.anc = a.LINKNO LEFT JOIN streams b ON b.LINKNO = q.id GROUP BY a.LINKNO, a.sz")
def _(t):
    nodes = t.streams.select(F.col("LINKNO").alias("id"), F.when(F.col("DSLINKNO") > 0, F.col("DSLINKNO")).alias("down"), "sz")
    return network.accumulate(nodes, "sz")


@query("T_distance_to_outlet", "SELECT a.LINKNO AS id, CAST(coalesce(sum(b.sz), 0) AS BIGINT) AS below FROM streams a LEFT JOIN reach q ON q.id = a.LINKNO LEFT JOIN streams b ON b.LINKNO = q.anc GROUP BY a.LINKNO")
def _(t):
    nodes = t.streams.select(F.col("LINKNO").alias("id"), F.when(F.col("DSLINKNO") > 0, F.col("DSLINKNO")).alias("down"), "sz")
    return network.path_sums(nodes, "sz")


@query("E4_stream_order", """
SELECT LINKNO AS id, CAST(sum(CASE WHEN (LINKNO + 1) * power(2e0, h) - 1 <= n THEN 1 ELSE 0 END) AS INT) AS ord
FROM streams, (SELECT max(LINKNO) AS n FROM streams), (SELECT unnest(range(0, 40)) AS h) GROUP BY LINKNO""")
def _(t):
    nodes = t.streams.select(F.col("LINKNO").alias("id"), F.when(F.col("DSLINKNO") > 0, F.col("DSLINKNO")).alias("down"))
    return network.strahler(nodes)


# ---- raster -----------------------------------------------------------------------------------------------------


def _once(t, name, make):
    """A table of this query, written when it is first asked for."""
    if name not in t.__dict__:
        t.__dict__[name] = settled(make(), plain=True)
    return t.__dict__[name]


def _mask(t):
    return _once(t, "mask_", lambda: raster.burn(t.lake_rings(), t.width(), t.width()))


def _flows(t):
    """The grid with its flow directions."""
    around = lambda: d8.with_around(t.cells(), F.col("z"))
    return _once(t, "flows_", lambda: around().select("row", "col", raster.downhill().alias("fdr"), "z", "src", "fac", "w"))


def _named(df, *more):
    return df.select("lake_id", F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), *more)


@query("S7_window", "SELECT r, c, z FROM grid WHERE c BETWEEN 5 AND 14 AND r BETWEEN 3 AND 22")
def _(t):
    return raster.window(t.cells(), 5, 3, 10, 20).select(F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), "z")


@query("S8_sample", "SELECT s.sid, coalesce(g.w, -1) AS w FROM stations s LEFT JOIN grid g ON g.r = CAST(round_even(s.y, 0) AS BIGINT) AND g.c = CAST(round_even(s.x, 0) AS BIGINT)")
def _(t):
    cell = G.xy_cell([0.0, 1.0, 0.0, 0.0, 0.0, 1.0], F.col("p"))
    points = t.gauges().select("sid", cell["row"].alias("row"), cell["col"].alias("col"))
    return raster.sample(points, t.cells(), "w").select("sid", "w")


@query("R1_lake_windows", """
SELECT lake_id, CAST(floor(cx - hw) AS BIGINT) AS xoff, CAST(floor(cy - hw) AS BIGINT) AS yoff, CAST(ceil(cx + hw) - floor(cx - hw) + 1 AS BIGINT) AS xsize
FROM lakes WHERE floor(cx - hw) >= 0 AND floor(cy - hw) >= 0 AND ceil(cx + hw) + 1 <= (SELECT max(wide) FROM grid) AND ceil(cy + hw) + 1 <= (SELECT max(wide) FROM grid)""")
def _(t):
    n = t.width()
    w = raster.window_of_bounds(G.bounds(F.col("ring")), [0.0, 1.0, 0.0, 0.0, 0.0, 1.0], n, n)
    df = t.lake_rings().select("lake_id", w.alias("w")).where("w is not null")
    return df.select("lake_id", "w.xoff", "w.yoff", "w.xsize")


@query("R2_padded_windows", """
SELECT lake_id, CAST(greatest(0, floor(cx - hw) - 6) AS BIGINT) AS xoff, CAST(least((SELECT max(wide) FROM grid), ceil(cx + hw) + 6) - greatest(0, floor(cx - hw) - 6) AS BIGINT) AS xsize FROM lakes""")
def _(t):
    n = t.width()
    w = raster.padded_window(G.bounds(F.col("ring")), [0.0, 1.0, 0.0, 0.0, 0.0, 1.0], n, n)
    return t.lake_rings().select("lake_id", w.alias("w")).where("w is not null").select("lake_id", F.col("w.xoff").cast("long").alias("xoff"), F.col("w.xsize").cast("long").alias("xsize"))


@query("R3_burned_lakes", "SELECT lake_id, r, c FROM mask")
def _(t):
    return _named(_mask(t))


@query("R4_shoreline", "SELECT lake_id, r, c FROM shore")
def _(t):
    return _named(raster.shoreline(_mask(t)))


@query("R5_exit_cells", """
SELECT s.lake_id, s.r, s.c FROM shore s JOIN d8 g ON g.r = s.r AND g.c = s.c
WHERE g.src = 1 AND NOT EXISTS (SELECT 1 FROM mask m WHERE m.lake_id = s.lake_id AND m.r = g.tr AND m.c = g.tc)""")
def _(t):
    mask = _mask(t)
    return _named(raster.exits(raster.shoreline(mask), mask, _flows(t)))


_INFLOWS = """SELECT DISTINCT s.lake_id, s.r, s.c FROM shore s JOIN grid g ON g.r = s.r AND g.c = s.c AND g.src = 1
JOIN d8 n ON n.tr = s.r AND n.tc = s.c AND n.fdr > 0 AND n.src = 1 LEFT JOIN mask m ON m.lake_id = s.lake_id AND m.r = n.r AND m.c = n.c WHERE m.r IS NULL"""


@query("R6_inflow_cells", _INFLOWS)
def _(t):
    mask = _mask(t)
    return _named(raster.inflows(raster.shoreline(mask), mask, _flows(t)))


@query("R7_most_upstream", "SELECT lake_id, link_no, seq FROM exits e WHERE NOT EXISTS (SELECT 1 FROM exits b JOIN reach q ON q.id = b.link_no WHERE b.lake_id = e.lake_id AND q.anc = e.link_no)")
def _(t):
    return raster.most_upstream(t.exits, _spans(t)).select("lake_id", "link_no", "seq")


@query("R7_resolved_inflows", """
WITH kept AS (SELECT * FROM exits e WHERE NOT EXISTS (SELECT 1 FROM exits b JOIN reach q ON q.id = b.link_no WHERE b.lake_id = e.lake_id AND q.anc = e.link_no))
SELECT lake_id, link_no, min(local_accum) AS fac, arg_min(seq, (local_accum, seq)) AS seq FROM kept GROUP BY lake_id, link_no""")
def _(t):
    """Of each most upstream link the cell with the least accumulation."""
    df = t.exits.withColumns({"row": F.col("seq"), "col": F.lit(0), "fac": F.col("local_accum")})
    return raster.resolved_inflows(df, _spans(t), "fac").select("lake_id", "link_no", "fac", F.col("row").alias("seq"))


@query("R8_most_downstream", "SELECT lake_id, link_no, seq FROM exits e WHERE NOT EXISTS (SELECT 1 FROM exits b JOIN reach q ON q.anc = b.link_no WHERE b.lake_id = e.lake_id AND q.id = e.link_no)")
def _(t):
    return raster.most_downstream(t.exits, _spans(t)).select("lake_id", "link_no", "seq")


_CONFLICTS = """SELECT r, c, arg_min(m.lake_id, (-n, m.lake_id)) AS winner FROM mask m JOIN (SELECT lake_id, count(*) AS n FROM mask GROUP BY lake_id) k ON k.lake_id = m.lake_id GROUP BY r, c HAVING count(*) > 1"""


def _won(mask):
    return raster.conflicts(mask, mask.groupBy("lake_id").agg(F.count(F.lit(1)).alias("size")))


@query("R9_lake_conflicts", _CONFLICTS)
def _(t):
    return _won(_mask(t)).select(F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), "winner")


@query("R17_merged_patches", f"""
WITH won AS ({_CONFLICTS}), p AS (SELECT m.*, CAST((m.lake_id + m.r) % 8 + 1 AS INT) AS new_fdr FROM mask m LEFT JOIN won w ON w.r = m.r AND w.c = m.c WHERE w.winner IS NULL OR w.winner = m.lake_id)
SELECT d.r, d.c, coalesce(p.new_fdr, d.fdr) AS fdr FROM d8 d LEFT JOIN p ON p.r = d.r AND p.c = d.c""")
def _(t):
    mask = _mask(t)
    patches = mask.select("lake_id", F.col("lake_id").alias("seq"), "row", "col", ((F.col("lake_id") + F.col("row")) % 8 + 1).cast("int").alias("new_fdr"))
    merged = raster.merge_patches(raster.steepest(t.cells()), patches, _won(mask))
    return merged.select(F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), "fdr")


@query("J12_links_of_cells", """
SELECT g.r, g.c, coalesce(s.LINKNO, -1) AS link_no, CASE WHEN s.DOUTEND IS NULL THEN 'none' ELSE CAST(CAST(s.DOUTEND AS BIGINT) AS VARCHAR) END AS doutend, coalesce(s.DSContArea, 0e0) AS dscontarea
FROM grid g LEFT JOIN streams s ON s.WSNO = g.w""")
def _(t):
    """The link of each cell by its basin and that link's attributes: -1, infinity and 0 where there is none."""
    links = t.streams.select(F.col("WSNO").alias("w"), "LINKNO", "DOUTEND", "DSContArea")
    df = raster.lookup(t.cells(), "w", links, {"LINKNO": -1, "DOUTEND": float("inf"), "DSContArea": 0.0})
    out = F.when(F.col("DOUTEND") == float("inf"), "none").otherwise(F.col("DOUTEND").cast("long").cast("string"))
    return _named_cells(df, F.col("LINKNO").alias("link_no"), out.alias("doutend"), F.col("DSContArea").alias("dscontarea"))


@query("A9_common_basin", "SELECT lake_id, arg_min(w, (-n, w)) AS value, max(n) AS n FROM (SELECT lake_id, w, count(*) AS n FROM mask m JOIN grid g ON g.r = m.r AND g.c = m.c WHERE w > 0 GROUP BY lake_id, w) GROUP BY lake_id")
def _(t):
    return raster.common_value(_mask(t), _once(t, "cells_", lambda: t.cells().select("row", "col", "w")), "w")


@query("A13_local_centroid", f"""
WITH first AS (SELECT lake_id, min((r, c)) AS s FROM shore GROUP BY lake_id)
SELECT lake_id, {SIX('avg(r)')} AS r, {SIX('avg(c)')} AS c FROM (SELECT m.*, row_number() OVER (PARTITION BY m.lake_id ORDER BY power(m.r - s[1], 2) + power(m.c - s[2], 2), m.r, m.c) AS k
FROM mask m JOIN first f ON f.lake_id = m.lake_id WHERE m.r <> s[1] OR m.c <> s[2]) WHERE k <= 10 GROUP BY lake_id""")
def _(t):
    """The middle of the ten lake cells nearest to the lake's first shore cell, that cell left out."""
    mask = _mask(t)
    first = raster.shoreline(mask).groupBy("lake_id").agg(F.min(F.struct("row", "col")).alias("s"))
    middle = raster.local_centroid(mask, first.select("lake_id", F.col("s.row").alias("srow"), F.col("s.col").alias("scol")))
    return middle.select("lake_id", six(F.col("row")).alias("r"), six(F.col("col")).alias("c"))


@query("E2_flow_directions", "SELECT fdr, count(*) AS n, CAST(sum(r * 31 + c) AS BIGINT) AS s FROM d8 GROUP BY fdr")
def _(t):
    return raster.steepest(t.cells()).groupBy("fdr").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("row").cast("long") * 31 + F.col("col")).alias("s"))


_ACCUM = """SELECT * FROM (WITH RECURSIVE w(r, c, tr, tc) AS (SELECT r, c, r, c FROM d8 UNION ALL
  SELECT w.r, w.c, d.tr, d.tc FROM w JOIN d8 d ON d.r = w.tr AND d.c = w.tc AND d.fdr > 0) SELECT tr AS r, tc AS c, count(*) AS ad8 FROM w GROUP BY tr, tc)"""


@query("E3_contributing_cells", f"SELECT r, c, ad8 FROM ({_ACCUM})")
def _(t):
    df = raster.contributing(raster.steepest(t.cells()), t.width())
    return df.select(F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), "ad8")


@query("E3_cells_clear_of_edges", f"""
SELECT r, c, CASE WHEN bad = 0 THEN ad8 END AS ad8 FROM (SELECT tr AS r, tc AS c, count(*) AS ad8, sum(edge) AS bad FROM (
  SELECT w.*, CASE WHEN w.r IN (0, lastr) OR w.c IN (0, lastc) THEN 1 ELSE 0 END AS edge FROM ({_ACCUM.replace(' SELECT tr AS r, tc AS c, count(*) AS ad8 FROM w GROUP BY tr, tc', ' SELECT * FROM w')}) w,
  (SELECT max(r) AS lastr, max(c) AS lastc FROM grid)) GROUP BY tr, tc)""")
def _(t):
    """Contributing cells, null where cells beyond the edge may drain too."""
    df = raster.contributing(raster.steepest(t.cells()), t.width(), check_edges=True)
    return df.select(F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), "ad8")


@query("E4_grid_order", """
WITH flowing AS MATERIALIZED (SELECT a.r * a.wide + a.c AS id, b.r * b.wide + b.c AS down FROM d8 a LEFT JOIN d8 b ON a.fdr > 0 AND b.r = a.tr AND b.c = a.tc)
SELECT CAST(floor(id / wide) AS BIGINT) AS r, id % wide AS c, ord FROM (WITH RECURSIVE f(id, ord) USING KEY (id) AS (SELECT id, 1 FROM flowing
  UNION SELECT id, new FROM (SELECT x.id, o.ord, list(k.ord) AS ords, list_max(ords) + CASE WHEN len(list_filter(ords, lambda v : v = list_max(ords))) > 1 THEN 1 ELSE 0 END AS new
    FROM (SELECT DISTINCT n.down AS id FROM f JOIN flowing n ON n.id = f.id WHERE n.down IS NOT NULL) x JOIN flowing m ON m.down = x.id
    JOIN recurring.f k ON k.id = m.id JOIN recurring.f o ON o.id = x.id GROUP BY x.id, o.ord) WHERE new > ord)
  SELECT id, ord FROM f), (SELECT max(wide) AS wide FROM grid)""")
def _(t):
    """Orders of the cells of the flow grid, whose trees are as irregular as its heights."""
    return _named_cells(raster.grid_order(raster.steepest(t.cells()), t.width()), "ord")


@query("E5_stream_threshold", f"SELECT CASE WHEN ad8 >= 5 THEN 1 ELSE 0 END AS src, count(*) AS n FROM ({_ACCUM}) GROUP BY 1")
def _(t):
    df = raster.contributing(raster.steepest(t.cells()), t.width())
    return df.groupBy(F.when(F.col("ad8") >= 5, 1).otherwise(0).alias("src")).agg(F.count(F.lit(1)).alias("n"))


@query("E7_snapped_points", """
SELECT s.sid, coalesce(f.r, -1) AS r, coalesce(f.c, -1) AS c, coalesce(f.steps, -1) AS steps FROM stations s LEFT JOIN (SELECT * FROM (WITH RECURSIVE w(sid, r, c, steps) AS (
  SELECT sid, CAST(floor(y) AS BIGINT), CAST(floor(x) AS BIGINT), 0 FROM stations UNION ALL
  SELECT w.sid, d.tr, d.tc, w.steps + 1 FROM w JOIN d8 d ON d.r = w.r AND d.c = w.c WHERE d.src <> 1 AND d.fdr > 0 AND w.steps < 25)
  SELECT w.sid, w.r, w.c, w.steps FROM w JOIN d8 d ON d.r = w.r AND d.c = w.c WHERE d.src = 1)) f ON f.sid = s.sid""")
def _(t):
    pts = t.gauges().select(F.col("sid").alias("pt"), F.floor("y").cast("int").alias("row"), F.floor("x").cast("int").alias("col"))
    df = raster.snap(pts, _flows(t))
    off = lambda c: F.coalesce(c, F.lit(-1))
    return df.select(F.col("pt").alias("sid"), off("srow").cast("long").alias("r"), off("scol").cast("long").alias("c"), off("steps").alias("steps"))


@query("R8b_separated_inflows", f"""
WITH inflow AS ({_INFLOWS}), outflow AS (SELECT s.lake_id, s.r, s.c FROM shore s JOIN d8 g ON g.r = s.r AND g.c = s.c LEFT JOIN mask m ON m.lake_id = s.lake_id AND m.r = g.tr AND m.c = g.tc WHERE g.src = 1 AND m.r IS NULL),
moved AS (SELECT i.lake_id, i.r, i.c, min((o.code, n.r, n.c)) AS b FROM inflow i JOIN outflow x ON x.lake_id = i.lake_id AND x.r = i.r AND x.c = i.c, offsets o, d8 n
  WHERE n.r = i.r + o.dr AND n.c = i.c + o.dc AND n.fdr = (o.code + 3) % 8 + 1 AND n.src = 1 AND NOT EXISTS (SELECT 1 FROM mask m WHERE m.lake_id = i.lake_id AND m.r = n.r AND m.c = n.c) GROUP BY i.lake_id, i.r, i.c)
SELECT i.lake_id, coalesce(b[2], i.r) AS r, coalesce(b[3], i.c) AS c, b IS NOT NULL AS moved FROM inflow i LEFT JOIN moved m ON m.lake_id = i.lake_id AND m.r = i.r AND m.c = i.c""")
def _(t):
    mask, flows = _mask(t), _flows(t)
    shore = raster.shoreline(mask)
    return _named(raster.separate(raster.inflows(shore, mask, flows), raster.exits(shore, mask, flows), mask, flows), "moved")


@query("G5_point_line_distance", f"""
SELECT LINKNO, {SIX('sqrt(power(3e4 - (x0 + f * (x1 - x0)), 2) + power(25e2 - (y0 + f * (y1 - y0)), 2))')} AS d FROM (
SELECT *, greatest(0e0, least(1e0, ((3e4 - x0) * (x1 - x0) + (25e2 - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS f FROM streams)""")
def _(t):
    p = F.struct(F.lit(30000.0).alias("x"), F.lit(2500.0).alias("y"))
    return t.lines().select("LINKNO", six(G.line_distance(p, F.col("line"))).alias("d"))


@query("G14_mercator", "SELECT sid, round_even((x % 180) * pi() * 6378137e0 / 180 * 1e3, 0) / 1e3 AS mx, round_even(ln(tan(pi() / 4 + (y % 80) * pi() / 360)) * 6378137e0 * 1e3, 0) / 1e3 AS my FROM stations")
def _(t):
    m = G.to_mercator(F.col("x") % 180, F.col("y") % 80)
    return t.stations.select("sid", rules.rounded(m["x"], 3).alias("mx"), rules.rounded(m["y"], 3).alias("my"))


_UTM, _CONIC = projections.utm(18), projections.LambertConformal(-96.0, 23.0, 33.0, 45.0)
#: Stations as degrees around the meridians of the projections.
_DEGREES = "(SELECT sid, -78 + x % 6 AS lon, 25 + y % 30 AS lat, radians(25 + y % 30) AS phi FROM stations)"


def _utm_sql() -> str:
    e, terms = _UTM.ellipsoid.e, list(enumerate(projections.series(projections.FORWARD, _UTM.ellipsoid.n), 1))
    x = " + ".join(["e", *[f"({c!r}) * cos({2 * j} * n) * sinh({2 * j} * e)" for j, c in terms]])
    y = " + ".join(["n", *[f"({c!r}) * sin({2 * j} * n) * cosh({2 * j} * e)" for j, c in terms]])
    rounded = "round_even(({0}) * 1e3, 0) / 1e3".format
    return f"""
SELECT sid, {rounded(f'({x}) * {_UTM.radius!r} + 5e5')} AS x, {rounded(f'({y}) * {_UTM.radius!r}')} AS y FROM (
SELECT sid, atan2(t, cos(lam)) AS n, asinh(sin(lam) / sqrt(t * t + cos(lam) * cos(lam))) AS e FROM (
SELECT sid, radians(lon + 75) AS lam, sinh(atanh(sin(phi)) - {e!r} * atanh({e!r} * sin(phi))) AS t FROM {_DEGREES}))"""


@query("G14_transverse_mercator", _utm_sql())
def _(t):
    """Degrees to the metres of a zone."""
    p = _UTM.forward(F.lit(-78.0) + F.col("x") % 6, F.lit(25.0) + F.col("y") % 30)
    return t.stations.select("sid", rules.rounded(p["x"], 3).alias("x"), rules.rounded(p["y"], 3).alias("y"))


@query("G14_lambert_conformal", f"""
SELECT sid, round_even(rho * sin(turn) * 1e3, 0) / 1e3 AS x, round_even(({_CONIC.origin!r} - rho * cos(turn)) * 1e3, 0) / 1e3 AS y FROM (
SELECT sid, {_CONIC.reach!r} * exp(-({_CONIC.cone!r}) * (atanh(sin(phi)) - {_CONIC.ellipsoid.e!r} * atanh({_CONIC.ellipsoid.e!r} * sin(phi)))) AS rho, {_CONIC.cone!r} * radians(lon + 96) AS turn FROM {_DEGREES})""")
def _(t):
    p = _CONIC.forward(F.lit(-78.0) + F.col("x") % 6, F.lit(25.0) + F.col("y") % 30)
    return t.stations.select("sid", rules.rounded(p["x"], 3).alias("x"), rules.rounded(p["y"], 3).alias("y"))


@query("W4_override_snapped", f"""
SELECT lake_id, link FROM (SELECT o.lake_id, s.LINKNO AS link, row_number() OVER (PARTITION BY o.lake_id ORDER BY abs(o.x - s.LINKNO % 100), s.LINKNO) AS k
FROM overrides o JOIN streams s ON abs(o.x - s.LINKNO % 100) <= 3e0) WHERE k = 1""")
def _(t):
    here = t.overrides.select("lake_id", F.struct("x", F.lit(0.0).alias("y")).alias("p"))
    there = t.streams.select("LINKNO", F.struct((F.col("LINKNO") % 100).cast("double").alias("x"), F.lit(0.0).alias("y")).alias("q"))
    near = spatial.within_distance(here, there, "lake_id", 3.0)
    best = near.groupBy("lake_id").agg(F.min(F.struct("d", "LINKNO")).alias("b"))
    return best.select("lake_id", F.col("b.LINKNO").alias("link"))


@query("R16_edit_mask", "SELECT r, c, CAST(8 AS INT) AS new_fdr FROM d8 WHERE (r + c) % 3 = 0 AND fdr <> 8")
def _(t):
    before = raster.steepest(t.cells())
    after = before.withColumn("fdr", F.when((F.col("row") + F.col("col")) % 3 == 0, 8).otherwise(F.col("fdr")))
    return raster.edits(before, after).select(F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), "new_fdr")


_SWALLOWED = "SELECT LINKNO % 25 AS lake_id, LINKNO FROM streams WHERE sz >= 20"


@query("T7_reservoir_basins", f"""
WITH internal AS ({_SWALLOWED}), winner AS (SELECT lake_id, min(LINKNO) AS LINKNO FROM internal GROUP BY lake_id),
taken AS (SELECT DISTINCT i.lake_id, b.DN FROM internal i JOIN basins b ON b.DN = i.LINKNO),
unit AS (SELECT DISTINCT t.lake_id, g.r, g.c FROM taken t JOIN grid g ON g.w = t.DN),
area AS (SELECT u.lake_id, count(*) AS n, count(m.r) AS wet FROM unit u LEFT JOIN mask m ON m.lake_id = u.lake_id AND m.r = u.r AND m.c = u.c GROUP BY u.lake_id)
SELECT b.DN, CAST(-1 AS BIGINT) AS lake_id, 0 AS is_lake, 0e0 AS lake_area, 0e0 AS frac_lake, CAST(coalesce(g.n, 0) AS BIGINT) AS n_cells
FROM basins b LEFT JOIN (SELECT w, count(*) AS n FROM grid WHERE w > 0 GROUP BY w) g ON g.w = b.DN WHERE b.DN NOT IN (SELECT DN FROM taken)
UNION ALL SELECT w.LINKNO, w.lake_id, 1, {SIX('coalesce(l.Lake_area, 0e0) * 1e6')}, {SIX('coalesce(a.wet / (a.n + 0e0), 0e0)')}, CAST(coalesce(a.n, 0) AS BIGINT)
FROM (SELECT DISTINCT lake_id FROM taken) t JOIN winner w ON w.lake_id = t.lake_id LEFT JOIN lakes l ON l.lake_id = w.lake_id LEFT JOIN area a ON a.lake_id = w.lake_id""")
def _(t):
    internal = t.streams.where("sz >= 20").select((F.col("LINKNO") % 25).alias("lake_id"), "LINKNO")
    winners = internal.groupBy("lake_id").agg(F.min("LINKNO").alias("LINKNO"))
    df = dissolve.reservoir_basins(t.basins, _basin_cells(t), internal, winners, _mask(t), t.lakes)
    return df.withColumns({"lake_area": six(F.col("lake_area")), "frac_lake": six(F.col("frac_lake"))})


#: Points where links cross the lakes' shores: outflow at the lower end, inflow at the upper one.
_POURS = """pours AS (SELECT lake_id * 1000000000 + LINKNO * 2 AS pt, lake_id, 'outflow' AS point_type, x0 AS px, y0 AS py FROM met WHERE x1 > xl AND x1 < xh AND y1 > yl AND y1 < yh AND NOT (x0 > xl AND x0 < xh AND y0 > yl AND y0 < yh)
  UNION ALL SELECT lake_id * 1000000000 + LINKNO * 2 + 1, lake_id, 'inflow', x1, y1 FROM met WHERE x0 > xl AND x0 < xh AND y0 > yl AND y0 < yh AND NOT (x1 > xl AND x1 < xh AND y1 > yl AND y1 < yh)),
touched AS (SELECT p.*, s.LINKNO, sqrt(power(px - CASE WHEN point_type = 'inflow' THEN x1 ELSE x0 END, 2) + power(py - CASE WHEN point_type = 'inflow' THEN y1 ELSE y0 END, 2)) AS d,
  greatest(0e0, least(1e0, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS f, x0, y0, x1, y1 FROM pours p JOIN streams s ON s.y0 <= p.py + 5e0 AND s.y1 >= p.py - 5e0),
linked AS MATERIALIZED (SELECT pt, lake_id, point_type, px, py, arg_min(LINKNO, (d, LINKNO)) AS link_no FROM touched WHERE sqrt(power(px - (x0 + f * (x1 - x0)), 2) + power(py - (y0 + f * (y1 - y0)), 2)) <= 5e0 GROUP BY pt, lake_id, point_type, px, py),
w AS (SELECT CAST(max(wide) AS DOUBLE) AS w FROM grid),
cands AS MATERIALIZED (SELECT l.*, s.DOUTEND, s.strmOrder, s.DSContArea, coalesce((SELECT min(sqrt(power(g.x * 1e5 / w - l.px, 2) + power(g.y * 15e3 / w - l.py, 2))) FROM stations g, w WHERE sqrt(power(g.x * 1e5 / w - l.px, 2) + power(g.y * 15e3 / w - l.py, 2)) <= 750), 1e300) AS gd
  FROM linked l JOIN streams s ON s.LINKNO = l.link_no WHERE point_type = 'outflow'),
alive AS MATERIALIZED (SELECT * FROM cands c WHERE NOT EXISTS (SELECT 1 FROM cands o JOIN reach q ON q.anc = o.link_no WHERE o.lake_id = c.lake_id AND q.id = c.link_no)),
near AS (SELECT a.lake_id, arg_min(link_no, (sqrt(power(px - o.x * 1e5 / w, 2) + power(py - o.y * 15e3 / w, 2)), pt)) AS link_no FROM alive a JOIN overrides o ON CAST(o.lake_id AS BIGINT) = a.lake_id, w
  WHERE sqrt(power(px - o.x * 1e5 / w, 2) + power(py - o.y * 15e3 / w, 2)) <= 3000 GROUP BY a.lake_id),
won0 AS MATERIALIZED (SELECT b.lake_id, coalesce(n.link_no, b.link_no) AS winner FROM (SELECT lake_id, arg_min(link_no, (gd, DOUTEND, -strmOrder, -DSContArea, pt)) AS link_no FROM alive GROUP BY lake_id) b LEFT JOIN near n ON n.lake_id = b.lake_id),
starts AS (SELECT lake_id, link_no AS LINKNO FROM linked WHERE point_type = 'inflow'
  UNION SELECT lake_id, LINKNO FROM met WHERE (mid_inside OR tips_inside OR overlap > 180) AND LINKNO NOT IN (SELECT DSLINKNO FROM streams)),
ways AS (SELECT s.lake_id, s.LINKNO AS start, r.anc AS id, r.hops FROM starts s JOIN reach r ON r.id = s.LINKNO UNION ALL SELECT lake_id, LINKNO, LINKNO, 0 FROM starts),
stops AS (SELECT y.lake_id, y.start, min(y.hops) AS stop FROM ways y JOIN cands c ON c.lake_id = y.lake_id AND c.link_no = y.id GROUP BY y.lake_id, y.start),
inner_ AS MATERIALIZED (SELECT lake_id, winner AS LINKNO FROM won0 UNION SELECT y.lake_id, y.id FROM ways y JOIN won0 n ON n.lake_id = y.lake_id LEFT JOIN stops p ON p.lake_id = y.lake_id AND p.start = y.start WHERE p.stop IS NULL OR y.hops <= p.stop),
taken AS MATERIALIZED (SELECT i.lake_id, i.LINKNO AS DN FROM inner_ i JOIN basins b ON b.DN = i.LINKNO),
won AS MATERIALIZED (SELECT * FROM won0 WHERE lake_id IN (SELECT lake_id FROM taken)),
swallowed AS MATERIALIZED (SELECT * FROM inner_ WHERE lake_id IN (SELECT lake_id FROM taken))"""


def _reservoirs(t):
    met = settled(spatial.lines_in_polygons(t.lines().select("LINKNO", "line"), t.wide_rings(), 5000.0))
    upper, lower = G.last_vertex(F.col("line")), G.first_vertex(F.col("line"))
    up, low = G.contains(F.col("ring"), upper), G.contains(F.col("ring"), lower)
    pt = F.col("lake_id") * 1000000000 + F.col("LINKNO") * 2
    out = met.where(up & ~low).select(pt.alias("pt"), "lake_id", F.lit("outflow").alias("point_type"), lower.alias("p"))
    into = met.where(low & ~up).select((pt + 1).alias("pt"), "lake_id", F.lit("inflow").alias("point_type"), upper.alias("p"))
    n = t.width()
    wide = lambda name: F.struct((F.col("x") * 1e5 / n).alias("x"), (F.col("y") * 15e3 / n).alias("y")).alias(name)
    streams = t.lines().select("LINKNO", "DSLINKNO", "USLINKNO1", "line", "Length", "strmDrop", "StraightL", "DOUTEND", "DSContArea", "strmOrder", "Slope")
    lakes = t.wide_rings().select("lake_id", F.array("ring").alias("rings")).join(t.lakes.select("lake_id", "Lake_area"), "lake_id")
    overrides = t.overrides.select(F.col("lake_id").cast("long").alias("lake_id"), wide("o"))
    return reservoirs.reservoirs(out.union(into), streams, lakes, t.catchments(), t.stations.select(wide("q")), overrides)


@query("T7_reservoir_units", f"""
WITH {_POURS}, boxes AS (SELECT b.DN, (b.DN - power(2e0, lvl)) / power(2e0, lvl) * 1e5 AS cx0, (b.DN - power(2e0, lvl) + 1) / power(2e0, lvl) * 1e5 AS cx1, lvl * 1e3 - 500 AS cy0, lvl * 1e3 + 500 AS cy1 FROM basins b JOIN streams s ON s.LINKNO = b.DN),
parts AS (SELECT t.lake_id, t.DN, (cx1 - cx0) * (cy1 - cy0) AS own, greatest(least(cx1, xh) - greatest(cx0, xl), 0e0) * greatest(least(cy1, yh) - greatest(cy0, yl), 0e0) AS wet FROM taken t JOIN boxes b ON b.DN = t.DN JOIN wide l ON l.lake_id = t.lake_id)
SELECT b.DN, CAST(-1 AS BIGINT) AS lake_id, 0 AS is_lake, 0e0 AS lake_area, 0e0 AS frac_lake, {SIX('sqrt((cx1 - cx0) * (cy1 - cy0))')} AS side FROM boxes b WHERE DN NOT IN (SELECT DN FROM taken)
UNION ALL SELECT n.winner, n.lake_id, 1, {SIX('any_value(l.Lake_area) * 1e6')}, {SIX('greatest(0e0, least(1e0, sum(wet) / sum(own)))')}, {SIX('sqrt(sum(own))')} FROM parts p JOIN won n ON n.lake_id = p.lake_id JOIN lakes l ON l.lake_id = n.lake_id GROUP BY n.winner, n.lake_id""")
def _(t):
    """From pour points to the basins after each lake has become one unit: outlets, swallowed links, areas and shares."""
    units = _reservoirs(t)[0]
    return units.select("DN", "lake_id", "is_lake", six(F.col("lake_area")).alias("lake_area"), six(F.col("frac_lake")).alias("frac_lake"), six(F.sqrt("area")).alias("side"))


@query("T6_reservoir_streams", f"""
WITH {_POURS}, tops AS (SELECT a.lake_id, a.LINKNO AS start FROM swallowed a JOIN streams s ON s.LINKNO = a.LINKNO LEFT JOIN swallowed b ON b.lake_id = a.lake_id AND b.LINKNO = s.USLINKNO1 WHERE b.LINKNO IS NULL),
lines AS (SELECT lake_id, start, start AS cur, 0 AS hops FROM tops UNION ALL SELECT t.lake_id, t.start, r.anc, r.hops FROM tops t JOIN reach r ON r.id = t.start),
marks AS (SELECT y.lake_id, y.start, min(CASE WHEN s.LINKNO IS NULL THEN y.hops - 1 WHEN y.cur = n.winner THEN y.hops END) AS stop FROM lines y JOIN won n ON n.lake_id = y.lake_id LEFT JOIN swallowed s ON s.lake_id = y.lake_id AND s.LINKNO = y.cur GROUP BY y.lake_id, y.start),
each AS (SELECT y.lake_id, y.start, sum(i.Length) AS Length, sum(i.strmDrop) AS strmDrop, min(i.DOUTEND) AS DOUTEND, arg_max(i.x0, y.hops) AS ex, arg_max(i.y0, y.hops) AS ey
  FROM lines y JOIN streams i ON i.LINKNO = y.cur JOIN marks m ON m.lake_id = y.lake_id AND m.start = y.start WHERE m.stop IS NULL OR y.hops <= m.stop GROUP BY y.lake_id, y.start),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lake_id ORDER BY round_even(Length * 1e6, 0) DESC, start) AS k FROM each) WHERE k = 1),
metric AS (SELECT n.winner, arg_max((b.Length, b.strmDrop, sqrt(power(s.x1 - b.ex, 2) + power(s.y1 - b.ey, 2)), b.DOUTEND), n.lake_id) AS m FROM won n JOIN best b ON b.lake_id = n.lake_id JOIN streams s ON s.LINKNO = b.start GROUP BY n.winner),
one AS (SELECT i.LINKNO, arg_max(n.winner, n.lake_id) AS winner FROM swallowed i JOIN won n ON n.lake_id = i.lake_id GROUP BY i.LINKNO),
unit AS (SELECT coalesce(o.winner, s.LINKNO) AS unit, s.* FROM streams s LEFT JOIN one o ON o.LINKNO = s.LINKNO),
merged AS (SELECT unit, max(Length) AS Length, max(strmDrop) AS strmDrop, max(StraightL) AS StraightL, max(DOUTEND) AS DOUTEND, max(DSContArea) AS DSContArea, max(strmOrder) AS strmOrder, max(Slope) AS Slope FROM unit GROUP BY unit)
SELECT u.unit AS LINKNO, coalesce(o.winner, s.DSLINKNO) AS DSLINKNO, {SIX('coalesce(m[1], u.Length)')} AS Length, {SIX('coalesce(m[2], u.strmDrop)')} AS strmDrop, {SIX('coalesce(m[3], u.StraightL)')} AS StraightL, {SIX('coalesce(m[4], u.DOUTEND)')} AS DOUTEND,
  u.DSContArea, CAST(u.strmOrder AS BIGINT) AS strmOrder, {SIX('coalesce(m[2] / m[1], u.Slope)')} AS Slope FROM merged u JOIN streams s ON s.LINKNO = u.unit LEFT JOIN one o ON o.LINKNO = s.DSLINKNO LEFT JOIN metric m ON m.winner = u.unit""")
def _(t):
    """The streams after each lake's links have become its outlet link, with the lake's longest path, and all others mapped."""
    streams = _reservoirs(t)[1]
    rounded = [six(F.col(c)).alias(c) for c in ("Length", "strmDrop", "StraightL", "DOUTEND", "Slope")]
    return streams.select("LINKNO", "DSLINKNO", *rounded, "DSContArea", "strmOrder")


def _windows(t):
    """All cells of the windows of the lakes that lie within the raster, with the lake's own."""
    return _once(t, "windows_", lambda: _lake_windows(t))


def _lake_windows(t):
    n = t.width()
    box = G.bounds(F.col("ring"))
    w = raster.window_of_bounds(box, [0.0, 1.0, 0.0, 0.0, 0.0, 1.0], n, n)
    cells = _flows(t).select("row", "col", "fdr", "w")
    # a lake whose low edge lies between two cells touches both, but the window of its bounds begins at the second
    more = lambda low: F.when(box[low] == F.floor(box[low]), 1).otherwise(0)
    off = [(F.col(f"win.{c}off") - more(f"min{c}")).alias(f"{c}off") for c in "xy"]
    size = [(F.col(f"win.{c}size") + more(f"min{c}")).alias(f"{c}size") for c in "xy"]
    whole = t.lake_rings().select("lake_id", "ring", w.alias("win")).where("win is not null").select("lake_id", F.struct(*off, *size).alias("w"))
    at = raster.window_cells(whole, cells.withColumnRenamed("w", "basin"))
    inside = _mask(t).withColumn("inside", F.lit(True))
    return at.join(inside, ["lake_id", "row", "col"], "left").select("lake_id", "row", "col", "fdr", F.col("basin").alias("w"), F.coalesce("inside", F.lit(False)).alias("inside"))


def _routed(t):
    windows = _windows(t)
    shore = raster.shoreline(windows.where("inside").select("lake_id", "row", "col"))
    target = shore.groupBy("lake_id").agg(F.max(F.struct("row", "col")).alias("b")).select("lake_id", F.col("b.row").alias("trow"), F.col("b.col").alias("tcol"))
    return windows, target, centerline.route_lakes(windows, target)


@query("R11_centre_line_routing")
def _(t):
    """Edits of the flow directions of all lakes, each along its centre line to an outlet on its shore."""
    return _named(_routed(t)[2], "new_fdr")


@query("R11_paths_to_outlets", """
SELECT m.lake_id, count(*) AS n, count(*) AS n_to_outlet, CAST(max(m.r * 100000 + m.c) AS BIGINT) AS outlet FROM mask m JOIN lakes l ON l.lake_id = m.lake_id, (SELECT max(wide) AS w FROM grid)
WHERE floor(cx - hw) >= 0 AND floor(cy - hw) >= 0 AND ceil(cx + hw) + 1 <= w AND ceil(cy + hw) + 1 <= w GROUP BY m.lake_id""")
def _(t):
    """What must hold of routed lakes: from every cell the flow stays in the lake until it is at the outlet, without a ring."""
    windows, target, edits = _routed(t)
    inside = windows.where("inside").select("lake_id", "row", "col", "fdr").join(edits, ["lake_id", "row", "col"], "left")
    inside = inside.withColumn("fdr", F.coalesce("new_fdr", "fdr")).join(target, "lake_id")
    at = lambda r, c: F.struct("lake_id", F.col(r).alias("row"), F.col(c).alias("col"))
    flows = raster.flow_targets(inside.withColumnsRenamed({"trow": "orow", "tcol": "ocol"}))
    on = F.when((F.col("row") != F.col("orow")) | (F.col("col") != F.col("ocol")), at("trow", "tcol"))
    ends = network.path_folds(flows.select(at("row", "col").alias("id"), on.alias("down")))
    done = ends.select("id.lake_id", F.col("end.row").alias("row"), F.col("end.col").alias("col")).join(target, "lake_id")
    hit = (F.col("row") == F.col("trow")) & (F.col("col") == F.col("tcol"))
    outlet = F.max(F.col("trow").cast("long") * 100000 + F.col("tcol")).alias("outlet")
    return done.groupBy("lake_id").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(hit, 1)).alias("n_to_outlet"), outlet)


def _lake_exits(t):
    """Exit cells with what ranks them; the basin of a cell is its link."""
    mask = _mask(t)
    on = raster.exits(raster.shoreline(mask), mask, _flows(t))
    link = F.when(F.col("w") > 0, F.col("w")).otherwise(F.lit(-1).cast("long")).alias("link_no")
    far = F.when((F.col("row") + F.col("col")) % 5 == 0, (F.col("row") % 7).cast("double")).otherwise(F.lit(float("inf"))).alias("gauge_dist")
    seq = (F.col("row").cast("long") * 100000 + F.col("col")).alias("seq")
    return on.select("lake_id", "row", "col", link, far, (F.col("w") * 7 % 10).cast("double").alias("doutend"), F.col("fac").alias("local_accum"), (F.col("w") * 31 % 50).alias("dscontarea"), seq)


def _outlet_plans(t, exits):
    mask = _mask(t)
    through = mask.join(_flows(t).where("src = 1 and w > 0"), ["row", "col"]).select("lake_id", "w").distinct()
    at = t.overrides.select(F.col("lake_id").cast("long").alias("lake_id"), F.col("y").alias("row"), F.col("x").alias("col"))
    return routing.plan_outlets(t.lakes, exits, raster.shoreline(mask), at, _flows(t), through)


@query("R15_planned_outlets", """
WITH ex AS (SELECT s.lake_id, s.r, s.c, CASE WHEN g.w > 0 THEN g.w ELSE -1 END AS link_no, CASE WHEN (s.r + s.c) % 5 = 0 THEN s.r % 7 + 0e0 ELSE 1e300 END AS gd,
  (g.w * 7) % 10 AS dout, g.fac, (g.w * 31) % 50 AS area, s.r * 100000 + s.c AS seq FROM shore s JOIN d8 g ON g.r = s.r AND g.c = s.c
  LEFT JOIN mask m ON m.lake_id = s.lake_id AND m.r = g.tr AND m.c = g.tc WHERE g.src = 1 AND m.r IS NULL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lake_id ORDER BY gd, dout, fac DESC, area DESC, seq) AS k FROM ex) WHERE k = 1),
o AS (SELECT CAST(lake_id AS BIGINT) AS lake_id, y, x FROM overrides),
near AS (SELECT * FROM (SELECT e.*, row_number() OVER (PARTITION BY e.lake_id ORDER BY sqrt(power(e.r - o.y, 2) + power(e.c - o.x, 2)), e.seq) AS k FROM ex e JOIN o ON o.lake_id = e.lake_id
  WHERE sqrt(power(e.r - o.y, 2) + power(e.c - o.x, 2)) <= 3) WHERE k = 1),
close AS (SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY s.lake_id ORDER BY sqrt(power(s.r - o.y, 2) + power(s.c - o.x, 2)), s.r, s.c) AS k FROM shore s JOIN o ON o.lake_id = s.lake_id) WHERE k = 1),
through AS (SELECT DISTINCT m.lake_id, g.w FROM mask m JOIN grid g ON g.r = m.r AND g.c = m.c WHERE g.src = 1 AND g.w > 0),
apart AS (SELECT o.lake_id FROM o JOIN grid g ON g.r = round_even(o.y, 0) AND g.c = round_even(o.x, 0) LEFT JOIN through t ON t.lake_id = o.lake_id AND t.w = g.w WHERE g.w > 0 AND t.w IS NULL)
SELECT lake_id, try_, CASE WHEN try_ = 'override_snapped' THEN nr WHEN try_ LIKE 'override%' THEN sr END AS trow, CASE WHEN try_ = 'override_snapped' THEN nc WHEN try_ LIKE 'override%' THEN sc END AS tcol, arow, acol, alink
FROM (SELECT l.lake_id, CASE WHEN o.lake_id IS NULL THEN 'algorithmic_stream' WHEN n.r IS NOT NULL THEN 'override_snapped' WHEN s.r IS NULL THEN 'skipped_no_boundary' WHEN a.lake_id IS NOT NULL THEN 'override_direct_ds' ELSE 'override_carved' END AS try_,
  n.r AS nr, n.c AS nc, s.r AS sr, s.c AS sc, b.r AS arow, b.c AS acol, b.link_no AS alink
  FROM lakes l LEFT JOIN o ON o.lake_id = l.lake_id LEFT JOIN near n ON n.lake_id = l.lake_id LEFT JOIN close s ON s.lake_id = l.lake_id LEFT JOIN apart a ON a.lake_id = l.lake_id LEFT JOIN best b ON b.lake_id = l.lake_id)""")
def _(t):
    """What is tried first as the outlet of each lake, at which cell, and the best exit to fall back on."""
    long = lambda c: F.col(c).cast("long").alias(c)
    return _outlet_plans(t, _lake_exits(t)).select("lake_id", "try_", long("trow"), long("tcol"), long("arow"), long("acol"), "alink")


@query("R18_edited_lakes")
def _(t):
    """The outlet of each lake in its window and the edits of its flow: exits without those upstream of others, overrides
    snapped, broken out or carved, else the best exit, then the centre line."""
    exits = network.drop_duplicate_exits(_lake_exits(t), _spans(t), "local_accum")
    outlets, edits = centerline.edit_lakes(_windows(t), settled(_outlet_plans(t, exits)))
    counts = edits.groupBy("lake_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    n = F.coalesce("n", F.lit(0)).alias("n_edits")
    return outlets.join(counts, "lake_id", "left").select("lake_id", "sel_type", F.col("trow").cast("long").alias("r"), F.col("tcol").cast("long").alias("c"), "link_no", n)


def _units(t):
    area = network.accumulate(t.streams.select(F.col("LINKNO").alias("id"), F.when(F.col("DSLINKNO") > 0, F.col("DSLINKNO")).alias("down"), F.col("sz").cast("double").alias("unit")), "unit")
    end = F.col("DSLINKNO") <= 0
    units = t.streams.join(area.withColumnsRenamed({"id": "LINKNO", "total": "uparea"}), "LINKNO")
    mask = rules.role_mask(end, F.col("LINKNO") % 23 == 0, F.col("LINKNO") % 50 == 0).alias("mask")
    return units.select(F.col("LINKNO").alias("id"), F.when(end, F.lit(-9999)).otherwise(F.col("DSLINKNO")).alias("down"), F.col("sz").cast("double").alias("unit"), "uparea", mask)


@query("T10_basin_aggregation")
def _(t):
    """Groups of small units over the whole network, each with the attributes of its pour point and the group downstream."""
    units = _units(t)
    return routing.aggregated(units, routing.aggregate_units(units))


@query("T10_invariants", """
SELECT CAST(sum(sz) AS DOUBLE) AS area, count(*) AS units, count(*) FILTER (WHERE LINKNO % 50 = 0) AS lakes_alone,
  count(*) FILTER (WHERE LINKNO % 23 = 0 AND LINKNO % 50 <> 0) AS gauges_kept, CAST(0 AS BIGINT) AS torn, CAST(0 AS BIGINT) AS dangling, true AS fewer FROM streams""")
def _(t):
    """What holds of all groups: areas add up, each unit is in one, lakes are alone, gauges keep theirs, a unit that isn't
    its group's pour point drains to one of its group, and what groups drain to is there."""
    units = _units(t)
    groups = routing.aggregate_units(units)
    out = routing.aggregated(units, groups)
    sums = out.agg(
        F.sum("unit").alias("area"), F.sum("n_units").alias("units"), F.count(F.when(F.expr("mask = 3 and n_units = 1"), 1)).alias("lakes_alone"),
        F.count(F.when(F.expr("mask = 2"), 1)).alias("gauges_kept"), F.count(F.lit(1)).alias("n"),
    )
    of = groups.select("id", "agg")
    below = of.select(F.col("id").alias("down"), F.col("agg").alias("other"))
    torn = units.join(of.where("id <> agg"), "id").join(below, "down", "left").where("not agg <=> other").agg(F.count(F.lit(1)).alias("torn"))
    dangling = out.where("down > 0").join(out.select(F.col("id").alias("down")), "down", "left_anti").agg(F.count(F.lit(1)).alias("dangling"))
    df = sums.crossJoin(torn).crossJoin(dangling)  # one row each
    return df.select("area", "units", "lakes_alone", "gauges_kept", "torn", "dangling", (F.col("n") < F.col("units")).alias("fewer"))


_FILLED = """(WITH RECURSIVE f(r, c, z, level) USING KEY (r, c) AS (
  SELECT r, c, z, z AS level FROM {0}, (SELECT max(r) AS lr, max(c) AS lc FROM {0}) WHERE r IN (0, lr) OR c IN (0, lc)
  UNION SELECT n.r, n.c, n.z, min(greatest(n.z, f.level)) FROM f JOIN offsets o ON true JOIN {0} n ON n.r = f.r + o.dr AND n.c = f.c + o.dc
    LEFT JOIN recurring.f AS k ON k.r = n.r AND k.c = n.c WHERE k.level IS NULL OR greatest(n.z, f.level) < k.level GROUP BY n.r, n.c, n.z)
  SELECT r, c, z, level FROM f)"""


@query("E1_filled_pits", f"SELECT r, c, level AS z FROM {_FILLED.format('grid')}")
def _(t):
    """Depressions filled over the whole grid, from tiles of 64 x 64 cells."""
    return _named_cells(terrain.fill_pits(t.cells()), "z")


def _named_cells(df, *more):
    return df.select(F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), *more)


#: The terraces that heights in steps of 100 make: flats of many cells, with depressions.
_TERRACES = "terraces AS MATERIALIZED (SELECT r, c, floor(z / 1e2) AS z FROM grid)"
_STEPWISE = """(WITH RECURSIVE f(r, c, z, d) USING KEY (r, c) AS (SELECT r, c, z, 1 AS d FROM {0}
  UNION SELECT n.r, n.c, n.z, min(f.d + 1) FROM f JOIN offsets o ON true JOIN still n ON n.r = f.r + o.dr AND n.c = f.c + o.dc AND n.z = f.z
    LEFT JOIN recurring.f AS k ON k.r = n.r AND k.c = n.c WHERE k.d IS NULL GROUP BY n.r, n.c, n.z) SELECT r, c, d FROM f)"""


@query("E2_directions_over_flats", f"""
WITH {_TERRACES}, filled AS MATERIALIZED (SELECT r, c, level AS z FROM {_FILLED.format('terraces')}),
falls AS (SELECT a.r, a.c, o.code, (a.z - b.z) / CASE WHEN o.code % 2 = 0 THEN sqrt(2e0) ELSE 1e0 END AS fall, a.z, b.z AS nz
  FROM filled a, offsets o, filled b WHERE b.r = a.r + o.dr AND b.c = a.c + o.dc),
steep AS MATERIALIZED (SELECT r, c, z, count(*) AS n, max(nz) AS most, coalesce(arg_min(code, (-fall, code)) FILTER (WHERE fall > 0), 0) AS fdr FROM falls GROUP BY r, c, z),
still AS MATERIALIZED (SELECT * FROM steep WHERE fdr = 0 AND n = 8),
outlets AS MATERIALIZED (SELECT s.r, s.c, s.z, min(o.code) AS code FROM still s, offsets o, steep d WHERE d.r = s.r + o.dr AND d.c = s.c + o.dc AND d.z = s.z AND (d.fdr > 0 OR d.n < 8) GROUP BY s.r, s.c, s.z),
higher AS MATERIALIZED (SELECT r, c, z FROM still WHERE most > z),
low AS MATERIALIZED (SELECT * FROM {_STEPWISE.format('outlets')}), away AS MATERIALIZED (SELECT * FROM {_STEPWISE.format('higher')}),
ranked AS MATERIALIZED (SELECT s.r, s.c, s.z, l.d, 2 * l.d - coalesce(a.d, 0) AS over FROM still s JOIN low l ON l.r = s.r AND l.c = s.c LEFT JOIN away a ON a.r = s.r AND a.c = s.c),
ways AS (SELECT s.r, s.c, arg_min(o.code, (n.over, o.code)) AS code FROM ranked s, offsets o, ranked n WHERE n.r = s.r + o.dr AND n.c = s.c + o.dc AND n.z = s.z AND n.over < s.over AND s.d > 1 GROUP BY s.r, s.c)
SELECT s.r, s.c, s.z, CAST(coalesce(x.code, w.code, s.fdr) AS INT) AS fdr FROM steep s LEFT JOIN outlets x ON x.r = s.r AND x.c = s.c LEFT JOIN ways w ON w.r = s.r AND w.c = s.c""")
def _(t):
    """Terraces filled, then directions down slopes and across flats."""
    filled = _filled_terraces(t)
    return _named_cells(terrain.directions(filled).join(filled, ["row", "col"]), "z", "fdr")


def _filled_terraces(t):
    return terrain.fill_pits(t.cells().withColumn("z", F.floor(F.col("z") / 1e2).cast("double")))


@query("E8_outlines", """
SELECT m.lake_id AS label, count(*) + 0e0 AS area, 4e0 * count(*) - 2 * (count(a.r) + count(b.r)) AS perimeter FROM mask m
LEFT JOIN mask a ON a.lake_id = m.lake_id AND a.r = m.r + 1 AND a.c = m.c LEFT JOIN mask b ON b.lake_id = m.lake_id AND b.r = m.r AND b.c = m.c + 1 GROUP BY m.lake_id""")
def _(t):
    """Rings around the lakes' cells, by the area that they enclose, holes left out, and their length."""
    found = rings.outlines(_mask(t).withColumnRenamed("lake_id", "label"))
    return found.groupBy("label").agg(F.sum(F.col("sense") * G.ring_area(F.col("vertices"))).alias("area"), F.sum(F.size("vertices") - 1).cast("double").alias("perimeter"))


_STREAMS = f"""acc AS ({_ACCUM}), s0 AS (SELECT d.r, d.c, d.tr, d.tc, d.z, a.ad8 FROM d8 d JOIN acc a ON a.r = d.r AND a.c = d.c WHERE a.ad8 >= 5),
s AS MATERIALIZED (SELECT x.r, x.c, x.z, x.ad8, y.r AS tr, y.c AS tc, y.z AS tz, x.r * wide + x.c AS id, sqrt(power(y.r - x.r, 2) + power(y.c - x.c, 2)) AS far
  FROM s0 x LEFT JOIN s0 y ON y.r = x.tr AND y.c = x.tc AND (x.r <> y.r OR x.c <> y.c), (SELECT max(wide) AS wide FROM grid)),
ups AS MATERIALIZED (SELECT n.r, n.c, count(u.r) AS ups FROM s n LEFT JOIN s u ON u.tr = n.r AND u.tc = n.c GROUP BY n.r, n.c),
runs AS MATERIALIZED (SELECT * FROM (WITH RECURSIVE w(r0, c0, r, c, n) AS (SELECT r, c, r, c, 1 FROM ups WHERE ups <> 1 UNION ALL
  SELECT w.r0, w.c0, s.tr, s.tc, w.n + 1 FROM w JOIN s ON s.r = w.r AND s.c = w.c JOIN ups u ON u.r = s.tr AND u.c = s.tc AND u.ups = 1) SELECT * FROM w)),
ends AS (SELECT r0, c0, max(n) AS n_cells, arg_max(s.id, n) AS id, sum(coalesce(far, 0)) AS len, arg_max(s.ad8, n) AS ad8, arg_max((s.tr, s.tc), n) AS nxt, arg_max(coalesce(s.tz, s.z), n) AS zend
  FROM runs w JOIN s ON s.r = w.r AND s.c = w.c GROUP BY r0, c0)"""


@query("E6_stream_links", f"""
WITH {_STREAMS} SELECT e.id AS LINKNO, coalesce(d.id, -1) AS DSLINKNO, CAST(e.n_cells AS BIGINT) AS n_cells, {SIX('e.len')} AS Length, CAST(e.ad8 AS BIGINT) AS DSContArea, {SIX('s.z - e.zend')} AS strmDrop
FROM ends e JOIN s ON s.r = e.r0 AND s.c = e.c0 LEFT JOIN ends d ON d.r0 = e.nxt[1] AND d.c0 = e.nxt[2]""")
def _(t):
    """The links of the streams of five cells and more, split at junctions."""
    links = _network(t, grid=False)[0]
    return links.select("LINKNO", "DSLINKNO", "n_cells", six(F.col("Length")).alias("Length"), "DSContArea", six(F.col("strmDrop")).alias("strmDrop"))


@query("E6_watersheds", f"""
WITH {_STREAMS}, owner AS (SELECT w.r, w.c, e.id FROM runs w JOIN ends e ON e.r0 = w.r0 AND e.c0 = w.c0),
down AS (SELECT * FROM (WITH RECURSIVE w(r, c, ar, ac) AS (SELECT r, c, r, c FROM d8 UNION ALL
  SELECT w.r, w.c, d.tr, d.tc FROM w JOIN d8 d ON d.r = w.ar AND d.c = w.ac LEFT JOIN s ON s.r = w.ar AND s.c = w.ac JOIN d8 x ON x.r = d.tr AND x.c = d.tc WHERE d.fdr > 0 AND s.r IS NULL) SELECT * FROM w))
SELECT coalesce(o.id, -1) AS WSNO, count(*) AS n FROM (SELECT d.r, d.c, max(o.id) AS id FROM down d LEFT JOIN owner o ON o.r = d.ar AND o.c = d.ac GROUP BY d.r, d.c) o GROUP BY 1""")
def _(t):
    """How many cells drain to each link."""
    return _network(t)[1].groupBy("WSNO").agg(F.count(F.lit(1)).alias("n"))


def _network(t, grid=True):
    flows = _flows(t).select("row", "col", "fdr", "z")
    cells = flows.join(raster.contributing(flows, t.width()), ["row", "col"])
    return raster.stream_network(cells.withColumn("stream", F.col("ad8") >= 5), t.width(), grid=grid)
