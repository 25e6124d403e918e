"""Spatial joins by grid buckets: an equi-join on cells of a common grid, then the exact test.

Geometry columns are arrays of struct<x, y>; polygons are closed rings. Cells come from bounding boxes, so the buckets of
a large polygon grow with its box over the cell size; choose ``cell`` near the size of the usual polygon.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from .store import settled


def _cells(low: Column, high: Column, cell: float) -> Column:
    return F.sequence(F.floor(low / cell).cast("int"), F.floor(high / cell).cast("int"))


def with_buckets(df: DataFrame, box: Column, cell: float) -> DataFrame:
    """A row for each bucket that the box meets: bx, by."""
    df = df.withColumn("__box", box)
    df = df.withColumn("bx", F.explode(_cells(F.col("__box.minx"), F.col("__box.maxx"), cell)))
    return df.withColumn("by", F.explode(_cells(F.col("__box.miny"), F.col("__box.maxy"), cell))).drop("__box")


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float) -> DataFrame:
    """Inner join of ``points`` (p, ...) with the ``polygons`` (ring, ...) that strictly contain them."""
    left = points.withColumn("bx", F.floor(F.col("p.x") / cell).cast("int")).withColumn("by", F.floor(F.col("p.y") / cell).cast("int"))
    right = with_buckets(polygons, G.bounds(F.col("ring")), cell)
    return left.join(right, ["bx", "by"]).where(G.contains(F.col("ring"), F.col("p"))).drop("bx", "by")


def within_distance(points: DataFrame, others: DataFrame, key: str, reach: float) -> DataFrame:
    """Pairs of ``points`` (p, key) and ``others`` (q, ...) at most ``reach`` apart, with their distance d."""
    p, q = F.col("p"), F.col("q")
    box = F.struct((p["x"] - reach).alias("minx"), (p["y"] - reach).alias("miny"), (p["x"] + reach).alias("maxx"), (p["y"] + reach).alias("maxy"))
    left = with_buckets(points, box, reach)
    right = others.withColumn("bx", F.floor(q["x"] / reach).cast("int")).withColumn("by", F.floor(q["y"] / reach).cast("int"))
    return left.join(right, ["bx", "by"]).withColumn("d", G.distance(p, q)).where(F.col("d") <= reach).drop("bx", "by")


def nearest_distance(points: DataFrame, others: DataFrame, key: str, reach: float) -> DataFrame:
    """``points`` with d: the least distance to any of ``others`` within ``reach``, else infinity."""
    near = within_distance(points, others, key, reach).groupBy(key).agg(F.min("d").alias("d"))
    return points.join(near, key, "left").withColumn("d", F.coalesce("d", F.lit(float("inf"))))


def lines_near_points(points: DataFrame, lines: DataFrame, key: str, reach: float, cell: float) -> DataFrame:
    """Pairs of ``points`` (p, key) and ``lines`` (line, ...) at most ``reach`` apart."""
    found = _fitted(points, lines, reach, cell).where(G.line_distance(F.col("p"), F.col("line")) <= reach)
    return found.drop("bx", "by", "kx", "ky")


def _fitted(points: DataFrame, lines: DataFrame, reach: float, cell: float) -> DataFrame:
    """Candidate pairs of ``points`` (p, ...) and ``lines`` (line, ...), once each, by buckets that fit each line's box.

    A bucket is as wide and as high as the box, each rounded up to ``reach`` times a power of two but at most ``cell``, so
    flat or narrow lines gather only points beside them. A point lies in one bucket of each of the sizes that occur.
    """
    top = max(1, math.ceil(math.log2(cell / (4 * reach))) + 1) if cell > 4 * reach else 0
    box = F.col("__box")
    boxed = lines.withColumn("__box", G.bounds(F.col("line")))
    size = lambda low, high: F.least(F.greatest(F.ceil(F.log2(F.greatest(box[high] - box[low], F.lit(reach)) / (4 * reach))), F.lit(0)), F.lit(top)).cast("int")
    boxed = boxed.withColumn("kx", size("minx", "maxx")).withColumn("ky", size("miny", "maxy"))
    wide = lambda k: F.lit(4.0 * reach) * F.pow(F.lit(2.0), F.col(k))
    at = lambda v, k: F.floor(v / wide(k)).cast("long")
    right = boxed.withColumn("bx", F.explode(F.sequence(at(box["minx"] - reach, "kx"), at(box["maxx"] + reach, "kx"))))
    right = right.withColumn("by", F.explode(F.sequence(at(box["miny"] - reach, "ky"), at(box["maxy"] + reach, "ky"))))
    right = right.drop("__box").hint("merge")  # more rows than the planner, which doesn't count a generator's, takes it for
    sizes = F.explode(F.sequence(F.lit(0), F.lit(top)))
    left = points.withColumn("kx", sizes).withColumn("ky", sizes)
    left = left.withColumn("bx", at(F.col("p.x"), "kx")).withColumn("by", at(F.col("p.y"), "ky"))
    some = boxed.select("kx", "ky").distinct()  # at most (top + 1) squared rows
    return left.join(F.broadcast(some), ["kx", "ky"], "left_semi").join(right, ["kx", "ky", "bx", "by"])


def nearest_line(lines: DataFrame, p: Column) -> DataFrame:
    """The row of ``lines`` (LINKNO, line) nearest to a point, the least LINKNO on ties, with its distance d."""
    df = lines.withColumn("d", G.line_distance(p, F.col("line")))
    return df.orderBy("d", "LINKNO").limit(1)


def lines_in_polygons(lines: DataFrame, polygons: DataFrame, cell: float) -> DataFrame:
    """Pairs of ``lines`` (line, ...) and ``polygons`` (ring, ...) that meet, with overlap (the length within), mid_inside and
    tips_inside. A pair is tested in one bucket only, the first that both boxes have.

    Pairs whose boxes meet are written first, dealt out to all cores: their tests take far longer than they are large, and
    are not to become part of the join, where the planner has sent some of them to the side of one table.
    """
    left = with_buckets(lines.withColumn("__lb", G.bounds(F.col("line"))), F.col("__lb"), cell)
    right = with_buckets(polygons.withColumn("__rb", G.bounds(F.col("ring"))), F.col("__rb"), cell)
    first = lambda c: F.floor(F.greatest(F.col(f"__lb.{c}"), F.col(f"__rb.{c}")) / cell)
    pairs = left.hint("merge").join(right, ["bx", "by"]).where((F.col("bx") == first("minx")) & (F.col("by") == first("miny")))
    line, ring = F.col("line"), F.col("ring")
    pairs = pairs.where(G.boxes_meet(F.col("__lb"), F.col("__rb"))).drop("bx", "by", "__lb", "__rb")
    pairs = settled(pairs.repartition(2 * lines.sparkSession.sparkContext.defaultParallelism)).where(G.line_meets(line, ring))
    return pairs.select(
        "*",
        G.length_inside(line, ring).alias("overlap"),
        G.contains(ring, G.midpoint(line)).alias("mid_inside"),
        (G.contains(ring, G.first_vertex(line)) & G.contains(ring, G.last_vertex(line))).alias("tips_inside"),
    )


def through_basins(lakes: DataFrame, streams: DataFrame, cell: float) -> DataFrame:
    """(lake_id, basins) of all ``lakes`` (lake_id, ring): the ascending positive WSNO of the streams (WSNO, line) that meet
    each, empty where none does."""
    met = lines_in_polygons(streams.where("WSNO > 0").select("WSNO", "line"), lakes.select("lake_id", "ring"), cell)
    sets = met.groupBy("lake_id").agg(F.array_sort(F.collect_set("WSNO")).alias("basins"))
    return lakes.select("lake_id").join(sets, "lake_id", "left").withColumn("basins", F.coalesce("basins", F.array().cast("array<bigint>")))


def swallowed_starts(met: DataFrame, links: DataFrame, least: float = 180.0) -> DataFrame:
    """(lake_id, LINKNO) of the headwater links, those that are nobody's DSLINKNO, that a lake swallows: their midpoint or
    both ends lie within it, or more than ``least`` of their length. ``met`` from ``lines_in_polygons``."""
    some = met.where(F.col("mid_inside") | F.col("tips_inside") | (F.col("overlap") > least)).select("lake_id", "LINKNO")
    return some.join(links.select(F.col("DSLINKNO").alias("LINKNO")).distinct(), "LINKNO", "left_anti").select("lake_id", "LINKNO").distinct()


def connect_nodes(points: DataFrame, streams: DataFrame, reach: float, cell: float, most: int = 50_000) -> DataFrame:
    """(pt, LINKNO, d): of the links within reach of a point, for an inflow that whose upstream end is nearest, for an
    outflow that whose downstream end is; points (pt, point_type, p), streams (LINKNO, line from its downstream end).

    The links within reach of a point grow with their density, so pairs aren't rows: points lie in one tile each, links in all
    that they come near to, and a task searches a tile by the order of ends. Tiles of more than ``most`` rows are halved
    along both sides until they hold about as many, 16 times at most."""
    wide = 16 * cell
    at = lambda v, k: F.floor(v / (F.lit(wide) / F.pow(F.lit(2.0), F.col(k)))).cast("long")
    low, high = (F.struct(*[(F.col(f"__box.{m}{c}") + by).alias(c) for c in "xy"]) for m, by in (("min", -reach), ("max", reach)))
    first = lambda c, k="k0": at(F.col(f"low.{c}"), k)
    last = lambda c, k="k0": at(F.col(f"high.{c}"), k)
    zero = F.lit(0).alias("k0")
    here = points.where("not isnan(p.x) and not isnan(p.y)").select("pt", F.coalesce(F.col("point_type") == "inflow", F.lit(False)).alias("up"), F.col("p.x").alias("x"), F.col("p.y").alias("y"), zero)
    here = here.withColumn("tx", at(F.col("x"), "k0")).withColumn("ty", at(F.col("y"), "k0"))
    boxed = streams.where(F.size("line") > 1).select("LINKNO", "line", G.bounds(F.col("line")).alias("__box"), zero)
    boxed = boxed.select("LINKNO", "line", low.alias("low"), high.alias("high"), "k0")
    there = boxed.withColumn("tx", F.explode(F.sequence(first("x"), last("x")))).withColumn("ty", F.explode(F.sequence(first("y"), last("y"))))
    rows = here.select("tx", "ty").union(there.select("tx", "ty")).groupBy("tx", "ty").agg(F.count(F.lit(1)).alias("n"))
    halvings = F.least(F.greatest(F.ceil(F.log2(F.col("n") / most) / 2), F.lit(0)), F.lit(16)).cast("int")
    sizes = settled(rows.select("tx", "ty", halvings.alias("k")))
    mine = here.join(sizes, ["tx", "ty"]).select("pt", "up", "x", "y", F.col("k").alias("k"), at(F.col("x"), "k").alias("bx"), at(F.col("y"), "k").alias("by"))
    parts = F.pow(F.lit(2.0), F.col("k")).cast("long")
    within = lambda t, c: F.sequence(F.greatest(first(c, "k"), F.col(t) * parts), F.least(last(c, "k"), (F.col(t) + 1) * parts - 1))
    theirs = there.hint("merge").join(sizes, ["tx", "ty"]).withColumn("bx", F.explode(within("tx", "x"))).withColumn("by", F.explode(within("ty", "y")))
    theirs = theirs.select("LINKNO", F.transform("line", lambda v: v["x"]).alias("xs"), F.transform("line", lambda v: v["y"]).alias("ys"), "k", "bx", "by")
    kinds = {"pt": points.schema["pt"].dataType.simpleString(), "LINKNO": streams.schema["LINKNO"].dataType.simpleString()}

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        link, d = _nearest_ends(left, right, reach)
        found = link >= 0
        picked = pa.array(np.maximum(link, 0)[found])
        return pa.table({"pt": left.column("pt").filter(pa.array(found)), "LINKNO": right.column("LINKNO").take(picked), "d": pa.array(d[found])})

    tile = ["k", "bx", "by"]
    near = mine.groupBy(*tile).cogroup(theirs.groupBy(*tile)).applyInArrow(search, f"pt {kinds['pt']}, LINKNO {kinds['LINKNO']}, d double")
    best = near.groupBy("pt").agg(F.min(F.struct("d", "LINKNO")).alias("b"))
    return best.select("pt", F.col("b.LINKNO").alias("LINKNO"), F.col("b.d").alias("d"))


def _nearest_ends(points: pa.Table, links: pa.Table, reach: float, most: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """For each point (up, x, y) the row of the link (LINKNO, xs, ys) within reach whose end is nearest, the least LINKNO on ties,
    or -1, and its distance. Blocks of points meet blocks of links in the order of the distance of their ends' boxes, until none
    that is left can be nearer."""
    up, x, y = (points.column(c).to_numpy() for c in ("up", "x", "y"))
    found, d = np.full(len(x), -1), np.full(len(x), np.inf)
    if not len(x) or not links.num_rows:
        return found, d
    ids = pc.rank(links.column("LINKNO"), null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
    xs, ys = (links.column(c).combine_chunks().flatten().to_numpy() for c in ("xs", "ys"))
    sizes = links.column("xs").combine_chunks().value_lengths().to_numpy().astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    low = np.stack([np.fmin.reduceat(v, begins) for v in (xs, ys)], 1)
    high = np.stack([np.fmax.reduceat(v, begins) for v in (xs, ys)], 1)
    for kind in (True, False):
        mine = np.flatnonzero(up == kind)
        if not len(mine):
            continue
        end = begins + sizes - 1 if kind else begins
        ends, at = np.stack([xs[end], ys[end]], 1), np.stack([x[mine], y[mine]], 1)
        leaves = _blocks(ends, most)
        box = lambda f, v: np.stack([f.reduce(v[i], 0) for i in leaves])
        end_low, end_high, line_low, line_high = box(np.fmin, ends), box(np.fmax, ends), box(np.fmin, low), box(np.fmax, high)
        for block in _blocks(at, most):
            p = at[block]
            to_line, to_end = (_apart(p.min(0), p.max(0), a, b) for a, b in ((line_low, line_high), (end_low, end_high)))
            near = np.flatnonzero(to_line <= reach * (1 + 1e-9))
            best, row = np.full(len(p), np.inf), np.full(len(p), -1)
            for leaf in near[np.argsort(to_end[near], kind="stable")]:
                if to_end[leaf] * (1 - 1e-9) > best.max():
                    break
                some = leaves[leaf]
                far = np.sqrt((p[:, :1] - ends[some, 0]) ** 2 + (p[:, 1:] - ends[some, 1]) ** 2)
                far[~(far <= best[:, None])] = np.inf
                least, which = _first(far, ids[some])
                # most often the nearest end's link is in reach, for certain if its end is
                unsure = np.flatnonzero((least > reach * (1 - 1e-9)) & (least < np.inf))
                out = unsure[~(_line_distances(p[unsure], some[which[unsure]], xs, ys, begins, sizes) <= reach)]
                if len(out):
                    i, j = np.nonzero(far[out] < np.inf)
                    off = ~(_line_distances(p[out[i]], some[j], xs, ys, begins, sizes) <= reach)
                    far[out[i[off]], j[off]] = np.inf
                    least[out], which[out] = _first(far[out], ids[some])
                better = (least < best) | ((least < np.inf) & (ids[some[which]] < ids[row]))
                best[better], row[better] = least[better], some[which[better]]
            found[mine[block]], d[mine[block]] = row, best
    return found, d


def _first(far: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least of each row and its place, that of the least id on ties."""
    least = far.min(1)
    return least, np.where(far == least[:, None], ids, np.iinfo(ids.dtype).max).argmin(1)


def _blocks(at: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows of ``at`` (x, y) in blocks of at most ``most`` that lie together: halved along the longer side of their box."""
    todo, done = [np.arange(len(at))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            done.append(rows)
            continue
        v = at[rows]
        half = len(rows) // 2
        order = np.argpartition(v[:, int(np.ptp(v, 0).argmax())], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return done


def _apart(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Distances of a box to others."""
    gap = np.maximum(np.maximum(lows - high, low - highs), 0)
    return np.sqrt((gap**2).sum(1))


def _line_distances(p: np.ndarray, link: np.ndarray, xs: np.ndarray, ys: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Distances of points to a link each, as ``G.line_distance``."""
    n = sizes[link] - 1
    start = np.cumsum(n) - n
    a = np.repeat(begins[link] - start, n) + np.arange(n.sum())
    px, py = np.repeat(p, n, 0).T
    dx, dy = xs[a + 1] - xs[a], ys[a + 1] - ys[a]
    square = dx * dx + dy * dy
    t = np.where(square == 0, 0.0, ((px - xs[a]) * dx + (py - ys[a]) * dy) / np.where(square == 0, 1.0, square))
    t = np.maximum(0.0, np.minimum(1.0, t))
    ex, ey = px - (xs[a] + t * dx), py - (ys[a] + t * dy)
    far = np.sqrt(ex * ex + ey * ey)
    return np.fmin.reduceat(far, start) if len(start) else far


def boxes_in_window(df: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Rows whose box columns meet a window: plain comparisons that reach the file's statistics."""
    return df.where((F.col("minx") <= maxx) & (F.col("maxx") >= minx) & (F.col("miny") <= maxy) & (F.col("maxy") >= miny))


def rank_exits(exits: DataFrame, tiebreak: str) -> DataFrame:
    """The best exit of each lake: nearest gauge, least DOUTEND, greatest tiebreak, greatest area, first in order."""
    w = Window.partitionBy("lake_id").orderBy("gauge_dist", "doutend", F.desc(tiebreak), F.desc("dscontarea"), "seq")
    return exits.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
