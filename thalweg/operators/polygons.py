"""Polygons of any number of rings: joins with points, lines of sight by bucket, and overlay.

A polygon is ``rings``, an array of closed rings (arrays of struct<x, y>, the first vertex repeated at the end) in any
order and sense; what lies within an odd number of them is inside. So holes, islands in holes and separate parts need no
marks. Null and empty polygons contain nothing and meet nothing.

Joins use a hierarchy of grids: a polygon lies on the level whose cells are no smaller than its box, so it has at most
four buckets whatever its size; a point has one on each level that polygons use, and of two polygons the smaller one is
also put on the level of the larger. Levels in use are counted by their binary exponents, some tens at most.

Overlay (``overlay``) works on pairs that a join has made, a pair at a time: edges are cut where they cross or touch,
parts of edges kept by whether they lie inside, outside or along the other polygon, and strung into rings. Coordinates
are snapped to a grid of ``snap`` times the pair's extent, so that points that are equal but for rounding are one. Rings
of one polygon may touch, but not cross one another or themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G

RINGS = "array<array<struct<x: double, y: double>>>"


def bounds(rings: Column) -> Column:
    """The box of a polygon; null for one without vertices."""
    return G.bounds(F.flatten(rings))


def contains(rings: Column, p: Column) -> Column:
    """A point strictly inside, by crossings with all rings; on any ring it isn't."""
    parity = F.aggregate(F.transform(rings, lambda r: G.crossings(r, p)), F.lit(0), lambda n, k: n + k) % 2 == 1
    return F.coalesce(parity & ~F.exists(rings, lambda r: G.line_distance(p, r) == 0), F.lit(False))


def area(rings: Column) -> Column:
    """Area of a polygon whose rings don't cross: a ring within an odd number of others is taken off."""

    def signed(r: Column, i: Column) -> Column:
        others = F.filter(rings, lambda s, j: j != i)
        # a point of the ring that is on no other: the middle of its first edge will do where rings touch at vertices
        a, b = F.get(r, F.lit(0)), F.get(r, F.lit(1))
        middle = G.point((a["x"] + b["x"]) / 2, (a["y"] + b["y"]) / 2)
        depth = F.aggregate(F.transform(others, lambda s: G.crossings(s, middle) % 2), F.lit(0), lambda n, k: n + k)
        return F.when(depth % 2 == 0, G.ring_area(r)).otherwise(-G.ring_area(r))

    return F.coalesce(F.aggregate(F.transform(rings, signed), F.lit(0.0), lambda n, k: n + k), F.lit(0.0))


def _level(box: Column) -> Column:
    """The binary exponent of cells no smaller than a box; boxes without extent get a very fine one."""
    extent = F.greatest(box["maxx"] - box["minx"], box["maxy"] - box["miny"], F.lit(2.0**-30))
    return F.ceil(F.log2(extent)).cast("int")


def _buckets(box: Column, level: Column) -> Column:
    """Array of (level, bx, by): the cells of a level that a box meets, four at most on its own level or a coarser one."""
    cell = F.pow(F.lit(2.0), level)
    at = lambda v: F.floor(v / cell).cast("long")
    xs, ys = F.sequence(at(box["minx"]), at(box["maxx"])), F.sequence(at(box["miny"]), at(box["maxy"]))
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: F.struct(level.alias("level"), x.alias("bx"), y.alias("by")))))


def _levels(boxed: DataFrame) -> list[int]:
    return sorted(r[0] for r in boxed.select(_level(F.col("__box"))).distinct().collect())  # exponents of doubles


def _on(df: DataFrame, cells: Column) -> DataFrame:
    return df.withColumn("__cell", F.explode(cells)).select("*", "__cell.level", "__cell.bx", "__cell.by").drop("__cell")


def _boxed(polygons: DataFrame, name: str = "rings") -> DataFrame:
    return polygons.where(F.size(F.flatten(F.coalesce(name, F.array().cast(RINGS)))) > 0).withColumn("__box", bounds(F.col(name)))


def points_in_polygons(points: DataFrame, polygons: DataFrame) -> DataFrame:
    """Inner join of ``points`` (p, ...) with the ``polygons`` (rings, ...) that strictly contain them."""
    boxed = _boxed(polygons)
    own = _on(boxed, _buckets(F.col("__box"), _level(F.col("__box"))))
    levels = F.array(*[F.lit(k) for k in _levels(boxed)]) if (boxed.columns and _levels(boxed)) else F.array().cast("array<int>")
    at = lambda v, k: F.floor(v / F.pow(F.lit(2.0), k)).cast("long")
    cells = F.transform(levels, lambda k: F.struct(k.alias("level"), at(F.col("p.x"), k).alias("bx"), at(F.col("p.y"), k).alias("by")))
    b, p = F.col("__box"), F.col("p")
    inside = p["x"].between(b["minx"], b["maxx"]) & p["y"].between(b["miny"], b["maxy"])
    pairs = _on(points, cells).join(own, ["level", "bx", "by"]).where(inside)
    return pairs.where(contains(F.col("rings"), p)).drop("level", "bx", "by", "__box")


def box_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of ``left`` (rings, ...) and ``right`` (others, ...) whose closed boxes meet, each pair once."""
    a = _boxed(left).withColumnRenamed("__box", "__a")
    b = _boxed(right, "others").withColumnRenamed("__box", "__b")
    la, lb = _level(F.col("__a")), _level(F.col("__b"))
    used = [sorted(r[0] for r in df.select(k).distinct().collect()) for df, k in ((a, la), (b, lb))]  # exponents of doubles

    def coarser(box: Column, own: Column, levels: list[int], equal: bool) -> Column:
        some = F.filter(F.array(*[F.lit(k) for k in levels]), lambda k: (k >= own) if equal else (k > own))
        return F.flatten(F.transform(some, lambda k: _buckets(box, k)))

    if not all(used):
        return a.join(b, F.lit(False)).drop("__a", "__b")
    keys = ["level", "bx", "by"]
    fine_left = _on(a, coarser(F.col("__a"), la, used[1], True)).join(_on(b, _buckets(F.col("__b"), lb)), keys)
    fine_right = _on(a, _buckets(F.col("__a"), la)).join(_on(b, coarser(F.col("__b"), lb, used[0], False)), keys)
    cell = F.pow(F.lit(2.0), F.col("level"))
    first = lambda c: F.floor(F.greatest(F.col(f"__a.{c}"), F.col(f"__b.{c}")) / cell).cast("long")
    pairs = fine_left.unionByName(fine_right).where(G.boxes_meet(F.col("__a"), F.col("__b")))
    return pairs.where((F.col("bx") == first("minx")) & (F.col("by") == first("miny"))).drop(*keys, "__a", "__b")


def packed(rings: Column) -> Column:
    """A polygon as arrays of numbers, for tasks in Python: x and y of all vertices, and the size of each ring."""
    every, none = F.flatten(rings), F.array().cast("array<double>")
    return F.struct(
        F.coalesce(F.transform(every, lambda v: v["x"]), none).alias("x"),
        F.coalesce(F.transform(every, lambda v: v["y"]), none).alias("y"),
        F.coalesce(F.transform(rings, F.size), F.array().cast("array<int>")).alias("sizes"),
    )


def unpacked(batch: pa.RecordBatch, name: str) -> Iterator[list[np.ndarray]]:
    """Of each row of a column of ``packed`` polygons its rings, as rows (x, y)."""
    x, y, sizes = (pc.struct_field(batch.column(name), part) for part in ("x", "y", "sizes"))
    for i in range(batch.num_rows):
        vertices = np.column_stack([x[i].values.to_numpy(zero_copy_only=False), y[i].values.to_numpy(zero_copy_only=False)])
        ends = np.cumsum(sizes[i].values.to_numpy(zero_copy_only=False))
        yield np.split(vertices, ends[:-1]) if len(ends) else []


# ---- overlay of a pair ------------------------------------------------------------------------------------------------


def _edges(rings: list[np.ndarray]) -> np.ndarray:
    """Rows (ax, ay, bx, by) of the edges of rings, those without length left out."""
    each = [np.hstack([r[:-1], r[1:]]) for r in rings if len(r) > 3]
    edges = np.vstack(each) if each else np.zeros((0, 4))
    return edges[(edges[:, :2] != edges[:, 2:]).any(axis=1)]


def _inside(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Whether points lie within an odd number of rings, a block of points at a time."""
    out = np.zeros(len(points), bool)
    ax, ay, bx, by = edges.T
    step = max(1, 4_000_000 // max(1, len(edges)))
    for i in range(0, len(points), step):
        x, y = points[i : i + step, 0:1], points[i : i + step, 1:2]
        spans = (ay > y) != (by > y)
        with np.errstate(divide="ignore", invalid="ignore"):
            crossed = spans & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
        out[i : i + step] = crossed.sum(axis=1) % 2 == 1
    return out


def _oriented(rings: list[np.ndarray]) -> list[np.ndarray]:
    """Rings with the inside of the polygon on their left."""
    out = []
    for i, r in enumerate(rings):
        twice = (r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1]).sum()
        others = _edges([s for j, s in enumerate(rings) if j != i])
        depth = int(_inside((r[:1] + r[1:2]) / 2, others)[0]) if len(others) else 0
        if twice:
            out.append(r if (twice > 0) == (depth == 0) else r[::-1])
    return out


def _cut(edges: np.ndarray, by: np.ndarray, grid, second: bool) -> np.ndarray:
    """The edges cut at all points where those of ``by`` cross or touch them; crossings are reckoned along the edges of the
    first polygon in either case, so that both get the same points."""
    out = []
    low, high = np.minimum(by[:, :2], by[:, 2:]), np.maximum(by[:, :2], by[:, 2:])
    for ax, ay, bx, by_ in edges:
        near = (low[:, 0] <= max(ax, bx)) & (high[:, 0] >= min(ax, bx)) & (low[:, 1] <= max(ay, by_)) & (high[:, 1] >= min(ay, by_))
        points = [(0.0, ax, ay), (1.0, bx, by_)]
        if near.any():
            c, d = by[near, :2], by[near, 2:]
            dx, dy = bx - ax, by_ - ay
            ex, ey, wx, wy = d[:, 0] - c[:, 0], d[:, 1] - c[:, 1], c[:, 0] - ax, c[:, 1] - ay
            cross, square = dx * ey - dy * ex, dx * dx + dy * dy
            with np.errstate(divide="ignore", invalid="ignore"):
                t, u = (wx * ey - wy * ex) / cross, (wx * dy - wy * dx) / cross
            hit = (cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
            if second:
                points += [(s, *grid(x, y)) for s, x, y in zip(t[hit], (c[:, 0] + u * ex)[hit], (c[:, 1] + u * ey)[hit], strict=True)]
            else:
                points += [(s, *grid(ax + s * dx, ay + s * dy)) for s in t[hit]]
            for q in (c, d):  # ends of the others that lie on this edge, along it or not
                s = ((q[:, 0] - ax) * dx + (q[:, 1] - ay) * dy) / square
                foot = np.array([grid(ax + k * dx, ay + k * dy) for k in s]).reshape(-1, 2)
                on = (s > 0) & (s < 1) & (foot == q).all(axis=1)
                points += [(k, *p) for k, p in zip(s[on], q[on], strict=True)]
        points.sort()
        for (_, *p), (_, *q) in zip(points, points[1:], strict=False):
            if p != q:
                out.append((*p, *q))
    return np.array(out).reshape(-1, 4)


def _strung(edges: list[tuple]) -> list[list[tuple]]:
    """Rings of directed edges; where several leave a vertex, the one furthest to the left of the way in."""
    leaving: dict = {}
    for a, b in edges:
        leaving.setdefault(a, []).append(b)
    rings = []
    for start in list(leaving):
        while leaving.get(start):
            ring, at, before = [start], start, None
            while True:
                options = leaving[at]
                if before is None or len(options) == 1:
                    pick = options[0]
                else:
                    way = np.arctan2(at[1] - before[1], at[0] - before[0])
                    turn = lambda n: (np.arctan2(n[1] - at[1], n[0] - at[0]) - way + np.pi) % (2 * np.pi)
                    pick = max(options, key=turn)
                options.remove(pick)
                before, at = at, pick
                ring.append(at)
                if at == start or not leaving.get(at):
                    break
            if len(ring) > 3 and ring[-1] == start:
                rings.append(ring)
    return rings


#: For each operation: whether parts of edges of the first and of the second polygon stay that lie inside the other one,
#: whether those of the second turn round, and whether parts along both stay that run the same way, or opposite ways.
_OPERATIONS = {"intersection": (True, True, False, True, False), "union": (False, False, False, True, False), "difference": (False, True, True, False, True)}


def overlaid(first: list[np.ndarray], second: list[np.ndarray], operation: str = "intersection", snap: float = 1e-14) -> list[list[tuple]]:
    """Rings of the intersection, union or difference of two polygons."""
    every = [r for r in [*first, *second] if len(r)]
    if not every:
        return []
    corner = np.floor(np.vstack(every).min(axis=0))
    # a power of two, so that multiples are exact
    unit = 2.0 ** np.ceil(np.log2(max(float(np.ptp(np.vstack(every), axis=0).max()), 1e-300) * snap))

    def grid(x: float, y: float) -> tuple[float, float]:
        return float(np.rint(x / unit) * unit), float(np.rint(y / unit) * unit)

    snapped = [[np.rint((r - corner) / unit) * unit for r in rings] for rings in (first, second)]
    a, b = (_edges(_oriented([r for r in rings if len(r) > 3])) for rings in snapped)
    a, b = _cut(a, b, grid, False), _cut(b, a, grid, True)
    keep_a, keep_b, turn, along, against = _OPERATIONS[operation]
    key = lambda e: ((e[0], e[1]), (e[2], e[3]))
    ours, theirs = {key(e) for e in a}, {key(e) for e in b}
    found = []
    for edges, other, shared, keep, back in ((a, b, theirs, keep_a, False), (b, a, ours, keep_b, turn)):
        within = _inside((edges[:, :2] + edges[:, 2:]) / 2, other) if len(edges) else []
        for e, inside in zip(edges, within, strict=True):
            p, q = key(e)
            if (p, q) in shared or (q, p) in shared:
                if edges is a and (along if (p, q) in shared else against):
                    found.append((p, q))
            elif inside == keep:
                found.append((q, p) if back else (p, q))
    return [[(float(x + corner[0]), float(y + corner[1])) for x, y in r] for r in _strung(found)]


def overlay(pairs: DataFrame, operation: str = "intersection", snap: float = 1e-14) -> DataFrame:
    """``pairs`` (rings, others, ...) with rings of their intersection, union or difference in place of both; an empty array
    where nothing is left."""
    keep = [c for c in pairs.columns if c not in ("rings", "others")]
    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.select(*keep).schema] + [f"rings {RINGS}"])
    made = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                [[{"x": x, "y": y} for x, y in r] for r in overlaid(a, b, operation, snap)]
                for a, b in zip(unpacked(batch, "__a"), unpacked(batch, "__b"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(out, made)], [*keep, "rings"])

    return pairs.select(*keep, packed(F.col("rings")).alias("__a"), packed(F.col("others")).alias("__b")).mapInArrow(run, kinds)


def meeting(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of ``left`` (rings, ...) and ``right`` (others, ...) with a point in common, on their edges or inside."""
    pairs = box_pairs(left, right)
    a, b = F.col("rings"), F.col("others")
    touch = F.exists(a, lambda r: F.exists(b, lambda s: G.lines_meet(r, s)))
    vertex = lambda rings: F.flatten(F.transform(rings, lambda r: F.slice(r, F.lit(1), F.lit(1))))
    within = F.exists(vertex(a), lambda v: contains(b, v)) | F.exists(vertex(b), lambda v: contains(a, v))
    return pairs.where(touch | within)


def clipped(polygons: DataFrame, boundary: DataFrame) -> DataFrame:
    """``polygons`` (rings, ...) cut to those of ``boundary`` (others); a row for each pair with an area in common."""
    return overlay(box_pairs(polygons, boundary.select("others"))).where(F.size("rings") > 0)
