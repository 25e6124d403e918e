"""Geometry measures over arrays of vertices, struct<x: double, y: double>, as native expressions."""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS = 6378137.0


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _pairs(line: Column) -> Column:
    """Consecutive vertices as (a, b)."""
    ends = F.slice(line, F.lit(2), F.greatest(F.size(line) - 1, F.lit(0)))
    starts = F.slice(line, F.lit(1), F.greatest(F.size(line) - 1, F.lit(0)))
    return F.arrays_zip(starts.alias("a"), ends.alias("b"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def distance(a: Column, b: Column) -> Column:
    return F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"]))


def length(line: Column) -> Column:
    return _sum(F.transform(_pairs(line), lambda p: distance(p["a"], p["b"])))


def ring_area(ring: Column) -> Column:
    """Area of a closed ring (the first vertex is repeated at the end), whatever its sense."""
    return F.abs(_sum(F.transform(_pairs(ring), lambda p: p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"]))) / 2


def polygon_area(rings: Column) -> Column:
    """Area of the first ring less those of its holes."""
    holes = _sum(F.transform(F.slice(rings, F.lit(2), F.size(rings)), ring_area))
    return ring_area(F.get(rings, F.lit(0))) - holes


def bounds(line: Column) -> Column:
    xs, ys = F.transform(line, lambda v: v["x"]), F.transform(line, lambda v: v["y"])
    return F.struct(
        F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy")
    )


def boxes_meet(a: Column, b: Column) -> Column:
    """Closed boxes with a common point."""
    return (a["minx"] <= b["maxx"]) & (b["minx"] <= a["maxx"]) & (a["miny"] <= b["maxy"]) & (b["miny"] <= a["maxy"])


def segment_distance(p: Column, a: Column, b: Column) -> Column:
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    square = dx * dx + dy * dy
    t = F.when(square == 0, 0.0).otherwise(
        ((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy) / F.when(square == 0, F.lit(1.0)).otherwise(square)
    )
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    ex, ey = p["x"] - (a["x"] + t * dx), p["y"] - (a["y"] + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def line_distance(p: Column, line: Column) -> Column:
    return F.array_min(F.transform(_pairs(line), lambda s: segment_distance(p, s["a"], s["b"])))


def crossings(ring: Column, p: Column) -> Column:
    """How many edges of a closed ring a ray from a point to the right crosses; odd inside."""

    def crossed(s: Column) -> Column:
        a, b = s["a"], s["b"]
        rise = F.when(b["y"] == a["y"], F.lit(1.0)).otherwise(b["y"] - a["y"])
        return ((a["y"] > p["y"]) != (b["y"] > p["y"])) & (p["x"] < (b["x"] - a["x"]) * (p["y"] - a["y"]) / rise + a["x"])

    return F.size(F.filter(_pairs(ring), crossed))


def contains(ring: Column, p: Column) -> Column:
    """A point strictly inside a closed ring, by crossings; on the boundary it isn't."""
    return (crossings(ring, p) % 2 == 1) & (line_distance(p, ring) > 0)


def lines_meet(a: Column, b: Column) -> Column:
    """Whether two lines have a point in common."""
    return F.exists(_pairs(a), lambda s: F.exists(_pairs(b), lambda e: _segments_meet(s, e)))


def _segments_meet(s: Column, e: Column) -> Column:
    side = lambda p, q, r: F.signum((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))
    a, b, c, d = s["a"], s["b"], e["a"], e["b"]
    apart = (side(a, b, c) * side(a, b, d) > 0) | (side(c, d, a) * side(c, d, b) > 0)
    box = lambda p, q: F.struct(F.least(p["x"], q["x"]).alias("minx"), F.least(p["y"], q["y"]).alias("miny"), F.greatest(p["x"], q["x"]).alias("maxx"), F.greatest(p["y"], q["y"]).alias("maxy"))
    return boxes_meet(box(a, b), box(c, d)) & ~apart


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def _clip_half(ring: Column, *, side: tuple[float, float, float]) -> Column:
    """The part of a closed ring with a x + b y <= c, closed again; empty if there is none."""
    a, b, c = side
    off = lambda p: p["x"] * a + p["y"] * b - c

    def step(s: Column) -> Column:
        p, q = s["a"], s["b"]
        t = off(p) / F.nullif(off(p) - off(q), F.lit(0.0))
        cross = point(p["x"] + t * (q["x"] - p["x"]), p["y"] + t * (q["y"] - p["y"]))
        own = F.when(off(p) <= 0, F.array(point(p["x"], p["y"]))).otherwise(F.array().cast("array<struct<x:double,y:double>>"))
        return F.when(off(p) * off(q) < 0, F.concat(own, F.array(cross))).otherwise(own)

    open_ = F.flatten(F.transform(_pairs(ring), step))
    return _let(open_, lambda r: F.when(F.size(r) > 0, F.concat(r, F.slice(r, F.lit(1), F.lit(1)))).otherwise(r))


def clip_box(ring: Column, minx: float, miny: float, maxx: float, maxy: float) -> Column:
    """The part of a closed ring within a box; where it falls into several, they hang together by edges of the box."""
    sides = [(-1.0, 0.0, -minx), (1.0, 0.0, maxx), (0.0, -1.0, -miny), (0.0, 1.0, maxy)]
    for side in sides:
        ring = _let(ring, partial(_clip_half, side=side))
    return ring


def _cuts(s: Column, ring: Column) -> Column:
    """Ascending parameters, 0 and 1 included, at which a segment meets the edges of a ring."""
    p, q = s["a"], s["b"]
    dx, dy = q["x"] - p["x"], q["y"] - p["y"]

    def at(e: Column) -> Column:
        ex, ey = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        wx, wy = e["a"]["x"] - p["x"], e["a"]["y"] - p["y"]
        cross = F.nullif(dx * ey - dy * ex, F.lit(0.0))
        t, u = (wx * ey - wy * ex) / cross, (wx * dy - wy * dx) / cross
        return F.when(t.between(0, 1) & u.between(0, 1), t)

    found = F.array_compact(F.transform(_pairs(ring), at))
    return F.sort_array(F.concat(F.array(F.lit(0.0), F.lit(1.0)), found))


def length_inside(line: Column, ring: Column) -> Column:
    """Length of the part of a line within a closed ring: each segment is cut where it meets the ring."""

    def inside(s: Column) -> Column:
        p, q = s["a"], s["b"]

        def part(cuts: Column) -> Column:
            def one(t: Column, i: Column) -> Column:
                to = F.get(cuts, i + 1)
                mid = (t + to) / 2
                there = contains(ring, point(p["x"] + mid * (q["x"] - p["x"]), p["y"] + mid * (q["y"] - p["y"])))
                return F.when((to > t) & there, (to - t) * distance(p, q)).otherwise(0.0)

            return _sum(F.transform(F.slice(cuts, F.lit(1), F.size(cuts) - 1), one))

        return _let(_cuts(s, ring), part)

    return _sum(F.transform(_pairs(line), inside))


def line_meets(line: Column, ring: Column) -> Column:
    """A line with a point within or on a closed ring."""
    touch = F.exists(_pairs(line), lambda s: F.size(_cuts(s, ring)) > 2)
    return touch | contains(ring, first_vertex(line))


def to_wkt(kind: str, vertices: Column) -> Column:
    """WKT of a LINESTRING or a POLYGON of one ring."""
    text = F.array_join(F.transform(vertices, lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string"))), ", ")
    return F.concat(F.lit(f"{kind} {'((' if kind == 'POLYGON' else '('}"), text, F.lit("))" if kind == "POLYGON" else ")"))


def from_wkt(text: Column) -> Column:
    """Vertices of the first ring or line of a WKT."""
    inner = F.regexp_extract(text, r"\(+([^()]*)\)", 1)
    return F.transform(
        F.split(F.trim(inner), r"\s*,\s*"),
        lambda v: F.struct(F.get(F.split(v, r"\s+"), F.lit(0)).cast("double").alias("x"), F.get(F.split(v, r"\s+"), F.lit(1)).cast("double").alias("y")),
    )


def midpoint(line: Column) -> Column:
    """The point at half the length."""
    half = length(line) / 2
    state = F.struct(F.lit(0.0).alias("gone"), F.get(line, F.lit(0))["x"].alias("x"), F.get(line, F.lit(0))["y"].alias("y"))

    def step(acc: Column, s: Column) -> Column:
        d = distance(s["a"], s["b"])
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (half - acc["gone"]) / F.when(d == 0, F.lit(1.0)).otherwise(d)))
        open_ = (acc["gone"] < half) & (d > 0)
        return F.struct(
            (acc["gone"] + d).alias("gone"),
            F.when(open_, s["a"]["x"] + t * (s["b"]["x"] - s["a"]["x"])).otherwise(acc["x"]).alias("x"),
            F.when(open_, s["a"]["y"] + t * (s["b"]["y"] - s["a"]["y"])).otherwise(acc["y"]).alias("y"),
        )

    return F.aggregate(_pairs(line), state, step, lambda acc: F.struct(acc["x"].alias("x"), acc["y"].alias("y")))


def first_vertex(line: Column) -> Column:
    return F.get(line, F.lit(0))


def last_vertex(line: Column) -> Column:
    return F.element_at(line, -1)


def joined(a: Column, b: Column, within: float = 0.01) -> Column:
    """Array of parts: one line where the end of ``a`` lies within a distance of the start of ``b``, else two."""
    near = distance(last_vertex(a), first_vertex(b)) <= within
    return F.when(near, F.array(F.concat(a, F.slice(b, F.lit(2), F.size(b))))).otherwise(F.array(a, b))


def strung(lines: Column, within: float = 0.01) -> Column:
    """Array of parts of lines given one after the other, each joined to the part made last where an end of the one lies
    within a distance of an end of the other; lines that run the other way are turned round, others begin a new part.
    The vertex of the part made so far stays. Parts come latest first; lines without vertices are left out."""

    def without(line: Column, first: bool) -> Column:
        return F.slice(line, F.lit(2 if first else 1), F.size(line) - 1)

    def step(parts: Column, x: Column) -> Column:
        a = F.get(parts, F.lit(0))
        near = lambda p, q: distance(p, q) <= within
        one = (
            F.when(near(last_vertex(x), first_vertex(a)), F.concat(without(x, False), a))
            .when(near(first_vertex(x), first_vertex(a)), F.concat(without(F.reverse(x), False), a))
            .when(near(first_vertex(x), last_vertex(a)), F.concat(a, without(x, True)))
            .when(near(last_vertex(x), last_vertex(a)), F.concat(a, without(F.reverse(x), True)))
        )
        rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        return F.when(one.isNull(), F.concat(F.array(x), parts)).otherwise(F.concat(F.array(one), rest))

    some = F.filter(lines, lambda x: F.size(F.coalesce(x, F.array().cast("array<struct<x:double,y:double>>"))) > 0)
    return F.aggregate(some, F.array().cast("array<array<struct<x:double,y:double>>>"), step)


def least_step(line: Column) -> Column:
    """The least distance of consecutive vertices that isn't 0."""
    steps = F.transform(_pairs(line), lambda s: distance(s["a"], s["b"]))
    return F.array_min(F.filter(steps, lambda d: d > 0))


def to_mercator(lon: Column, lat: Column) -> Column:
    """EPSG:4326 degrees to EPSG:3857 metres."""
    x = lon * (math.pi * RADIUS / 180)
    y = F.log(F.tan(F.lit(math.pi / 4) + lat * (math.pi / 360))) * RADIUS
    return F.struct(x.alias("x"), y.alias("y"))


def from_mercator(x: Column, y: Column) -> Column:
    lon = x * (180 / (math.pi * RADIUS))
    lat = (2 * F.atan(F.exp(y / RADIUS)) - F.lit(math.pi / 2)) * (180 / math.pi)
    return F.struct(lon.alias("x"), lat.alias("y"))


def cell_xy(gt: list[float], row: Column, col: Column, offset: float) -> Column:
    """Map coordinates of a cell: of its corner at offset 0, of its centre at 0.5; ``gt`` is the affine transform."""
    c, r = col + F.lit(float(offset)), row + F.lit(float(offset))
    return F.struct(
        (F.lit(gt[0]) + c * gt[1] + r * gt[2]).alias("x"), (F.lit(gt[3]) + c * gt[4] + r * gt[5]).alias("y")
    )


def xy_cell(gt: list[float], p: Column) -> Column:
    """Row and column nearest to a point, halves to even, for a transform without rotation."""
    return F.struct(
        F.rint((p["y"] - gt[3]) / gt[5]).cast("int").alias("row"), F.rint((p["x"] - gt[0]) / gt[1]).cast("int").alias("col")
    )
