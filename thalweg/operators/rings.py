"""Boundary rings of labelled cells, 4-connected, traced by pointers.

Edges between cells of one label cancel, by two windows over cells. Each edge that is left points at the one that goes on from its end;
where two do, at a corner that two cells share, it turns right and so stays with its own cell. Within a tile a kernel
strings edges into chains; chains point at the chain that goes on in the next tile. Doubling of those pointers gives each
ring the least of its chains, there the ring is cut, and each chain its place. So no task holds a ring or a label, only a
tile; the arrays of vertices that ``outlines`` makes in the end are its rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import d8
from . import network
from .store import release, settled, tasks

#: For each side of a cell the code of the neighbour beyond it, where it begins (row, column), and its direction
#: (0 east, 1 south, 2 west, 3 north); the cell lies on its right.
SIDES = [(3, 0, 0, 0), (1, 0, 1, 1), (7, 1, 1, 2), (5, 1, 0, 3)]
STEP = [(0, 1), (1, 0), (0, -1), (-1, 0)]


def _edge_id(y, x, way):
    """A number of an edge by its first corner (from 0, below 2^30) and direction."""
    return F.shiftleft(F.shiftleft(y.cast("long"), 31) + x.cast("long"), 2) + way.cast("long")


def boundary_edges(labels: DataFrame) -> DataFrame:
    """(label, id, y, x, way, to): the edges around cells (label, row, col) of a label, and the edge that goes on from each."""
    n = tasks(labels.count())
    # dealt out by rows of cells once, for the cells and for the window along rows
    cells = labels.select("label", "row", "col").repartition(n, "label", "row").distinct()
    around = d8.with_around(cells, F.lit(True), ("label",), n)
    side = lambda code, dy, dx, way: F.when(
        F.col(f"n{code}").isNull(), F.struct((F.col("row") + dy).alias("y"), (F.col("col") + dx).alias("x"), F.lit(way).alias("way"))
    )
    bare = around.select("label", F.inline(F.array_compact(F.array(*[side(*s) for s in SIDES]))))
    edges = settled(bare.select("label", "y", "x", "way", _edge_id(F.col("y"), F.col("x"), F.col("way")).alias("id")))
    step = lambda i: F.element_at(F.array(*[F.lit(s[i]) for s in STEP]), F.col("way") + 1)
    ends = edges.select("label", "id", "y", "x", "way", (F.col("y") + step(0)).alias("ey"), (F.col("x") + step(1)).alias("ex"))
    begins = edges.select("label", F.col("y").alias("ey"), F.col("x").alias("ex"), F.col("way").alias("next"), F.col("id").alias("to"))
    turn = (F.col("next") - F.col("way") + 3) % 4  # 0 right, 3 ahead, 2 left
    pairs = ends.join(begins, ["label", "ey", "ex"]).groupBy("label", "id", "y", "x", "way")
    return pairs.agg(F.min(F.struct(F.when(turn == 0, 0).when(turn == 3, 1).otherwise(2).alias("t"), "to")).alias("n")).select(
        "label", "id", "y", "x", "way", F.col("n.to").alias("to")
    )


def _chains(tile: pd.DataFrame) -> pd.DataFrame:
    """Chains of the tile's edges: the first one's id, the vertices where they begin, and the id that follows the last."""
    out = []
    for label, part in tile.groupby("label"):
        to = dict(zip(part.id.tolist(), part.to.tolist(), strict=True))
        at = {i: (y, x) for i, y, x in zip(part.id.tolist(), part.y.tolist(), part.x.tolist(), strict=True)}
        inner = set(to.values()) & to.keys()
        heads = [i for i in sorted(to) if i not in inner]
        left = set(to)
        for closed in (False, True):
            for head in heads if not closed else sorted(to):
                if head not in left:
                    continue
                chain, i = [], head
                while i in left:
                    left.discard(i)
                    chain.append(i)
                    i = to[i]
                ys, xs = zip(*(at[i] for i in chain), strict=True)
                out.append((label, head, min(chain), list(ys), list(xs), i))
    return pd.DataFrame(out, columns=["label", "head", "least", "ys", "xs", "to"])


def ring_chains(labels: DataFrame, size: int = 64) -> DataFrame:
    """(label, ring, place, ys, xs): the rings of all labels in pieces; ring is the least id of its edges, place counts edges
    from the ring's cut to the piece's first."""
    edges = boundary_edges(labels)
    tiled = edges.withColumns({"ty": F.floor(F.col("y") / size), "tx": F.floor(F.col("x") / size)})
    kinds = "label long, head long, least long, ys array<int>, xs array<int>, to long"
    chains = settled(tiled.groupBy("ty", "tx").applyInPandas(_chains, kinds))
    named = lambda c: F.struct("label", F.col(c).alias("edge"))
    state = settled(chains.select(named("head").alias("id"), named("to").alias("ahead"), "least"))
    while True:  # ``least`` of the next 2^k chains; once it changes nowhere, it is that of the whole ring
        ahead = state.select(F.col("id").alias("ahead"), F.col("ahead").alias("next"), F.col("least").alias("more"))
        joined = state.join(ahead, "ahead").select("id", F.col("next").alias("ahead"), F.least("least", "more").alias("least"), (F.col("more") < F.col("least")).alias("went"))
        new = settled(joined)
        release(state)
        state = new
        if state.where("went").isEmpty():
            break
    rings = settled(chains.join(state.select("id.label", F.col("id.edge").alias("head"), F.col("least").alias("ring")), ["label", "head"]))
    release(state)
    # cut before the chain that holds the least edge, and count edges down to the cut
    first = rings.where("least = ring").select("label", F.col("head").alias("to"), F.lit(True).alias("cut"))
    links = rings.join(first, ["label", "to"], "left").select(
        named("head").alias("id"), F.when(F.col("cut").isNull(), named("to")).alias("down"), F.size("ys").cast("long").alias("n")
    )
    below = network.path_folds(links, ["n"]).select("id.label", F.col("id.edge").alias("head"), F.col("n").alias("rest"))
    whole = rings.groupBy("label", "ring").agg(F.sum(F.size("ys")).alias("total"))
    df = rings.join(below, ["label", "head"]).join(whole, ["label", "ring"])
    result = settled(df.select("label", "ring", (F.col("total") - F.col("rest")).alias("place"), "ys", "xs"))
    release(chains, rings)
    return result


def outlines(labels: DataFrame, size: int = 64) -> DataFrame:
    """(label, ring, sense, vertices): boundary rings of labelled cells (label, row, col), corner vertices at each step; sense
    is 1 for rings around cells and -1 for those around holes."""
    chains = ring_chains(labels, size)
    whole = chains.groupBy("label", "ring").agg(F.sort_array(F.collect_list(F.struct("place", "ys", "xs"))).alias("parts"))
    ys, xs = F.flatten("parts.ys"), F.flatten("parts.xs")
    point = lambda y, x: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    open_ = whole.select("label", "ring", F.zip_with(ys, xs, point).alias("v"))
    ring = open_.select("label", "ring", F.concat("v", F.slice("v", 1, 1)).alias("vertices"))
    pairs = F.zip_with(F.slice("vertices", F.lit(1), F.size("vertices") - 1), F.slice("vertices", F.lit(2), F.size("vertices") - 1), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    twice = F.aggregate(pairs, F.lit(0.0), lambda n, k: n + k)
    return ring.select("label", "ring", F.when(twice > 0, 1).otherwise(-1).alias("sense"), "vertices")


def measures(labels: DataFrame, size: int = 64) -> DataFrame:
    """(label, ring, area, perimeter) of each ring, area less than 0 for holes: sums over pieces, no ring as a row."""
    chains = ring_chains(labels, size)
    # the area by Green's theorem needs only steps to the south and north, whose columns are known from the vertices
    step = F.zip_with(F.slice("ys", F.lit(1), F.size("ys") - 1), F.slice("ys", F.lit(2), F.size("ys") - 1), lambda a, b: b - a)
    inner = F.aggregate(F.zip_with(step, F.slice("xs", F.lit(1), F.size("xs") - 1), lambda d, x: d * x), F.lit(0), lambda n, k: n + k)
    # each piece's last step leads to the first vertex of the next, by place, round the ring
    ends = chains.select("label", "ring", "place", F.size("ys").alias("n"), inner.cast("long").alias("inner"), F.get("ys", F.lit(0)).alias("y"), F.element_at("ys", -1).alias("ly"), F.element_at("xs", -1).alias("lx"))
    total = ends.groupBy("label", "ring").agg(F.sum("n").alias("total"))
    ends = settled(ends.join(total, ["label", "ring"]))
    after = ends.select("label", "ring", F.col("place").alias("at"), F.col("y").alias("ny"))
    df = ends.withColumn("at", (F.col("place") + F.col("n")) % F.col("total")).join(after, ["label", "ring", "at"])
    area = F.sum(F.col("inner") + (F.col("ny") - F.col("ly")) * F.col("lx"))
    return df.groupBy("label", "ring").agg(area.cast("double").alias("area"), F.sum("n").cast("double").alias("perimeter"))
