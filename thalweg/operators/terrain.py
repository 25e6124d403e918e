"""Terrain conditioning over tiles: depressions filled to their spill levels, and flow directions across flats.

Tiles are handled by a kernel each; what crosses their borders is solved by joins over border cells. No task holds more
than a tile, whatever the size of a depression or a flat.

Cells without a height (null, or absent) are outside: water leaves the grid beside them. Empty tables give empty results.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import d8
from . import network, raster
from .store import release, settled

STEPS = [(r, c) for _, r, c in d8.OFFSETS]
#: The node that stands for all that lies outside the grid.
OUTSIDE = -1
_TILED = "trow int, tcol int, row int, col int"


def _tile(c: str, size: int) -> Column:
    return F.floor(F.col(c) / size).cast("int")


def cell_id(row: Column, col: Column) -> Column:
    """A number of a cell by its row and column, both from 0 and below 2^31."""
    return F.shiftleft(row.cast("long"), 32) + col.cast("long")


def _flood(z: dict) -> tuple[dict, dict, dict]:
    """Of cells' heights: neighbours of each border cell, level of each cell to spill over the border, border cell it spills to."""
    inside = {k: sum((k[0] + r, k[1] + c) in z for r, c in STEPS) for k in z}
    border = {k: n for k, n in inside.items() if n < len(STEPS)}
    edge = [(z[k], *k) for k in border]
    heapq.heapify(edge)
    owner, filled = {k: k for k in border}, {}
    while edge:
        h, r, c = heapq.heappop(edge)
        filled[r, c] = h
        for dr, dc in STEPS:
            n = (r + dr, c + dc)
            if n in z and n not in owner:
                owner[n] = owner[r, c]
                heapq.heappush(edge, (max(h, z[n]), *n))
    return border, filled, owner


def _passes(filled: dict, owner: dict) -> list[tuple]:
    """(level, a, b): the lowest passes that join all watersheds of a tile, one fewer than these (a least spanning tree)."""
    least: dict = {}
    for k, h in filled.items():
        for dr, dc in STEPS:
            n = (k[0] + dr, k[1] + dc)
            if n in filled and owner[k] < owner[n]:
                pair, level = (owner[k], owner[n]), max(h, filled[n])
                least[pair] = min(level, least.get(pair, level))
    root: dict = {}

    def find(k):
        while root.get(k, k) != k:
            root[k] = root.get(root[k], root[k])
            k = root[k]
        return k

    kept = []
    for level, a, b in sorted((h, a, b) for (a, b), h in least.items()):
        x, y = find(a), find(b)
        if x != y:
            root[x] = y
            kept.append((level, a, b))
    return kept


def spill_levels(passes: DataFrame) -> DataFrame:
    """(id, level): the least, over all ways from a node to OUTSIDE, of the greatest level on the way; ``passes``: (a, b, level).

    Rounds of Boruvka's kind: each group of nodes but that of OUTSIDE takes its lowest pass out, which all its nodes must
    reach, and groups joined by passes become one. Groups at least halve in number a round, and each round works on
    groups alone; the levels of groups are handed down to their nodes at the end. Passes rank by level and then by the
    groups that they join, so that the choices of a round close no ring; of two groups that choose each other, the lesser
    stays.
    """
    def between(edges: DataFrame) -> DataFrame:
        low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        return edges.where("a <> b").select(low, high, "level").groupBy("a", "b").agg(F.min("level").alias("level"))

    edges, rounds = settled(between(passes)), []
    while not edges.isEmpty():
        ways = edges.select("a", "b", "level", F.col("a").alias("lo"), F.col("b").alias("hi"))
        ways = ways.union(edges.select(F.col("b"), F.col("a"), "level", F.col("a"), F.col("b")))
        best = ways.where(F.col("a") != OUTSIDE).groupBy("a").agg(F.min(F.struct("level", "lo", "hi", "b")).alias("way"))
        picks = settled(best.select(F.col("a").alias("id"), F.col("way.b").alias("to"), F.col("way.level").alias("level")))
        back = picks.select(F.col("id").alias("to"), F.col("to").alias("id"), F.lit(True).alias("mutual"))
        stays = F.coalesce("mutual", F.lit(False)) & (F.col("id") < F.col("to"))
        nodes = picks.join(back, ["id", "to"], "left").select("id", F.when(~stays, F.col("to")).alias("down"))
        some = picks.where(F.col("to") == OUTSIDE).limit(1).select(F.lit(OUTSIDE).cast("long").alias("id"), F.lit(None).cast("long").alias("down"))
        ends = network.path_folds(nodes.union(some))
        groups = settled(picks.join(ends, "id").select("id", "level", "end"))
        rounds.append(groups)
        into = groups.select("id", "end")
        df = edges
        for side in ("a", "b"):
            named = into.select(F.col("id").alias(side), F.col("end").alias("to"))
            df = df.join(named, side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
        merged = settled(between(df))
        release(ends, picks, edges)
        edges = merged
    release(edges)
    if not rounds:
        return settled(passes.select(F.col("a").alias("id"), "level").where("false"))
    levels = rounds[-1].select("id", "level")
    for groups in reversed(rounds[:-1]):
        above = levels.select(F.col("id").alias("end"), F.col("level").alias("more"))
        levels = groups.join(above, "end", "left").select("id", F.greatest("level", "more").alias("level"))
    result = settled(levels)
    release(*rounds)
    return result


def fill_pits(heights: DataFrame, size: int = 64) -> DataFrame:
    """``heights`` (row, col, z) with depressions filled to their spill level over the whole grid, from tiles of ``size``.

    A priority flood within each tile labels cells by the border cell that they spill to and finds the lowest passes
    between the watersheds of border cells; those passes, the ones across tile borders and those out of the grid give the
    border cells' levels (``spill_levels``), and each cell is raised to that of its border cell.
    """

    def kernel(tile: pd.DataFrame) -> pd.DataFrame:
        border, filled, owner = _flood({(r, c): h for r, c, h in zip(tile.row, tile.col, tile.z, strict=True)})
        rows = [(*k, h, *owner[k], border.get(k, -1), False) for k, h in filled.items()]
        rows += [(*a, h, *b, -1, True) for h, a, b in _passes(filled, owner)]
        return pd.DataFrame(rows, columns=["row", "col", "z", "orow", "ocol", "inside", "pass"])

    cells = heights.where("z is not null").select(_tile("row", size).alias("trow"), _tile("col", size).alias("tcol"), "row", "col", F.col("z").cast("double").alias("z"))
    kinds = "row int, col int, z double, orow int, ocol int, inside int, pass boolean"
    flooded = settled(cells.groupBy("trow", "tcol").applyInPandas(kernel, kinds))
    own, other = cell_id(F.col("row"), F.col("col")), cell_id(F.col("orow"), F.col("ocol"))
    within = flooded.where("pass").select(own.alias("a"), other.alias("b"), F.col("z").alias("level"))
    border = flooded.where("inside >= 0").select("row", "col", "z", "inside")
    there = border.select(F.col("row").alias("nrow"), F.col("col").alias("ncol"), F.col("z").alias("nz"))
    apart = (_tile("row", size) != _tile("nrow", size)) | (_tile("col", size) != _tile("ncol", size))
    across = settled(d8.neighbours(border).join(there, ["nrow", "ncol"]).where(apart))
    joins = across.select(own.alias("a"), cell_id(F.col("nrow"), F.col("ncol")).alias("b"), F.greatest("z", "nz").alias("level"))
    met = across.groupBy("row", "col").agg(F.count(F.lit(1)).alias("met"))
    outer = border.join(met, ["row", "col"], "left").where(F.col("inside") + F.coalesce("met", F.lit(0)) < len(STEPS))
    out = outer.select(own.alias("a"), F.lit(OUTSIDE).cast("long").alias("b"), F.col("z").alias("level"))
    levels = spill_levels(within.union(joins).union(out))
    found = flooded.where("not pass").select("row", "col", "z", other.alias("id")).join(levels, "id")
    filled = settled(found.select("row", "col", F.greatest("z", "level").alias("z")), plain=True)
    release(flooded, across, levels)
    return filled


def _relaxed(part: pd.DataFrame) -> pd.DataFrame:
    """The tile's own cells with distances settled among all cells given, and whether any became shorter."""
    r0, c0 = part.row.min(), part.col.min()
    shape = (part.row.max() - r0 + 3, part.col.max() - c0 + 3)
    at = (part.row.to_numpy() - r0 + 1, part.col.to_numpy() - c0 + 1)
    z = np.full(shape, np.nan)
    z[at] = part.z
    own = ~part.halo.to_numpy()
    out = part[own][["trow", "tcol", "row", "col", "z"]].copy()
    here = (at[0][own], at[1][own])
    changed = np.zeros(own.sum(), bool)
    for name in ("low", "away"):
        far = np.full(shape, np.inf)
        far[at] = part[name].fillna(np.inf)
        before = far[here]
        while True:
            best = far.copy()
            for dr, dc in STEPS:
                to = (slice(max(dr, 0), shape[0] + min(dr, 0)), slice(max(dc, 0), shape[1] + min(dc, 0)))
                of = (slice(max(-dr, 0), shape[0] + min(-dr, 0)), slice(max(-dc, 0), shape[1] + min(-dc, 0)))
                same = z[to] == z[of]
                best[to] = np.where(same, np.minimum(best[to], far[of] + 1), best[to])
            if (best == far).all():
                break
            far = best
        out[name] = pd.array(np.where(np.isinf(far[here]), 0, far[here]).astype(np.int64), "Int64")
        out.loc[np.isinf(far[here]), name] = pd.NA
        changed |= far[here] < before
    out["changed"] = changed
    return out


def flat_distances(flats: DataFrame, size: int = 64) -> DataFrame:
    """(row, col, low, away): steps along cells of one height from the nearest cells whose ``low`` or ``away`` was given.

    ``flats``: (row, col, z, low, away), low and away null but where steps begin. Distances settle within a tile; those of
    cells at tile borders then pass to the neighbouring tiles, of which only those that hear of changes work in the next
    round. So the rounds grow with the tiles, not the cells, that a flat is long.
    """
    kinds = f"{_TILED}, z double, low long, away long, changed boolean"
    columns = [x.split()[0] for x in kinds.split(", ")]
    state = settled(
        flats.select(_tile("row", size).alias("trow"), _tile("col", size).alias("tcol"), "row", "col", F.col("z").cast("double").alias("z"),
                     F.col("low").cast("long").alias("low"), F.col("away").cast("long").alias("away"), F.lit(True).alias("changed")),
        plain=True,
    )
    first = True
    while True:
        # cells at a tile's border, once for each other tile that has a neighbour of theirs
        near = d8.neighbours(state.where(f"row % {size} in (0, {size - 1}) or col % {size} in (0, {size - 1})"))
        ours = [F.col(c) for c in columns if c not in ("trow", "tcol")]
        halo = near.select(_tile("nrow", size).alias("trow"), _tile("ncol", size).alias("tcol"), *ours, F.col("trow").alias("t"), F.col("tcol").alias("u"))
        halo = halo.where("trow <> t or tcol <> u").drop("t", "u").distinct()
        active = (state if first else halo.where("changed and (low is not null or away is not null)")).select("trow", "tcol").distinct()
        active = settled(active.join(state.select("trow", "tcol").distinct(), ["trow", "tcol"]))
        if active.isEmpty():
            release(active)
            break
        every = state.withColumn("halo", F.lit(False)).unionByName(halo.withColumn("halo", F.lit(True)))
        worked = every.join(active, ["trow", "tcol"], "left_semi").groupBy("trow", "tcol").applyInPandas(_relaxed, kinds)
        rest = state.join(active, ["trow", "tcol"], "left_anti").withColumn("changed", F.lit(False))
        new = settled(worked.select(*columns).union(rest.select(*columns)), plain=True)
        release(state, active)
        state, first = new, False
    result = settled(state.select("row", "col", "low", "away"), plain=True)
    release(state)
    return result


def directions(heights: DataFrame, size: int = 64) -> DataFrame:
    """(row, col, fdr): the steepest drop, as ``raster.steepest``, and across flats a way to where they drain.

    A cell without a lower neighbour flows over its flat: towards the nearest cell of its height that drains (or lies at
    the edge of the grid), and away from higher ground, by two breadth-first distances, ``2 * low - away``. That sum falls
    by one at least with the first step of any shortest way down, so directions form no ring. Cells beside one that
    drains point at it, the least code on ties, as among cells of equal sums. 0 is left at cells on the edge of the grid,
    which drain off it, and in depressions; filled heights have none.
    """
    heights = heights.where("z is not null").select("row", "col", F.col("z").cast("double").alias("z"))
    near = d8.with_around(heights, F.col("z"))
    beyond = [F.col(f"n{code}") for code, *_ in d8.OFFSETS]
    n = sum((F.when(z.isNull(), 0).otherwise(1) for z in beyond), F.lit(0)).alias("n")
    flows = settled(near.select("row", "col", "z", raster.downhill().alias("fdr"), n, F.greatest(*beyond).alias("most")), plain=True)
    still = flows.where("fdr = 0 and n = 8")
    drains = flows.where("fdr > 0 or n < 8").select(F.col("row").alias("nrow"), F.col("col").alias("ncol"), F.col("z").alias("nz"))
    beside = d8.neighbours(still.select("row", "col", "z")).join(drains, ["nrow", "ncol"]).where("z = nz")
    outlets = settled(beside.groupBy("row", "col").agg(F.min("code").alias("code")), plain=True)
    starts = still.join(outlets, ["row", "col"], "left").select(
        "row", "col", "z", F.when(F.col("code").isNotNull(), 1).alias("low"), F.when(F.col("most") > F.col("z"), 1).alias("away")
    )
    far = flat_distances(starts, size)
    over = 2 * F.col("low") - F.coalesce("away", F.lit(0))
    ranked = settled(starts.select("row", "col", "z").join(far, ["row", "col"]).where("low is not null").select("row", "col", "z", "low", over.alias("over")), plain=True)
    other = ranked.select(F.col("row").alias("nrow"), F.col("col").alias("ncol"), F.col("z").alias("nz"), F.col("over").alias("nover"))
    ways = d8.neighbours(ranked.where("low > 1")).join(other, ["nrow", "ncol"]).where("z = nz and nover < over")
    inner = ways.groupBy("row", "col").agg(F.min(F.struct("nover", "code")).alias("way")).select("row", "col", F.col("way.code").alias("code"))
    found = outlets.union(inner).withColumnRenamed("code", "flat")
    result = settled(flows.select("row", "col", "fdr").join(found, ["row", "col"], "left").select("row", "col", F.coalesce("flat", "fdr").cast("int").alias("fdr")), plain=True)
    release(flows, outlets, far, ranked)
    return result
