"""Raster algebra over cell tables (row, col, bands): neighbours are equi-joins on shifted coordinates."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import d8
from . import network
from .polygons import packed, unpacked
from .store import release, settled, tasks


def window(cells: DataFrame, xoff: int | Column, yoff: int | Column, xsize: int | Column, ysize: int | Column) -> DataFrame:
    """The cells of a window; comparisons on plain columns prune files."""
    return cells.where(F.col("col").between(xoff, xoff + xsize - 1) & F.col("row").between(yoff, yoff + ysize - 1))


def window_of_bounds(box: Column, gt: list[float], rows: int, cols: int) -> Column:
    """(xoff, yoff, xsize, ysize) of the cells that a box touches; null if any lies off the raster."""
    left, right = (box["minx"] - gt[0]) / gt[1], (box["maxx"] - gt[0]) / gt[1]
    top, low = (box["maxy"] - gt[3]) / gt[5], (box["miny"] - gt[3]) / gt[5]
    x0, y0 = F.floor(F.least(left, right)), F.floor(F.least(top, low))
    xs, ys = F.ceil(F.greatest(left, right)) - x0 + 1, F.ceil(F.greatest(top, low)) - y0 + 1
    inside = (x0 >= 0) & (y0 >= 0) & (x0 + xs <= cols) & (y0 + ys <= rows)
    return F.when(inside, F.struct(x0.alias("xoff"), y0.alias("yoff"), xs.alias("xsize"), ys.alias("ysize")))


def padded_window(box: Column, gt: list[float], rows: int, cols: int, pad: int = 6) -> Column:
    """The window of a box with ``pad`` cells on each side, clipped to the raster; null if nothing is left."""
    left, right = (box["minx"] - gt[0]) / gt[1], (box["maxx"] - gt[0]) / gt[1]
    top, low = (box["maxy"] - gt[3]) / gt[5], (box["miny"] - gt[3]) / gt[5]
    x0 = F.greatest(F.lit(0), F.floor(F.least(left, right)) - pad)
    y0 = F.greatest(F.lit(0), F.floor(F.least(top, low)) - pad)
    x1 = F.least(F.lit(cols), F.ceil(F.greatest(left, right)) + pad)
    y1 = F.least(F.lit(rows), F.ceil(F.greatest(top, low)) + pad)
    some = (x1 > x0) & (y1 > y0)
    return F.when(some, F.struct(x0.alias("xoff"), y0.alias("yoff"), (x1 - x0).alias("xsize"), (y1 - y0).alias("ysize")))


def sample(points: DataFrame, cells: DataFrame, band: str) -> DataFrame:
    """``points`` (row, col, ...) with the band's value there, -1 off the raster."""
    df = points.join(cells.select("row", "col", F.col(band).alias("__v")), ["row", "col"], "left")
    return df.withColumn(band, F.coalesce("__v", F.lit(-1))).drop("__v")


def lookup(rows: DataFrame, key: str, table: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """``rows`` with the columns that ``defaults`` names of the row of ``table`` that has their ``key``, or the defaults where
    there is none or its value is null. Of several rows of a key those of the greatest values count; null keys find none."""
    one = table.groupBy(key).agg(F.max(F.struct(*defaults)).alias("__found"))
    kept = [c for c in rows.columns if c not in defaults]
    found = [F.coalesce(F.col("__found")[c], F.lit(v).cast(table.schema[c].dataType)).alias(c) for c, v in defaults.items()]
    return rows.join(one, key, "left").select(*kept, *found)


def burn(polygons: DataFrame, rows: int, cols: int, band: int = 256) -> DataFrame:
    """(lake_id, row, col) of each cell whose closed square meets the polygon, in cell units (x column, y row).

    ``polygons``: (lake_id, ring) or (lake_id, rings), what lies within an odd number of rings being inside. Tall polygons
    are dealt out by bands of rows, so a task holds a band of one and never all cells of a large lake.
    """
    rings = F.col("rings") if "rings" in polygons.columns else F.array("ring")
    ys = F.transform(F.flatten(rings), lambda v: v["y"])
    low = F.greatest(F.floor(F.array_min(ys)) - 1, F.lit(0))
    high = F.least(F.ceil(F.array_max(ys)), F.lit(rows - 1))
    some = polygons.select("lake_id", rings.alias("rings"), low.alias("low"), high.alias("high")).where("low <= high")
    bands = some.select("lake_id", "rings", "low", "high", F.explode(F.sequence(F.floor(F.col("low") / band), F.floor(F.col("high") / band))).alias("band"))
    bands = bands.select("lake_id", "rings", F.greatest("low", F.col("band") * band).alias("low"), F.least("high", (F.col("band") + 1) * band - 1).alias("high"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lakes, lows, highs = (batch.column(c) for c in ("lake_id", "low", "high"))
            for i, each in enumerate(unpacked(batch, "polygon")):
                edges = np.vstack([np.hstack([v[:-1], v[1:]]) for v in each if len(v) > 1])
                cells = _touched(edges, lows[i].as_py(), highs[i].as_py(), cols)
                own = pa.array([lakes[i].as_py()] * len(cells), pa.int64())
                yield pa.RecordBatch.from_arrays([own, pa.array(cells[:, 0]), pa.array(cells[:, 1])], ["lake_id", "row", "col"])

    flat = bands.select(F.col("lake_id").cast("long").alias("lake_id"), packed(F.col("rings")).alias("polygon"), "low", "high")
    flat = flat.repartition(polygons.sparkSession.sparkContext.defaultParallelism)  # few rows of much work each
    return flat.mapInArrow(run, "lake_id long, row int, col int")


def _touched(edges: np.ndarray, first: int, last: int, cols: int) -> np.ndarray:
    """Cells by edges (ax, ay, bx, by) that cross them, closed, and by centres inside, one row of cells at a time."""
    low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    out = []
    for r in range(first, last + 1):
        ax, ay, bx, by = edges[(low <= r + 1) & (high >= r)].T
        # the part of each edge between the row's top and bottom
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.sort(np.array([(r - ay) / (by - ay), (r + 1 - ay) / (by - ay)]), axis=0)
        t = np.where(ay == by, [[0.0], [1.0]], np.clip(t, 0.0, 1.0))
        ends = np.sort(ax + t * (bx - ax), axis=0)
        hits = np.zeros(cols + 1, int)
        np.add.at(hits, np.clip(np.ceil(ends[0] - 1), 0, cols).astype(int), 1)
        np.add.at(hits, np.clip(np.floor(ends[1]) + 1, 0, cols).astype(int), -1)
        hit = np.cumsum(hits[:-1]) > 0
        y = r + 0.5
        across = (ay > y) != (by > y)
        at = np.sort((bx - ax)[across] * (y - ay[across]) / (by - ay)[across] + ax[across])
        hit |= (len(at) - np.searchsorted(at, np.arange(cols) + 0.5, side="right")) % 2 == 1
        k = np.flatnonzero(hit).astype(np.int32)
        out.append(np.stack([np.full_like(k, r), k], 1))
    return np.concatenate(out)


def shoreline(mask: DataFrame) -> DataFrame:
    """Lake cells with fewer than eight neighbours in their lake."""
    around = d8.with_around(mask, F.lit(True), ("lake_id",))
    return around.where(~_surrounded()).select(*mask.columns)


def _surrounded() -> Column:
    """Whether a cell of ``d8.with_around`` has all eight neighbours."""
    return reduce(Column.__and__, [F.col(f"n{code}").isNotNull() for code, *_ in d8.OFFSETS])


def flow_targets(cells: DataFrame) -> DataFrame:
    """``cells`` (row, col, fdr) with trow, tcol: the cell that each flows to."""
    code = F.col("fdr")
    return cells.withColumn("trow", F.col("row") + d8.row_step(code)).withColumn("tcol", F.col("col") + d8.col_step(code))


def exits(shore: DataFrame, mask: DataFrame, cells: DataFrame) -> DataFrame:
    """Shore cells on a stream whose flow leaves their lake."""
    inside = mask.select("lake_id", F.col("row").alias("trow"), F.col("col").alias("tcol"))
    on = flow_targets(shore.join(cells.where("src = 1"), ["row", "col"]))
    return on.join(inside, ["lake_id", "trow", "tcol"], "left_anti").drop("trow", "tcol")


def _arrivals(cells: DataFrame) -> DataFrame:
    """(row, col, nrow, ncol): the cell that each of ``cells`` (row, col, fdr) flows to, and the cell itself."""
    on = flow_targets(cells.where("fdr between 1 and 8"))
    return on.select(F.col("trow").alias("row"), F.col("tcol").alias("col"), F.col("row").alias("nrow"), F.col("col").alias("ncol"))


def inflows(shore: DataFrame, mask: DataFrame, cells: DataFrame) -> DataFrame:
    """Shore cells on a stream into which a stream cell outside their lake flows."""
    streams = cells.where("src = 1")
    on = shore.join(streams.select("row", "col"), ["row", "col"], "left_semi")
    near = on.join(_arrivals(streams), ["row", "col"])
    inside = mask.select("lake_id", F.col("row").alias("nrow"), F.col("col").alias("ncol"))
    return near.join(inside, ["lake_id", "nrow", "ncol"], "left_anti").select(*on.columns).distinct()


def best_per_link(candidates: DataFrame, order: str, least: bool) -> DataFrame:
    """One cell of each (lake_id, link_no): the greatest or least ``order``, the first cell by row and column on ties."""
    rank = F.struct((F.col(order) if least else -F.col(order)).alias("o"), "row", "col")
    best = candidates.groupBy("lake_id", "link_no").agg(F.min(F.struct(rank.alias("r"), F.col(order).alias("v"))).alias("b"))
    return best.select("lake_id", "link_no", F.col("b.r.row").alias("row"), F.col("b.r.col").alias("col"), F.col("b.v").alias(order))


def most_upstream(candidates: DataFrame, spans: DataFrame) -> DataFrame:
    """Candidates (lake_id, link_no, ...) without those that another of their lake lies upstream of; ``spans`` of the links
    from ``network.intervals``."""
    lower = network.has_other_below(candidates, "lake_id", spans).where("above").select("lake_id", "link_no")
    return candidates.join(lower, ["lake_id", "link_no"], "left_anti")


def most_downstream(candidates: DataFrame, spans: DataFrame) -> DataFrame:
    """Candidates (lake_id, link_no, ...) without those that another of their lake lies downstream of."""
    upper = network.has_other_below(candidates, "lake_id", spans).where("below").select("lake_id", "link_no")
    return candidates.join(upper, ["lake_id", "link_no"], "left_anti")


def resolved_inflows(candidates: DataFrame, spans: DataFrame, order: str) -> DataFrame:
    """Of the most upstream links of each lake, the cell of the least ``order``: (lake_id, link_no, row, col, order)."""
    return best_per_link(most_upstream(candidates, spans), order, True)


def separate(inflow: DataFrame, outflow: DataFrame, mask: DataFrame, cells: DataFrame) -> DataFrame:
    """Inflows (lake_id, row, col) that lie on an outflow cell move to the first stream neighbour outside the lake that
    flows into them, in the order E, NE, N, NW, W, SW, S, SE; without one they stay."""
    clash = inflow.join(outflow.select("lake_id", "row", "col").distinct(), ["lake_id", "row", "col"], "left_semi")
    inside = mask.select("lake_id", F.col("row").alias("nrow"), F.col("col").alias("ncol"))
    near = clash.select("lake_id", "row", "col").join(_arrivals(cells.where("src = 1")), ["row", "col"])
    near = near.withColumn("code", d8.encode(F.col("nrow") - F.col("row"), F.col("ncol") - F.col("col")))
    near = near.join(inside, ["lake_id", "nrow", "ncol"], "left_anti")
    moved = near.groupBy("lake_id", "row", "col").agg(F.min(F.struct("code", "nrow", "ncol")).alias("m"))
    df = inflow.join(moved, ["lake_id", "row", "col"], "left")
    return df.select(
        "lake_id",
        F.coalesce(F.col("m.nrow"), F.col("row")).alias("row"),
        F.coalesce(F.col("m.ncol"), F.col("col")).alias("col"),
        F.col("m").isNotNull().alias("moved"),
    )


def conflicts(mask: DataFrame, sizes: DataFrame) -> DataFrame:
    """(row, col, winner) of cells in two lakes or more: the largest lake, the least id on ties; sizes (lake_id, size)."""
    df = mask.join(sizes, "lake_id").repartition(tasks(mask.count()), "row", "col").groupBy("row", "col")
    best = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("size", (-F.col("lake_id")).alias("neg"))).alias("b"))
    return best.where("n > 1").select("row", "col", (-F.col("b.neg")).alias("winner"))


def merge_patches(cells: DataFrame, patches: DataFrame, won: DataFrame) -> DataFrame:
    """``cells`` (row, col, fdr) with the edits of ``patches`` (lake_id, seq, row, col, new_fdr): in contested cells only
    those of the winner, of several the last by seq."""
    free = patches.join(won, ["row", "col"], "left").where("winner is null or winner = lake_id")
    last = free.groupBy("row", "col").agg(F.max_by("new_fdr", "seq").alias("new_fdr"))
    df = cells.join(last, ["row", "col"], "left")
    return df.withColumn("fdr", F.coalesce("new_fdr", "fdr")).drop("new_fdr")


def edits(before: DataFrame, after: DataFrame) -> DataFrame:
    """(row, col, new_fdr) of the cells that changed."""
    new = after.select("row", "col", F.col("fdr").alias("new_fdr"))
    return before.join(new, ["row", "col"]).where("not fdr <=> new_fdr").select("row", "col", "new_fdr")


def common_value(mask: DataFrame, cells: DataFrame, band: str) -> DataFrame:
    """(lake_id, value): the most common positive value in each lake, the least on ties."""
    counts = mask.join(cells.where(F.col(band) > 0), ["row", "col"]).groupBy("lake_id", F.col(band).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("lake_id").agg(F.max(F.struct("n", (-F.col("value")).alias("neg"))).alias("b"))
    return best.select("lake_id", (-F.col("b.neg")).alias("value"), F.col("b.n").alias("n"))


def local_centroid(mask: DataFrame, shore: DataFrame, cells: int = 10) -> DataFrame:
    """(lake_id, row, col): the mean of the lake's cells nearest to its cell of ``shore`` (lake_id, srow, scol), that one left
    out; ties by row and column."""
    df = mask.join(shore, "lake_id").where("row <> srow or col <> scol")
    far = F.pow(F.col("row") - F.col("srow"), 2) + F.pow(F.col("col") - F.col("scol"), 2)
    near = df.withColumn("__k", F.row_number().over(Window.partitionBy("lake_id").orderBy(far, "row", "col"))).where(F.col("__k") <= cells)
    return near.groupBy("lake_id").agg(F.avg("row").alias("row"), F.avg("col").alias("col"))


def steepest(heights: DataFrame) -> DataFrame:
    """(row, col, fdr): the direction of the steepest positive drop by distance, the least code on ties, 0 for pits."""
    around = d8.with_around(heights.select("row", "col", "z"), F.col("z"))
    return around.select("row", "col", downhill().alias("fdr"))


def downhill() -> Column:
    """The direction that ``steepest`` gives a cell with z and, from ``d8.with_around``, those of its neighbours."""
    drops = []
    for code, dr, dc in d8.OFFSETS:
        drop = (F.col("z") - F.col(f"n{code}")) / (F.sqrt(F.lit(2.0)) if dr and dc else F.lit(1.0))
        drops.append(F.when(drop > 0, F.struct(drop.alias("drop"), F.lit(-code).alias("neg"))))
    return F.coalesce(-F.greatest(*drops)["neg"], F.lit(0))


#: Marks what flows into a cell from other tiles, beside the cells that flow nowhere (-1).
_INFLOW = -2


def _within(tile: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Of a tile's cells (id, down, one, edge), and what flows into some (down ``_INFLOW``): ids and downs in order, the sums
    of one and of edge over all cells of the tile that drain through each, and the place of the last cell on its way in the
    tile; and whether that way ends in a ring, in which case the cell is its own last."""
    ids, down, one, edge = (tile[c].to_numpy() for c in ("id", "down", "one", "edge"))
    own = down != _INFLOW
    order = np.argsort(ids[own])
    names, down = ids[own][order], down[own][order]
    at = np.searchsorted(names, ids)
    sums = np.zeros((len(names), 2), np.int64)
    np.add.at(sums, at, np.stack([one, edge], 1))
    near = np.minimum(np.searchsorted(names, down), len(names) - 1)
    ahead = np.where(names[near] == down, near, -1)
    here = np.arange(len(names))
    last = np.where(ahead >= 0, ahead, here)
    for _ in range(len(names).bit_length()):
        live = np.flatnonzero(ahead >= 0)
        if not len(live):
            break
        more = np.zeros_like(sums)
        np.add.at(more, ahead[live], sums[live])
        sums += more
        ahead[live] = ahead[ahead[live]]
        last = last[last]
    ring = ahead >= 0
    return names, down, sums[:, 0], sums[:, 1], np.where(ring, here, last), ring


def _accumulated(nodes: DataFrame, cols: int, size: int) -> DataFrame:
    """(row, col, total, edges): of cells ``nodes`` (id, down, -1 where water ends, edge) how many, and how many edge cells,
    drain through each. A pass within tiles gives the last cells of ways in a tile, which alone are accumulated over the
    whole grid by joins; another adds what flows in over the tiles' borders."""
    tile = [F.floor(F.floor(F.col("id") / cols) / size).alias("trow"), F.floor(F.col("id") % cols / size).alias("tcol")]
    nodes = settled(nodes.select("id", "down", F.lit(1).cast("long").alias("one"), "edge"))
    by_tile = lambda df: df.select(*tile, "id", "down", "one", "edge")

    def ends(part: pd.DataFrame) -> pd.DataFrame:
        names, down, one, edge, last, ring = _within(part)
        row, col = np.divmod(names, cols)
        rim = np.isin(row % size, (0, size - 1)) | np.isin(col % size, (0, size - 1)) | ring
        leads = down[last] >= 0
        leaves, enters = (last == np.arange(len(names))) & leads, rim & leads
        out = {"id": (names, names), "to": (down, names[last]), "one": (one, one), "edge": (edge, edge)}
        kind = np.repeat([True, False], [leaves.sum(), enters.sum()])
        return pd.DataFrame({c: np.concatenate([a[leaves], b[enters]]) for c, (a, b) in out.items()}).assign(leaves=kind)

    def whole(part: pd.DataFrame) -> pd.DataFrame:
        names, _, one, edge, *_ = _within(part)
        row, col = np.divmod(names, cols)
        return pd.DataFrame({"row": row, "col": col, "total": one, "edges": edge})

    found = settled(by_tile(nodes).groupBy("trow", "tcol").applyInPandas(ends, "id long, to long, one long, edge long, leaves boolean"))
    leaves = found.where("leaves").drop("leaves")
    enters = found.where("not leaves").select(F.col("id").alias("to"), F.col("to").alias("down"))
    total = network.accumulate(leaves.join(enters.hint("merge"), "to", "left").select("id", "down", "one", "edge"), "one", more=["edge"])
    passed = leaves.select("id", "to").join(total.hint("merge"), "id").groupBy(F.col("to").alias("id"))
    passed = passed.agg(F.sum("total").alias("one"), F.sum("edge").alias("edge")).select("id", F.lit(_INFLOW).cast("long").alias("down"), "one", "edge")
    both = by_tile(nodes).union(by_tile(passed))
    result = settled(both.groupBy("trow", "tcol").applyInPandas(whole, "row int, col int, total long, edges long"), plain=True)
    release(nodes, found, total)
    return result


def walk_ends(nodes: DataFrame, cols: int, size: int = 256) -> DataFrame:
    """(row, col, end): the last cell on the walk from each of ``nodes`` (id, down null at ends), as ``network.path_folds``: within
    tiles first, over tiles by joins of their last cells alone."""
    tile = [F.floor(F.floor(F.col("id") / cols) / size).alias("trow"), F.floor(F.col("id") % cols / size).alias("tcol")]
    zero = F.lit(0).cast("long")
    nodes = settled(nodes.select("id", F.coalesce("down", F.lit(-1)).alias("down")))
    by_tile = lambda df, value: df.select(*tile, "id", "down", value.alias("one"), zero.alias("edge"))

    def ends(part: pd.DataFrame) -> pd.DataFrame:
        names, down, *_, last, ring = _within(part)
        row, col = np.divmod(names, cols)
        enters = np.isin(row % size, (0, size - 1)) | np.isin(col % size, (0, size - 1)) | ring
        leaves = (last == np.arange(len(names))) & (down >= 0)
        kind = np.repeat([True, False], [leaves.sum(), enters.sum()])
        return pd.DataFrame({"id": np.concatenate([names[leaves], names[enters]]), "to": np.concatenate([down[leaves], names[last][enters]]), "leaves": kind})

    def whole(part: pd.DataFrame) -> pd.DataFrame:
        far = part[part.down == _INFLOW]
        names, _, *_, last, _ = _within(part[part.down != _INFLOW])
        end = names.copy()
        end[np.searchsorted(names, far.id.to_numpy())] = far.one.to_numpy()
        row, col = np.divmod(names, cols)
        return pd.DataFrame({"row": row, "col": col, "end": end[last]})

    found = settled(by_tile(nodes, zero).groupBy("trow", "tcol").applyInPandas(ends, "id long, to long, leaves boolean"))
    leaves = found.where("leaves").select("id", "to")
    enters = found.where("not leaves").select(F.col("id").alias("to"), F.col("to").alias("down"))
    over = leaves.join(enters.hint("merge"), "to", "left").select("id", "down")
    stops = enters.select(F.col("down").alias("id")).distinct().join(leaves.select("id").hint("merge"), "id", "left_anti")
    far = network.path_folds(over.union(stops.select("id", F.lit(None).cast("long").alias("down"))))
    known = far.join(leaves.select("id").hint("merge"), "id", "left_semi").select("id", F.lit(_INFLOW).cast("long").alias("down"), "end")
    both = by_tile(nodes, zero).union(by_tile(known, F.col("end")))
    result = settled(both.groupBy("trow", "tcol").applyInPandas(whole, "row int, col int, end long"), plain=True)
    release(nodes, found, far)
    return result


def contributing(cells: DataFrame, cols: int, check_edges: bool = False, size: int = 256) -> DataFrame:
    """(row, col, ad8): how many cells drain through each, itself included. ``cells`` (row, col, fdr), ids below 2^62.

    With ``check_edges`` it is null for cells that an edge cell, one without all eight neighbours, drains through: what lies
    beyond may drain there too.
    """
    nodes = _grid_nodes(cells, cols).select("id", F.coalesce("down", F.lit(-1)).alias("down"), "edge")
    ad8 = F.when(F.col("edges") == 0, F.col("total")) if check_edges else F.col("total")
    return _accumulated(nodes, cols, size).select("row", "col", ad8.alias("ad8"))


def _grid_nodes(cells: DataFrame, cols: int) -> DataFrame:
    """(id, down, edge) of ``cells`` (row, col, fdr): numbers of each cell and of that which it flows to, null where it flows
    nowhere or off the grid; edge is 1 for cells without all eight neighbours, else 0."""
    key = lambda r, c: F.col(r).cast("long") * cols + F.col(c)
    df = flow_targets(d8.with_around(cells.select("row", "col", "fdr"), F.lit(True)))
    there = F.coalesce(*[F.when(F.col("fdr") == code, F.col(f"n{code}")) for code, *_ in d8.OFFSETS], F.lit(False))
    on = there & F.col("tcol").between(0, cols - 1)
    edge = F.when(_surrounded(), 0).otherwise(1).cast("long")
    return df.select(key("row", "col").alias("id"), F.when(on, key("trow", "tcol")).alias("down"), edge.alias("edge"))


def grid_order(cells: DataFrame, cols: int) -> DataFrame:
    """(row, col, ord): Strahler's order of each cell of the flow grid ``cells`` (row, col, fdr), 1 where no cell drains in.

    Cells that flow off the grid, or nowhere, end their trees.
    """
    order = network.strahler(_grid_nodes(cells, cols).select("id", "down"))
    return order.select(F.floor(F.col("id") / cols).cast("int").alias("row"), (F.col("id") % cols).cast("int").alias("col"), "ord")


def snap(points: DataFrame, cells: DataFrame, most: int = 25) -> DataFrame:
    """``points`` (pt, row, col) with srow, scol, steps: the first stream cell down the flow within ``most`` steps."""
    step = flow_targets(cells).select("row", "col", "src", "fdr", "trow", "tcol")
    at = points.select("pt", "row", "col", F.lit(0).alias("steps"))
    found = None
    for _ in range(most + 1):
        here = at.join(step, ["row", "col"])
        hit = here.where("src = 1").select("pt", F.col("row").alias("srow"), F.col("col").alias("scol"), "steps")
        found = hit if found is None else found.union(hit)
        at = here.where("src <> 1 and fdr between 1 and 8").select("pt", F.col("trow").alias("row"), F.col("tcol").alias("col"), (F.col("steps") + 1).alias("steps"))
        if at.isEmpty():
            break
        at = settled(at)
    return points.join(found, "pt", "left")


def window_cells(windows: DataFrame, cells: DataFrame, size: int = 64) -> DataFrame:
    """The cells of each window (lake_id, w: a struct of xoff, yoff, xsize, ysize), by an equi-join on tiles of the grid: the
    planner takes a generator's rows for as few as those before it and broadcasts them, so windows give tiles, not cells."""
    w = F.col("w")
    tiles = lambda low, n: F.explode(F.sequence(F.floor(low / size), F.floor((low + n - 1) / size)))
    at = windows.select("lake_id", "w", tiles(w["yoff"], w["ysize"]).alias("__trow"))
    at = at.select("lake_id", F.col("w").alias("__w"), "__trow", tiles(w["xoff"], w["xsize"]).alias("__tcol"))
    tiled = cells.withColumn("__trow", F.floor(F.col("row") / size)).withColumn("__tcol", F.floor(F.col("col") / size))
    met = window(tiled.join(at, ["__trow", "__tcol"]), *(F.col("__w")[c] for c in ("xoff", "yoff", "xsize", "ysize")))
    return met.select("row", "col", "lake_id", *[c for c in cells.columns if c not in ("row", "col")])


def stream_network(cells: DataFrame, cols: int, splits: DataFrame | None = None, grid: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Links of the streams, and if wanted the grid (row, col, WSNO) of the link that each cell drains to (-1 if none).

    ``cells``: (row, col, fdr, z, ad8, stream) with stream true on stream cells. A link is a run of stream cells from a head,
    a junction or the cell after one of ``splits`` (row, col: pour points, the last cells of their links) to the cell before
    the next; its number is that of its last cell, row * cols + col. Length includes the step to the link downstream.
    """
    key = lambda r, c: F.col(r).cast("long") * cols + F.col(c)
    inside = F.col("tcol").between(0, cols - 1) & (F.col("trow") >= 0) & F.col("fdr").between(1, 8)
    on = flow_targets(cells).select("row", "col", "z", "ad8", "stream", "fdr", key("row", "col").alias("id"), F.when(inside, key("trow", "tcol")).alias("to"))
    on = settled(on)
    streams = on.where("stream")
    known = streams.select(F.col("id").alias("to"), F.col("row").alias("trow"), F.col("col").alias("tcol"), F.col("z").alias("tz"))
    streams = settled(streams.join(known, "to", "left").withColumn("to", F.when(F.col("trow").isNotNull(), F.col("to"))))
    ups = streams.where("to is not null").groupBy(F.col("to").alias("id")).agg(F.count(F.lit(1)).alias("ups"))
    cut = splits.select(key("row", "col").alias("id"), F.lit(True).alias("cut")) if splits is not None else ups.select("id", F.lit(True).alias("cut")).where("false")
    marked = streams.join(ups, "id", "left").join(cut.distinct(), "id", "left")
    marked = settled(marked.withColumn("ups", F.coalesce("ups", F.lit(0))).withColumn("cut", F.coalesce("cut", F.lit(False))))
    single = marked.where("ups = 1").select(F.col("id").alias("to"), F.lit(True).alias("single"))
    far = F.when(F.col("to").isNull(), 0.0).when(F.col("fdr") % 2 == 0, F.sqrt(F.lit(2.0))).otherwise(1.0)
    steps = marked.join(single, "to", "left").select(
        "id", F.when(F.coalesce("single", F.lit(False)) & ~F.col("cut"), F.col("to")).alias("down"), far.alias("Length"), F.lit(1).cast("long").alias("n_cells")
    )
    runs = settled(network.path_folds(steps, ["Length", "n_cells"]))
    after = marked.where("cut and to is not null").select(F.col("to").alias("id"))
    heads = marked.where("ups <> 1").select("id").union(after).distinct()
    first = marked.select("id", F.col("row").alias("row0"), F.col("col").alias("col0"), F.col("z").alias("z0"), F.col("ad8").alias("USContArea"))
    last = marked.select(F.col("id").alias("end"), "row", "col", "z", "ad8", "to", "trow", "tcol", "tz")
    links = settled(runs.join(heads, "id").join(first, "id").join(last, "end"))
    below = links.select(F.col("id").alias("to"), F.col("end").alias("below"))
    links = settled(links.join(below, "to", "left"))
    nodes = links.select(F.col("end").alias("id"), F.col("below").alias("down"), "Length")
    order = network.strahler(nodes.select("id", "down")).withColumnRenamed("id", "end")
    out = network.path_sums(nodes, "Length").select(F.col("id").alias("end"), F.col("below").alias("DOUTEND"))
    inflows = nodes.where("down is not null").groupBy(F.col("down").alias("end")).agg(F.sort_array(F.collect_list("id")).alias("us"))
    straight = F.hypot(F.col("row0") - F.coalesce("trow", "row"), F.col("col0") - F.coalesce("tcol", "col"))
    drop = F.col("z0") - F.coalesce("tz", "z")
    none = F.lit(-1).cast("long")
    table = links.join(order, "end").join(out, "end").join(inflows, "end", "left").select(
        F.col("end").alias("LINKNO"),
        F.coalesce("below", none).alias("DSLINKNO"),
        F.coalesce(F.get("us", F.lit(0)), none).alias("USLINKNO1"),
        F.coalesce(F.get("us", F.lit(1)), none).alias("USLINKNO2"),
        F.col("ord").alias("strmOrder"),
        "Length",
        "n_cells",
        F.col("ad8").alias("DSContArea"),
        "USContArea",
        drop.alias("strmDrop"),
        F.when(F.col("Length") > 0, drop / F.nullif("Length", F.lit(0.0))).otherwise(0.0).alias("Slope"),
        straight.alias("StraightL"),
        "DOUTEND",
        F.col("end").alias("WSNO"),
    )
    if not grid:
        return table, None
    walks = walk_ends(on.select("id", F.when(~F.col("stream"), F.col("to")).alias("down")), cols)
    ends = runs.select(F.col("id").alias("end"), F.col("end").alias("WSNO"))
    return table, walks.join(ends, "end", "left").select("row", "col", F.coalesce("WSNO", none).alias("WSNO"))
