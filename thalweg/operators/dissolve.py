"""Merging units: attributes by rule, geometry by the cells that units cover, and reservoirs out of swallowed basins.

Units are sets of cells, so a union is a relabelling: edges between cells of one label cancel (``rings.outlines``), and
areas of intersections are counts of common cells.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rings
from .store import settled, tasks


def first_known(column: str, order: str) -> Column:
    """The first value that isn't null, by ``order``."""
    c = F.col(column)
    return F.min(F.when(c.isNotNull(), F.struct(F.col(order).alias("o"), c.alias("v"))))["v"]


def dissolve(df: DataFrame, key: str, rules: Mapping[str, str], order: str) -> DataFrame:
    """A row for each value of ``key`` that isn't null: columns by rule, which is first (known), max, min, sum or mean."""
    by = {"max": F.max, "min": F.min, "sum": F.sum, "mean": F.avg}
    made = [(first_known(c, order) if rule == "first" else by[rule](c)).alias(c) for c, rule in rules.items()]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*made)


def merged_cells(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(label, row, col) once each, as a table: the cells of all units of a group; cells (unit, row, col), groups (unit, label)."""
    named = cells.join(groups, "unit").select("label", "row", "col")
    return settled(named.repartition(tasks(cells.count()), "row", "col").distinct(), plain=True)


def union_outlines(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(label, ring, sense, vertices) around the union of each group's units."""
    return rings.outlines(merged_cells(cells, groups))


def cell_area(cells: DataFrame, cell: float = 1.0) -> DataFrame:
    """(label, area, perimeter) of labelled cells (label, row, col)."""
    sides = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((0, 1), (1, 0))]))
    near = cells.select("label", "row", "col", sides.alias("s")).select("label", (F.col("row") + F.col("s.r")).alias("row"), (F.col("col") + F.col("s.c")).alias("col"))
    inner = near.join(cells, ["label", "row", "col"], "left_semi").groupBy("label").agg(F.count(F.lit(1)).alias("inner"))
    n = cells.groupBy("label").agg(F.count(F.lit(1)).alias("n")).join(inner, "label", "left")
    return n.select("label", (F.col("n") * cell**2).alias("area"), ((F.col("n") * 4 - F.coalesce("inner", F.lit(0)) * 2) * cell).alias("perimeter"))


def reservoir_basins(basins: DataFrame, cells: DataFrame, internal: DataFrame, winners: DataFrame, mask: DataFrame, lakes: DataFrame, cell: float = 1.0) -> DataFrame:
    """(DN, lake_id, is_lake, lake_area, frac_lake, n_cells) of the basins after each lake's swallowed ones are one.

    basins (DN); cells (DN, row, col); internal (lake_id, LINKNO) the swallowed links; winners (lake_id, LINKNO) the outlet
    links, swallowed too; mask (lake_id, row, col); lakes (lake_id, Lake_area in km2). A lake none of whose links has a basin
    has no unit. lake_area is in m2; frac_lake is the share of the unit that is lake, from 0 to 1.
    """
    links = internal.select("lake_id", "LINKNO").join(winners.select("lake_id"), "lake_id", "left_semi")
    taken = links.union(winners.select("lake_id", "LINKNO")).distinct().withColumnRenamed("LINKNO", "DN").join(basins.select("DN"), "DN", "left_semi")
    key, n = ["lake_id", "row", "col"], tasks(cells.count() + mask.count())
    unit = taken.join(cells, "DN").select(*key).repartition(n, *key).distinct()
    size = unit.groupBy("lake_id").agg(F.count(F.lit(1)).alias("n_cells"))
    wet = unit.join(mask.select(*key).repartition(n, *key), key, "left_semi").groupBy("lake_id").agg(F.count(F.lit(1)).alias("wet"))
    merged = (
        taken.select("lake_id").distinct().join(winners.withColumnRenamed("LINKNO", "DN"), "lake_id").join(lakes.select("lake_id", "Lake_area"), "lake_id", "left")
        .join(size, "lake_id", "left").join(wet, "lake_id", "left")
    )
    share = F.coalesce(F.try_divide(F.coalesce("wet", F.lit(0)), F.col("n_cells")), F.lit(0.0))
    merged = merged.select(
        "DN", "lake_id", F.lit(1).alias("is_lake"), (F.coalesce("Lake_area", F.lit(0.0)) * 1e6).alias("lake_area"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)).alias("frac_lake"), F.coalesce("n_cells", F.lit(0)).cast("long").alias("n_cells"),
    )
    rest = basins.select("DN").join(taken.select("DN").distinct(), "DN", "left_anti")
    own = cells.groupBy("DN").agg(F.count(F.lit(1)).alias("n_cells"))
    plain = rest.join(own, "DN", "left").select(
        "DN", F.lit(-1).cast("long").alias("lake_id"), F.lit(0).alias("is_lake"), F.lit(0.0).alias("lake_area"), F.lit(0.0).alias("frac_lake"),
        F.coalesce("n_cells", F.lit(0)).cast("long").alias("n_cells"),
    )
    return plain.unionByName(merged)


def estimated_cells(area: Column, cell: float) -> Column:
    """Cells that an area covers, one at least, halves to even."""
    return F.greatest(F.lit(1), F.rint(area / cell**2).cast("long"))


def balanced_batches(loads: Iterable[tuple], batches: int) -> dict:
    """The batch of each (id, load): the heaviest first, each to the least loaded batch, the first on ties. For lists of
    lakes on the driver, such as which raster windows one job takes; rows of tables are balanced by Spark itself."""
    heap = [(0, b) for b in range(batches)]
    out = {}
    for id_, load in sorted(loads, key=lambda x: (-x[1], x[0])):
        total, b = heapq.heappop(heap)
        out[id_] = b
        heapq.heappush(heap, (total + load, b))
    return out
