"""Reservoirs from pour points: each lake's outlet, the links that it swallows, and the network and basins after that.

Inputs: ``points`` (pt, lake_id, point_type inflow or outflow, p), ``streams`` (LINKNO, DSLINKNO, USLINKNO1, line from its
downstream end, Length, strmDrop, StraightL, DOUTEND, DSContArea, strmOrder), ``lakes`` (lake_id, Lake_area in km2, rings),
``basins`` (DN, rings), ``gauges`` (q) and ``overrides`` (lake_id, o), all in one metric plane.

Lakes without an outflow point, or whose outflow points lie at no link, stay out; so do those none of whose links has a
basin. Lakes are in the order of their ids, and where two swallow one link the later one has it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import network, polygons, spatial
from .store import settled


@dataclass(frozen=True)
class Reach:
    """Distances: of a point's links, of gauges, the size of a cell, and the overlap from which a headwater is swallowed."""

    link: float = 5.0
    gauge: float = 750.0
    cell: float = 1000.0
    overlap: float = 180.0
    bucket: float = 5000.0


def outflow_candidates(points: DataFrame, streams: DataFrame, gauges: DataFrame, reach: Reach = Reach()) -> DataFrame:
    """(lake_id, link_no, seq, p, doutend, strm_order, dscontarea, gauge_dist) of the outflow points that lie at a link."""
    out = points.where("point_type = 'outflow'")
    linked = spatial.connect_nodes(out.select("pt", "point_type", "p"), streams.select("LINKNO", "line"), reach.link, reach.bucket)
    near = spatial.nearest_distance(out.select("pt", "p"), gauges.select("q"), "pt", reach.gauge).select("pt", F.col("d").alias("gauge_dist"))
    own = streams.select("LINKNO", F.col("DOUTEND").alias("doutend"), F.col("strmOrder").alias("strm_order"), F.col("DSContArea").alias("dscontarea"))
    df = out.join(linked.select("pt", "LINKNO"), "pt").join(near, "pt").join(own, "LINKNO")
    return df.select("lake_id", F.col("LINKNO").alias("link_no"), F.col("pt").alias("seq"), "p", "doutend", "strm_order", "dscontarea", "gauge_dist")


def outlets(candidates: DataFrame, spans: DataFrame, overrides: DataFrame, reach: Reach = Reach()) -> DataFrame:
    """(lake_id, LINKNO) of each lake's outlet link, of the candidates without others of their lake below them: that nearest
    to the lake's override, if it is within three cells, or else the first in rank."""
    left = settled(network.drop_duplicate_exits(candidates, spans, "strm_order"))
    best = spatial.rank_exits(left, "strm_order").select("lake_id", F.col("link_no").alias("ranked"))
    far = F.hypot(F.col("p.x") - F.col("o.x"), F.col("p.y") - F.col("o.y"))
    named = left.join(overrides, "lake_id").withColumn("d", far).where(F.col("d") <= 3 * reach.cell)
    named = named.groupBy("lake_id").agg(F.min(F.struct("d", "seq", "link_no")).alias("n"))
    df = best.join(named, "lake_id", "left")
    return df.select("lake_id", F.coalesce("n.link_no", "ranked").alias("LINKNO"))


def swallowed_links(points: DataFrame, streams: DataFrame, lakes: DataFrame, candidates: DataFrame, winners: DataFrame, reach: Reach = Reach()) -> DataFrame:
    """(lake_id, LINKNO) of the links that each lake with an outlet swallows: down from its inflow links, and from headwaters
    that lie in it, through the first link of an outflow point; and the outlet link."""
    inflow = points.where("point_type = 'inflow'")
    linked = spatial.connect_nodes(inflow.select("pt", "point_type", "p"), streams.select("LINKNO", "line"), reach.link, reach.bucket)
    starts = inflow.join(linked.select("pt", "LINKNO"), "pt").select("lake_id", "LINKNO")
    rings = lakes.select("lake_id", F.get("rings", F.lit(0)).alias("ring"))
    met = spatial.lines_in_polygons(streams.select("LINKNO", "line"), rings, reach.bucket)
    starts = starts.union(spatial.swallowed_starts(met, streams, reach.overlap)).distinct().join(winners.select("lake_id"), "lake_id", "left_semi")
    stops = candidates.select("lake_id", F.col("link_no").alias("LINKNO")).distinct()
    inner = network.internal_links(starts, network.edges(streams), stops)
    return settled(inner.union(winners.select("lake_id", "LINKNO")).distinct())


def reservoir_units(basins: DataFrame, lakes: DataFrame, swallowed: DataFrame, winners: DataFrame) -> DataFrame:
    """(DN, lake_id, is_lake, lake_area, frac_lake, area): basins that no lake swallows, and a unit for each lake that does.

    lake_area is in m2, frac_lake the share of the unit that is lake, from 0 to 1, by the areas that the lake has in common
    with each of the unit's basins. Basins don't overlap, so the unit's area is the sum of theirs.
    """
    sized = basins.select("DN", "rings", polygons.area(F.col("rings")).alias("own"))
    taken = settled(swallowed.withColumnRenamed("LINKNO", "DN").join(basins.select("DN"), "DN", "left_semi"))
    parts = settled(taken.join(sized, "DN"))
    size = parts.groupBy("lake_id").agg(F.sum("own").alias("area"))
    near = polygons.box_pairs(parts.select("lake_id", "rings"), lakes.select(F.col("lake_id").alias("l"), F.col("rings").alias("others")))
    both = polygons.overlay(near.where("l = lake_id"))
    wet = both.groupBy("lake_id").agg(F.sum(polygons.area(F.col("rings"))).alias("wet"))
    share = F.coalesce(F.try_divide(F.coalesce("wet", F.lit(0.0)), F.col("area")), F.lit(0.0))
    merged = size.join(winners.withColumnRenamed("LINKNO", "DN"), "lake_id").join(lakes.select("lake_id", "Lake_area"), "lake_id", "left").join(wet, "lake_id", "left")
    merged = merged.select(
        "DN", "lake_id", F.lit(1).alias("is_lake"), (F.coalesce("Lake_area", F.lit(0.0)) * 1e6).alias("lake_area"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)).alias("frac_lake"), "area",
    )
    rest = sized.join(taken.select("DN").distinct(), "DN", "left_anti")
    plain = rest.select(
        "DN", F.lit(-1).cast("long").alias("lake_id"), F.lit(0).alias("is_lake"), F.lit(0.0).alias("lake_area"), F.lit(0.0).alias("frac_lake"), F.col("own").alias("area")
    )
    return plain.unionByName(merged)


def reservoirs(
    points: DataFrame, streams: DataFrame, lakes: DataFrame, basins: DataFrame, gauges: DataFrame, overrides: DataFrame, reach: Reach = Reach()
) -> tuple[DataFrame, DataFrame]:
    """The basins (``reservoir_units``) and the streams (``network.contract``, with the lakes' path metrics) after each lake
    has become one unit at its outlet link."""
    points, streams = settled(points), settled(streams)
    nodes = network.as_nodes(network.edges(streams), streams.select("LINKNO"))
    candidates = settled(outflow_candidates(points, streams, gauges, reach))
    winners = settled(outlets(candidates, network.intervals(nodes), overrides, reach))
    swallowed = swallowed_links(points, streams, lakes, candidates, winners, reach)
    some = swallowed.join(basins.select(F.col("DN").alias("LINKNO")), "LINKNO", "left_semi").select("lake_id").distinct()
    winners = settled(winners.join(some, "lake_id", "left_semi"))
    swallowed = settled(swallowed.join(some, "lake_id", "left_semi"))
    units = reservoir_units(basins, lakes, swallowed, winners)
    metrics = network.path_metrics(swallowed, streams, winners)
    into = swallowed.join(winners.withColumnRenamed("LINKNO", "winner"), "lake_id")
    return units, network.contract(streams.drop("line"), into, metrics)
