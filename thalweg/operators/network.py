"""Operators over a functional graph of links (id, down): closures, accumulation, filters, contraction, validation.

Walks use pointer doubling: the rounds grow with the logarithm of the longest path, each is one join by key, and rows never
multiply. Whether a link lies upstream of another is a comparison of intervals (``intervals``); the table of all pairs of
links and ancestors (``closure``) is only for its own export, and for chains known to be short.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from .store import release, settled

ENDS = (-1, 0)


def edges(links: DataFrame, id: str = "LINKNO", down: str = "DSLINKNO", ends: Iterable[int] = ENDS) -> DataFrame:
    """(id, down) without the ends of the network."""
    df = links.select(F.col(id).alias("id"), F.col(down).alias("down"))
    return df.where(F.col("id").isNotNull() & F.col("down").isNotNull() & ~F.col("down").isin(*ends))


def closure(edges: DataFrame) -> DataFrame:
    """(id, anc, hops): every link and each link downstream of it; a cycle adds each of its links once.

    With all pairs up to 2^k hops known, those of exactly 2^k lead to the ones up to twice as far, which are written beside
    them: without cycles each pair is made and written once.
    """
    tables, far = [settled(edges.select("id", F.col("down").alias("anc"), F.lit(1).cast("long").alias("hops")).distinct())], 1
    while not (last := tables[-1].where(F.col("hops") == far)).isEmpty():
        known = reduce(DataFrame.union, tables)
        onward = known.select(F.col("id").alias("via"), "anc", (F.col("hops") + far).alias("hops"))
        found = last.select("id", F.col("anc").alias("via")).join(onward, "via").groupBy("id", "anc").agg(F.min("hops").alias("hops"))
        tables.append(settled(found.join(known.select("id", "anc"), ["id", "anc"], "left_anti")))
        far *= 2
    return reduce(DataFrame.union, tables)


def accumulate(nodes: DataFrame, weight: str, most_rounds: int = 40, more: Iterable[str] = ()) -> DataFrame:
    """(id, total): each node's weight and that of all nodes upstream. ``nodes``: (id, down null at ends, weight). Columns
    ``more`` are summed in the same rounds, under their own names.

    After round i a node holds the sum over paths shorter than 2^i, and points 2^i links ahead: rows never multiply. Only
    nodes that still point at one take part; what the others gain is kept apart and summed at the end.
    """
    first = settled(nodes.select("id", F.col("down").alias("ahead"), F.col(weight).alias("total"), *more))
    values = ["total", *more]
    sums = [F.sum(c).cast(first.schema[c].dataType).alias(c) for c in values]
    tables = [first]
    for _ in range(most_rounds):
        live = tables[-1].where("ahead is not null")
        if live.isEmpty():
            parts = reduce(DataFrame.union, [t.where("ahead is null").select("id", *values) for t in tables])
            total = settled(parts.groupBy("id").agg(*sums), plain=True)
            release(*tables)
            return total
        # what flows on meets what was there: no join, and the nodes that point nowhere any more have no ``ahead``
        flows = live.union(live.select(F.col("ahead").alias("id"), F.lit(None).cast(first.schema["ahead"].dataType), *values))
        met = flows.groupBy("id").agg(F.max("ahead").alias("at"), *sums)
        jump = live.select(F.col("id").alias("key"), F.col("ahead"))
        # nodes without an ``ahead`` aren't live, so their own id finds nothing; it keeps them apart, as nulls wouldn't be
        onward = met.withColumn("key", F.coalesce("at", "id")).join(jump.hint("merge"), "key", "left")
        tables.append(settled(onward.select("id", "ahead", *values)))
    raise ValueError("the network has a cycle")


def path_folds(nodes: DataFrame, sums: Iterable[str] = (), mins: Iterable[str] = ()) -> DataFrame:
    """For each node of ``nodes`` (id, down null at ends, ...) the walk down from it, itself included: end (its last node),
    hops, and the folds of the columns ``sums`` and ``mins`` over it. A ``down`` that is no id ends the walk.

    Nodes whose walk is known are written once; each round only takes up those that aren't there yet. Rounds never
    broadcast: each table would be small enough in files, but they are many, and all pass through the driver.
    """
    sums, mins = [*sums], [*mins]
    known = nodes.select(F.col("id").alias("down"), F.lit(True).alias("there"))
    ahead = F.when(F.coalesce("there", F.lit(False)), F.col("down")).alias("ahead")
    rest = [F.col("id").alias("end"), F.lit(0).cast("long").alias("hops"), *sums, *mins]
    inner = nodes.where("down is not null").join(known, "down", "left").select("id", ahead, *rest)
    outer = nodes.where("down is null").select("id", F.col("down").alias("ahead"), *rest)
    tables = [settled(inner.union(outer))]
    for _ in range(tables[0].count().bit_length() + 2):
        live = tables[-1].where("ahead is not null")
        if live.isEmpty():
            result = settled(reduce(DataFrame.union, [t.where("ahead is null") for t in tables]).drop("ahead"), plain=True)
            release(*tables)
            return result
        # ``end`` and the folds reach up to, but not including, ``ahead``
        state = reduce(DataFrame.union, [*[t.where("ahead is null") for t in tables], live])
        next_ = state.select(F.col("id").alias("ahead"), F.struct(F.col("ahead").alias("to"), "end", "hops", *sums, *mins).alias("__n"))
        n = F.col("__n")
        tables.append(
            settled(
                live.join(next_.hint("merge"), "ahead").select(
                    "id",
                    n["to"].alias("ahead"),
                    n["end"].alias("end"),
                    (F.col("hops") + n["hops"] + 1).alias("hops"),
                    *[(F.col(c) + n[c]).alias(c) for c in sums],
                    *[F.least(F.col(c), n[c]).alias(c) for c in mins],
                )
            )
        )
    raise ValueError("the network has a cycle")


def path_sums(nodes: DataFrame, weight: str) -> DataFrame:
    """(id, below): the sum of the weights of the nodes strictly downstream. ``nodes``: (id, down null at ends, weight)."""
    total = path_folds(nodes.select("id", "down", F.col(weight).alias("below"), F.col(weight).alias("own")).select("id", "down", "below"), ["below"])
    return total.join(nodes.select("id", F.col(weight).alias("own")), "id").select("id", (F.col("below") - F.col("own")).alias("below"))


def as_nodes(edges: DataFrame, *more: DataFrame) -> DataFrame:
    """(id, down null at ends) of all ids of ``edges`` (id, down), and those of tables ``more`` of one column."""
    ids = edges.select("id").union(edges.select("down"))
    for m in more:
        ids = ids.union(m)
    return ids.distinct().join(edges.select("id", "down"), "id", "left")


def intervals(nodes: DataFrame) -> DataFrame:
    """(id, tree, low, high) of a forest of ``nodes`` (id, down null at ends): x drains through y, or is y, if, and only if,
    they are of one tree and low of y <= low of x < high of y. Numbers are places in a walk of each tree that takes a node
    before its inflows."""
    nodes = settled(nodes.select("id", "down").withColumn("one", F.lit(1).cast("long")), plain=True)
    sizes = accumulate(nodes, "one").withColumnRenamed("total", "size")
    tree = settled(nodes.join(sizes, "id"))
    before = Window.partitionBy("down").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    steps = tree.where("down is not null").withColumn("step", 1 + F.coalesce(F.sum("size").over(before), F.lit(0)))
    roots = tree.where("down is null").select("id", "down", "size", F.lit(0).cast("long").alias("step"))
    low = path_folds(steps.select("id", "down", "size", "step").union(roots), ["step"])
    # each tree has numbers of its own: the root's id beside them
    return low.join(sizes, "id").select("id", F.col("end").alias("tree"), F.col("step").alias("low"), (F.col("step") + F.col("size")).alias("high"))


def has_other_below(rows: DataFrame, group: str, spans: DataFrame) -> DataFrame:
    """``rows`` (group, link_no) once each, with below: whether another of the group lies downstream of it, and above: whether
    another lies upstream. One window by place: intervals are nested or apart."""
    links = rows.select(group, "link_no").distinct().join(spans.withColumnRenamed("id", "link_no"), "link_no")
    order = Window.partitionBy(group, "tree").orderBy("low")
    below = F.coalesce(F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1)) > F.col("low"), F.lit(False))
    above = F.coalesce(F.lead("low").over(order) < F.col("high"), F.lit(False))
    return links.select(group, "link_no", below.alias("below"), above.alias("above"))


def drop_duplicate_exits(exits: DataFrame, spans: DataFrame, tiebreak: str) -> DataFrame:
    """``exits`` (lake_id, link_no, seq, tiebreak) without those upstream of another exit of their lake, or on the link of
    one with a greater tiebreak; exits without a link (-1) neither drop nor are dropped. ``spans`` from ``intervals``."""
    on = exits.where("link_no <> -1")
    most = on.groupBy("lake_id", "link_no").agg(F.max(tiebreak).alias("__most"))
    upper = has_other_below(on, "lake_id", spans).where("below").select("lake_id", "link_no", F.lit(True).alias("__upper"))
    df = exits.join(most, ["lake_id", "link_no"], "left").join(upper, ["lake_id", "link_no"], "left")
    stays = (F.col("link_no") == -1) | ((F.col(tiebreak) >= F.col("__most")) & F.col("__upper").isNull())
    return df.where(stays).select(*exits.columns)


def trace_downstream(starts: DataFrame, edges: DataFrame, stops: DataFrame) -> DataFrame:
    """(start, id, hops) of the walk from each ``start`` through its first ``stop``, both included.

    The rows are those of the result: each start gets its hops, and each hop its link by the tables of 2^k links ahead.
    """
    open_ = settled(edges.join(stops.select(F.col("stop").alias("id")).distinct(), "id", "left_anti"))
    hops = path_folds(as_nodes(open_, starts.select("start"))).select(F.col("id").alias("start"), F.col("hops").alias("steps"))
    return walk_steps(starts.select("start").distinct().join(hops, "start"), open_)


def walk_steps(starts: DataFrame, edges: DataFrame) -> DataFrame:
    """(start, id, hops) of the first ``steps`` steps of the walk from each of ``starts`` (start, steps) along ``edges``."""
    starts = settled(starts)
    longest = starts.agg(F.max("steps")).first()[0] or 0
    walk = starts.select("start", F.col("start").alias("id"), F.explode(F.sequence(F.lit(0).cast("long"), "steps")).alias("hops"))
    jump = settled(edges.select("id", "down"))
    for k in range(int(longest).bit_length()):
        far = F.col("hops").bitwiseAND(1 << k) != 0
        walk = settled(walk.join(jump, "id", "left").select("start", F.when(far, F.col("down")).otherwise(F.col("id")).alias("id"), "hops"))
        jump = settled(jump.join(jump.select(F.col("id").alias("down"), F.col("down").alias("next")), "down").select("id", F.col("next").alias("down")))
    return walk


def upstream_of(spans: DataFrame, target: int) -> DataFrame:
    """(id): the link and all links that drain through it; the link alone if it isn't known. ``spans`` from ``intervals``."""
    own = spans.where(F.col("id") == target).select(F.col("tree").alias("t"), F.col("low").alias("from"), F.col("high").alias("to"))
    some = spans.join(F.broadcast(own), (F.col("tree") == F.col("t")) & F.col("low").between(F.col("from"), F.col("to") - 1))  # one row
    return some.select("id").union(spans.sparkSession.range(1).select(F.lit(target).cast("long").alias("id"))).distinct()


def dangling(links: DataFrame, known: DataFrame, id: str = "LINKNO", down: str = "DSLINKNO") -> DataFrame:
    """Links whose downstream id is no outlet and not among the ``known`` ids (column id)."""
    ids = known.select(F.col("id").alias(down)).distinct()
    return links.where(F.col(down) > 0).join(ids, down, "left_anti").select(id, down)


def validate(links: DataFrame, known: DataFrame, id: str = "LINKNO", down: str = "DSLINKNO") -> None:
    some = dangling(links, known, id, down).orderBy(id).limit(10).collect()
    if some:
        raise ValueError("dangling downstream ids: " + ", ".join(f"{r[0]} -> {r[1]}" for r in some))


def bypass_phantoms(streams: DataFrame, basins: DataFrame, within: float = 0.01) -> DataFrame:
    """Real links after absorbing the phantom links (without a basin) that follow them: all columns of ``streams`` (LINKNO,
    DSLINKNO, Length, strmDrop, DSContArea, DOUTEND, DOUTSTART, line from its downstream end, ...), but that ``line`` becomes
    parts (``geometry.strung``), with Slope, StraightL, DOUTMID and n_absorbed.

    Length and strmDrop add up, DSContArea takes the least, DOUTEND that of the last, DSLINKNO the first real link or end
    after them; lines are joined in order. Phantoms whose line is missing or has no length give nothing and are only
    followed. Chains of phantoms are folded once (``path_folds``); their lines come to each real link that they follow, and
    so are as many rows as the lines that result have pieces.
    """
    real = basins.select(F.col("DN").alias("LINKNO")).distinct().withColumn("real", F.lit(True))
    long = F.coalesce(G.length(F.col("line")), F.lit(0.0)) > 0
    kept = [c for c in streams.columns if c not in ("Slope", "StraightL", "DOUTMID", "n_absorbed", "parts")]
    marked = streams.select(*kept).join(real, "LINKNO", "left").withColumn("real", F.coalesce("real", F.lit(False)))
    marked = settled(marked.withColumn("empty", ~F.col("real") & ~long))
    # what lies behind phantoms without a line
    empty = marked.where("empty").select(F.col("LINKNO").alias("id"), F.col("DSLINKNO").alias("down"))
    behind = path_folds(empty).select("id", "end").join(empty.select(F.col("id").alias("end"), F.col("down").alias("to")), "end")
    behind = behind.select(F.col("id").alias("DSLINKNO"), "to")
    marked = settled(marked.where("not empty").join(behind, "DSLINKNO", "left").withColumn("DSLINKNO", F.coalesce("to", "DSLINKNO")).drop("to", "empty"))
    phantom = marked.where("not real").withColumn("count", F.lit(1).cast("long"))
    # walks through phantoms only, from the first after a real link to the last
    folds = path_folds(
        phantom.select(F.col("LINKNO").alias("id"), F.col("DSLINKNO").alias("down"), "Length", "strmDrop", "DSContArea", "count"),
        ["Length", "strmDrop", "count"],
        ["DSContArea"],
    )
    last = phantom.select(F.col("LINKNO").alias("end"), F.col("DSLINKNO").alias("last_down"), F.col("DOUTEND").alias("last_out"))
    gained = folds.join(last, "end").select(
        F.col("id").alias("DSLINKNO"),
        F.struct("Length", "strmDrop", "DSContArea", "count", "last_down", "last_out").alias("g"),
    )
    firsts = marked.where("real").select("LINKNO", F.col("DSLINKNO").alias("id")).join(folds.select("id", F.col("count").alias("n")), "id")
    starts = firsts.groupBy(F.col("id").alias("start")).agg((F.max("n") - 1).alias("steps"))
    chain = walk_steps(starts, phantom.select(F.col("LINKNO").alias("id"), F.col("DSLINKNO").alias("down")))
    pieces = chain.join(phantom.select(F.col("LINKNO").alias("id"), "line"), "id").groupBy("start")
    pieces = pieces.agg(F.sort_array(F.collect_list(F.struct("hops", "line"))).alias("pieces")).withColumnRenamed("start", "DSLINKNO")
    df, g = marked.where("real").join(gained, "DSLINKNO", "left").join(pieces, "DSLINKNO", "left"), F.col("g")
    lines = F.concat(F.array("line"), F.transform(F.coalesce("pieces", F.array().cast(df.schema["pieces"].dataType)), lambda x: x["line"]))
    new = {
        "DSLINKNO": F.coalesce(g["last_down"], F.col("DSLINKNO")),
        "Length": F.col("Length") + F.coalesce(g["Length"], F.lit(0.0)),
        "strmDrop": F.col("strmDrop") + F.coalesce(g["strmDrop"], F.lit(0.0)),
        "DSContArea": F.least("DSContArea", g["DSContArea"]),
        "DOUTEND": F.coalesce(g["last_out"], F.col("DOUTEND")),
    }
    n = F.coalesce(g["count"], F.lit(0).cast("long")).alias("n_absorbed")
    df = df.select(*[new[c].alias(c) if c in new else c for c in kept if c != "line"], G.strung(lines, within).alias("parts"), n)
    ends = F.flatten("parts")
    slope = F.when(F.col("Length") > 0, F.col("strmDrop") / F.nullif("Length", F.lit(0.0))).otherwise(0.0)
    return df.select("*", slope.alias("Slope"), G.distance(G.first_vertex(ends), G.last_vertex(ends)).alias("StraightL"), ((F.col("DOUTSTART") + F.col("DOUTEND")) / 2).alias("DOUTMID"))


def contract(links: DataFrame, swallowed: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """Links after each lake's ``swallowed`` ones (lake_id, LINKNO, winner) have become its winner.

    A link that several lakes swallow goes to the one of the greatest lake_id. Numbers take the greatest of their group, but
    for those that ``metrics`` (from ``path_metrics``, with winner) has of the winner, and the Slope that follows from them;
    of lakes with one winner the greatest lake_id's count. The winner's downstream link and those of all others are mapped
    once, not through one another; self-loops of a group stay for validation to report.
    """
    into = swallowed.groupBy("LINKNO").agg(F.max(F.struct("lake_id", "winner")).alias("s")).select("LINKNO", "s.winner")
    named = links.join(into, "LINKNO", "left").withColumn("unit", F.coalesce("winner", "LINKNO"))
    own = links.select(F.col("LINKNO").alias("unit"), F.col("DSLINKNO").alias("out"))
    numbers = [c for c in links.columns if c not in ("LINKNO", "DSLINKNO", "USLINKNO1", "USLINKNO2")]
    merged = named.groupBy("unit").agg(*[F.max(c).alias(c) for c in numbers])
    merged = merged.join(own, "unit").withColumnRenamed("out", "DSLINKNO")
    if metrics is not None:
        put = [c for c in PATH_METRICS if c in numbers]
        last = metrics.groupBy(F.col("winner").alias("unit")).agg(F.max_by(F.struct("winner", *PATH_METRICS), "lake_id").alias("m"))
        merged = merged.join(last, "unit", "left")
        there, m = F.col("m").isNotNull(), F.col("m")
        slope = F.when(m["Length"] > 0, m["strmDrop"] / F.nullif(m["Length"], F.lit(0.0))).otherwise(0.0)
        new = {c: F.when(there, m[c]).otherwise(F.col(c)) for c in put}
        if "Slope" in numbers:
            new["Slope"] = F.when(there, slope).otherwise(F.col("Slope"))
        merged = merged.withColumns(new).drop("m")
    mapped = into.select(F.col("LINKNO").alias("DSLINKNO"), F.col("winner").alias("to"))
    df = merged.join(mapped, "DSLINKNO", "left")
    return df.select(F.col("unit").alias("LINKNO"), F.coalesce("to", "DSLINKNO").alias("DSLINKNO"), *numbers)


#: What a lake's longest path gives its unit.
PATH_METRICS = ("Length", "strmDrop", "StraightL", "DOUTEND", "DOUTSTART", "DOUTMID")


def path_metrics(internal: DataFrame, links: DataFrame, winners: DataFrame) -> DataFrame:
    """Per lake the longest path of ``internal`` links (lake_id, LINKNO) from a start, one whose USLINKNO1 isn't internal, down
    to its winner (lake_id, LINKNO) or to where it leaves: (lake_id, winner, start, *PATH_METRICS).

    ``links``: (LINKNO, DSLINKNO, USLINKNO1, Length, strmDrop, DOUTEND, line from its downstream end). StraightL is the
    distance of the path's two ends, DOUTEND the least on it. All are 0, and start null, where no path has a length; of
    paths equally long the one of the least start counts.
    """
    inside = internal.join(links, "LINKNO").join(winners.select("lake_id", F.col("LINKNO").alias("winner")), "lake_id", "left")
    ends = [G.last_vertex(F.col("line")).alias("upper"), G.first_vertex(F.col("line")).alias("lower")]
    inside = settled(inside.select("lake_id", "LINKNO", "DSLINKNO", "USLINKNO1", "Length", "strmDrop", "DOUTEND", "winner", *ends))
    named = lambda c: F.struct("lake_id", F.col(c).alias("link"))
    on = F.when(~F.col("LINKNO").eqNullSafe(F.col("winner")), named("DSLINKNO"))
    folds = path_folds(inside.select(named("LINKNO").alias("id"), on.alias("down"), "Length", "strmDrop", "DOUTEND"), ["Length", "strmDrop"], ["DOUTEND"])
    ups = inside.select("lake_id", F.col("LINKNO").alias("USLINKNO1"))
    starts = inside.join(ups, ["lake_id", "USLINKNO1"], "left_anti").select(named("LINKNO").alias("id"), "upper")
    lowest = inside.select(named("LINKNO").alias("end"), "lower")
    each = folds.join(starts, "id").join(lowest, "end").where("Length > 0")
    each = each.select("id.lake_id", F.col("id.link").alias("start"), "Length", "strmDrop", G.distance(F.col("upper"), F.col("lower")).alias("StraightL"), "DOUTEND")
    first = Window.partitionBy("lake_id").orderBy(F.desc("Length"), "start")
    best = each.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn")
    lakes = internal.select("lake_id").distinct().join(winners.select("lake_id", F.col("LINKNO").alias("winner")), "lake_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    df = lakes.join(best, "lake_id", "left").select("lake_id", "winner", "start", zero("Length"), zero("strmDrop"), zero("StraightL"), zero("DOUTEND"))
    end = F.col("DOUTEND") + F.col("Length")
    return df.select("*", end.alias("DOUTSTART"), ((F.col("DOUTEND") + end) / 2).alias("DOUTMID"))


def remap_to_survivors(targets: DataFrame, moved: DataFrame, survivors: DataFrame, outlet: int = -9999) -> DataFrame:
    """(id, down) with each ``down`` followed through ``moved`` (id, agg) until it survives; cycles, unknown ids and a unit
    that would drain into itself become the outlet."""
    alive = survivors.select(F.col("id").alias("t")).distinct()
    hops = moved.join(alive, F.col("id") == F.col("t"), "left_anti").where("id <> agg").select("id", F.col("agg").alias("at"))
    at = settled(hops)
    for _ in range(at.count().bit_length() + 1):  # jumps twice as far a round; only cycles go on to the last
        jump = at.select(F.col("id").alias("at"), F.col("at").alias("to"))
        gone = settled(at.join(jump, "at", "left").select("id", F.coalesce("to", "at").alias("at"), F.col("to").isNotNull().alias("went")))
        at = gone.select("id", "at")
        if gone.where("went").isEmpty():
            break
    ends = at.join(alive, F.col("at") == F.col("t")).select(F.col("id").alias("via"), F.col("at").alias("end"))
    df = targets.select(F.col("id").alias("unit"), "down")
    df = df.join(alive, F.col("down") == F.col("t"), "left").join(ends, F.col("down") == F.col("via"), "left")
    found = F.coalesce("t", "end", F.lit(outlet).cast("long"))
    return df.select(F.col("unit").alias("id"), F.when(found == F.col("unit"), F.lit(outlet)).otherwise(found).alias("down"))


def main_stems(rivers: DataFrame, seeds: DataFrame) -> DataFrame:
    """(LINKNO) on the way from each seed (id) upstream, always by the inflow of the largest area, least id on ties.

    Links whose link downstream takes them for its largest inflow hang together in chains: a link is on the way from a seed
    if it is in the seed's chain, as many hops from its lower end or more.
    """
    w = Window.partitionBy("DSLINKNO").orderBy(F.desc("area"), "LINKNO")
    best = rivers.where("DSLINKNO > 0").withColumn("rn", F.row_number().over(w)).where("rn = 1").select("LINKNO", F.col("DSLINKNO").alias("down"))
    ids = rivers.select("LINKNO").union(best.select("down")).distinct()
    chains = settled(path_folds(ids.join(best, "LINKNO", "left").withColumnRenamed("LINKNO", "id")))
    lowest = seeds.select("id").distinct().join(chains, "id").groupBy("end").agg(F.min("hops").alias("from"))
    on = chains.join(lowest, "end").where(F.col("hops") >= F.col("from")).select("id")
    return on.union(seeds.select("id")).distinct().select(F.col("id").alias("LINKNO"))


def strahler(nodes: DataFrame) -> DataFrame:
    """(id, ord) of ``nodes`` (id, down null at ends): 1 at heads; the greatest inflow's, one more if two share it.

    A node is of order k + 1 or more if it, or one upstream of it, has two inflows of order k or more. So a round an order,
    of which there are as many as the count of nodes has binary digits, not one a level; each keeps the nodes that go on.
    """
    alive = settled(nodes.select("id", "down"))
    known, k = None, 1
    while True:
        done = alive.select("id", F.lit(k).alias("ord"))
        known = done if known is None else known.union(done)
        forks = alive.where("down is not null").groupBy(F.col("down").alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        flagged = alive.join(forks, "id", "left").select("id", "down", F.when(F.col("n").isNotNull(), 1).otherwise(0).cast("long").alias("fork"))
        above = accumulate(flagged, "fork").where("total > 0").select("id")
        alive, k = settled(alive.join(above, "id")), k + 1
        if alive.isEmpty():
            return known.groupBy("id").agg(F.max("ord").alias("ord"))


def internal_links(starts: DataFrame, edges: DataFrame, stops: DataFrame) -> DataFrame:
    """(lake_id, LINKNO) on the walks down from each of ``starts`` (lake_id, LINKNO) through the first of its lake's ``stops``
    (lake_id, LINKNO), both included; to the end of the network if there is none."""
    nodes = settled(as_nodes(edges, starts.select("LINKNO"), stops.select("LINKNO")))
    near = settled(intervals(nodes).join(path_folds(nodes).select("id", "hops"), "id"))
    at = lambda df, p: df.join(near.select(F.col("id").alias("LINKNO"), F.struct("tree", "low", "high", "hops").alias(p)), "LINKNO")
    lower = at(stops.select("lake_id", "LINKNO").distinct(), "b").select("lake_id", "b")
    tops = at(starts.select("lake_id", "LINKNO").distinct(), "a")
    below = tops.join(lower.withColumnRenamed("lake_id", "l"), (F.col("l") == F.col("lake_id")) & (F.col("a.tree") == F.col("b.tree")) & F.col("a.low").between(F.col("b.low"), F.col("b.high") - 1), "left")
    first = below.groupBy("lake_id", "LINKNO", "a").agg(F.max("b.hops").alias("stop"))
    steps = first.select("lake_id", "LINKNO", (F.col("a.hops") - F.coalesce("stop", F.lit(0))).alias("steps"))
    longest = steps.groupBy(F.col("LINKNO").alias("start")).agg(F.max("steps").alias("steps"))
    walks = walk_steps(longest, edges)
    return walks.join(steps.select("LINKNO", "lake_id", F.col("steps").alias("most")), F.col("start") == F.col("LINKNO")).where("hops <= most").select("lake_id", F.col("id").alias("LINKNO")).distinct()


