"""Network operators on random forests and deep chains against plain Python."""

import math
import random
from collections import defaultdict, namedtuple

import pandas as pd
import pytest
from pyspark.sql import functions as F

from thalweg.operators import network, raster, routing


def forest(rng, n, deep=0.5):
    """down of each of n nodes: a chain for some, else a random earlier node; a few roots."""
    return {i: None if i == 1 or rng.random() < 0.03 else i - 1 if rng.random() < deep else rng.randint(1, i - 1) for i in range(1, n + 1)}


def path(down, i):
    out = [i]
    while down.get(out[-1]) is not None:
        out.append(down[out[-1]])
    return out


def nodes_of(spark, down):
    return spark.createDataFrame([(i, d) for i, d in down.items()], "id long, down long")


@pytest.fixture(scope="module", params=[1, 2])
def tree(request):
    return forest(random.Random(request.param), 300, 0.9 if request.param == 1 else 0.3)


def test_intervals_tell_what_drains_through_what(spark, tree):
    span = {r.id: r for r in network.intervals(nodes_of(spark, tree)).collect()}
    for x in tree:
        below = set(path(tree, x))
        for y in tree:
            a, b = span[x], span[y]
            assert (a.tree == b.tree and b.low <= a.low < b.high) == (y in below)


def test_folds_along_paths(spark, tree):
    rows = [(i, d, float(i % 7), i * 13 % 101) for i, d in tree.items()]
    got = network.path_folds(spark.createDataFrame(rows, "id long, down long, w double, z long"), ["w"], ["z"]).collect()
    for r in got:
        p = path(tree, r.id)
        assert (r.end, r.hops, r.w, r.z) == (p[-1], len(p) - 1, sum(i % 7 for i in p), min(i * 13 % 101 for i in p))


def test_traces_stop_at_the_first_stop(spark, tree):
    starts, stops = [i for i in tree if i % 3 == 0], {i for i in tree if i % 11 == 0}
    edges = nodes_of(spark, tree).where("down is not null")
    got = network.trace_downstream(
        spark.createDataFrame([(i,) for i in starts], "start long"), edges, spark.createDataFrame([(i,) for i in stops], "stop long")
    )
    want = set()
    for s in starts:
        for h, i in enumerate(path(tree, s)):
            want.add((s, i, h))
            if i in stops:
                break
    assert {tuple(r) for r in got.collect()} == want


def test_strahler_orders(spark, tree):
    ups = defaultdict(list)
    for i, d in tree.items():
        ups[d].append(i)
    order = {}
    for i in sorted(tree, reverse=True):  # inflows have greater numbers
        top = sorted((order[u] for u in ups[i]), reverse=True)
        order[i] = 1 if not top else top[0] + (len(top) > 1 and top[0] == top[1])
    assert dict(network.strahler(nodes_of(spark, tree)).collect()) == order


def test_a_deep_chain(spark):
    chain = {i: i - 1 if i > 1 else None for i in range(1, 2001)}
    assert dict(network.strahler(nodes_of(spark, chain)).collect()) == dict.fromkeys(chain, 1)
    assert max(r.hops for r in network.path_folds(nodes_of(spark, chain)).collect()) == 1999


def test_exits_of_one_branch(spark, tree):
    rng = random.Random(3)
    rows = [(rng.randint(1, 3), rng.choice([-1, *tree]), s, rng.randint(1, 5)) for s in range(150)]
    exits = spark.createDataFrame(rows, "lake_id long, link_no long, seq long, local_accum long")
    spans = network.intervals(nodes_of(spark, tree))
    want, upper, lower = set(), set(), set()
    for lake, link, seq, acc in rows:
        others = [r for r in rows if r[0] == lake and r[1] != -1 and r[2] != seq]
        above = link != -1 and any(o[1] != link and o[1] in path(tree, link) for o in others)
        if link == -1 or not above and not any(o[1] == link and o[3] > acc for o in others):
            want.add(seq)
        if not above:
            lower.add(seq)
        if link == -1 or not any(o[1] != link and link in path(tree, o[1]) for o in others):
            upper.add(seq)
    ids = lambda df: {r.seq for r in df.collect()}
    assert ids(network.drop_duplicate_exits(exits, spans, "local_accum")) == want
    assert ids(raster.most_downstream(exits, spans)) == lower
    assert ids(raster.most_upstream(exits, spans)) == upper


def test_internal_links(spark, tree):
    rng = random.Random(4)
    starts = {(rng.randint(1, 3), rng.randint(1, 300)) for _ in range(40)}
    stops = {(rng.randint(1, 3), rng.randint(1, 300)) for _ in range(40)}
    want = set()
    for lake, s in starts:
        for i in path(tree, s):
            want.add((lake, i))
            if (lake, i) in stops:
                break
    table = lambda rows: spark.createDataFrame(list(rows), "lake_id long, LINKNO long")
    got = network.internal_links(table(starts), nodes_of(spark, tree).where("down is not null"), table(stops))
    assert {tuple(r) for r in got.collect()} == want


def test_survivors_and_cycles(spark):
    moved = [(1, 2), (2, 3), (5, 6), (6, 5), (7, 99), *[(i, i + 1) for i in range(100, 400)]]
    targets = [(10, 1), (11, 3), (12, 5), (13, 7), (14, 100), (15, 150), (3, 1)]
    t = lambda rows, kinds: spark.createDataFrame(rows, kinds)
    got = network.remap_to_survivors(t(targets, "id long, down long"), t(moved, "id long, agg long"), t([(3,), (400,)], "id long"))
    assert dict(got.collect()) == {10: 3, 11: 3, 12: -9999, 13: -9999, 14: 400, 15: 400, 3: -9999}


# ---- aggregation of basins: the rules as steps between states -------------------------------------------------------

OUT = -9999


def shown(state, units, least):
    """The groups that take part in a state, with what they flow to and the area of their units that say so."""
    found = {}
    for i, (group, flow) in state.items():
        if flow is not None:
            found.setdefault(group, {}).setdefault(flow, []).append(units[i].area)
    out = {}
    for group, flows in found.items():
        flow = max(flows)
        if units[group].mask < 3 and (flow != OUT or units[group].up >= least):
            out[group] = flow, sum(flows[flow])
    return out


def by_rule(table, least):
    """Groups of units (id, down, area, uparea, mask) once the number of small groups that take part repeats."""
    Unit = namedtuple("Unit", "down area up mask")
    units = {i: Unit(d, a, up, m) for i, d, a, up, m in table}
    state = {i: (i, u.down if u.down > 0 else OUT) for i, u in units.items()}
    largest_first = lambda some: sorted(some, key=lambda g: (-units[g].up, g))
    counts = []
    while len(counts) < 2 or counts[-1] != counts[-2]:
        view = shown(state, units, least)
        fed = {flow for flow, _ in view.values()}
        for g in largest_first(g for g, (flow, area) in view.items() if g not in fed and area < least and units[g].mask < 2):
            into = view[g][0]
            if into != OUT and units[into].mask < 3:
                onward = view[into][0] if into in view else None
                state |= {i: (into, onward) for i, (group, _) in state.items() if group == g}
        view = shown(state, units, least)
        fed = {flow for flow, _ in view.values()}
        for pour in largest_first(g for g, (_, area) in view.items() if g in fed and area < least):
            group, flow = state[pour]
            inflows = [i for i, u in units.items() if u.down == pour]
            best = min(inflows, key=lambda i: (-units[i].up, i), default=None)
            if best is None or units[best].mask >= 2 or sum(units[i].area for i, s in state.items() if s[0] == group) >= least:
                continue
            taken = state[best][0]
            to_taken = {i for i, s in state.items() if s[1] == taken}
            state = {i: (group if g in (group, taken) else g, flow if g in (group, taken) else f) for i, (g, f) in state.items()}
            state |= {i: (state[i][0], group) for i in to_taken if state[i][0] != group}
        counts.append(sum(area < least for _, area in shown(state, units, least).values()))
    return {i: group for i, (group, _) in state.items()}


def units_of(down, area, mask):
    up = dict(area)
    for i in sorted(down, reverse=True):
        if down[i]:
            up[down[i]] += up[i]
    return [(i, d or -9999, area[i], up[i], mask.get(i, 1 if not d else 0)) for i, d in down.items()]


def groups_of(spark, units, least=100.0):
    df = spark.createDataFrame([(i, d, float(u), float(up), m) for i, d, u, up, m in units], "id long, down long, unit double, uparea double, mask int")
    how = routing.Aggregation(least)
    return df, routing.aggregate_units(df, how), how


def test_a_chain_falls_into_groups_of_four(spark):
    units = units_of({i: i - 1 if i > 1 else None for i in range(1, 13)}, dict.fromkeys(range(1, 13), 30), {})
    df, got, how = groups_of(spark, units)
    assert {r.id: r.agg for r in got.collect()} == {i: (i - 1) // 4 * 4 + 1 for i in range(1, 13)}
    out = {r.id: r for r in routing.aggregated(df, got, how).collect()}
    assert {k: (r.down, r.unit, r.n_units) for k, r in out.items()} == {1: (-9999, 120.0, 4), 5: (1, 120.0, 4), 9: (5, 120.0, 4)}


def random_units(rng, n, first=0):
    down = {i: None if i == 1 else rng.randint(max(1, i - rng.choice([1, 3, 20])), i - 1) for i in range(1, n + 1)}
    mask = {i: rng.choice([0, 0, 0, 0, 2, 3]) for i in range(1, n + 1) if rng.random() < 0.4}
    area = {i: rng.randint(5, 60) for i in down}
    if not mask.get(1):
        mask.pop(1, None)
    units = units_of(down, area, mask)
    return [(i + first, d + first if d > 0 else d, a, up, m) for i, d, a, up, m in units]


@pytest.mark.parametrize("seed", range(8))
def test_groups_of_random_trees(seed):
    rng = random.Random(seed)
    for _ in range(6):
        tree = random_units(rng, 40)
        states = routing.aggregate_tree(pd.DataFrame(tree, columns=["id", "down", "unit", "uparea", "mask"]))
        stop = next((k for k in range(1, len(states)) if states[k][0] == states[k - 1][0]), len(states) - 1)
        groups = states[stop][1]
        assert groups == by_rule(tree, 100)
        at = {u[0]: u for u in tree}
        for i, g in groups.items():
            assert groups[g] == g  # a group has its pour point,
            if i != g:  # and hangs together
                assert groups[at[i][1]] == g
            assert at[i][4] < 3 or g == i and list(groups.values()).count(g) == 1
            assert at[i][4] < 2 or g == i


@pytest.mark.parametrize("seed", range(3))
def test_parts_give_what_whole_trees_do(spark, seed):
    """Forests of protected and plain units, cut below protected ones, against one kernel over everything."""
    rng = random.Random(seed)
    units = [u for t in range(5) for u in random_units(rng, 60, 100 * t)]
    states = routing.aggregate_tree(pd.DataFrame(units, columns=["id", "down", "unit", "uparea", "mask"]))
    stop = next((k for k in range(1, len(states)) if states[k][0] == states[k - 1][0]), len(states) - 1)
    _, groups, down = states[stop]
    df, got, how = groups_of(spark, units)
    rows = got.collect()
    assert {r.id: r.agg for r in rows} == groups
    assert {r.id: r.aggdown for r in rows} == down
    assert len({r.part for r in rows}) == sum(u[4] >= 2 or u[1] <= 0 for u in units)
    out = routing.aggregated(df, got, how).collect()
    assert math.isclose(sum(r.unit for r in out), sum(u[2] for u in units))


def test_no_task_takes_a_part_of_a_network(spark, monkeypatch):
    """One part, with units of no area and so of equal upstream areas: groups come from joins and stems, not from a kernel over all."""
    monkeypatch.setattr(routing, "aggregate_tree", None)
    rng = random.Random(5)
    tree = random_units(rng, 80)
    units = units_of({i: d if d > 0 else None for i, d, *_ in tree}, {u[0]: rng.choice([0, u[2]]) for u in tree}, {u[0]: 2 for u in tree[1::9]})
    monkeypatch.setattr("pyspark.sql.GroupedData.applyInPandas", None)
    df, got, how = groups_of(spark, units)
    rows = got.collect()
    monkeypatch.undo()
    states = routing.aggregate_tree(pd.DataFrame(units, columns=["id", "down", "unit", "uparea", "mask"]))
    stop = next((k for k in range(1, len(states)) if states[k][0] == states[k - 1][0]), len(states) - 1)
    assert {r.id: (r.agg, r.aggdown) for r in rows} == {i: (g, states[stop][2][i]) for i, g in states[stop][1].items()}


def test_stream_network_of_a_small_grid(spark):
    """Two heads that meet, then run on: three links."""
    east, south = 1, 7
    grid = {(0, 0): (east, 9), (0, 1): (east, 8), (0, 2): (south, 7), (1, 2): (south, 6), (2, 2): (0, 5), (1, 0): (east, 9), (1, 1): (east, 8), (2, 0): (east, 9), (2, 1): (2, 8.5)}
    streams = {(0, 1), (0, 2), (1, 1), (1, 2), (2, 2)}
    rows = [(r, c, f, float(z), 1, (r, c) in streams) for (r, c), (f, z) in grid.items()]
    links, owners = raster.stream_network(spark.createDataFrame(rows, "row int, col int, fdr int, z double, ad8 long, stream boolean"), 3)
    got = {r.LINKNO: (r.DSLINKNO, r.n_cells, round(r.Length, 6), r.strmOrder, r.strmDrop, r.DOUTEND) for r in links.collect()}
    assert got == {2: (8, 2, 2.0, 1, 2.0, 1.0), 4: (8, 1, 1.0, 1, 2.0, 1.0), 8: (-1, 2, 1.0, 2, 1.0, 0.0)}
    assert {(r.row, r.col): r.WSNO for r in owners.collect()} == {(0, 0): 2, (0, 1): 2, (0, 2): 2, (1, 0): 4, (1, 1): 4, (1, 2): 8, (2, 2): 8, (2, 0): 8, (2, 1): 8}
    cut = spark.createDataFrame([(0, 1)], "row int, col int")
    split = raster.stream_network(spark.createDataFrame(rows, "row int, col int, fdr int, z double, ad8 long, stream boolean"), 3, cut)[0]
    assert {r.LINKNO: (r.DSLINKNO, r.n_cells) for r in split.collect()} == {1: (2, 1), 2: (8, 1), 4: (8, 1), 8: (-1, 2)}
    assert split.where(F.col("USLINKNO1") == 2).select("USLINKNO2").first()[0] == 4
