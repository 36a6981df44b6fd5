import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF, SF_SMALL, pairs, scalar
from countloom import workloads as w
from countloom.functions.hashing import Colouring, EdgePartitioning
from countloom.operators import graph as gr
from countloom.operators import triangles as tr
from countloom.plans.graph_report import run_colourings, triangle_report


def complete(n):
    return list(itertools.combinations(range(1, n + 1), 2))


def brute_force(edge_list):
    adjacent = {}
    for u, v in edge_list:
        if u != v:
            adjacent.setdefault(u, set()).add(v)
            adjacent.setdefault(v, set()).add(u)
    return [t for t in itertools.combinations(sorted(adjacent), 3)
            if t[1] in adjacent[t[0]] and t[2] in adjacent[t[0]] and t[2] in adjacent[t[1]]]


def random_graph(seed, n=40, m=260):
    rng = random.Random(seed)
    hubs = [(0, x) for x in range(1, n)] + [(x, 1) for x in range(n)]
    return hubs + [(rng.randrange(n) - 5, rng.randrange(n) - 5) for _ in range(m)]


CASES = [
    ([(1, 2), (2, 3), (1, 3)], 1),
    (complete(4), 4),
    (complete(5), 10),
    ([(1, 2), (2, 3)], 0),
    ([(0, x) for x in range(1, 8)], 0),
    ([(1, 2), (2, 3), (3, 4), (4, 1)], 0),
    ([(1, 2), (2, 1), (2, 3), (3, 1), (1, 2)], 1),
    ([(1, 1), (2, 2)], 0),
    ([(-1, -2), (-2, -3), (-1, -3)], 1),
    ([(5_000_000_000, 1), (1, 2), (2, 5_000_000_000)], 1),
    ([], 0),
]


@pytest.mark.parametrize(("edge_list", "expected"), CASES)
def test_exact_cases(edges, edge_list, expected):
    assert scalar(tr.triangles_exact(edges(*edge_list))) == expected


@pytest.mark.parametrize("edge_list", [[], [(-1, -2), (-2, -3), (-1, -3)], complete(5)])
def test_triple_cases(edges, edge_list):
    assert scalar(tr.triangles_colour_triple(edges(*edge_list), Colouring.seeded(3, 1))) == len(brute_force(edge_list))


@pytest.mark.parametrize("piece_rows", [1, 3, 1 << 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_heavy_vertices_in_pieces(edges, seed, piece_rows):
    graph = random_graph(seed)
    triangles = brute_force(graph)
    df = edges(*graph)
    assert scalar(tr.triangles_exact(df, piece_rows)) == len(triangles)
    colouring = Colouring.seeded(3, seed)
    assert scalar(tr.triangles_colour_triple(df, colouring, piece_rows)) == len(triangles)


@pytest.mark.parametrize("block", [1, 2, 5])
def test_long_lists_are_kept_in_chunks(edges, monkeypatch, block):
    """A clique makes long lists, a star a heavy vertex beside it."""
    graph = complete(12) + [(1, x) for x in range(100, 140)] + [(100 + i, 101 + i) for i in range(0, 38, 2)]
    monkeypatch.setattr(tr, "CHUNK", block)
    triangles = brute_force(graph)
    for piece_rows in (1, 4, 1 << 20):
        assert scalar(tr.triangles_exact(edges(*graph), piece_rows)) == len(triangles)
    assert scalar(tr.triangles_colour_triple(edges(*graph), Colouring.seeded(3, 4), 2)) == len(triangles)


def executed(df):
    """The plan that ran, without the one that was planned at first."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_colours_without_a_vertex_have_a_row(edges):
    colouring = Colouring.seeded(7, 1)
    got = {r.colour: (r.vertices, r.edges) for r in gr.colour_balance(gr.simplify(edges((1, 2), (2, 3))), colouring).collect()}
    expected = {c: [0, 0] for c in range(7)}
    for x in (1, 2, 3):
        expected[colouring.value(x)][0] += 1
    for u, v in ((1, 2), (2, 3)):
        expected[colouring.value(u)][1] += colouring.value(u) == colouring.value(v)
    assert got == {c: tuple(n) for c, n in expected.items()}


def test_runs_of_both_families_and_many(edges):
    graph = random_graph(9)
    triangles = brute_force(graph)
    colourings = [*run_colourings(3, 20, 5), *run_colourings(3, 2, 50, "linear8191")]
    expected = {run: 9 * sum(len({c.value(x) for x in t}) == 1 for t in triangles) for run, c in enumerate(colourings)}
    assert dict(pairs(tr.triangle_runs(edges(*graph), colourings))) == expected


def test_every_colour_count_gives_the_exact_number(edges):
    graph = random_graph(3)
    expected = len(brute_force(graph))
    for colours in (1, 2, 5):
        assert scalar(tr.triangles_colour_triple(edges(*graph), Colouring.seeded(colours, 9))) == expected


def test_a_triangle_belongs_to_the_triple_of_its_colours(edges):
    graph = random_graph(4)
    colouring = Colouring.seeded(3, 2)
    expected = {}
    for t in brute_force(graph):
        k = tuple(sorted(colouring.value(x) for x in t))
        expected[k] = expected.get(k, 0) + 1
    got = {tuple(r)[:3]: r.triangles for r in tr.triangles_per_triple(edges(*graph), colouring).collect()}
    assert got == expected


def test_per_colour_against_brute_force(edges):
    graph = random_graph(5)
    colouring = Colouring.seeded(4, 6)
    expected = {c: 0 for c in range(4)}
    for t in brute_force(graph):
        if len({colouring.value(x) for x in t}) == 1:
            expected[colouring.value(t[0])] += 1
    df = edges(*graph)
    assert dict(pairs(tr.triangles_per_colour(df, colouring, 2))) == expected
    (row,) = tr.triangles_node_colour(df, colouring).collect()
    assert row.local == sum(expected.values()) and row.estimate == 16 * row.local


def test_one_colour_or_partition_is_exact(edges):
    graph = random_graph(6)
    expected = len(brute_force(graph))
    df = edges(*graph)
    one = Colouring.seeded(1, 3)
    assert tr.triangles_node_colour(df, one).first().estimate == expected
    assert tr.triangles_edge_partition(df, EdgePartitioning.seeded(1, 3)).first().estimate == expected
    assert dict(pairs(tr.triangle_runs(df, [one, one]))) == {0: expected, 1: expected}


def test_no_edge_survives(edges):
    apart = Colouring.seeded(1000, 1)
    df = edges((1, 2), (2, 3), (1, 3))
    assert tr.triangles_node_colour(df, apart).first().estimate == 0
    assert dict(pairs(tr.triangle_runs(df, [apart, apart]))) == {0: 0, 1: 0}


@pytest.mark.parametrize(("estimates", "expected"), [([3, 6], 4), ([5], 5), ([9, 1, 4], 4), ([1, 2, 3, 10], 2)])
def test_median_of_runs(spark, estimates, expected):
    runs = spark.createDataFrame(list(enumerate(estimates)), "run BIGINT, estimate BIGINT")
    assert tuple(tr.median_of_runs(runs).first()) == (len(estimates), expected)


def test_median_of_five_runs_is_near(spark):
    runs = tr.triangle_runs(w.part_supplier(spark, SF), run_colourings(4, 5, 100))
    assert abs(tr.median_of_runs(runs).first().median / 300_177 - 1) < 0.15


@pytest.mark.parametrize(("sf", "triangles", "simple", "vertices", "degree"), [(SF_SMALL, 7_852, 1_852, 200, 194), (SF, 300_177, 51_397, 2_000, 579)])
def test_part_supplier(spark, sf, triangles, simple, vertices, degree):
    edges = w.part_supplier(spark, sf)
    clean = gr.simplify(edges)
    assert clean.count() == simple
    degrees = gr.vertex_degrees(clean)
    assert degrees.count() == vertices and degrees.agg({"degree": "max"}).first()[0] == degree
    assert scalar(tr.triangles_exact(edges)) == triangles


def test_orientation_bounds_the_lists(spark):
    simple = gr.simplify(w.part_supplier(spark, SF))
    oriented = gr.orient(simple)
    longest = oriented.groupBy("lo.id").count().agg({"count": "max"}).first()[0]
    assert longest <= (2 * 51_397) ** 0.5
    assert oriented.count() == 51_397


def test_pieces_cap_the_edges_of_a_vertex(edges):
    star = gr.simplify(edges(*[(0, x) for x in range(1, 101)]))
    parts = {r.vertex: r.parts for r in gr.degree_pieces(star, 10).collect()}
    assert parts[0] == 10 and all(parts[x] == 1 for x in range(1, 101))


def test_triple_load_matches_replication(edges):
    graph = random_graph(8)
    colouring = Colouring.seeded(3, 5)
    expected = {}
    for u, v in {(min(e), max(e)) for e in graph if e[0] != e[1]}:
        for i in range(3):
            k = tuple(sorted((colouring.value(u), colouring.value(v), i)))
            expected[k] = expected.get(k, 0) + 1
    got = {tuple(r)[:3]: r.edges for r in gr.colour_triple_load(gr.simplify(edges(*graph)), colouring).collect()}
    assert got == expected


def test_mono_edges_keep_copies(edges):
    colouring = Colouring.seeded(1, 1)
    assert pairs(gr.mono_edges(edges((1, 2), (1, 2), (2, 1)), colouring)) == [(0, 1, 2), (0, 1, 2), (0, 2, 1)]


def test_reports(edges):
    df = edges(*complete(5), (1, 2))
    (row,) = triangle_report(df, "k5", colours=1, runs=2).collect()
    assert row.asDict() == {"dataset": "k5", "edges": 11, "colours": 1, "runs": 2, "node_colour": 10, "edge_partition": 10}
    (row,) = triangle_report(df, "k5", colours=3, runs=2, exact=1).collect()
    assert row.triangles == 10 and row.edges == 11


def test_bad_parameters(edges):
    df = edges((1, 2))
    with pytest.raises(ValueError):
        triangle_report(df, "x", colours=2, runs=1, exact=2)
    with pytest.raises(ValueError):
        triangle_report(df, "x", colours=0, runs=1)
    with pytest.raises(ValueError):
        triangle_report(df, "x", colours=2, runs=0)
    with pytest.raises(ValueError):
        tr.triangle_runs(df, [])
    with pytest.raises(ValueError):
        tr.triangle_runs(df, [Colouring.seeded(2, 1), Colouring.seeded(3, 1)])


def parts_of(graph, parts):
    """Triangles of each edge partition, summed."""
    groups = {}
    for u, v in {(min(e), max(e)) for e in graph if e[0] != e[1]}:
        groups.setdefault(parts(u, v), []).append((u, v))
    return sum(len(brute_force(g)) for g in groups.values())


@pytest.mark.parametrize("cells", [1, 4, 1 << 20])
def test_any_cells_give_the_same_estimates(edges, spark, monkeypatch, cells):
    """One cell ranks all vertices by id, a few mix heavy and light ones."""
    monkeypatch.setattr(gr, "DEGREE_CELLS", cells)
    graph = random_graph(4) + [(1, x) for x in range(200, 260)]
    df = edges(*graph)
    for piece_rows in (2, 1 << 20):
        colouring, split = Colouring.seeded(2, 3), EdgePartitioning.seeded(2, 3)
        mono = sum(len({colouring.value(x) for x in t}) == 1 for t in brute_force(graph))
        assert tr.triangles_node_colour(df, colouring, piece_rows).first().local == mono
        part = {(r.u, r.v): r.p for r in gr.simplify(df).selectExpr("u", "v", f"{split.spark('u', 'v')} AS p").collect()}
        assert tr.triangles_edge_partition(df, split, piece_rows).first().local == parts_of(graph, lambda u, v: part[u, v])
        assert scalar(tr.triangle_runs(df, [colouring], piece_rows).select("estimate")) == 4 * mono


def test_a_hundred_runs_are_one_plan(edges):
    graph = random_graph(8)
    triangles = brute_force(graph)
    colourings = run_colourings(3, 100, 7)
    expected = {run: 9 * sum(len({c.value(x) for x in t}) == 1 for t in triangles) for run, c in enumerate(colourings)}
    plan = tr.triangle_runs(edges(*graph), colourings)
    few = tr.triangle_runs(edges(*graph), colourings[:5])
    nodes = [len(p._jdf.queryExecution().executedPlan().treeString().splitlines()) for p in (plan, few)]
    assert nodes[0] == nodes[1] and dict(pairs(plan)) == expected


@pytest.mark.parametrize("chunk", [1, 3])
def test_no_row_holds_more_than_a_chunk(edges, monkeypatch, chunk):
    """Two long lists with little in common, a clique, and a star, in estimates and by groups too."""
    monkeypatch.setattr(tr, "CHUNK", chunk)
    graph = complete(9) + [(100, x) for x in range(200, 230, 2)] + [(101, x) for x in range(200, 230, 3)] + [(100, 101)]
    graph += [(1, x) for x in range(300, 320)]
    triangles = brute_force(graph)
    df = edges(*graph)
    colouring = Colouring.seeded(2, 3)
    mono = sum(len({colouring.value(x) for x in t}) == 1 for t in triangles)
    assert scalar(tr.triangles_exact(df, 5)) == len(triangles)
    assert scalar(tr.triangle_runs(df, [colouring], 5).select("estimate")) == 4 * mono
    per_triple = tr.triangles_per_triple(df, Colouring.seeded(3, 1), 5).collect()
    assert sum(r.triangles for r in per_triple) == len(triangles)


@pytest.mark.parametrize(
    "name",
    ["triangles_exact", "triangles_edge_partition", "triangles_node_colour", "triangles_per_colour", "triangle_runs", "triangles_colour_triple"],
)
def test_the_table_is_scanned_once_and_lists_are_gathered_once(spark, name):
    """The uses of the edges, and of the lists, are alike to the optimizer, so each is computed for one only."""
    plan = executed(w.QUERIES[name](spark, SF_SMALL))
    assert plan.count("FileScan") == 1 and plan.count("Window [row_number()") == 1 and "ReusedExchange" in plan


@pytest.mark.parametrize("chunk", [2, 4096])
def test_a_wedge_is_sent_to_one_triple(edges, chunk):
    """Own lists are replicated to all triples of an edge; what is sent to them is of the last colour only."""
    colouring = Colouring.seeded(3, 2)
    oriented = gr.orient(gr.simplify(edges(*random_graph(7)))).persist()
    lists = [r.n for r in oriented.groupBy("lo").agg(F.count("hi").alias("n")).collect()]
    sent, own = (df.collect() for df in tr.meetings(oriented, "k", colouring, chunk=chunk))
    assert sum(len(r.candidates) for r in sent) == sum(n * (n - 1) // 2 for n in lists)
    assert sum(len(r.ids) for r in own) == 3 * sum(lists)
    for r in sent:
        (last,) = {colouring.value(w) for w in r.candidates}
        triple = [r.k // 9, r.k // 3 % 3, r.k % 3]
        triple.remove(colouring.value(r.mid))
        assert last in triple
    oriented.unpersist()


@pytest.mark.parametrize("name", ["triangles_colour_triple", "triangles_per_triple", "triangle_report_exact"])
def test_lists_are_replicated_behind_their_exchange(spark, name):
    df = w.QUERIES[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    dealt_by = re.findall(r"Exchange hashpartitioning\((\w+)#\w+, (\w+)#.*REPARTITION_BY_COL", plan)
    assert set(dealt_by) == {("lo", "chunk")}


def test_a_list_that_nothing_is_sent_to_is_told_apart(edges):
    """Only vertices with an edge coming in take part as the middle of a triangle."""
    oriented = gr.orient(gr.simplify(edges(*random_graph(7), (50, 60), (50, 61)))).persist()
    entered = {r.id for r in oriented.select("hi.id").collect()}
    for group, colouring, chunk in ((None, None, 4096), ("k", Colouring.seeded(3, 2), 4096), ("k", Colouring.seeded(3, 2), 2)):
        sent, own = (df.collect() for df in tr.meetings(oriented, group, colouring, chunk=chunk))
        assert {r.mid for r in own if r.met} == entered & {r.mid for r in own}
        assert {r.mid for r in sent} <= entered and {r.mid for r in own} - entered
    oriented.unpersist()


FAR_APART = [-(1 << 63), -(1 << 63) + 5, -(1 << 40), -40_000, -3, 0, 7, 32_767, 32_768, 70_000, (1 << 31) - 1, 1 << 31, 5_000_000_000, (1 << 63) - 1]


def test_ids_are_kept_by_their_distance(spark):
    rows = [(0, mid, None, FAR_APART) for mid in FAR_APART]
    meeting = spark.createDataFrame(rows, "piece BIGINT, mid BIGINT, span ARRAY<BIGINT>, ids ARRAY<BIGINT>")
    for r in tr._by_distance(meeting, "ids", [], "span").collect():
        near, far, whole = r.ids_near or [], r.ids_far or [], r.ids_whole or []
        assert sorted([x + r.mid for x in near + far] + whole) == FAR_APART
        assert all(-(1 << 15) <= x < 1 << 15 for x in near) and all(-(1 << 31) <= x < 1 << 31 for x in far)
        assert not any(-(1 << 15) <= x < 1 << 15 for x in far) and not any(-(1 << 31) <= x - r.mid < 1 << 31 for x in whole)


@pytest.mark.parametrize("chunk", [3, 4096])
def test_triples_of_ids_far_apart(edges, monkeypatch, chunk):
    monkeypatch.setattr(tr, "CHUNK", chunk)
    graph = list(itertools.combinations(FAR_APART, 2)) + [(x, 11) for x in FAR_APART[::3]]
    triangles = brute_force(graph)
    colouring = Colouring.seeded(3, 2)
    per_triple = tr.triangles_per_triple(edges(*graph), colouring, 4).collect()
    assert sum(r.triangles for r in per_triple) == len(triangles)
    (row,) = triangle_report(edges(*graph), "far", colours=2, runs=1, exact=1).collect()
    assert row.triangles == len(triangles)


@pytest.mark.parametrize("name", ["triangle_report_exact", "triangles_per_triple"])
def test_distances_are_exchanged_by_triple(spark, name):
    df = w.QUERIES[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    by_triple = re.findall(r"Exchange hashpartitioning\(k#\w+L?, mid#\w+L?, piece#[^\n]*\n[^\n]*Project \[([^\n]*)", plan)
    assert by_triple and all("_near#" in row and not re.search(r"\b(ids|candidates)#\w+\b(?! AS)(,|\])", row) for row in by_triple)


FEW_CLOSE = [(x, y) for x in range(100, 130) for y in range(12)] + [(0, 1), (1, 2), (0, 2), (5, 9), (-7, 100)]


@pytest.mark.parametrize("chunk", [2, 4096])
def test_ids_that_close_no_triangle_are_not_sent(edges, chunk):
    """Of the many pairs of neighbours only those with an edge are sent, besides some that share a bit with one."""
    oriented = gr.orient(gr.simplify(edges(*FEW_CLOSE)), settled=True).persist()
    pairs_met = {(r.lo.id, r.hi.id) for r in oriented.collect()}
    colouring = Colouring.seeded(3, 2)
    every, closing = (
        [(r.mid, w) for r in tr.meetings(oriented, "k", colouring, chunk=chunk, closing=c)[0].collect() for w in r.candidates] for c in (False, True)
    )
    wanted = sorted(pair for pair in every if pair in pairs_met)
    assert len(wanted) == len(brute_force(FEW_CLOSE)) and len(every) > 10 * len(wanted)
    assert sorted(pair for pair in closing if pair in pairs_met) == wanted
    assert len(closing) < 2 * len(wanted)
    oriented.unpersist()


@pytest.mark.parametrize("edge_bits", [0, 32])
def test_a_bitmap_of_any_size_gives_the_exact_number(edges, monkeypatch, edge_bits):
    """One page for more edges than it has bits, and several pages."""
    monkeypatch.setattr(tr, "EDGE_BITS", edge_bits)
    graph = complete(90) + FEW_CLOSE
    (row,) = triangle_report(edges(*graph), "many", colours=3, runs=1, exact=1).collect()
    assert row.triangles == len(brute_force(graph))


@pytest.mark.parametrize("name", ["triangles_colour_triple", "triangles_per_triple"])
def test_the_bitmap_is_part_of_no_row(spark, name):
    """It stands in the expression that uses it; as a column it would be copied for every row."""
    df = w.QUERIES[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "known#" not in plan and "bitmap_construct_agg" in plan
