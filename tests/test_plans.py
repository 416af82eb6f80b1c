"""The physical plans are the intended ones."""

import importlib
import re

import pytest

from linkrank import operators as g
from linkrank.functions import part_count
from linkrank.operators.pagerank import _round
from linkrank.plans import Scratch, adjacency, encode_edges, index_vertices
from linkrank.sources import store_graph
from registry.graphs import ROWS


@pytest.fixture(scope="module")
def stored(spark, tables):
    return store_graph(ROWS["part_next"](spark, tables), Scratch(spark).folder)


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def without_cached(text):
    """The plan without what lies under its cached tables."""
    lines, below = [], None
    for line in text.split("\n"):
        depth = re.match(r"[ :]*(?:[+:]- )?", line).end()
        if below is not None and depth > below:
            continue
        below = depth if "InMemoryRelation" in line else None
        lines.append(line)
    return "\n".join(lines)


def test_a_round_moves_the_state_and_the_shares_only(spark, stored, no_broadcast, monkeypatch):
    monkeypatch.setattr("linkrank.plans.layout.FEW_LINKS", 100)
    vertices, edges = stored
    index = index_vertices(Scratch(spark), vertices)
    links = encode_edges(edges, index).selectExpr("u AS vid", "v AS target", "out_degree AS degree")
    adjacent = adjacency(links, index.n_links)
    adjacent.count()
    state = index.table.select("vid", part_count("out_degree").alias("parts")).selectExpr(
        "*", "1D AS rank"
    )
    text = plan(_round(state, adjacent, 10, 0.85))
    outside = text[: text.index("InMemoryRelation")]
    # one exchange by (vid, part) for the state and one by vid for the partial sums
    assert outside.count("Exchange hashpartitioning") == 2
    # the adjacency side of the merge join is neither exchanged nor sorted
    assert outside.count("Sort [") == 1
    assert outside.count("HashAggregate(keys=[vid") == 2
    adjacent.unpersist()


def test_a_level_of_a_search_leaves_the_links_in_place(stored, no_broadcast, monkeypatch):
    from linkrank.operators import paths

    monkeypatch.setattr("linkrank.plans.layout.FEW_LINKS", 100)
    (search,) = paths._searches(stored[1], None, "out")
    search.begin(paths._vertex(search.index, stored[1].first()["src"]))
    search.advance()

    def outside():
        text = plan(paths._reached(search.level(1), search.sizes[1], search.links, search.index, "out_degree"))
        return text[: text.index("InMemoryRelation")]

    # a small level is broadcast to the links
    assert "BroadcastHashJoin" in outside() and "SortMergeJoin" not in outside()
    monkeypatch.setattr(paths, "FEW", 0)
    # a large one looks its parts up, and goes to the links by (vid, part)
    assert outside().count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in outside()
    search.drop()


def test_jobs_on_a_stored_graph_exchange_no_links(spark, stored, no_broadcast, monkeypatch):
    from linkrank.plans import load_numbered, store_numbered
    from linkrank.plans.scratch import Scratch as Folder

    monkeypatch.setattr("linkrank.plans.layout.FEW_LINKS", 100)
    folder = Folder(spark).folder
    store_numbered(*stored, folder)
    graph = load_numbered(spark, folder)
    for direction in ("out", "into"):
        links = graph.links(direction)
        text = plan(links.selectExpr("vid", "part", "size(targets)"))
        assert "Exchange" not in text and "Bucketed: true" in text
        state = graph.index.table.select("vid", part_count("out_degree").alias("parts")).selectExpr("*", "1D AS rank")
        text = plan(_round(state, links, 10, 0.85))
        outside = text[: text.index("InMemoryRelation")]
        assert outside.count("Exchange hashpartitioning") == 2 and outside.count("Sort [") == 1
        assert links.selectExpr("sum(size(targets))").first()[0] == graph.index.n_links
        links.unpersist()
    with monkeypatch.context() as none:
        for name in ("pagerank", "communities", "components", "paths"):  # ids are sorted no more
            none.setattr(importlib.import_module(f"linkrank.operators.{name}"), "index_vertices", None)
        source = stored[1].first()["src"]
        made = [
            g.pagerank(None, None, iterations=2, numbered=graph),
            g.connected_components(None, None, numbered=graph),
            g.label_propagation(None, max_iter=2, numbered=graph),
            g.distances_to(None, source, numbered=graph),
        ]
    same = [
        g.pagerank(*stored, iterations=2),
        g.connected_components(*stored),
        g.label_propagation(stored[1], max_iter=2),
        g.distances_to(stored[1], source),
    ]
    for one, other in zip(made, same, strict=True):
        a, b = ({row[0]: row[1] for row in frame.collect()} for frame in (one, other))
        assert a == pytest.approx(b)


def test_settling_rounds_exchange_votes_and_draws_alone(spark, stored, no_broadcast, monkeypatch):
    from linkrank.operators import settled
    from linkrank.plans import store_numbered
    from linkrank.plans.scratch import Scratch as Folder

    monkeypatch.setattr("linkrank.plans.layout.FEW_LINKS", 100)
    graph = store_numbered(*stored, Folder(spark).folder)
    links = {direction: graph.links(direction) for direction in ("out", "into")}
    state = graph.index.table.selectExpr(
        "vid", "1 AS out_parts", "1 AS into_parts", "vid AS degree", "vid AS label", "vid AS draw"
    )
    text = without_cached(plan(settled._wishes(state, links)))
    # the state to the links of either direction, the votes by (vertex, label) and by vertex
    assert text.count("InMemoryRelation") == 2 and text.count("SortMergeJoin") == 2
    assert text.count("Exchange hashpartitioning") == 4
    wishes = Folder(spark).write(settled._wishes(state, links), "wishes")
    text = without_cached(plan(settled._moves(wishes, links)))
    # those that want to, to the links; the largest draws, and the state they are compared with
    assert text.count("InMemoryRelation") == 2 and text.count("SortMergeJoin") == 3
    assert text.count("Exchange hashpartitioning") == 4
    for one in links.values():
        one.unpersist()


def test_searching_from_both_ends_follows_few_links(spark, stored):
    ends = [row["id"] for row in stored[0].orderBy("id").limit(40).collect()]
    one_way = both = 0
    for k in (0, 10):
        single = g.find_path(stored[1], ends[k], ends[k + 5])
        double = g.find_path(stored[1], ends[k], ends[k + 5], both_ways=True)
        assert single.path.collect() == double.path.collect() and single.hops == double.levels
        one_way, both = one_way + single.links_followed, both + double.links_followed
    assert 3 * both < one_way


def test_modularity_joins_the_edges_once(stored, no_broadcast):
    vertices, edges = stored
    labels = vertices.selectExpr("id", "id AS label")
    for frame in (g.modularity(edges, labels), g.modularity_directed(edges, labels)):
        # two joins for the labels of both ends; the other scans of the edges find hot keys
        assert plan(frame).count("LeftOuter") >= 2
        assert plan(frame).split("Subquery")[0].count("SortMergeJoin") == 2


def test_scans_read_only_the_columns_needed(stored):
    text = plan(g.out_degrees(stored[1]))
    assert "ReadSchema: struct<src:string>" in text
    text = plan(g.in_degree_histogram(stored[0]))
    assert "ReadSchema: struct<in_degree:bigint>" in text


def test_top_k_never_sorts_everything(stored):
    assert "TakeOrderedAndProject(limit=10" in plan(g.top_in_degree(stored[0]))
    ranks = stored[0].selectExpr("id", "1D AS rank")
    assert "WindowGroupLimit" in plan(g.top_by_metric(g.rank_degree_profile(stored[0], ranks)))


def test_counts_are_combined_before_the_shuffle(stored):
    for frame in (g.vertex_degrees(stored[1]), g.in_degrees(stored[1])):
        text = plan(frame)
        assert "partial_" in text and text.count("Exchange hashpartitioning") == 1


def test_no_cross_joins_and_no_python(stored):
    vertices, edges = stored
    labels = vertices.selectExpr("id", "id AS label")
    for frame in (
        g.graph_stats(vertices, edges),
        g.modularity(edges, labels),
        g.modularity_directed(edges, labels),
        g.authority_scores(vertices, edges),
        g.undirected_edges(edges),
    ):
        text = plan(frame)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
        assert "Python" not in text and "Arrow" not in text


def test_a_hub_and_copies_of_a_link_are_many_adjacency_rows(spark, split_hubs):
    fan = spark.range(2000).selectExpr("0L AS vid", "id AS target", "2000L AS degree")
    copies = spark.range(0, 2000, 1, 50).selectExpr("1L AS vid", "7L AS target", "2000L AS degree")
    rows = adjacency(fan.union(copies), 4000)
    found = rows.selectExpr("vid", "part", "size(targets) AS n").groupBy("vid").agg(
        {"part": "count", "n": "max"}
    )
    sizes = {row["vid"]: (row["count(part)"], row["max(n)"]) for row in found.collect()}
    rows.unpersist()
    assert sizes[0][0] > 300 and sizes[0][1] < 30
    # copies are told apart by the partition they are read from: 50 of 40 rows each
    assert sizes[1][0] > 35 and sizes[1][1] <= 120


def test_every_hot_key_is_split(spark, monkeypatch):
    from linkrank.plans import heaviest, salted_join

    monkeypatch.setattr("linkrank.plans.skew.HOT_ROWS", 5)
    counts = spark.range(3_000).selectExpr("id AS key", "5 + id % 3 AS n")
    hot = heaviest(counts, "key", "n")
    assert hot.count() == 3_000 and hot.where("buckets = 2").count() == 2_000
    monkeypatch.setattr("linkrank.plans.skew.HOT_SHARE", 10)
    giant = counts.unionByName(spark.range(2).selectExpr("-1 - id AS key", "1000000L AS n"))
    assert {row.key for row in heaviest(giant, "key", "n").collect()} == {-1, -2}
    rows = spark.range(9_000).selectExpr("id % 3000 AS key", "id")
    table = spark.range(3_000).selectExpr("id AS key", "id * 2 AS value")
    assert salted_join(rows, table, "key", hot).where("value = 2 * key").count() == 9_000


def test_half_rounds_exchange_sums_alone(spark, stored, no_broadcast, monkeypatch):
    from linkrank.operators import spreading
    from linkrank.plans import store_numbered

    monkeypatch.setattr("linkrank.plans.layout.FEW_LINKS", 100)
    graph = store_numbered(*stored, Scratch(spark).folder)
    links = graph.links("out")
    scores = graph.index.table.selectExpr("vid", "1D AS score")
    assert spreading._parts(graph.index.table, "out_degree", graph.index.max_out) is None
    text = without_cached(plan(spreading._half_round(scores, links, None, 2.0)))
    # the scores to the links and the sums to their vertices; no state rides along
    assert text.count("Exchange hashpartitioning") == 2 and "max(" not in text
    links.unpersist()


def test_votes_without_a_hot_vertex_are_exchanged_once(spark, no_broadcast, monkeypatch):
    from linkrank.operators import communities

    rows = [(1, 7), (1, 7), (1, 5), (2, 9), (2, 4), (2, 4), (2, 9), (3, 3)]
    heard = spark.createDataFrame(rows, "vid long, label long")
    once = communities._winners(heard, 4)
    text = plan(once)
    assert text.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in text
    monkeypatch.setattr("linkrank.plans.skew.HOT_ROWS", 4)
    twice = communities._winners(heard, 4)
    assert plan(twice).count("Exchange hashpartitioning") == 2
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, 7), (2, 4), (3, 3)]


def test_customers_lines_are_dealt_out_by_their_size(spark, tables, no_broadcast, monkeypatch):
    from registry import graphs

    before = ROWS["cust_supp"](spark, tables)
    monkeypatch.setattr(graphs, "BYTES_PER_PARTITION", 1024)
    after = ROWS["cust_supp"](spark, tables)
    dealt = [int(n) for n in re.findall(r"hashpartitioning\(l_orderkey#\d+L?, (\d+)\)", plan(after))]
    assert dealt and min(dealt) > 8  # either side of the join
    assert sorted(before.collect()) == sorted(after.collect())
