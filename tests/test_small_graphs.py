"""Hand-made graphs with known answers, and random ones against plain loops."""

import random

import brute
import pytest

from linkrank import operators as g

CHAIN = [(f"{k:02d}", f"{k + 1:02d}") for k in range(40)]
HUB = (
    [("hub", f"x{k}") for k in range(30)]
    + [(f"x{k}", "sink") for k in range(30)]
    + [(f"x{k}", f"x{(k * 7 + 3) % 30}") for k in range(30)]
    + [("far", "away"), ("self", "self")]
)
CASES = {
    "chain": CHAIN,
    "self_loop": [("a", "a"), ("a", "b")],
    "dangling": [("a", "b"), ("a", "c")],
    "two_parts": [("a", "b"), ("c", "d")],
    "swap": [("a", "b"), ("b", "a")],
    "cycle": [("a", "b"), ("b", "c"), ("c", "a")],
    "diamond": [("s", "x"), ("s", "y"), ("x", "t"), ("y", "t")],
    "null_end": [(None, "b"), ("a", None), ("a", "b")],
    "hub": HUB,
}


def frame(spark, edges):
    return spark.createDataFrame(edges, "src string, dst string")


def graph(spark, edges):
    links = frame(spark, edges)
    return g.vertex_degrees(links), links


def as_dict(rows):
    return {row[0]: row[1] for row in rows.collect()}


@pytest.mark.parametrize("case", CASES)
def test_degrees(spark, case):
    found = {row["id"]: (row["out_degree"], row["in_degree"])
             for row in g.vertex_degrees(frame(spark, CASES[case])).collect()}
    assert found == brute.degrees(CASES[case])


@pytest.mark.parametrize("case", ["dangling", "cycle", "null_end", "hub"])
def test_pagerank(spark, case):
    found = as_dict(g.pagerank(*graph(spark, CASES[case]), iterations=6))
    assert found == pytest.approx(brute.pagerank(CASES[case], 6), abs=1e-12)


def test_pagerank_leak_and_zero_rounds(spark):
    leaky = as_dict(g.pagerank(*graph(spark, CASES["dangling"]), iterations=3))
    assert sum(leaky.values()) < 1
    assert min(leaky.values()) >= 0.15 / 3 - 1e-12
    start = as_dict(g.pagerank(*graph(spark, CASES["dangling"]), iterations=0))
    assert start == pytest.approx({"a": 1 / 3, "b": 1 / 3, "c": 1 / 3})
    closed = as_dict(g.pagerank(*graph(spark, CASES["cycle"]), iterations=3))
    assert sum(closed.values()) == pytest.approx(1)


def test_pagerank_history_and_tolerance(spark):
    vertices, edges = graph(spark, CASES["hub"])
    history = g.pagerank_rounds(vertices, edges, iterations=7, report_every=3)[1].collect()
    assert [row["iteration"] for row in history] == [1, 3, 6]
    before, after = brute.pagerank(HUB, 5), brute.pagerank(HUB, 6)
    assert history[-1]["max_rank"] == pytest.approx(max(after.values()))
    assert history[-1]["l1_delta"] == pytest.approx(sum(abs(after[v] - before[v]) for v in after))
    ranks, stopped = g.pagerank_rounds(vertices, edges, report_every=1, tol=1e9)
    assert stopped.count() == 1
    assert as_dict(ranks) == pytest.approx(brute.pagerank(HUB, 1))


@pytest.mark.parametrize("case", CASES)
def test_components(spark, case):
    assert as_dict(g.connected_components(*graph(spark, CASES[case]))) == brute.components(
        CASES[case]
    )


def test_min_label_rounds(spark):
    labels, history = g.min_label_rounds(*graph(spark, CHAIN))
    assert as_dict(labels) == brute.components(CHAIN)
    expected = [(k, 41 - k, k == 41) for k in range(1, 42)]
    assert [tuple(row) for row in history.collect()] == expected


def test_min_label_rounds_stop_at_the_cap(spark):
    labels, history = g.min_label_rounds(*graph(spark, CHAIN), max_iter=3)
    assert [row.converged for row in history.collect()] == [False] * 3
    assert as_dict(labels)["40"] == "37"


@pytest.mark.parametrize("case", ["self_loop", "swap", "null_end", "hub"])
def test_label_propagation(spark, case):
    labels, history = g.label_propagation_rounds(frame(spark, CASES[case]), max_iter=5)
    expected, rounds = brute.label_propagation(CASES[case], 5)
    assert as_dict(labels) == expected
    if case != "null_end":  # a null label is no label to count
        found = history.collect()
        assert [tuple(row)[:3] for row in found] == rounds
        assert [row.converged for row in found] == [not changed for _, changed, _ in rounds]


def test_parallel_edges_vote_and_dedup_removes_them(spark):
    edges = frame(spark, [("a", "c"), ("a", "c"), ("a", "b")])
    assert as_dict(g.label_propagation(edges, 1))["a"] == "c"
    assert as_dict(g.label_propagation(g.dedup_edges(edges), 1))["a"] == "b"
    assert g.dedup_edges(edges).count() == 2


def test_null_endpoints(spark):
    edges = frame(spark, CASES["null_end"])
    assert g.dedup_edges(edges).count() == 3
    assert g.dedup_edges(edges, drop_null_endpoints=True).count() == 1
    assert {row["id"] for row in g.vertices(edges).collect()} == {None, "a", "b"}


def test_modularity(spark):
    edges = frame(spark, CASES["two_parts"])
    labels = spark.createDataFrame(
        [("a", "1"), ("b", "1"), ("c", "2"), ("d", "2")], "id string, label string"
    )
    # m = 2, inside = 2, out-links per community 1 and 1
    assert g.modularity(edges, labels).first()[0] == pytest.approx(2 / 4 - (2 / 4) / 16)
    assert g.modularity_directed(edges, labels).first()[0] == pytest.approx(1 - 2 / 4)
    assert g.intra_community_edges(edges, labels).first()[0] == 2
    assert as_dict(g.community_degree(edges, labels)) == {"1": 1, "2": 1}


def test_paths(spark):
    def path(case, source, target, **options):
        rows = g.shortest_path(frame(spark, CASES[case]), source, target, **options).collect()
        return [row["node"] for row in sorted(rows)]

    assert path("diamond", "s", "t") == ["s", "x", "t"]
    assert path("cycle", "a", "a") == ["a", "b", "c", "a"]
    assert path("self_loop", "a", "a") == ["a", "a"]
    assert path("two_parts", "a", "d") == []
    assert path("two_parts", "nowhere", "d") == []
    assert path("chain", "00", "06") == [f"{k:02d}" for k in range(7)]
    assert path("chain", "00", "07", max_depth=6) == []
    assert len(path("chain", "00", "07", max_depth=7)) == 8
    assert len(path("chain", "00", "40")) == 41


def test_distances(spark):
    edges = frame(spark, CASES["hub"])
    sizes = as_dict(g.bfs_frontier_sizes(edges, "hub"))
    reached = brute.hops(HUB, "hub")
    assert sizes == {d: list(reached.values()).count(d) for d in set(reached.values())}
    back = brute.hops([(b, a) for a, b in HUB], "sink")
    assert as_dict(g.distances_to(edges, "sink")) == {**back, "sink": 0}


def test_long_way_to_the_target(spark):
    assert as_dict(g.distances_to(frame(spark, CHAIN[:12]), "12"))["00"] == 12


def test_empty_graph(spark):
    vertices, edges = graph(spark, [])
    assert tuple(g.graph_stats(vertices, edges).first()) == (0, 0, 0.0)
    assert g.pagerank(vertices, edges, iterations=2).count() == 0
    assert g.connected_components(vertices, edges).count() == 0
    labels = g.label_propagation(edges)
    assert labels.count() == 0
    assert g.modularity(edges, labels).first()[0] is None
    assert g.modularity_directed(edges, labels).first()[0] is None
    assert g.shortest_path(edges, "a", "b").count() == 0
    assert g.power_law_alpha(vertices).first()["alpha"] is None


def random_graph(seed, n=60, m=220):
    """A graph whose hub ``h`` is on a third of all links, half of them each way."""
    draw = random.Random(seed)
    links = {(f"v{draw.randrange(n)}", f"v{draw.randrange(n)}") for _ in range(m)}
    links |= {("h", f"v{draw.randrange(n)}") for _ in range(m // 4)}
    links |= {(f"v{draw.randrange(n)}", "h") for _ in range(m // 4)}
    links |= {(f"w{k}", f"w{k + 1}") for k in range(12)}
    return sorted(links)


@pytest.mark.parametrize("seed", [1, 2])
def test_hubs_are_split_without_changing_results(spark, split_hubs, seed):
    links = random_graph(seed)
    vertices, edges = graph(spark, links)
    edges = edges.repartition(3)
    assert as_dict(g.pagerank(vertices, edges, iterations=4)) == pytest.approx(
        brute.pagerank(links, 4)
    )
    assert as_dict(g.connected_components(vertices, edges)) == brute.components(links)
    assert as_dict(g.min_label_rounds(vertices, edges)[0]) == brute.components(links)
    labels = g.label_propagation(edges, 3)
    assert as_dict(labels) == brute.label_propagation(links, 3)[0]
    plain = brute.label_propagation(links, 3)[0]
    inside = sum(plain[a] == plain[b] for a, b in links)
    assert g.intra_community_edges(edges, labels).first()[0] == inside
    out = {v: pair[0] for v, pair in brute.degrees(links).items()}
    weights = {row["dst"]: row["hub_weight"] for row in g.authority_scores(vertices, edges).collect()}
    assert weights == {
        target: sum(out[a] for a, b in links if b == target) for target in {b for _, b in links}
    }


def test_many_copies_of_one_edge(spark, split_hubs):
    links = [("a", "b")] * 40 + [("a", "c")] * 39 + [("c", "a"), ("b", "c")]
    edges = frame(spark, links).repartition(6)
    assert as_dict(g.label_propagation(edges, 2)) == brute.label_propagation(links, 2)[0]
    ranks = as_dict(g.pagerank(g.vertex_degrees(edges), edges, iterations=3))
    assert ranks == pytest.approx(brute.pagerank(links, 3))


def test_degrees_that_do_not_fit_the_edges_are_an_error(spark):
    once = frame(spark, [("a", "b"), ("a", "c")])
    copies = frame(spark, [("a", "b"), ("a", "b"), ("a", "c")])
    with pytest.raises(ValueError, match="3 links"):
        g.pagerank(g.vertex_degrees(once), copies, iterations=1)
    with pytest.raises(ValueError, match="6 links"):
        g.min_label_rounds(g.vertex_degrees(once), copies)


def test_null_ends_and_vertices_without_a_community(spark, split_hubs):
    links = [("a", "b")] * 9 + [("b", "a"), ("a", None), (None, "b"), ("a", "z")] + [(None, "a")] * 9
    edges = spark.createDataFrame(links, "src string, dst string").repartition(3)
    labels = spark.createDataFrame([("a", "a"), ("b", "a")], "id string, label string")
    assert g.intra_community_edges(edges, labels).first()[0] == 10
    m, d_out, d_in = len(links), 12, 20
    assert g.modularity(edges, labels).first()[0] == pytest.approx(
        10 / (2 * m) - d_out**2 / (2 * m) / (4 * m * m)
    )
    assert g.modularity_directed(edges, labels).first()[0] == pytest.approx(10 / m - d_out * d_in / m**2)
    assert g.intra_community_edges(edges.limit(0), labels).first()[0] == 0
    assert g.modularity(edges.limit(0), labels).first()[0] is None


def test_wide_levels(spark, split_hubs):
    links = random_graph(3)
    edges = frame(spark, links)
    found = as_dict(g.bfs_frontier_sizes(edges, "h", max_depth=3))
    depths = [d for v, d in brute.hops(links, "h").items() if v != "h" and d <= 3]
    assert found == {d: depths.count(d) for d in set(depths)}


def test_vertex_index_is_the_same_for_any_partitioning(spark):
    links = random_graph(4)
    numbered = [
        as_dict(g.vertex_index(g.vertex_degrees(frame(spark, links).repartition(n))))
        for n in (1, 7)
    ]
    assert numbered[0] == numbered[1]
    assert numbered[0] == {v: k for k, v in enumerate(sorted(brute.vertex_set(links)))}


def test_profiles(spark):
    vertices, edges = graph(spark, HUB)
    ranks = g.pagerank(vertices, edges, iterations=2)
    best = g.top_by_metric(g.rank_degree_profile(vertices, ranks), 3).collect()
    assert len(best) == 9
    first = {row["metric"]: row["id"] for row in best if row["position"] == 1}
    assert first["in_degree"] == "sink" and first["out_degree"] == "hub"
    assert g.in_degree_histogram(vertices).agg({"count": "sum"}).first()[0] == vertices.count()
    assert g.top_in_degree(vertices, 1).first()["id"] == "sink"
    assert -1 <= g.rank_degree_correlation(g.rank_degree_profile(vertices, ranks)).first()[0] <= 1
