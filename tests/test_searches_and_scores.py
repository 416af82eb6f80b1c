"""Searches from both ends, scores and sketches along links, fits and places, against plain loops."""

import random

import brute
import numpy as np
import pytest

from linkrank import operators as g
from linkrank.plans import Scratch, store_numbered


def frame(spark, edges):
    return spark.createDataFrame(edges, "src string, dst string")


def graph(spark, edges):
    links = frame(spark, edges)
    return g.vertex_degrees(links), links


def random_edges(seed, n=60, m=110):
    rng = random.Random(seed)
    edges = {(f"v{rng.randrange(n):02}", f"v{int(n * rng.random() ** 3):02}") for _ in range(m)}
    return sorted(edges) + [(None, "v01"), ("v02", None), ("lone", "lone"), ("p", "q")]


def least_path(edges, source, target):
    """The shortest path whose vertices are smallest from the target back."""
    depth = brute.hops(edges, source)
    if target not in depth:
        return []
    path, level = [target], depth[target]
    while level > 1:
        level -= 1
        path.append(min(a for a, b in edges if b == path[-1] and depth.get(a) == level and a != source))
    return [source, *path[::-1]]


def nodes(search):
    return [row["node"] for row in search.path.orderBy("step").collect()]


@pytest.mark.parametrize("few", [500_000, 2])
def test_paths_from_one_end_and_from_both(spark, few, monkeypatch, split_hubs):
    monkeypatch.setattr("linkrank.operators.paths.FEW", few)
    edges = random_edges(1)
    links = frame(spark, edges)
    numbered = store_numbered(*graph(spark, edges), Scratch(spark).folder)
    depths = {source: brute.hops(edges, source) for source in ("v10", "v20", "v30", "v40")}
    source = max(depths, key=lambda one: len(depths[one]))
    target = max(depths[source], key=lambda one: (depths[source][one], one))
    for source, target in [(source, target), ("v00", "v00"), ("lone", "lone"), ("p", "v00")]:
        expected = least_path(edges, source, target)
        for both_ways in (False, True):
            found = g.find_path(None, source, target, both_ways=both_ways, numbered=numbered)
            assert nodes(found) == expected, (source, target, both_ways)
            assert found.exhausted == (not expected)
            assert found.hops == (len(expected) - 1 if expected else None)
    assert nodes(g.find_path(links, "nobody", "v00")) == []


def test_giving_up_is_not_the_end_of_the_search(spark):
    chain = [(f"{k:02}", f"{k + 1:02}") for k in range(12)]
    links = frame(spark, chain)
    for both_ways in (False, True):
        gave_up = g.find_path(links, "00", "09", max_depth=8, both_ways=both_ways)
        assert gave_up.hops is None and not gave_up.exhausted and gave_up.levels == 8
        found = g.find_path(links, "00", "09", max_depth=9, both_ways=both_ways)
        assert found.hops == 9 and tuple(found.summary().first())[:3] == (True, 9, False)
        none = g.find_path(links, "09", "00", both_ways=both_ways)
        assert none.exhausted and tuple(none.summary().first())[:3] == (False, None, True)
    sizes = g.bfs_frontier_sizes(links, "00", max_depth=3).collect()
    assert [tuple(row) for row in sizes] == [(d, 1, False) for d in (1, 2, 3)]
    assert all(row.exhausted for row in g.bfs_frontier_sizes(links, "00").collect())


def matrix(edges):
    ids = sorted({end for edge in edges for end in edge if end is not None})
    place = {v: k for k, v in enumerate(ids)}
    a = np.zeros((len(ids), len(ids)))
    for src, dst in edges:
        if src is not None and dst is not None:
            a[place[src], place[dst]] = 1
    return ids, a


def test_hubs_and_authorities(spark, split_hubs):
    edges = random_edges(5)
    ids, a = matrix(edges)
    hub = np.ones(len(ids))
    for _ in range(7):
        authority = a.T @ hub
        authority /= np.linalg.norm(authority)
        hub = a @ authority
        hub /= np.linalg.norm(hub)
    found = {r.id: (r.hub, r.authority) for r in g.hits(*graph(spark, edges), iterations=7).collect()}
    assert found.pop(None) == (0, 0)
    assert found.keys() == set(ids)
    for k, v in enumerate(ids):
        assert found[v] == pytest.approx((hub[k], authority[k]), abs=1e-12)
    lonely = [("a", None), (None, "b")]
    assert {tuple(r)[1:] for r in g.hits(*graph(spark, lonely)).collect()} == {(0.0, 0.0)}
    assert g.hits(*graph(spark, [])).count() == 0


def test_hop_distribution(spark, split_hubs):
    edges = random_edges(1, n=200, m=500)
    ids, a = matrix(edges)
    reach = np.eye(len(ids), dtype=bool)
    exact = [int(reach.sum())]
    while True:
        further = reach | ((a @ reach) > 0)
        if further.sum() == reach.sum():
            break
        reach = further
        exact.append(int(reach.sum()))
    lonely = 1  # the null end is a vertex that reaches itself
    found = g.hop_distribution(*graph(spark, edges), lg_k=12).orderBy("hops").collect()
    assert [r.hops for r in found] == list(range(len(exact)))
    for row, n in zip(found, exact, strict=True):
        assert row.n_pairs == pytest.approx(n + lonely, rel=3 / 2**6)
    assert found[-1].share == 1 and sum(r.new_pairs for r in found) == pytest.approx(found[-1].n_pairs)
    assert [r.hops for r in g.hop_distribution(*graph(spark, edges), max_hops=2).collect()] == [0, 1, 2]
    whole = spark.createDataFrame([(0, 0.5), (1, 0.8), (2, 1.0)], "hops int, share double")
    assert g.effective_hops(whole, 0.9).first().hops == pytest.approx(1.5)
    assert g.hop_distribution(*graph(spark, [])).first().n_pairs == 0


def test_dangling_ranks_are_handed_to_all(spark):
    edges = [edge for edge in random_edges(8) if None not in edge]
    found = {r.id: r.rank for r in g.pagerank(*graph(spark, edges), 9, redistribute=True).collect()}
    ids, a = matrix(edges)
    out = a.sum(axis=1)
    rank = np.full(len(ids), 1 / len(ids))
    for _ in range(9):
        idle = rank[out == 0].sum()
        rank = (0.15 + 0.85 * idle) / len(ids) + 0.85 * a.T @ (rank / np.maximum(out, 1))
    assert [found[v] for v in ids] == pytest.approx(rank.tolist(), abs=1e-12)
    assert (out == 0).any() and sum(found.values()) == pytest.approx(1)
    assert g.pagerank(*graph(spark, []), redistribute=True).count() == 0


def test_residuals_lead_to_the_ranks(spark):
    vertices, links = graph(spark, [e for e in random_edges(9) if None not in e])
    settled = {r.id: r.rank for r in g.pagerank(vertices, links, 200).collect()}
    ranks, pushes = g.residual_pagerank(vertices, links, tol=1e-8)
    found = {r.id: r.rank for r in ranks.collect()}
    assert sum(abs(found[v] - settled[v]) for v in settled) < 1e-8 / 0.15
    rows = pushes.orderBy("iteration").collect()
    assert rows[0].n_pushed == len(settled) and rows[-1].residual <= 1e-8
    assert all(a.n_pushed >= b.n_pushed for a, b in zip(rows, rows[1:], strict=False))
    assert rows[-1].n_pushed < rows[0].n_pushed
    assert g.residual_pagerank(*graph(spark, []))[0].count() == 0


def test_power_law_fit(spark):
    rng = random.Random(4)
    degrees = [int(2.5 * (1 - rng.random()) ** (-1 / 1.3)) + rng.randrange(2) for _ in range(3000)] + [0] * 500
    vertices = spark.createDataFrame([(str(k), 0, d) for k, d in enumerate(degrees)],
                                     "id string, out_degree long, in_degree long")
    best = None
    for x_min in sorted(set(degrees) - {0}):
        tail = np.array(sorted(d for d in degrees if d >= x_min), "f8")
        if len(set(tail)) < 2:
            continue
        alpha = 1 + len(tail) / np.log(tail / (x_min - 0.5)).sum()
        x = np.unique(tail)
        share = np.searchsorted(tail, x, "right") / len(tail)
        far = np.abs(share - (1 - ((x + 0.5) / (x_min - 0.5)) ** (1 - alpha))).max()
        if best is None or far < best[3] - 1e-12:
            best = (x_min, len(tail), alpha, far)
    assert tuple(g.power_law_fit(vertices).first()) == pytest.approx(best)
    assert g.power_law_fit(vertices.limit(0)).count() == 0


def test_places_with_ties(spark):
    values = [3, 1, 3, 3, 0, 0, 7, 1, 1, 1]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v int").repartition(5)
    found = {r.k: r.place for r in g.average_ranks(rows, "v", "place").collect()}
    for k, v in enumerate(values):
        less, same = sum(w < v for w in values), values.count(v)
        assert found[k] == less + (same + 1) / 2
