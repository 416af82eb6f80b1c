"""Labels that come to rest, against a plain loop, on graphs whose labels would swap for ever."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from linkrank import operators as g
from linkrank.operators import settled
from linkrank.plans import Scratch, store_numbered

EDGES = "src string, dst string"


def graph(spark, edges):
    links = spark.createDataFrame(edges, EDGES)
    return g.vertex_degrees(links), links


def plain(edges, max_iter=None, near_moves=None):
    """Labels and history by one dictionary per vertex.

    ``near_moves`` gets, per round, how many links the vertices that moved have, those next to them, and how many
    these are.
    """
    ids = {end for edge in edges for end in edge}
    near = defaultdict(list)
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near[a].append(b)
            near[b].append(a)
    label = {v: v for v in ids}
    draw = {v: int(hashlib.md5((v or "").encode()).hexdigest()[:8], 16) % 2**31 for v in ids}
    history = []
    while max_iter is None or len(history) < max_iter:
        best = {}
        for v, ends in near.items():
            heard = Counter(label[u] for u in ends)
            first = min(heard, key=lambda name: (-heard[name], name))
            if heard[first] > heard[label[v]]:
                best[v] = first
        if not best:
            history.append((len(history) + 1, 0, 0, True))
            break
        moves = [
            v for v in best
            if all((draw[u], u) < (draw[v], v) for u in near[v] if u in best)
        ]
        for v in moves:
            label[v] = best[v]
        if near_moves is not None:
            degree = Counter(end for edge in set(edges) for end in edge)
            beside = {u for v in moves for u in near[v]}
            near_moves.append(
                (sum(degree[v] for v in moves), sum(degree[u] for u in beside), len(beside))
            )
        history.append((len(history) + 1, len(best), len(moves), False))
        draw = {v: (one * 1103515245 + 12345) % 2**31 for v, one in draw.items()}
    return label, history


def random_edges(seed):
    rng = random.Random(seed)
    edges = [(f"v{rng.randrange(50):02}", f"v{int(50 * rng.random() ** 2):02}") for _ in range(140)]
    return edges + [("hub", f"v{k:02}") for k in range(50)] + [("v01", "v01"), ("lone", "lone")]


CASES = {
    "pair": [("a", "b"), ("b", "a")],
    "star": [("hub", f"x{k}") for k in range(12)] + [(f"x{k}", "hub") for k in range(6)],
    "parallel": [("a", "b")] * 3 + [("b", "c")] * 2,
    "nulls": [(None, "b"), ("a", None), ("a", "b"), (None, None), ("self", "self")],
    "random": random_edges(1),
    "other": random_edges(2),
}


@pytest.mark.parametrize("case", CASES)
def test_against_loop(spark, split_hubs, case):
    expected, rounds = plain(CASES[case])
    labels, history = g.settled_label_rounds(*graph(spark, CASES[case]))
    assert {row.id: row.label for row in labels.collect()} == expected
    assert [tuple(row) for row in history.orderBy("iteration").collect()] == rounds
    assert rounds[-1][-1]


def test_pairs_that_swap_come_to_rest(spark):
    edges = [(f"a{k}", f"b{k}") for k in range(5)] + [(f"b{k}", f"a{k}") for k in range(5)]
    assert not g.label_propagation_rounds(spark.createDataFrame(edges, EDGES), 6)[1].where(
        "converged"
    ).count()
    labels, history = g.settled_label_rounds(*graph(spark, edges))
    assert history.where("converged").count() == 1
    assert {row.label[1:] for row in labels.collect() if row.id[1:] == row.label[1:]} == set("01234")
    assert labels.select("label").distinct().count() == 5


def test_no_two_neighbours_move_at_once(spark):
    edges = random_edges(3)
    before = {v: v for edge in edges for v in edge}
    for rounds in (1, 2, 3):
        after = {r.id: r.label for r in g.settled_labels(*graph(spark, edges), rounds).collect()}
        moved = {v for v in after if after[v] != before[v]}
        assert moved
        assert not [(a, b) for a, b in edges if a != b and a in moved and b in moved]
        inside = [sum(label[a] == label[b] for a, b in edges) for label in (before, after)]
        assert inside[0] < inside[1]
        before = after


@pytest.mark.parametrize("case, share", [("star", 1), ("nulls", 1), ("random", 1), ("other", 0.5)])
def test_votes_are_counted_near_the_last_moves(spark, split_hubs, monkeypatch, case, share):
    asked, renewed = [], settled._renewed

    def seen(state, near, n_asked, links):
        asked.append((near.count(), n_asked))
        return renewed(state, near, n_asked, links)

    monkeypatch.setattr(settled, "_renewed", seen)
    monkeypatch.setattr(settled, "FEW_LINKS", 0)
    monkeypatch.setattr(settled, "SHARE", share)
    edges = sorted(set(CASES[case]), key=repr)
    labels, history = g.settled_label_rounds(*graph(spark, edges))
    sizes = []
    expected, rounds = plain(edges, near_moves=sizes)
    assert {row.id: row.label for row in labels.collect()} == expected
    assert [tuple(row) for row in history.orderBy("iteration").collect()] == rounds
    most = share * 2 * len(edges)
    assert asked == [(n, links) for told, links, n in sizes if told <= most and links <= most]
    assert asked


def test_limits_and_stored_graph(spark):
    edges = random_edges(4)
    vertices, links = graph(spark, edges)
    stored = store_numbered(vertices, links, Scratch(spark).folder)
    for limit in (0, 1, 3):
        expected, rounds = plain(edges, limit)
        labels, history = g.settled_label_rounds(None, None, limit, stored)
        assert {row.id: row.label for row in labels.collect()} == expected
        assert [tuple(row) for row in history.collect()] == rounds
    empty = g.settled_label_rounds(*graph(spark, []))
    assert empty[0].count() == 0
    assert [tuple(row) for row in empty[1].collect()] == [(1, 0, 0, True)]


@pytest.mark.parametrize("case", CASES)
def test_kept_votes_give_the_same_rounds(spark, monkeypatch, case):
    monkeypatch.setattr(settled, "MANY_LINKS", 0)
    monkeypatch.setattr(settled, "_wishes", None)  # votes are never counted anew
    expected, rounds = plain(CASES[case])
    labels, history = g.settled_label_rounds(*graph(spark, CASES[case]))
    assert {row.id: row.label for row in labels.collect()} == expected
    assert [tuple(row) for row in history.orderBy("iteration").collect()] == rounds


@pytest.mark.parametrize("case", ["nulls", "other"])
def test_kept_votes_of_hubs_and_equal_draws(spark, split_hubs, monkeypatch, case):
    monkeypatch.setattr(settled, "RANGE", 8)  # few draws: many are equal
    found = []
    for least in (2**40, 0):  # counted anew, then kept
        monkeypatch.setattr(settled, "MANY_LINKS", least)
        labels, history = g.settled_label_rounds(*graph(spark, CASES[case]))
        found.append((sorted(map(repr, labels.collect())), sorted(history.collect())))
    assert found[0] == found[1]


def test_kept_votes_stay_in_their_buckets(spark, monkeypatch):
    """A round's changes are exchanged, the votes are not."""
    monkeypatch.setattr(settled, "MANY_LINKS", 0)
    added = []

    def add(self, changes, add=settled._Votes.add):
        if self.table is not None:
            votes = self.table.unionByName(changes.repartition(self.buckets, "vid"))
            text = votes.groupBy("vid", "label").count()._jdf.queryExecution().executedPlan().toString()
            added.append(text[: text.index("Union")].count("Exchange"))
            wishes = self.wishes()._jdf.queryExecution().executedPlan().toString()
            added.append(wishes.count("Exchange"))
        add(self, changes)

    monkeypatch.setattr(settled._Votes, "add", add)
    vertices, links = graph(spark, random_edges(5))
    labels, history = g.settled_label_rounds(vertices, links, 2)
    expected, rounds = plain(random_edges(5), 2)
    assert {row.id: row.label for row in labels.collect()} == expected
    assert [tuple(row) for row in history.collect()] == rounds
    assert added == [0, 0, 0, 0]


@pytest.mark.parametrize("case, changes", [("random", 0), ("star", 1)])
def test_kept_votes_with_draws_told_by_few(spark, monkeypatch, case, changes):
    """Small draws are not told but asked for, and changes of the votes are sorted where they are many."""
    monkeypatch.setattr(settled, "MANY_LINKS", 0)
    monkeypatch.setattr(settled, "FEW_TOLD", -1)
    monkeypatch.setattr(settled, "FEW_CHANGES", changes)
    floors, floor = [], settled._floor
    monkeypatch.setattr(settled, "_floor", lambda *sizes: floors.append(floor(*sizes)) or floors[-1])
    expected, rounds = plain(CASES[case])
    labels, history = g.settled_label_rounds(*graph(spark, CASES[case]))
    assert {row.id: row.label for row in labels.collect()} == expected
    assert [tuple(row) for row in history.orderBy("iteration").collect()] == rounds
    assert 0 < floors[0] < settled.RANGE


def test_kept_votes_of_split_hubs_told_by_few(spark, split_hubs, monkeypatch):
    monkeypatch.setattr(settled, "MANY_LINKS", 0)
    monkeypatch.setattr(settled, "FEW_TOLD", -1)
    monkeypatch.setattr(settled, "FEW_CHANGES", 0)
    labels, history = g.settled_label_rounds(*graph(spark, CASES["other"]))
    expected, rounds = plain(CASES["other"])
    assert {row.id: row.label for row in labels.collect()} == expected
    assert [tuple(row) for row in history.orderBy("iteration").collect()] == rounds


def test_kept_votes_are_a_row_for_each_vertex(spark, monkeypatch):
    monkeypatch.setattr(settled, "MANY_LINKS", 0)
    sizes = []

    def add(self, changes, add=settled._Votes.add):
        if self.lists is not None:
            lists = changes.repartition(self.buckets, "vid").groupBy("vid").agg(
                F.expr("collect_list(struct(n, -label AS back)) AS changes")
            )
            text = self._merged(lists)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in text[: text.index("linkrank_votes_")]  # the lists stay where they are
        add(self, changes)
        sizes.append((self.lists.count(), self.table.count()))

    monkeypatch.setattr(settled._Votes, "add", add)
    vertices, links = graph(spark, random_edges(5))
    g.settled_label_rounds(vertices, links, 2)
    heard = {frozenset(edge) for edge in random_edges(5) if edge[0] != edge[1]}
    assert [rows for rows, votes in sizes] == [vertices.count()] * 3
    assert sizes[0][1] == vertices.count() + 2 * len(heard)  # the own label, and each neighbour's
    assert sizes[2][1] < sizes[0][1]
