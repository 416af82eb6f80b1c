"""Nearest neighbours among jittered and rescaled copies against all pairs."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import plain  # noqa: E402
from linkrank.llm import ann  # noqa: E402


def test_copies(spark):
    rng = np.random.default_rng(7)
    clumps = []
    for jitter in (0.001, 0.005):
        base = rng.standard_normal(64)
        clumps.append(base + jitter * rng.standard_normal((300, 64)))
    base = rng.standard_normal(64)
    clumps.append(base * 2.0 ** np.arange(-20, 20)[:, None])  # powers of 2, so that ties are exact
    clumps.append(rng.standard_normal((300, 64)))
    x = np.vstack(clumps)
    rows = [(k, one.tolist()) for k, one in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = list(range(0, len(rows), 20))
    queries = vectors.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding AS x")
    found = {}
    for r in ann.search(ann.build_graph(vectors), queries, 5).collect():
        found.setdefault(r.query_id, set()).add(r.id)
    exact = plain.nearest([k for k, _ in rows], [v for _, v in rows], set(asked), 5)
    hits = [len(found[q] & {j for _, j in exact[q]}) / 5 for q in asked]
    assert min(np.mean(hits[:15]), np.mean(hits[15:30]), np.mean(hits[30:])) >= 0.95, hits
    assert found[600] == {601, 602, 603, 604, 605}


def test_joins_go_on_until_lists_settle(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((6000, 24))
    vectors = spark.createDataFrame(
        [(k, one.tolist()) for k, one in enumerate(x)], "vec_id long, embedding array<double>"
    )
    index = ann.build_graph(vectors)
    more = ann._local_joins(index.scratch, index.nodes, index.graph, ann.NEIGHBOURS, 99)
    lists = index.graph.selectExpr("u", "v", "s", "false AS found").unionByName(
        more.selectExpr("u", "v", "s", "true AS found")
    )
    changed, entries = ann._changes(ann._best(lists, ann.NEIGHBOURS))
    assert entries == 6000 * ann.NEIGHBOURS
    assert changed <= ann.SETTLED * entries


def test_cosines_beyond_the_range_of_squares():
    a, b = np.array([3e200, 4e200]), np.array([4e-200, 3e-200])
    assert ann.cosine(a, b) == pytest.approx(24 / 25)
    assert ann.cosine(np.array([3.0, 4.0]), np.array([4.0, 3.0, 0.0])) == pytest.approx(24 / 25)
