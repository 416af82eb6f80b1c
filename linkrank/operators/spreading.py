"""Scores and sketches that travel along the links in both directions: hubs, authorities, reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from linkrank.functions import columns, part_count
from linkrank.plans import NumberedGraph, Scratch, spread, store_numbered

HOPS = "hops int, n_pairs double, new_pairs double, share double"


def _numbered(
    vertices: DataFrame | None, edges: DataFrame | None, numbered: NumberedGraph | None
) -> tuple[Scratch, NumberedGraph]:
    if numbered is None:
        scratch = Scratch(vertices.sparkSession)
        return scratch, store_numbered(vertices, edges, scratch.path("graph"))
    return Scratch(numbered.index.table.sparkSession), numbered


def hits(
    vertices: DataFrame | None,
    edges: DataFrame | None,
    iterations: int = 20,
    numbered: NumberedGraph | None = None,
) -> DataFrame:
    """``id, hub, authority`` after ``iterations`` rounds from hub scores that are all equal.

    In a round a page's authority is the sum of the hub scores of the pages linking to it, then
    its hub score that of the authorities it links to; either is scaled to squares that add up to 1. The sum of
    squares is taken while a half round is written, and divides what the next one sends: no pass
    is made for it. Without links all scores are 0.
    """
    scratch, graph = _numbered(vertices, edges, numbered)
    links = {direction: graph.links(direction) for direction in ("out", "into")}
    index = graph.index.table
    degrees = {"out": ("out_degree", graph.index.max_out), "into": ("in_degree", graph.index.max_in)}
    parts = {way: _parts(index, degree, most) for way, (degree, most) in degrees.items()}
    scores = {"hub": index.select("vid", F.lit(1.0).alias("score"))}
    norms = {"hub": 1.0, "authority": 1.0}
    for done in range(1, iterations + 1 if graph.index.n_links else 1):
        for direction, sent, made in (("out", "hub", "authority"), ("into", "authority", "hub")):
            seen = Observation()
            half = _half_round(scores[sent], links[direction], parts[direction], norms[sent])
            half = half.observe(seen, F.sum(F.col("score") * F.col("score")).alias("squares"))
            scores[made] = scratch.write(half, f"{made}-{done}")
            scratch.drop(f"{made}-{done - 1}")
            norms[made] = (seen.get["squares"] or 0.0) ** 0.5 or 1.0
    named = index.select("id", "vid")
    for kind in ("hub", "authority"):
        if kind in scores and graph.index.n_links:
            score = F.col("score") / F.lit(norms[kind])
            named = named.join(scores[kind].select("vid", score.alias(kind)), "vid", "left")
        else:
            named = named.withColumn(kind, F.lit(None).cast("double"))
    named = named.select("id", *(F.coalesce(kind, F.lit(0.0)).alias(kind) for kind in norms))
    result = scratch.write(named, "result")
    for one in links.values():
        one.unpersist()
    scratch.drop(*(f"{kind}-{iterations}" for kind in norms))
    if numbered is None:
        graph.drop(scratch, "graph")
    return result


def _parts(index: DataFrame, degree: str, most: int) -> DataFrame | None:
    """``vid, parts`` of the vertices with several adjacency rows; None if no degree is that large."""
    if most <= columns.LINKS_PER_PART:
        return None
    return index.select("vid", part_count(degree).alias("parts")).where("parts > 1")


def _half_round(scores: DataFrame, links: DataFrame, parts: DataFrame | None, norm: float) -> DataFrame:
    """``vid, score``: the scaled scores summed up along the links. Vertices that nothing arrives at have none.

    Sums alone are made and exchanged; how many rows a vertex's links have is looked up where that is several.
    """
    scores = scores.where("score <> 0").selectExpr("vid", f"score / {norm!r}D AS score")
    if parts is None:
        senders = scores.withColumn("parts", F.lit(1))
    else:
        senders = scores.join(parts, "vid", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return spread(senders, links, "score").groupBy("vid").agg(F.sum("score").alias("score"))


def hop_distribution(
    vertices: DataFrame | None,
    edges: DataFrame | None,
    lg_k: int = 12,
    max_hops: int | None = None,
    numbered: NumberedGraph | None = None,
) -> DataFrame:
    """``hops, n_pairs, new_pairs, share``: how many pairs of pages are within so many clicks.

    ``n_pairs`` counts the pairs from a page to those it reaches by at most ``hops`` links, itself included;
    ``new_pairs`` what the last link adds, and ``share`` the part of all pairs that any number of links connects. It ends
    when a round adds none, or at ``max_hops``.

    Every vertex has a sketch of the vertices within reach (HyperLogLog of ``2 ** lg_k`` registers, with a relative error of about
    ``1 / sqrt(2 ** lg_k)`` for each vertex, less for the sum), which a round merges with those of the pages it
    links to. So a round costs the links and not the pairs; sketches for one vertex are merged before they are moved.
    """
    scratch, graph = _numbered(vertices, edges, numbered)
    links = graph.links("into")
    sketches = graph.index.table.groupBy("vid").agg(F.hll_sketch_agg("vid", lg_k).alias("sketch"))
    parts = graph.index.table.select("vid", part_count("in_degree").alias("parts"))
    state = scratch.write(parts.join(sketches, "vid"), "reach-0")
    totals = [float(graph.index.n_vertices)]
    while graph.index.n_links and (max_hops is None or len(totals) <= max_hops):
        done = len(totals)
        reached = spread(state, links, "NULL AS parts", "sketch")
        state = scratch.write(
            state.select("vid", "parts", "sketch").union(reached).groupBy("vid").agg(
                F.max("parts").alias("parts"), F.hll_union_agg("sketch").alias("sketch")
            ),
            f"reach-{done}",
        )
        scratch.drop(f"reach-{done - 1}")
        total = float(state.agg(F.sum(F.hll_sketch_estimate("sketch"))).first()[0])
        if total <= totals[-1]:
            break
        totals.append(total)
    links.unpersist()
    scratch.drop(f"reach-{len(totals) - 1}", f"reach-{len(totals)}")
    n_all = totals[-1]
    if numbered is None:
        graph.drop(scratch, "graph")
    rows = [
        (hops, n, n - (totals[hops - 1] if hops else 0.0), n / n_all if n_all else 1.0)
        for hops, n in enumerate(totals)
    ]
    return graph.index.table.sparkSession.createDataFrame(rows, HOPS)


def effective_hops(distribution: DataFrame, share: float = 0.9) -> DataFrame:
    """One row, ``hops``: clicks within which ``share`` of all connected pairs are, between two numbers in proportion."""
    before = distribution.selectExpr("hops + 1 AS hops", "share AS below")
    steps = distribution.join(before, "hops", "left").where(F.col("share") >= share)
    first = steps.orderBy("hops").limit(1)
    part = (F.lit(share) - F.col("below")) / (F.col("share") - F.col("below"))
    return first.select(F.coalesce(F.col("hops") - 1 + part, F.col("hops").cast("double")).alias("hops"))
