"""PageRank, by a fixed number of rounds or by pushing what is left to hand on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from linkrank.functions import part_count
from linkrank.plans import (
    NumberedGraph,
    Scratch,
    adjacency,
    encode_edges,
    index_vertices,
    spread,
)
from linkrank.plans.layout import VertexIndex

HISTORY = "iteration int, max_rank double, l1_delta double"
PUSHES = "iteration int, n_pushed long, residual double"


def pagerank(
    vertices: DataFrame | None,
    edges: DataFrame | None,
    iterations: int = 20,
    damping: float = 0.85,
    redistribute: bool = False,
    numbered: NumberedGraph | None = None,
) -> DataFrame:
    """``id, rank`` after ``iterations`` rounds; see :func:`pagerank_rounds`."""
    return pagerank_rounds(
        vertices, edges, iterations, damping, redistribute=redistribute, numbered=numbered
    )[0]


def _out_links(
    vertices: DataFrame | None, edges: DataFrame | None, numbered: NumberedGraph | None
) -> tuple[Scratch, VertexIndex, DataFrame]:
    """The numbered vertices and their links, of a stored graph or numbered here."""
    if numbered is not None:
        scratch = Scratch(numbered.index.table.sparkSession)
        return scratch, numbered.index, numbered.links("out")
    scratch = Scratch(vertices.sparkSession)
    index = index_vertices(scratch, vertices)
    links = encode_edges(edges, index).select(
        F.col("u").alias("vid"), F.col("v").alias("target"), F.col("out_degree").alias("degree")
    )
    return scratch, index, adjacency(links, index.n_links)


def pagerank_rounds(
    vertices: DataFrame | None,
    edges: DataFrame | None,
    iterations: int = 20,
    damping: float = 0.85,
    report_every: int = 5,
    tol: float | None = None,
    redistribute: bool = False,
    numbered: NumberedGraph | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Ranks and their history.

    Every vertex starts at 1/N. In a round it hands its rank in equal shares to its
    out-links, and its new rank is ``(1 - damping) / N + damping * received``. The rank of a
    vertex without out-links is handed to nobody, so ranks may add up to less than one. With ``redistribute``
    it is handed to all vertices in equal shares, and ranks add up to one: a round's write sums up what the next
    one hands out, so this takes no job of its own.

    ``vertices`` has ``id, out_degree, in_degree``. The history has a row for round 1 and
    every ``report_every``-th round: the largest rank and the summed change of that round.
    With ``tol`` the loop ends at the first reported round whose change is below it. A ``numbered`` graph
    is used instead of ``vertices`` and ``edges``.
    """
    scratch, index, adjacent = _out_links(vertices, edges, numbered)
    spark = index.table.sparkSession
    n = max(index.n_vertices, 1)

    state = index.table.select(
        "vid", part_count("out_degree").alias("parts"), F.lit(1.0 / n).alias("rank")
    )
    history = []
    done, idle = 0, 0.0
    if redistribute and index.n_vertices:
        idle = index.table.where("out_degree = 0").count() / n
    for done in range(1, iterations + 1):
        ranked = _round(state, adjacent, n, damping, idle)
        if redistribute and index.n_vertices:
            seen = Observation()
            ranked = ranked.observe(seen, F.sum(F.when(F.col("parts") == 0, F.col("rank"))).alias("idle"))
            state = scratch.write(ranked, f"ranks-{done}")
            idle = seen.get["idle"] or 0.0
        else:
            state = scratch.write(ranked, f"ranks-{done}")
        scratch.drop(f"ranks-{done - 1}")
        if done == 1 or done % report_every == 0:
            seen = state.selectExpr("max(rank)", "sum(abs(rank - previous))").first()
            history.append((done, *seen))
            if tol is not None and seen[1] is not None and seen[1] < tol:
                break
    ranks = scratch.write(
        index.table.select("id", "vid")
        .join(state.select("vid", "rank"), "vid")
        .select("id", "rank"),
        "result",
    )
    adjacent.unpersist()
    scratch.drop("index", f"ranks-{done}")
    return ranks, spark.createDataFrame(history, HISTORY)


def _round(
    state: DataFrame, adjacent: DataFrame, n: int, damping: float, idle: float = 0.0
) -> DataFrame:
    """One round, ``vid, parts, rank, previous``; ``idle`` is the rank that all vertices share.

    The vertices themselves are united with the shares they receive, so those without
    in-links are kept by the one aggregate, and no join is needed for them.
    """
    shares = spread(
        state, adjacent, "rank / degree AS share", "NULL AS parts", "NULL AS previous"
    )
    return (
        shares.union(state.selectExpr("vid", "NULL", "parts", "rank"))
        .groupBy("vid")
        .agg(
            F.expr("max(parts) AS parts"),
            F.expr(
                f"{(1.0 - damping + damping * idle) / n!r}D + {damping!r}D * coalesce(sum(share), 0D) AS rank"
            ),
            F.expr("max(previous) AS previous"),
        )
    )


def residual_pagerank(
    vertices: DataFrame | None,
    edges: DataFrame | None,
    damping: float = 0.85,
    tol: float = 1e-9,
    numbered: NumberedGraph | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The ranks that rounds of :func:`pagerank` lead to, and the pushes of each round.

    Every vertex has a rank and a residual, rank that it has not passed on yet. In a round those whose
    residual is above ``tol / N`` add it to their rank and push it along their links; the others do nothing, so
    rounds get cheaper as most vertices settle. It ends when none is above: the ranks are then at most
    ``tol / (1 - damping)`` from the end of all rounds, added up over all vertices. The history has the vertices that
    pushed and the residual left over.
    """
    scratch, index, adjacent = _out_links(vertices, edges, numbered)
    n = max(index.n_vertices, 1)
    bound = f"{tol / n!r}D"
    state = index.table.select(
        "vid",
        part_count("out_degree").alias("parts"),
        F.lit(0.0).alias("rank"),
        F.lit((1.0 - damping) / n).alias("residual"),
    )
    history, pushing = [], index.n_vertices if (1.0 - damping) > tol else 0
    while pushing:
        done = len(history) + 1
        pushed = spread(
            state.where(f"residual > {bound}"),
            adjacent,
            "NULL AS parts",
            "NULL AS rank",
            f"{damping!r}D * residual / degree AS residual",
        )
        kept = state.selectExpr(
            "vid",
            "parts",
            f"IF(residual > {bound}, rank + residual, rank) AS rank",
            f"IF(residual > {bound}, 0D, residual) AS residual",
        )
        state = scratch.write(
            kept.union(pushed).groupBy("vid").agg(
                F.max("parts").alias("parts"),
                F.max("rank").alias("rank"),
                F.sum("residual").alias("residual"),
            ),
            f"pushed-{done}",
        )
        scratch.drop(f"pushed-{done - 1}")
        left, rest = state.selectExpr(f"count_if(residual > {bound})", "sum(residual)").first()
        history.append((done, pushing, rest))
        pushing = left
    ranks = index.table.select("id", "vid").join(state.select("vid", "rank"), "vid")
    ranks = scratch.write(ranks.select("id", "rank"), "result")
    adjacent.unpersist()
    scratch.drop("index", f"pushed-{len(history)}")
    return ranks, ranks.sparkSession.createDataFrame(history, PUSHES)


def top_ranks(ranks: DataFrame, k: int = 50) -> DataFrame:
    return ranks.orderBy(F.desc("rank"), "id").limit(k).select("id", "rank")
