"""Communities by label propagation, and how good a division into communities is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions import part_count
from linkrank.operators.graph import in_degrees, out_degrees, vertex_degrees
from linkrank.plans import (
    NumberedGraph,
    Scratch,
    adjacency,
    encode_edges,
    heaviest,
    index_vertices,
    salted_join,
    spread,
)
from linkrank.plans import skew
from linkrank.plans.layout import name_labels

HISTORY = "iteration int, changed long, n_communities long, converged boolean"


def label_propagation(
    edges: DataFrame | None, max_iter: int = 20, numbered: NumberedGraph | None = None
) -> DataFrame:
    """``id, label``; see :func:`label_propagation_rounds`."""
    return label_propagation_rounds(edges, max_iter, numbered)[0]


def label_propagation_rounds(
    edges: DataFrame | None, max_iter: int = 20, numbered: NumberedGraph | None = None
) -> tuple[DataFrame, DataFrame]:
    """Communities, and the labels changed and left in each round.

    Every vertex starts with its own id as label. In a round all vertices at once take the
    label most frequent among the vertices they link to, the smallest one if several are;
    without out-links they keep theirs. Parallel edges each count. The loop ends when
    nothing changed, which is ``converged`` in the last row of the history, or after ``max_iter``
    rounds (labels can swap for ever). A ``numbered`` graph is used instead of ``edges``.
    """
    # labels travel against the links, from a link's target to its source
    if numbered is None:
        scratch = Scratch(edges.sparkSession)
        index = index_vertices(scratch, vertex_degrees(edges))
        links = encode_edges(edges, index).select(
            F.col("v").alias("vid"), F.col("u").alias("target"), F.col("in_degree").alias("degree")
        )
        adjacent = adjacency(links, index.n_links)
    else:
        index, adjacent = numbered.index, numbered.links("into")
        scratch = Scratch(index.table.sparkSession)
    spark = index.table.sparkSession

    state = index.table.select(
        "vid", part_count("in_degree").alias("parts"), F.col("vid").alias("label")
    )
    history = []
    for done in range(1, max_iter + 1):
        winners = _winners(spread(state, adjacent, "label"), index.max_out)
        state = scratch.write(
            state.join(winners, "vid", "left").selectExpr(
                "vid", "parts", "coalesce(winner, label) AS label", "label AS previous"
            ),
            f"labels-{done}",
        )
        scratch.drop(f"labels-{done - 1}")
        changed, left = state.selectExpr(
            "count_if(label <> previous)", "count(DISTINCT label)"
        ).first()
        history.append((done, changed, left, not changed))
        if not changed:
            break
    result = scratch.write(name_labels(state.select("vid", "label"), index), "result")
    adjacent.unpersist()
    scratch.drop("index", f"labels-{len(history)}")
    return result, spark.createDataFrame(history, HISTORY)


def _winners(heard: DataFrame, most: int) -> DataFrame:
    """``vid, winner``: the label each vertex hears most, the smallest one if several are.

    ``most`` is the largest number of labels one vertex hears. If that is no hot key, what is heard is exchanged once,
    by vertex, and all else is done there. Else counting by (vertex, label) first keeps a vertex
    with many links off a single task.
    """
    if most >= skew.HOT_ROWS:
        votes = heard.groupBy("vid", "label").count()
        return votes.groupBy("vid").agg(F.expr("min_by(label, struct(-count, label)) AS winner"))
    votes = heard.repartition("vid").groupBy("vid", "label").count()
    # the smallest label of each count first: then numbers alone are compared, which needs no sort
    smallest = votes.groupBy("vid", "count").agg(F.min("label").alias("label"))
    return smallest.groupBy("vid").agg(F.max_by("label", "count").alias("winner"))


def community_sizes(communities: DataFrame) -> DataFrame:
    """``label, count``, largest first."""
    return (
        communities.groupBy("label")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "label")
    )


def community_count(communities: DataFrame) -> DataFrame:
    return communities.select("label").distinct().agg(F.count(F.lit(1)).alias("n_communities"))


def _tallies(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """``label, k_out, k_in, n_intra``: links from, to and inside each community.

    One pass over the edges. Ends outside ``communities`` are counted under the null label, so the
    sum of ``k_out`` is the number of all edges. Labels are taken to be not null.
    """
    sources = communities.select(F.col("id").alias("src"), F.col("label").alias("from_label"))
    targets = communities.select(F.col("id").alias("dst"), F.col("label").alias("to_label"))
    half = salted_join(
        edges.select("src", "dst"),
        sources,
        "src",
        heaviest(out_degrees(edges), "src", "out_degree"),
        "left",
    )
    ends = salted_join(
        half.select("dst", "from_label"),
        targets,
        "dst",
        heaviest(in_degrees(edges), "dst", "in_degree"),
        "left",
    )
    return (
        ends.selectExpr(
            "inline(array("
            "struct(from_label AS label, 1L AS o, 0L AS i, IF(from_label = to_label, 1L, 0L) AS n),"
            "struct(to_label AS label, 0L AS o, 1L AS i, 0L AS n)))"
        )
        .groupBy("label")
        .agg(F.sum("o").alias("k_out"), F.sum("i").alias("k_in"), F.sum("n").alias("n_intra"))
    )


def intra_community_edges(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """One row: the number of edges with both ends in one community."""
    return _tallies(edges, communities).agg(F.coalesce(F.sum("n_intra"), F.lit(0)).alias("n_intra"))


def community_degree(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """``label, total_degree``: the links going out of each community's members."""
    degrees = out_degrees(edges).withColumnRenamed("src", "id")
    return (
        degrees.join(communities, "id")
        .groupBy("label")
        .agg(F.sum("out_degree").alias("total_degree"))
    )


def modularity(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """One row: I / 2m - X / 4m^2, X the sum of D^2 / 2m over the communities.

    I counts the edges inside communities, D is a community's out-links, m all edges. Kept
    for comparable results; :func:`modularity_directed` is the textbook measure.
    """
    terms = _tallies(edges, communities).selectExpr(
        "CAST(sum(k_out) AS DOUBLE) AS m",
        "sum(n_intra) AS i",
        "sum(CASE WHEN label IS NOT NULL AND k_out > 0 THEN CAST(k_out AS DOUBLE) * k_out END) AS s",
    )
    m = F.col("m")
    return terms.select(
        (
            F.try_divide(F.col("i"), 2 * m)
            - F.try_divide(F.try_divide(F.col("s"), 2 * m), 4 * m * m)
        ).alias("modularity")
    )


def modularity_directed(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """One row: I / m - sum of K_out * K_in / m^2 (directed modularity)."""
    terms = _tallies(edges, communities).selectExpr(
        "CAST(sum(k_out) AS DOUBLE) AS m",
        "sum(n_intra) AS i",
        "sum(CASE WHEN label IS NOT NULL THEN CAST(k_out AS DOUBLE) * k_in END) AS p",
    )
    m = F.col("m")
    return terms.select(
        (F.try_divide(F.col("i"), m) - F.try_divide(F.col("p"), m * m)).alias("modularity")
    )
