"""Weakly connected components."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions import part_count
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
from linkrank.plans.layout import name_labels

HISTORY = "iteration int, changed long, converged boolean"


def connected_components(
    vertices: DataFrame | None, edges: DataFrame | None, numbered: NumberedGraph | None = None
) -> DataFrame:
    """``id, component``: the smallest id each vertex is connected with, edges undirected.

    Works by contraction, so long chains need few rounds and the edge table shrinks from
    round to round: every vertex hooks to its smallest neighbour, the hook chains are
    shortened to their end by pointer doubling, and the edges are rewritten between those
    ends. Ends of one component are merged until no edge is left. A hook only ever leads to
    a smaller vertex, so the last end standing is the component's smallest member.
    A ``numbered`` graph is used instead of ``vertices`` and ``edges``.
    """
    if numbered is None:
        scratch = Scratch(vertices.sparkSession)
        index = index_vertices(scratch, vertices)
        pairs = encode_edges(edges, index).select("u", "v")
    else:
        index, pairs = numbered.index, numbered.pairs()
        scratch = Scratch(index.table.sparkSession)
    pairs = scratch.write(_canonical(pairs), "pairs-0")
    ends = []
    while True:
        done = len(ends)
        hooks = scratch.write(_hooks(pairs), f"ends-{done}/hooks")
        n, degree = hooks.selectExpr("count(u)", "max(degree)").first()
        if not n:
            break
        ends.append(_shorten(scratch, hooks, n, f"ends-{done}"))
        hot = heaviest(hooks, "u", "degree", at_most=degree)
        pairs = scratch.write(_rewritten(pairs, ends[-1], hot).distinct(), f"pairs-{done + 1}")
        scratch.drop(f"pairs-{done}")

    labels = index.table.select("vid", F.col("vid").alias("label"))
    if ends:
        # follow the last round's ends back to the first round's vertices
        last = ends[-1]
        for step in reversed(ends[:-1]):
            last = _followed(step, last, index.n_vertices, "left").select(
                "u", F.coalesce("next", "to").alias("to")
            )
        labels = labels.join(last.withColumnRenamed("u", "vid"), "vid", "left").select(
            "vid", F.coalesce("to", "label").alias("label")
        )
    labels = scratch.write(labels, "labels")
    named = name_labels(labels, index).withColumnRenamed("label", "component")
    result = scratch.write(named, "result")
    scratch.drop("index", "labels", f"pairs-{len(ends)}")
    scratch.drop(*(f"ends-{done}" for done in range(len(ends) + 1)))
    return result


def _canonical(pairs: DataFrame) -> DataFrame:
    """Larger end first, self-loops left out."""
    return pairs.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v")


def _hooks(pairs: DataFrame) -> DataFrame:
    """``u, to, degree``: each vertex with its smallest neighbour, or itself if smaller."""
    return (
        pairs.selectExpr("inline(array(struct(u, v), struct(v AS u, u AS v)))")
        .groupBy("u")
        .agg(F.expr("min(v) AS v"), F.expr("count(1) AS degree"))
        .selectExpr("u", "least(u, v) AS to", "degree")
    )


def _followed(steps: DataFrame, more: DataFrame, n: int, how: str = "inner") -> DataFrame:
    """``u, to, next``, where the mapping ``more`` leads from ``to`` to ``next``.

    Many of the ``n`` vertices may point to the same one, the end of a giant component.
    """
    users = steps.groupBy("to").agg(F.expr("count(1) AS n"))
    moved = more.selectExpr("u AS to", "to AS next")
    return salted_join(steps, moved, "to", heaviest(users, "to", "n", at_most=n), how)


def _shorten(scratch: Scratch, hooks: DataFrame, n: int, name: str) -> DataFrame:
    """Pointer doubling until every vertex points to the end of its hook chain.

    A chain's end leads to itself, so pointers that stand still have arrived; only the
    others are followed further.
    """
    arrived = hooks.where("to = u").select("u", "to")
    moving = hooks.where("to <> u").select("u", "to")
    jump = 0
    while True:
        jumped = scratch.write(
            _followed(moving, arrived.union(moving), n), f"{name}/{jump}"
        )
        arrived = arrived.union(jumped.where("next = to").select("u", "to"))
        moving = jumped.where("next <> to").selectExpr("u", "next AS to")
        if moving.isEmpty():
            return arrived
        jump += 1


def _rewritten(pairs: DataFrame, ends: DataFrame, hot: DataFrame | None) -> DataFrame:
    """The pairs between chain ends that still differ."""
    upper = salted_join(pairs, ends.selectExpr("u", "to AS a"), "u", hot).select("a", "v")
    lower = ends.selectExpr("u AS v", "to AS b")
    hot = None if hot is None else hot.withColumnRenamed("u", "v")
    return _canonical(salted_join(upper, lower, "v", hot).selectExpr("a AS u", "b AS v"))


def min_label_rounds(
    vertices: DataFrame, edges: DataFrame, max_iter: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Components by label spreading, one hop a round, with the labels changed per round.

    In a round every vertex takes the smallest label among its own and its neighbours'. The
    loop ends when nothing changed. With ``max_iter`` it may end before, and then the labels of
    long chains are not final: ``converged`` is false in the last row of the history.
    """
    spark = vertices.sparkSession
    scratch = Scratch(spark)
    index = index_vertices(scratch, vertices)
    links = encode_edges(edges, index).selectExpr(
        "inline(array(struct(u AS vid, v AS target), struct(v AS vid, u AS target)))"
    )
    degrees = index.table.select(
        "vid", (F.col("out_degree") + F.col("in_degree")).alias("degree")
    )
    hot = heaviest(degrees, "vid", "degree", at_most=index.max_out + index.max_in)
    adjacent = adjacency(salted_join(links, degrees, "vid", hot), 2 * index.n_links)

    state = degrees.select("vid", part_count("degree").alias("parts"), F.col("vid").alias("label"))
    history = []
    for done in count(1) if max_iter is None else range(1, max_iter + 1):
        heard = spread(state, adjacent, "label", "NULL AS parts", "NULL AS previous")
        state = scratch.write(
            heard.union(state.selectExpr("vid", "label", "parts", "label"))
            .groupBy("vid")
            .agg(
                F.expr("max(parts) AS parts"),
                F.expr("min(label) AS label"),
                F.expr("max(previous) AS previous"),
            ),
            f"labels-{done}",
        )
        scratch.drop(f"labels-{done - 1}")
        changed = state.selectExpr("count_if(label <> previous)").first()[0]
        history.append((done, changed, not changed))
        if not changed:
            break
    named = name_labels(state.select("vid", "label"), index)
    result = scratch.write(named.withColumnRenamed("label", "component"), "result")
    adjacent.unpersist()
    scratch.drop("index", f"labels-{len(history)}")
    return result, spark.createDataFrame(history, HISTORY)


def component_sizes(components: DataFrame) -> DataFrame:
    """``component, size``, largest first."""
    return (
        components.groupBy("component")
        .agg(F.count(F.lit(1)).alias("size"))
        .orderBy(F.desc("size"), "component")
    )


def component_count(components: DataFrame) -> DataFrame:
    return components.select("component").distinct().agg(F.count(F.lit(1)).alias("n_components"))


def giant_component_share(components: DataFrame) -> DataFrame:
    """Size of the largest component, and its share of all vertices."""
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(
        F.max("size").alias("giant_size"),
        F.try_divide(F.max("size"), F.sum("size")).alias("share"),
    )
