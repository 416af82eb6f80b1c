"""Vertices, degrees and summary numbers of an edge table (``src``, ``dst``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkrank.plans import Scratch, index_vertices


def dedup_edges(edges: DataFrame, drop_null_endpoints: bool = False) -> DataFrame:
    """One row per distinct (src, dst). Null endpoints are kept unless asked otherwise."""
    pairs = edges.select("src", "dst")
    if drop_null_endpoints:
        pairs = pairs.dropna()
    return pairs.distinct()


def vertices(edges: DataFrame) -> DataFrame:
    """Every id that is an endpoint, once."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def in_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("dst").agg(F.count(F.lit(1)).alias("in_degree"))


def vertex_degrees(edges: DataFrame) -> DataFrame:
    """``id, out_degree, in_degree`` from one scan and one map-side combined aggregate.

    A null endpoint is a vertex, but as a null key it is nobody's neighbour: degrees 0.
    """
    ends = edges.selectExpr(
        "inline(array(struct(src AS id, 1 AS o, 0 AS i), struct(dst AS id, 0 AS o, 1 AS i)))"
    )
    known = F.col("id").isNotNull()
    return (
        ends.groupBy("id")
        .agg(F.sum("o").alias("o"), F.sum("i").alias("i"))
        .select(
            "id",
            F.when(known, F.col("o")).otherwise(F.lit(0)).cast("long").alias("out_degree"),
            F.when(known, F.col("i")).otherwise(F.lit(0)).cast("long").alias("in_degree"),
        )
    )


def graph_stats(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: vertex count, edge count and average out-degree."""
    tally = vertices.select(F.lit(1).alias("v"), F.lit(0).alias("e")).unionByName(
        edges.select(F.lit(0).alias("v"), F.lit(1).alias("e"))
    )
    return tally.agg(
        F.coalesce(F.sum("v"), F.lit(0)).alias("n_vertices"),
        F.coalesce(F.sum("e"), F.lit(0)).alias("n_edges"),
    ).withColumn(
        "avg_out_degree", F.col("n_edges") / F.greatest(F.col("n_vertices"), F.lit(1))
    )


def top_in_degree(vertices: DataFrame, k: int = 10) -> DataFrame:
    return (
        vertices.orderBy(F.desc("in_degree"), "id")
        .limit(k)
        .select("id", "in_degree", "out_degree")
    )


def undirected_edges(edges: DataFrame) -> DataFrame:
    """Both directions of every edge between known vertices, once each: ``v1, v2``."""
    return (
        edges.dropna(subset=["src", "dst"])
        .selectExpr(
            "inline(array(struct(src AS v1, dst AS v2), struct(dst AS v1, src AS v2)))"
        )
        .distinct()
    )


def vertex_index(vertices: DataFrame) -> DataFrame:
    """Consecutive numbers 0.. in id order: ``id, vid``.

    The sort is range-partitioned; only the row counts of the partitions, one row each, are
    brought together to give every partition its offset.
    """
    index = index_vertices(Scratch(vertices.sparkSession), vertices)
    raw = index.table.select("id", "vid", F.shiftright("vid", 33).alias("slice"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        raw.groupBy("slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = F.col("vid") - F.shiftleft("slice", 33)
    # one row per partition of the index table, however many vertices there are
    return raw.join(F.broadcast(offsets), "slice").select(
        "id", (F.col("offset") + within).alias("vid")
    )
