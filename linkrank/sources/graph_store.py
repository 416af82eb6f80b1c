"""Graphs stored as two parquet folders, ``vertices`` and ``edges``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkrank.operators.graph import dedup_edges, vertex_degrees

VERTICES = "id string, out_degree bigint, in_degree bigint"
EDGES = "src string, dst string"


def store_graph(
    rows: DataFrame, path: str, drop_null_endpoints: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Write the graph of the links ``src, dst`` to ``path``; returns (vertices, edges).

    Edges are written first and the degrees counted from the written table, so the input is
    read and deduplicated once.
    """
    spark = rows.sparkSession
    folder = path.rstrip("/")
    dedup_edges(rows, drop_null_endpoints).write.mode("overwrite").parquet(f"{folder}/edges")
    edges = spark.read.schema(EDGES).parquet(f"{folder}/edges")
    vertex_degrees(edges).write.mode("overwrite").parquet(f"{folder}/vertices")
    return load_graph(spark, folder)


def load_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    folder = path.rstrip("/")
    return (
        spark.read.schema(VERTICES).parquet(f"{folder}/vertices"),
        spark.read.schema(EDGES).parquet(f"{folder}/edges"),
    )
