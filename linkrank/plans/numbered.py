"""A numbered graph stored once, which all loops read without moving its links."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.plans.layout import (
    VertexIndex,
    adjacency_rows,
    encode_edges,
    index_vertices,
    partitions_for,
)
from linkrank.plans.scratch import Scratch

INDEX = "id string, out_degree long, in_degree long, vid long"
LINKS = "vid long, part int, degree long, targets array<long>"
SIZES = "buckets int, n_vertices long, n_links long, max_out long, max_in long"
DIRECTIONS = ("out", "into")


@dataclass(frozen=True)
class NumberedGraph:
    """Vertices by number, and the links from and to each, in buckets by (vid, part).

    The buckets are what a join of vertex states with links hashes by, so only states are
    exchanged. A session that uses several operators on one graph sorts its ids once.
    """

    index: VertexIndex
    tables: dict[str, str]  # names of the bucketed tables

    def links(self, direction: str) -> DataFrame:
        """``vid, part, degree, targets`` in order, kept in memory; the caller unpersists it."""
        table = self.index.table.sparkSession.table(self.tables[direction])
        return table.sortWithinPartitions("vid", "part").persist(StorageLevel.MEMORY_AND_DISK)

    def pairs(self) -> DataFrame:
        """Every link once: ``u, v``."""
        table = self.index.table.sparkSession.table(self.tables["out"])
        return table.selectExpr("vid AS u", "explode(targets) AS v")

    def drop(self, scratch: Scratch, name: str) -> None:
        """Forget the graph, stored as ``name`` of ``scratch``."""
        for table in self.tables.values():
            scratch.spark.sql(f"DROP TABLE IF EXISTS {table}")
        scratch.drop(name)


def store_numbered(vertices: DataFrame, edges: DataFrame, path: str) -> NumberedGraph:
    """Number the graph of ``vertices`` (``id, out_degree, in_degree``) and ``edges`` and write it to ``path``.

    ``path`` is a folder that all executors reach. More links than the degrees count are an error.
    """
    spark, folder = vertices.sparkSession, path.rstrip("/")
    scratch = Scratch(spark)
    index = index_vertices(scratch, vertices)
    index.table.write.parquet(f"{folder}/index")
    encoded = scratch.write(encode_edges(edges, index), "encoded")
    buckets = partitions_for(encoded, index.n_links)
    ends = {"out": ("u", "v", "out_degree"), "into": ("v", "u", "in_degree")}
    for direction, (vid, target, degree) in ends.items():
        links = encoded.select(
            F.col(vid).alias("vid"), F.col(target).alias("target"), F.col(degree).alias("degree")
        )
        writer = adjacency_rows(links, buckets).write.bucketBy(buckets, "vid", "part")
        name = f"linkrank_{uuid4().hex}"
        writer.sortBy("vid", "part").option("path", f"{folder}/{direction}").saveAsTable(name)
        found = spark.table(name).agg(F.sum(F.size("targets"))).first()[0] or 0
        spark.sql(f"DROP TABLE {name}")
        if found > index.n_links:
            raise ValueError(f"{found} links, but the degrees add up to {index.n_links}")
    sizes = [(buckets, index.n_vertices, index.n_links, index.max_out, index.max_in)]
    spark.createDataFrame(sizes, SIZES).write.parquet(f"{folder}/sizes")
    scratch.drop("index", "encoded")
    return load_numbered(spark, folder)


def load_numbered(spark: SparkSession, path: str) -> NumberedGraph:
    """The graph that :func:`store_numbered` wrote; its tables get names in this session."""
    folder = path.rstrip("/")
    buckets, *sizes = spark.read.schema(SIZES).parquet(f"{folder}/sizes").first()
    tables = {}
    for direction in DIRECTIONS:
        tables[direction] = f"linkrank_{direction}_{uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {tables[direction]} ({LINKS}) USING parquet CLUSTERED BY (vid, part)"
            f" SORTED BY (vid, part) INTO {buckets} BUCKETS LOCATION '{folder}/{direction}'"
        )
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    return NumberedGraph(VertexIndex(index, *sizes), tables)
