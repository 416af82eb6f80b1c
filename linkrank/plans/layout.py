"""Vertex numbers and salted adjacency rows, the layout all loops run on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions import part_count, salt_of
from linkrank.plans.scratch import Scratch
from linkrank.plans.skew import heaviest, salted_join

LINKS_PER_PARTITION = 32_000_000  # at most: about 256 MB of vertex numbers
FEW_LINKS = 64_000  # not worth a partition of their own


@dataclass(frozen=True)
class VertexIndex:
    """The numbered vertices, ``id, out_degree, in_degree, vid``, and their measured size."""

    table: DataFrame
    n_vertices: int
    n_links: int
    max_out: int
    max_in: int


def index_vertices(scratch: Scratch, vertices: DataFrame) -> VertexIndex:
    """Number the vertices in id order and write the table ``index``.

    A range-partitioned sort followed by ``monotonically_increasing_id`` gives longs that
    compare like the ids themselves, so "smallest label" needs no strings inside the loops.
    Once written the numbers are fixed: nothing recomputes them.
    """
    ordered = (
        vertices.select("id", "out_degree", "in_degree")
        .orderBy("id")
        .withColumn("vid", F.monotonically_increasing_id())
    )
    table = scratch.write(ordered, "index")
    n, out, into, max_out, max_in = table.agg(
        F.count("vid"),
        F.sum("out_degree"),
        F.sum("in_degree"),
        F.max("out_degree"),
        F.max("in_degree"),
    ).first()
    return VertexIndex(table, n, max(out or 0, into or 0), max_out or 0, max_in or 0)


def encode_edges(edges: DataFrame, index: VertexIndex) -> DataFrame:
    """Replace both endpoint ids by vertex numbers: ``u, v, out_degree(u), in_degree(v)``.

    Endpoints outside the index, and null ones, match nothing and drop out.
    """
    sources = index.table.select(F.col("id").alias("src"), F.col("vid").alias("u"), "out_degree")
    targets = index.table.select(F.col("id").alias("dst"), F.col("vid").alias("v"), "in_degree")
    half = salted_join(
        edges.select("src", "dst"),
        sources,
        "src",
        heaviest(sources, "src", "out_degree", at_most=index.max_out),
    )
    return salted_join(
        half.select("dst", "u", "out_degree"),
        targets,
        "dst",
        heaviest(targets, "dst", "in_degree", at_most=index.max_in),
    ).select("u", "v", "out_degree", "in_degree")


def adjacency(links: DataFrame, n_links: int) -> DataFrame:
    """Group ``vid, target, degree`` into rows ``vid, part, degree, targets`` and keep them.

    A vertex has one row per ``LINKS_PER_PART`` links, so a row stays small and a hub, or a
    link repeated many times, is spread over partitions. The rows are persisted partitioned
    and sorted by (vid, part): a round only moves the vertex state, never the links.

    More links than ``n_links`` means that the vertex table counts other edges: an error.
    """
    rows = adjacency_rows(links, partitions_for(links, n_links))
    rows = rows.sortWithinPartitions("vid", "part").persist(StorageLevel.MEMORY_AND_DISK)
    found = rows.agg(F.sum(F.size("targets"))).first()[0] or 0  # fills the cache as well
    if found > n_links:
        rows.unpersist()
        raise ValueError(f"{found} links, but the degrees of the vertex table add up to {n_links}")
    return rows


def adjacency_rows(links: DataFrame, partitions: int) -> DataFrame:
    """The rows of :func:`adjacency`, partitioned by (vid, part)."""
    return (
        links.withColumn("part", salt_of(part_count("degree"), "target"))
        .repartition(partitions, "vid", "part")
        .groupBy("vid", "part")
        .agg(F.max("degree").alias("degree"), F.collect_list("target").alias("targets"))
    )


def partitions_for(frame: DataFrame, n_links: int) -> int:
    """A partition per core as far as the links make it worthwhile, and more if they need it."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    worthwhile = min(cores, -(-n_links // FEW_LINKS))
    return max(worthwhile, -(-n_links // LINKS_PER_PARTITION), 1)


def spread(state: DataFrame, adjacent: DataFrame, *columns: str) -> DataFrame:
    """Send every state row along its vertex's links: one row per link.

    ``state`` has ``vid`` and ``parts``; a row is repeated once per adjacency row. The result
    has the link's other end as ``vid`` and the given expressions over the sender's columns
    and its ``degree``.
    """
    return (
        state.where("parts > 0")
        .selectExpr("*", "explode(sequence(0, parts - 1)) AS part")
        .join(adjacent, ["vid", "part"])
        .selectExpr("explode(targets) AS vid", *columns)
    )


def name_labels(labels: DataFrame, index: VertexIndex) -> DataFrame:
    """Turn ``vid, label`` numbers into ``id, label`` ids. Few labels may hold most vertices."""
    users = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    ids = index.table.select("vid", "id")
    named = salted_join(
        labels,
        ids.select(F.col("vid").alias("label"), F.col("id").alias("name")),
        "label",
        heaviest(users, "label", "n", at_most=index.n_vertices),
    )
    return named.join(ids, "vid").select("id", F.col("name").alias("label"))
