"""Whole jobs from stored input to stored output. The caller owns the session.

``python -m linkrank <job> ...`` runs one of them; see :mod:`linkrank.__main__`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkrank import operators as g
from linkrank import sources as s


def build_job(
    spark: SparkSession, edges_path: str, output: str, drop_null_endpoints: bool = False
) -> dict[str, DataFrame]:
    """Edge CSV to the stored graph; its size and the pages linked to most."""
    rows = s.read_edge_csv(spark, edges_path)
    vertices, edges = s.store_graph(rows, output, drop_null_endpoints)
    return {"stats": g.graph_stats(vertices, edges), "top": g.top_in_degree(vertices)}


def pagerank_job(
    spark: SparkSession,
    graph: str,
    output: str,
    iterations: int = 20,
    damping: float = 0.85,
    top_k: int = 50,
) -> dict[str, DataFrame]:
    """Ranks to parquet, the first ``top_k`` to one CSV file next to it."""
    output = output.rstrip("/")
    ranks, history = g.pagerank_rounds(*s.load_graph(spark, graph), iterations, damping)
    ranks.write.mode("overwrite").parquet(output)
    top = g.top_ranks(ranks, top_k)
    s.write_small_csv(top, f"{output}_top{top_k}")
    return {"history": history, "top": top}


def components_job(spark: SparkSession, graph: str, output: str) -> dict[str, DataFrame]:
    """Component labels to parquet, the component sizes to ordered CSV files next to it."""
    output = output.rstrip("/")
    labels = g.connected_components(*s.load_graph(spark, graph))
    labels.write.mode("overwrite").parquet(output)
    sizes = g.component_sizes(labels)
    s.write_csv(sizes, f"{output}_summary")
    return {
        "count": g.component_count(labels),
        "giant": g.giant_component_share(labels),
        "top": sizes.limit(20),
    }


def communities_job(
    spark: SparkSession, edges_path: str, output: str, max_iter: int = 20
) -> dict[str, DataFrame]:
    """Community labels of an edges parquet folder to parquet, and how good they are."""
    edges = spark.read.parquet(edges_path).select("src", "dst")
    labels, history = g.label_propagation_rounds(edges, max_iter)
    labels.write.mode("overwrite").parquet(output.rstrip("/"))
    return {
        "history": history,
        "count": g.community_count(labels),
        "top": g.community_sizes(labels).limit(10),
        "modularity": g.modularity(edges, labels),
    }


def analysis_job(
    spark: SparkSession,
    graph: str,
    output: str,
    ranks_path: str | None = None,
    path_from: str | None = None,
    path_to: str | None = None,
    top_k: int = 20,
    max_depth: int | None = 6,
) -> dict[str, DataFrame]:
    """Degree histograms to CSV; best hubs and authorities; a path and rank profile if asked.

    ``path_search`` tells a search that found no path from one that gave up after ``max_depth`` hops.
    """
    output = output.rstrip("/")
    vertices, edges = s.load_graph(spark, graph)
    s.write_csv(g.in_degree_histogram(vertices), f"{output}/in_degree")
    s.write_csv(g.out_degree_histogram(vertices), f"{output}/out_degree")
    results = {
        "authorities": g.authority_scores(vertices, edges).limit(top_k),
        "hubs": g.hub_scores(vertices).limit(top_k),
    }
    if path_from and path_to:
        search = g.find_path(edges, path_from, path_to, max_depth)
        results["path"], results["path_search"] = search.path, search.summary()
    if ranks_path:
        profile = g.rank_degree_profile(vertices, spark.read.parquet(ranks_path))
        results["best"] = g.top_by_metric(profile)
        results["correlation"] = g.rank_degree_correlation(profile)
    return results


def dump_job(spark: SparkSession, dump: str, output: str, pages: str | None = None) -> None:
    """Link dump to CSV: ``source_id, target_title``, or ``source, target`` by title when a
    parquet table of pages (``id, title``) is given."""
    links = s.parse_link_dump(spark, dump)
    if not pages:
        s.write_csv(links, output)
        return
    named = s.resolve_page_ids(links, spark.read.parquet(pages))
    s.write_csv(named.selectExpr("src AS source", "dst AS target"), output)
