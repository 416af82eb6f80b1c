"""One query per operator, on the link graphs of :mod:`registry.graphs`.

Every query reads whole tables. Graphs are stored once per application, as a user would
store them, and the queries then run on the stored vertices and edges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank import operators as g
from linkrank import sources as s
from linkrank.plans import Scratch, heaviest, salted_join, store_numbered
from registry.graphs import ROWS, edges, table

SOURCE, TARGET = "1", "17"  # parts, for the path queries

_stored: dict[tuple[str, str, str], str] = {}


def graph(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, DataFrame]:
    """The stored (vertices, edges) of a graph."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _stored or not _exists(spark, f"{_stored[key]}/vertices/_SUCCESS"):
        path = Scratch(spark).folder
        s.store_graph(ROWS[name](spark, folder), path)
        _stored[key] = path
    return s.load_graph(spark, _stored[key])


def _exists(spark: SparkSession, path: str) -> bool:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(file)


def rounded(frame: DataFrame, digits: int, *names: str) -> DataFrame:
    return frame.withColumns({name: F.round(name, digits) for name in names})


# --- ingest and graph construction ---


def read_edge_csv(spark, folder):
    path = Scratch(spark).folder
    rows = edges(spark, folder, "page_link")
    # columns in another order and one more than needed: they are read by name
    s.write_csv(rows.select(F.col("dst").alias("target"), F.length("src").alias("n"),
                            F.col("src").alias("source")), path)
    return s.read_edge_csv(spark, path)


def write_dump(spark: SparkSession, folder: str) -> str:
    """A dump text of the order lines: comments, other statements, escapes, namespaces."""
    part = F.concat(F.lit("Part's_\\"), F.col("l_partkey"), F.lit("_(7,0,"))
    supplier = F.concat(F.lit('Supplier_"'), F.col("l_suppkey"), F.lit('"'))

    def tup(space, title, from_space):
        escaped = F.replace(F.replace(title, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
        return F.concat(F.lit("("), F.col("l_orderkey"), F.lit(","), space, F.lit(",'"),
                        escaped, F.lit("',"), from_space, F.lit(")"))

    odd = (F.col("l_linenumber") % 2).cast("string")
    values = F.concat(
        tup(F.lit("0"), part, F.lit("0")), F.lit(","),
        tup(odd, supplier, F.lit("0")), F.lit(","),
        tup(F.lit("0"), supplier, odd),
    )
    lines = F.array(
        F.lit("-- dump of links"),
        F.concat(F.lit("INSERT INTO `pagelinks` VALUES "), values, F.lit(";")),
        F.concat(F.lit("INSERT INTO `page` VALUES "), values, F.lit(";")),
    )
    text = table(spark, folder, "lineitem").select(F.explode(lines).alias("value"))
    path = Scratch(spark).folder
    text.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
    return path


def dump_links(spark: SparkSession, folder: str) -> DataFrame:
    return s.parse_link_dump(spark, write_dump(spark, folder))


def edge_csv_sink(spark, folder):
    path = Scratch(spark).folder
    s.write_csv(dump_links(spark, folder), path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return back.select(F.col("source_id").cast("bigint").alias("source_id"), "target_title")


def resolve_page_ids(spark, folder):
    titles = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("Order_"), F.col("o_orderkey")).alias("title")
    )
    return s.resolve_page_ids(dump_links(spark, folder), titles)


def build_graph(spark, folder):
    rows = ROWS["page_link"](spark, folder)
    csv, path = Scratch(spark).folder, Scratch(spark).folder
    s.write_csv(rows.select(F.col("src").alias("source"), F.col("dst").alias("target")), csv)
    return s.store_graph(s.read_edge_csv(spark, csv), path)[0]


# --- iterative operators ---


def pagerank(spark, folder, name="part_next"):
    return rounded(g.pagerank(*graph(spark, folder, name)), 10, "rank")


def rank_history(spark, folder, every):
    history = g.pagerank_rounds(*graph(spark, folder, "page_link"), report_every=every)[1]
    return rounded(history, 10, "max_rank", "l1_delta")


def pagerank_sinks(spark, folder):
    """Ranks to parquet and the top 50 to CSV; the CSV rows with the ranks stored as parquet."""
    ranks = g.pagerank(*graph(spark, folder, "part_next"))
    path = Scratch(spark).folder
    ranks.write.parquet(f"{path}/ranks")
    s.write_small_csv(g.top_ranks(ranks), f"{path}/top")
    top = spark.read.option("header", True).option("escape", '"').csv(f"{path}/top")
    return rounded(spark.read.parquet(f"{path}/ranks").join(top.select("id"), "id"), 10, "rank")


def components(spark, folder):
    return g.connected_components(*graph(spark, folder, "page_link"))


def component_sinks(spark, folder):
    """Labels to parquet and sizes to CSV; every label with the size read back."""
    labels = components(spark, folder)
    path = Scratch(spark).folder
    labels.write.parquet(f"{path}/labels")
    s.write_csv(g.component_sizes(labels), f"{path}/sizes")
    sizes = spark.read.option("header", True).option("escape", '"').csv(f"{path}/sizes")
    sizes = sizes.select("component", F.col("size").cast("bigint").alias("size"))
    labels = spark.read.parquet(f"{path}/labels")
    joined = salted_join(labels, sizes, "component", heaviest(sizes, "component", "size"))
    return joined.select("id", "component", "size")


def communities(spark, folder, name="page_link"):
    return g.label_propagation(graph(spark, folder, name)[1])


def community_sink(spark, folder):
    path = Scratch(spark).folder
    communities(spark, folder).write.parquet(path)
    return spark.read.parquet(path)


def on_communities(operator):
    def run(spark, folder):
        return operator(graph(spark, folder, "page_link")[1], communities(spark, folder))

    return run


def profile(spark, folder):
    vertices, links = graph(spark, folder, "part_next")
    return g.rank_degree_profile(vertices, g.pagerank(vertices, links))


def numbered_graph(spark, folder):
    """Four jobs on one stored graph: its ids are sorted and its links placed once."""
    stored = store_numbered(*graph(spark, folder, "part_next"), Scratch(spark).folder)
    hops = g.distances_to(None, SOURCE, numbered=stored)
    return (
        g.pagerank(None, None, numbered=stored)
        .join(g.connected_components(None, None, numbered=stored), "id")
        .join(g.label_propagation(None, numbered=stored), "id")
        .join(hops, "id", "left")
        .select("id", F.round("rank", 10).alias("rank"), "component", "label", "hops")
    )


Q = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Q] = {
    "read_edge_csv": read_edge_csv,
    "parse_link_dump": dump_links,
    "edge_csv_sink": edge_csv_sink,
    "resolve_page_ids": resolve_page_ids,
    "dedup_edges": lambda spark, d: g.dedup_edges(ROWS["cust_supp"](spark, d)),
    "vertices": lambda spark, d: g.vertices(graph(spark, d, "part_next")[1]),
    "out_degrees": lambda spark, d: g.out_degrees(graph(spark, d, "part_next")[1]),
    "in_degrees": lambda spark, d: g.in_degrees(graph(spark, d, "part_next")[1]),
    "vertex_degrees": lambda spark, d: g.vertex_degrees(graph(spark, d, "cust_supp")[1]),
    "build_graph": build_graph,
    "graph_stats": lambda spark, d: rounded(
        g.graph_stats(*graph(spark, d, "cust_supp")), 8, "avg_out_degree"
    ),
    "top_in_degree": lambda spark, d: g.top_in_degree(graph(spark, d, "cust_supp")[0]),
    "pagerank": pagerank,
    "pagerank_with_sinks": lambda spark, d: pagerank(spark, d, "page_link"),
    "pagerank_progress": lambda spark, d: rank_history(spark, d, 5).select(
        "iteration", "max_rank"
    ),
    "pagerank_convergence": lambda spark, d: rank_history(spark, d, 1).select(
        "iteration", "l1_delta"
    ),
    "pagerank_topk": lambda spark, d: rounded(
        g.top_ranks(g.pagerank(*graph(spark, d, "part_next"))), 10, "rank"
    ),
    "pagerank_sinks": pagerank_sinks,
    "vertex_index": lambda spark, d: g.vertex_index(graph(spark, d, "page_link")[0]),
    "undirected_edges": lambda spark, d: g.undirected_edges(graph(spark, d, "part_next")[1]),
    "connected_components": components,
    "wcc_progress": lambda spark, d: g.min_label_rounds(*graph(spark, d, "page_link"))[1],
    "component_sizes": lambda spark, d: g.component_sizes(components(spark, d)),
    "component_count": lambda spark, d: g.component_count(components(spark, d)),
    "component_sinks": component_sinks,
    "giant_component_share": lambda spark, d: rounded(
        g.giant_component_share(components(spark, d)), 8, "share"
    ),
    "label_propagation": communities,
    "label_propagation_dense": lambda spark, d: communities(spark, d, "part_next"),
    "lpa_progress": lambda spark, d: g.label_propagation_rounds(
        graph(spark, d, "part_next")[1]
    )[1],
    "settled_labels": lambda spark, d: g.settled_labels(*graph(spark, d, "page_link")),
    "settled_label_rounds": lambda spark, d: g.settled_label_rounds(
        *graph(spark, d, "part_next")
    )[1],
    "community_sizes": lambda spark, d: g.community_sizes(communities(spark, d)),
    "community_count": lambda spark, d: g.community_count(communities(spark, d)),
    "modularity": lambda spark, d: rounded(on_communities(g.modularity)(spark, d), 8, "modularity"),
    "modularity_directed": lambda spark, d: rounded(
        on_communities(g.modularity_directed)(spark, d), 8, "modularity"
    ),
    "intra_community_edges": on_communities(g.intra_community_edges),
    "community_degree": on_communities(g.community_degree),
    "community_sink": community_sink,
    "in_degree_histogram": lambda spark, d: g.in_degree_histogram(graph(spark, d, "cust_supp")[0]),
    "out_degree_histogram": lambda spark, d: g.out_degree_histogram(
        graph(spark, d, "cust_supp")[0]
    ),
    "authority_scores": lambda spark, d: rounded(
        g.authority_scores(*graph(spark, d, "part_next")), 6, "authority_score"
    ),
    "hub_scores": lambda spark, d: rounded(
        g.hub_scores(graph(spark, d, "part_next")[0]), 6, "hub_score"
    ),
    "shortest_path": lambda spark, d: g.shortest_path(
        graph(spark, d, "part_next")[1], SOURCE, TARGET
    ),
    "bidirectional_path": lambda spark, d: g.bidirectional_path(
        graph(spark, d, "part_next")[1], SOURCE, TARGET
    ),
    "path_search": lambda spark, d: g.find_path(
        graph(spark, d, "part_next")[1], SOURCE, TARGET, both_ways=True
    ).summary().select("found", "hops", "exhausted"),
    "shortest_cycle": lambda spark, d: g.shortest_path(
        graph(spark, d, "part_next")[1], SOURCE, SOURCE
    ),
    "bfs_frontier_sizes": lambda spark, d: g.bfs_frontier_sizes(
        graph(spark, d, "part_next")[1], SOURCE
    ),
    "distance_to_target": lambda spark, d: g.hop_histogram(
        g.distances_to(graph(spark, d, "part_next")[1], SOURCE)
    ),
    "hop_distribution": lambda spark, d: rounded(
        rounded(g.hop_distribution(*graph(spark, d, "page_link"), lg_k=14), 0, "n_pairs", "new_pairs"),
        4, "share",
    ),
    "hits": lambda spark, d: rounded(
        g.hits(*graph(spark, d, "part_next")), 9, "hub", "authority"
    ),
    "pagerank_redistributed": lambda spark, d: rounded(
        g.pagerank(*graph(spark, d, "page_link"), redistribute=True), 10, "rank"
    ),
    "pagerank_residual": lambda spark, d: rounded(
        g.residual_pagerank(*graph(spark, d, "page_link"), tol=1e-12)[0], 9, "rank"
    ),
    "numbered_graph": numbered_graph,
    "power_law_fit": lambda spark, d: rounded(
        g.power_law_fit(graph(spark, d, "part_next")[0]), 6, "alpha", "distance"
    ),
    "rank_degree_spearman": lambda spark, d: rounded(
        g.rank_degree_spearman(rounded(profile(spark, d), 10, "rank")), 6, "corr_in", "corr_out"
    ),
    "rank_degree_profile": lambda spark, d: rounded(profile(spark, d), 10, "rank"),
    "top_by_metric": lambda spark, d: rounded(g.top_by_metric(profile(spark, d)), 10, "value"),
    "rank_degree_corr": lambda spark, d: rounded(
        g.rank_degree_correlation(profile(spark, d)), 6, "corr_in", "corr_out"
    ),
    "power_law_alpha": lambda spark, d: rounded(
        g.power_law_alpha(graph(spark, d, "page_link")[0]), 6, "alpha"
    ),
}
