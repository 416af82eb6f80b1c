"""Graph operators: DataFrames in, DataFrames out."""

from linkrank.operators.communities import (
    community_count,
    community_degree,
    community_sizes,
    intra_community_edges,
    label_propagation,
    label_propagation_rounds,
    modularity,
    modularity_directed,
)
from linkrank.operators.components import (
    component_count,
    component_sizes,
    connected_components,
    giant_component_share,
    min_label_rounds,
)
from linkrank.operators.graph import (
    dedup_edges,
    graph_stats,
    in_degrees,
    out_degrees,
    top_in_degree,
    undirected_edges,
    vertex_degrees,
    vertex_index,
    vertices,
)
from linkrank.operators.pagerank import (
    pagerank,
    pagerank_rounds,
    residual_pagerank,
    top_ranks,
)
from linkrank.operators.paths import (
    PathSearch,
    bfs_frontier_sizes,
    bidirectional_path,
    distances_to,
    find_path,
    hop_histogram,
    shortest_path,
)
from linkrank.operators.profiles import (
    authority_scores,
    average_ranks,
    hub_scores,
    in_degree_histogram,
    out_degree_histogram,
    power_law_alpha,
    power_law_fit,
    rank_degree_correlation,
    rank_degree_profile,
    rank_degree_spearman,
    top_by_metric,
)
from linkrank.operators.settled import settled_label_rounds, settled_labels
from linkrank.operators.spreading import effective_hops, hits, hop_distribution

__all__ = [
    "PathSearch",
    "authority_scores",
    "average_ranks",
    "bfs_frontier_sizes",
    "bidirectional_path",
    "community_count",
    "community_degree",
    "community_sizes",
    "component_count",
    "component_sizes",
    "connected_components",
    "dedup_edges",
    "distances_to",
    "effective_hops",
    "find_path",
    "giant_component_share",
    "graph_stats",
    "hits",
    "hop_distribution",
    "hop_histogram",
    "hub_scores",
    "in_degree_histogram",
    "in_degrees",
    "intra_community_edges",
    "label_propagation",
    "label_propagation_rounds",
    "min_label_rounds",
    "modularity",
    "modularity_directed",
    "out_degree_histogram",
    "out_degrees",
    "pagerank",
    "pagerank_rounds",
    "power_law_alpha",
    "power_law_fit",
    "rank_degree_correlation",
    "rank_degree_profile",
    "rank_degree_spearman",
    "residual_pagerank",
    "settled_label_rounds",
    "settled_labels",
    "shortest_path",
    "top_by_metric",
    "top_in_degree",
    "top_ranks",
    "undirected_edges",
    "vertex_degrees",
    "vertex_index",
    "vertices",
]
