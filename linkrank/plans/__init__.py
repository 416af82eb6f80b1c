"""How the work is laid out on the cluster: scratch tables, skew-safe joins, adjacency."""

from linkrank.plans.layout import adjacency, encode_edges, index_vertices, spread
from linkrank.plans.numbered import NumberedGraph, load_numbered, store_numbered
from linkrank.plans.scratch import Scratch
from linkrank.plans.skew import heaviest, salted_join

__all__ = [
    "NumberedGraph",
    "Scratch",
    "adjacency",
    "encode_edges",
    "heaviest",
    "index_vertices",
    "load_numbered",
    "salted_join",
    "spread",
    "store_numbered",
]
