"""Readers and writers: edge CSV, link-table dumps, stored graphs."""

from linkrank.sources.edge_csv import read_edge_csv, write_csv, write_small_csv
from linkrank.sources.graph_store import load_graph, store_graph
from linkrank.sources.link_dump import parse_link_dump, resolve_page_ids

__all__ = [
    "load_graph",
    "parse_link_dump",
    "read_edge_csv",
    "resolve_page_ids",
    "store_graph",
    "write_csv",
    "write_small_csv",
]
