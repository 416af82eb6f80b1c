"""Column expressions shared by the operators."""

from linkrank.functions.columns import authority_score, hub_score, part_count, salt_of

__all__ = ["authority_score", "hub_score", "part_count", "salt_of"]
