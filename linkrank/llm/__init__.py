"""Operators for building training corpora: filtering, deduplication, mixing, packing, archives.

Nothing outside this package imports it. Operators take DataFrames and return DataFrames; the
registered queries, which derive digest columns from them, are in :mod:`linkrank.llm.queries`.
"""
