from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Links per adjacency row. A vertex with more links is spread over several rows, and with
# them over several partitions, so no hub is ever one task's work.
LINKS_PER_PART = 4096


def part_count(degree: Column | str) -> Column:
    """Number of adjacency rows a vertex of this degree is spread over (0 without links)."""
    return F.ceil(F.col(degree) / F.lit(LINKS_PER_PART)).cast("int")


def salt_of(buckets: Column, *columns: str) -> Column:
    """A bucket in [0, buckets) from a row's columns and the partition it is read from.

    The partition spreads even rows that are copies of each other. A retried task has the
    same partition, so it repeats its choice.
    """
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), buckets).cast("int")


def authority_score(in_degree: Column, hub_weight: Column) -> Column:
    return in_degree * F.log1p(hub_weight)


def hub_score(out_degree: Column, in_degree: Column) -> Column:
    return out_degree * F.log1p(in_degree)
