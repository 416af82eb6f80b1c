"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions import salt_of

HOT_ROWS = 1_000_000  # rows of one key that are worth splitting
NULL_BUCKETS = 10_000  # for the rows without a key in an outer join
HOT_SHARE = 100_000  # in very large tables, a key is worth splitting from this part of the rows


def heaviest(
    counts: DataFrame, key: str, weight: str, at_most: int | None = None
) -> DataFrame | None:
    """The keys worth splitting, with the number of buckets for each: ``key, buckets``.

    Every key with ``HOT_ROWS`` rows or more is in the list, as far as it has a part of
    1/``HOT_SHARE`` of the rows of all such keys. So it has at most ``HOT_SHARE`` rows whatever the
    data and is safe to broadcast, and a key that isn't split is a vanishing part. None if
    ``at_most``, a measured bound on the weights, says that no key is heavy.
    """
    if at_most is not None and at_most < HOT_ROWS:
        return None
    heavy = counts.where((F.col(weight) >= HOT_ROWS) & F.col(key).isNotNull())
    share = heavy.agg(F.sum(weight)).scalar() / HOT_SHARE
    return heavy.where(F.col(weight) >= share).select(
        key, F.ceil(F.col(weight) / HOT_ROWS).cast("int").alias("buckets")
    )


def salted_join(
    rows: DataFrame, table: DataFrame, key: str, hot: DataFrame | None, how: str = "inner"
) -> DataFrame:
    """Join ``rows`` to ``table`` (one row per key), splitting the keys listed in ``hot``.

    Rows of a hot key go to one of its buckets, copies of one row too; the one table row is
    repeated per bucket. All other keys have a single bucket. ``rows`` is
    evaluated once here (once more if ``hot`` is derived from it), and the broadcast holds at most
    ``HOT_SHARE`` rows.
    """
    if hot is None:
        return rows.join(table, key, how)
    others = [name for name in rows.columns if name != key]
    hot = F.broadcast(hot)
    salted = rows.join(hot, key, "left").select(
        *rows.columns,
        F.coalesce(
            salt_of(F.col("buckets"), *others),
            # null keys match nothing; an outer join keeps them, so they are spread too
            F.when(F.col(key).isNull(), salt_of(F.lit(NULL_BUCKETS), *others)),
            F.lit(0),
        ).alias("salt"),
    )
    repeated = table.join(hot, key, "left").select(
        *table.columns,
        F.explode(
            F.sequence(F.lit(0), F.coalesce(F.col("buckets"), F.lit(1)) - 1)
        ).alias("salt"),
    )
    return salted.join(repeated, [key, "salt"], how).drop("salt")
