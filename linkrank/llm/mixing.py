"""Mixing sources to target weights by Poisson replication.

Every document is repeated a number of times drawn from a Poisson distribution whose mean is its
source's target rate. The draw inverts the distribution at a number hashed from the document and
a seed, so it needs no random state and comes out the same wherever it is evaluated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import free_name, running
from linkrank.plans import Scratch, heaviest, salted_join

FEW_CHANCES = 1_000_000  # doubles of all distributions that may be broadcast; with more, joins are by salted keys
POWER = 0.5  # default target: sources count with the root of their size
SEED = 17
DIGITS = 13  # hexadecimal digits of the hash that make the number, 52 bits


def rates(docs: DataFrame, source: str = "source", weights: dict[str, float] | None = None,
          power: float = POWER, budget: float | None = None) -> DataFrame:
    """``source_key, n, rate``: rows and mean repetitions of every source (null is one of its own).

    The expected number of all rows is ``budget``, or as many as there are. It is shared out by
    ``weights``; without them by n to the power of ``power``. A source that the weights don't
    name, or name with 0, gets rate 0.
    """
    sizes = docs.groupBy(F.col(source).alias("source_key")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow(F.col("n"), F.lit(float(power))))
    else:
        given = docs.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in weights.items()], "source_key string, weight double"
        )
        weighted = sizes.join(
            given.withColumnRenamed("source_key", "given"),
            F.col("source_key").eqNullSafe(F.col("given")),
            "left",
        ).select("source_key", "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    scratch = Scratch(docs.sparkSession)
    weighted = scratch.write(weighted, "weights")
    total, rows = weighted.agg(F.sum("weight"), F.sum("n")).first()
    wanted = float(rows or 0) if budget is None else float(budget)
    factor = wanted / total if total else 0.0
    return weighted.select(
        "source_key", "n", (F.col("weight") * F.lit(factor) / F.col("n")).alias("rate")
    )


def with_distribution(sources: DataFrame) -> DataFrame:
    """Adds ``chances``, the cumulative Poisson distribution up to where it is 1 in doubles.

    Terms are kept as logarithms, so that a large rate doesn't underflow. Time is linear in the rate.
    """
    steps = "transform(sequence(0, CAST(rate + 12 * sqrt(rate) + 40 AS INT)), k -> IF(k = 0, -rate, ln(rate) - ln(CAST(k AS DOUBLE))))"
    terms = f"transform({running(steps, 'double')}, t -> exp(t))"
    return sources.withColumn("chances", F.expr(running(terms, "double")))


def replicated(
    docs: DataFrame,
    id: str = "doc_id",
    source: str = "source",
    weights: dict[str, float] | None = None,
    power: float = POWER,
    budget: float | None = None,
    seed: int = SEED,
    copy: str = "copy",
) -> DataFrame:
    """``docs`` with every row repeated by its draw, ``copy`` numbering the repetitions from 0.

    Rows come out in a global random order: dealt out and then sorted by a hash. The draw depends
    on the id and the seed: rows that share an id are repeated equally often, null ids like an
    empty one. Texts, null, empty or long, are only carried along. An empty table gives no rows; a column of
    the name ``copy`` is replaced, any other name may be in use.
    """
    scratch = Scratch(docs.sparkSession)
    columns = [name for name in docs.columns if name != copy]
    table = scratch.write(
        with_distribution(rates(docs, source, weights, power, budget).where("rate > 0")), "rates"
    )
    key = free_name(columns, "mix_source")
    draw = free_name(columns, "mix_draw")
    # a join doesn't match nulls, so a flag and an empty string stand for them
    named = F.struct(F.col("source_key").isNull().alias("none"),
                     F.coalesce(F.col("source_key").cast("string"), F.lit("")).alias("name"))
    own = F.struct(F.col(source).isNull().alias("none"),
                   F.coalesce(F.col(source).cast("string"), F.lit("")).alias("name"))
    table = table.select(named.alias(key), "n", F.col("chances").alias(draw))
    rows = docs.select(*columns, own.alias(key))
    size = table.agg(F.sum(F.size(draw) + 8)).first()[0] or 0
    if size <= FEW_CHANCES:
        joined = rows.join(F.broadcast(table.drop("n")), key)
    else:
        joined = salted_join(rows, table.drop("n"), key, heaviest(table, key, "n"))
    text_id = F.coalesce(F.col(id).cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), text_id))
    number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)
    times = free_name(columns, "mix_times")
    place = free_name(columns, "mix_place")
    counted = joined.withColumn(times, number).withColumn(
        times, F.expr(f"CAST(size(filter(`{draw}`, c -> c <= `{times}`)) AS INT)")
    )
    repeated = counted.where(F.col(times) > 0).select(
        *columns, F.explode(F.sequence(F.lit(0), F.col(times) - 1)).alias(copy)
    )
    order = F.xxhash64(F.lit(seed), text_id, copy, F.spark_partition_id())
    return (
        repeated.withColumn(place, order)
        .repartition(F.col(place))
        .sortWithinPartitions(place, copy)
        .select(*columns, copy)
    )
