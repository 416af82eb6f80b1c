"""Degree distributions, hub and authority scores, and rank against degree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkrank.functions import authority_score, hub_score
from linkrank.plans import Scratch, heaviest, salted_join


def in_degree_histogram(vertices: DataFrame) -> DataFrame:
    """``in_degree, count``: vertices per in-degree, 0 included."""
    return _histogram(vertices, "in_degree")


def out_degree_histogram(vertices: DataFrame) -> DataFrame:
    return _histogram(vertices, "out_degree")


def _histogram(vertices: DataFrame, degree: str) -> DataFrame:
    return vertices.groupBy(degree).agg(F.count(F.lit(1)).alias("count")).orderBy(degree)


def authority_scores(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``dst, in_degree, hub_weight, authority_score`` of every page linked to, best first.

    A page's hub weight is the summed out-degree of the pages linking to it, its score
    in_degree * ln(1 + hub_weight): one pass, no iteration.
    """
    sources = vertices.select(F.col("id").alias("src"), "out_degree")
    linked = salted_join(
        edges.select("src", "dst"), sources, "src", heaviest(sources, "src", "out_degree")
    )
    return (
        linked.groupBy("dst")
        .agg(F.count(F.lit(1)).alias("in_degree"), F.sum("out_degree").alias("hub_weight"))
        .withColumn("authority_score", authority_score(F.col("in_degree"), F.col("hub_weight")))
        .orderBy(F.desc("authority_score"), "dst")
    )


def hub_scores(vertices: DataFrame) -> DataFrame:
    """``id, out_degree, in_degree, hub_score`` with out_degree * ln(1 + in_degree), best first."""
    return vertices.select(
        "id",
        "out_degree",
        "in_degree",
        hub_score(F.col("out_degree"), F.col("in_degree")).alias("hub_score"),
    ).orderBy(F.desc("hub_score"), "id")


def rank_degree_profile(vertices: DataFrame, ranks: DataFrame) -> DataFrame:
    return vertices.join(ranks, "id").select("id", "in_degree", "out_degree", "rank")


def top_by_metric(profile: DataFrame, k: int = 10) -> DataFrame:
    """``metric, position, id, value``: the first ``k`` by rank, in_degree and out_degree.

    One pass over the profile: each partition keeps its own first ``k`` per metric, and only
    those are shuffled.
    """
    best = Window.partitionBy("metric").orderBy(F.desc("value"), "id")
    return (
        profile.select(
            "id",
            F.col("rank"),
            F.col("in_degree").cast("double").alias("in_degree"),
            F.col("out_degree").cast("double").alias("out_degree"),
        )
        .unpivot("id", ["rank", "in_degree", "out_degree"], "metric", "value")
        .withColumn("position", F.row_number().over(best))
        .where(F.col("position") <= k)
        .select("metric", F.col("position").cast("long").alias("position"), "id", "value")
    )


def rank_degree_correlation(profile: DataFrame) -> DataFrame:
    """One row: the correlation of rank with in-degree and with out-degree."""
    return profile.agg(
        F.corr("rank", "in_degree").alias("corr_in"),
        F.corr("rank", "out_degree").alias("corr_out"),
    )


def power_law_alpha(vertices: DataFrame, degree: str = "in_degree", x_min: int = 1) -> DataFrame:
    """One row: the power-law exponent of a degree distribution, and the vertices used.

    The usual approximation for whole numbers of the maximum-likelihood exponent,
    1 + n / sum(ln(x / (x_min - 0.5))) over the degrees of at least ``x_min``, computed on
    the histogram.
    """
    tail = _histogram(vertices, degree).where(F.col(degree) >= x_min)
    logs = F.sum(F.col("count") * F.log(F.col(degree) / F.lit(x_min - 0.5)))
    return tail.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n_tail"),
        (1 + F.try_divide(F.sum("count").cast("double"), logs)).alias("alpha"),
    )


def power_law_fit(vertices: DataFrame, degree: str = "in_degree") -> DataFrame:
    """One row, ``x_min, n_tail, alpha, distance``: the power law that a degree distribution follows best.

    For every degree as cut-off, the exponent of :func:`power_law_alpha` and the largest distance between
    the shares of vertices up to each degree, as they are and as the power law has them
    (Kolmogorov and Smirnov). The smallest distance wins, ties go to the smaller cut-off; tails of a single degree are left
    out. No row if there is no other.

    All cut-offs are scored on the histogram, whose sums from the top need no second pass. d different degrees need
    at least d * d / 2 links, so the histogram, which goes to all tasks, is small and d * d steps are linear in the links.
    """
    counts = _histogram(vertices, degree).where(F.col(degree) > 0)
    packed = counts.agg(
        F.sort_array(F.collect_list(F.struct(F.col(degree).alias("x"), F.col("count").alias("n"))))
    ).scalar()
    cuts = counts.select(F.col(degree).cast("double").alias("x_min")).repartition("x_min")
    tails = (
        cuts.withColumn("histogram", packed)
        .withColumn("tail", F.expr("filter(histogram, one -> one.x >= x_min)"))
        .where(F.size("tail") > 1)
        .withColumn("m", F.col("x_min") - 0.5)
        .selectExpr(
            "x_min", "m", "tail", "aggregate(tail, 0L, (s, t) -> s + t.n) AS n_tail",
            "aggregate(tail, 0D, (s, t) -> s + t.n * ln(t.x / m)) AS logs",
        )
        .selectExpr("*", "1 + n_tail / logs AS alpha")
    )
    far = """aggregate(tail, named_struct('n', 0L, 'far', 0D), (s, t) -> named_struct('n', s.n + t.n,
        'far', greatest(s.far, abs((s.n + t.n) / n_tail - (1 - power((t.x + 0.5) / m, 1 - alpha))))),
        s -> s.far)"""
    scored = tails.selectExpr("CAST(x_min AS LONG) AS x_min", "n_tail", "alpha", f"{far} AS distance")
    return scored.orderBy("distance", "x_min").limit(1)


def average_ranks(rows: DataFrame, value: str, name: str) -> DataFrame:
    """``rows`` with the place of their ``value`` in ascending order as ``name``, equal ones sharing the mean.

    Values are counted first and sorted over partitions; the counts are added up within each partition, and
    only one sum per partition comes together for the offsets. Values must not be null.
    """
    scratch = Scratch(rows.sparkSession)
    counts = rows.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    placed = counts.repartitionByRange(value).withColumn("slice", F.spark_partition_id())
    placed = scratch.write(placed, "counts")
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("slice")
        .agg(F.sum("n").alias("rows"))
        .select("slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    upto = Window.partitionBy("slice").orderBy(value)
    # one row per partition of the counts, however many values there are
    ranks = (
        placed.withColumn("upto", F.sum("n").over(upto))
        .join(F.broadcast(offsets), "slice")
        .select(value, "n", (F.col("offset") + F.col("upto") - (F.col("n") - 1) / 2).alias(name))
    )
    hot = heaviest(placed, value, "n")
    return salted_join(rows, ranks.drop("n"), value, hot)


def rank_degree_spearman(profile: DataFrame) -> DataFrame:
    """One row: the correlation of the places by rank with those by in-degree and by out-degree."""
    placed = profile.select("id", "rank", "in_degree", "out_degree")
    for value in ("rank", "in_degree", "out_degree"):
        placed = average_ranks(placed, value, f"{value}_place")
    return placed.agg(
        F.corr("rank_place", "in_degree_place").alias("corr_in"),
        F.corr("rank_place", "out_degree_place").alias("corr_out"),
    )
