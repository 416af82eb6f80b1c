"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.plans import Scratch, heaviest, salted_join


def star_labels(scratch: Scratch, links: DataFrame) -> DataFrame:
    """``u, label`` for every end of the links ``u, v`` (longs): its component's smallest end.

    A large star hangs a vertex's larger neighbours on its smallest one, a small star the
    smaller ones; after a few alternations every component is one star. A round only groups
    with a minimum, which combines before the shuffle, and joins that minimum back, split where a
    vertex has very many neighbours, so these never meet in one place. Rounds end when no link changed.
    """
    edges = scratch.write(
        links.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(),
        "star-0",
    )
    state, done = _state(edges), 0
    while state[0]:
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        large = _with_smallest(both, 2 * state[0]).where("v > u").selectExpr("v AS u", "smallest AS v")
        large = scratch.write(large.distinct(), f"large-{done}")
        near = _with_smallest(large, 2 * state[0])
        small = near.where("v <> smallest").selectExpr("v AS u", "smallest AS v")
        small = small.unionByName(near.selectExpr("u", "smallest AS v"))
        edges = scratch.write(small.distinct(), f"star-{done + 1}")
        scratch.drop(f"star-{done}", f"large-{done}")
        done += 1
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.selectExpr("u", "v AS label").unionByName(
        edges.selectExpr("v AS u", "v AS label").distinct()
    )


def _with_smallest(edges: DataFrame, at_most: int) -> DataFrame:
    least = edges.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("smallest"), F.count(F.lit(1)).alias("n")
    )
    hot = heaviest(least, "u", "n", at_most=at_most)
    return salted_join(edges, least.drop("n"), "u", hot)


def _state(edges: DataFrame) -> tuple:
    """Tells two link tables apart: their number and a hash of all of them."""
    return tuple(edges.selectExpr("count(1)", "bit_xor(xxhash64(u, v))").first())
