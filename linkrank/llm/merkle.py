"""Merkle manifest of a table: a tree of hashes per source, one over the sources, a proof per row.

A superblock is 256 consecutive rows of a source, two levels of its tree. On the way up, superblocks
shrink to their roots, and these are the rows of the next tier, until a source is one digest; the
digests of the sources go up in the same way. On the way down, every superblock is cogrouped with the
one row of outer digests that its proofs need, and reduces, proves and folds its rows there. So only
digests move, a source of any size is many equal groups, and a proof is as long as its tree is high.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkrank.plans import Scratch

FAN = 16
LEVELS = 2  # of a tree that a superblock holds
DIGEST = 64  # hexadecimal digits
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

NODE = "g string, rank long, n long, digest string"
OUTER = "g string, block long, subroot string, root string, path array<struct<before:string,after:string>>"
PROVED = (
    "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string,"
    " proof array<struct<before:string,after:string>>"
)


def leaf_of(columns: Sequence[Column]) -> Column:
    """The digest of a row: every value with its length in bytes before it, nulls as a hyphen."""
    parts = []
    for column in columns:
        value = column.cast("string")
        whole = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(whole, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _digest(nodes: Sequence[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def _reduced(nodes: list[str], n: int, height: int) -> list[list[str]]:
    """The levels above the nodes of a superblock, up to its root, in a tree of ``n`` nodes."""
    levels = [nodes]
    while n > 1 and len(levels) <= height:
        nodes = [_digest(nodes[k : k + FAN]) for k in range(0, len(nodes), FAN)]
        levels.append(nodes)
        n = -(-n // FAN)
    return levels


def _paths(levels: list[list[str]]) -> list[list[tuple[str, str]]]:
    """For every node of the lowest level, what stands before and after it and its ancestors."""
    found: list[list[tuple[str, str]]] = [[] for _ in levels[0]]
    for height, nodes in enumerate(levels[:-1]):
        runs = ["".join(nodes[k : k + FAN]) for k in range(0, len(nodes), FAN)]
        for k, path in enumerate(found):
            run, place = divmod(k // FAN**height, FAN)
            path.append((runs[run][: DIGEST * place], runs[run][DIGEST * (place + 1) :]))
    return found


def ranked(scratch: Scratch, rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their place ``rank`` in group ``g`` by ``order``, and the group's size ``n``.

    The rows are sorted over partitions and written; only counts per partition and group are
    added up to offsets. Even equal rows are dealt over partitions.
    """
    copied = rows.withColumn("copy", F.monotonically_increasing_id())
    keys = ["g", *order, "copy"]
    placed = copied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("copy")
    table = scratch.write(placed.withColumn("place", F.monotonically_increasing_id()), name)
    table = table.withColumn("slice", F.shiftright("place", 33))
    counts = table.groupBy("slice", "g").agg(
        F.count(F.lit(1)).alias("rows"), F.min("place").alias("first")
    )
    group = Window.partitionBy("g")
    before = group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "slice",
        "g",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(group).alias("n"),
    )
    return table.join(counts, ["slice", "g"]).select(
        *rows.columns, (F.col("place") + F.col("shift")).alias("rank"), "n"
    )


def _tiers(scratch: Scratch, nodes: DataFrame, height: int, name: str) -> list[DataFrame]:
    """``NODE`` tables from the lowest nodes to the roots of all groups."""
    size = FAN**height

    def shrink(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("rank")
        n = int(nodes["n"].iloc[0])
        root = _reduced(nodes["digest"].tolist(), n, height)[-1][0]
        row = (nodes["g"].iloc[0], int(nodes["rank"].iloc[0]) // size, -(-n // size), root)
        return pd.DataFrame([row], columns=["g", "rank", "n", "digest"])

    tiers = [nodes.select("g", "rank", "n", "digest")]
    while True:
        blocks = _blocks(tiers[-1], height).groupBy("g", "block").applyInPandas(shrink, NODE)
        tiers.append(scratch.write(blocks, f"{name}-{len(tiers)}"))
        if (tiers[-1].agg(F.max("n")).first()[0] or 1) == 1:
            return tiers


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"rank DIV {FAN**height}"))


def _proved_down(
    scratch: Scratch, tiers: list[DataFrame], outer: DataFrame, height: int, name: str
) -> DataFrame:
    """``OUTER`` for the lowest nodes' superblocks from that of the roots; ``block`` is the rank there."""

    def prove(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("rank")
        above = [(one["before"], one["after"]) for one in outer["path"].iloc[0]]
        paths = _paths(_reduced(nodes["digest"].tolist(), int(nodes["n"].iloc[0]), height))
        found = nodes[["g"]].copy()
        found["block"] = nodes["rank"]
        for column in ("subroot", "root"):
            found[column] = outer[column].iloc[0]
        found["path"] = [[{"before": b, "after": a} for b, a in [*path, *above]] for path in paths]
        return found

    for k, nodes in reversed(list(enumerate(tiers[1:-1], 1))):
        met = _blocks(nodes, height).groupBy("g", "block").cogroup(outer.groupBy("g", "block"))
        outer = scratch.write(met.applyInPandas(prove, OUTER), f"{name}-down-{k}")
    return outer


def manifest(
    docs: DataFrame,
    id: str = "doc_id",
    group: str = "source",
    columns: Sequence[str] = COLUMNS,
    suspect: dict[str, Column] | None = None,
    with_proofs: bool = False,
    height: int = LEVELS,
) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``docs``.

    A leaf is the digest of the ``columns``. Rows of a ``group`` stand by id (null first; rows with one id
    by their leaf, so that repeated rows are neighbours), groups by name (null first, then by bytes).
    Every 16 nodes become one, the last run may be shorter, until one is left: ``subroot`` for a group,
    ``root`` for the groups. ``folded_root`` is what a row's proof makes of it, where ``suspect`` says what some
    columns hold now; ``verified`` if that is the root. ``with_proofs`` adds ``proof``, the digests that
    stand before and after the row's node on each level. ``height`` is that of a superblock.

    Null values are hyphens, empty texts have length 0. Texts of any length are only hashed. An empty table has no rows.
    Columns not named are not read, whatever their names.
    """
    scratch = Scratch(docs.sparkSession)
    now = [(suspect or {}).get(name, F.col(name)) for name in columns]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("g"),
        F.col(id).alias("id"),
        leaf_of([F.col(name) for name in columns]).alias("digest"),
        leaf_of(now).alias("found"),
    )
    leaves = scratch.write(leaves, "leaves")
    leaves = scratch.write(ranked(scratch, leaves, ["id", "digest"], "sorted"), "ranked")
    tiers = _tiers(scratch, leaves, height, "tier")

    # the sources' digests, all in one group
    subroots = tiers[-1].select(F.lit("").alias("g"), F.col("g").alias("source"), "digest")
    sources = scratch.write(ranked(scratch, subroots, ["source"], "sources"), "top")
    top = _tiers(scratch, sources, height, "top-tier")
    empty = F.array().cast("array<struct<before:string,after:string>>")
    above = top[-1].select(
        "g", F.lit(0).cast("long").alias("block"), F.lit("").alias("subroot"),
        F.col("digest").alias("root"), empty.alias("path"),
    )
    above = _proved_down(scratch, top, above, height, "top")
    outer = scratch.write(_source_paths(sources, above, height), "source-paths")
    outer = _proved_down(scratch, tiers, outer, height, "tier")

    def prove(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("rank")
        above = [(one["before"], one["after"]) for one in outer["path"].iloc[0]]
        above_text = "".join(before + after for before, after in above)
        paths = _paths(_reduced(nodes["digest"].tolist(), int(nodes["n"].iloc[0]), height))
        proofs, folded = [], []
        for path, digest in zip(paths, nodes["found"], strict=True):
            proofs.append(_digest([*(before + after for before, after in path), above_text]))
            for before, after in [*path, *above]:
                digest = _digest([before, digest, after])
            folded.append(digest)
        found = nodes[["id"]].copy()
        found["leaf"] = nodes["digest"]
        found["subroot"], found["root"] = outer["subroot"].iloc[0], outer["root"].iloc[0]
        found["proof_sha256"], found["folded_root"] = proofs, folded
        found["proof"] = [
            [{"before": b, "after": a} for b, a in [*path, *above]] if with_proofs else None
            for path in paths
        ]
        return found

    rows = _blocks(leaves.withColumn("id", F.col("id").cast("string")), height)
    met = rows.groupBy("g", "block").cogroup(outer.groupBy("g", "block"))
    proved = met.applyInPandas(prove, PROVED)
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    return proved.select(
        F.col("id").cast(docs.schema[id].dataType).alias(id),
        *names,
        F.expr("folded_root = root").alias("verified"),
        *(["proof"] if with_proofs else []),
    )


def _source_paths(sources: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """``OUTER`` of the sources' roots, from that of the superblocks of the tree over the sources."""

    def prove(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("rank")
        above = [(one["before"], one["after"]) for one in outer["path"].iloc[0]]
        paths = _paths(_reduced(nodes["digest"].tolist(), int(nodes["n"].iloc[0]), height))
        found = pd.DataFrame({"g": nodes["source"], "block": 0, "subroot": nodes["digest"]})
        found["root"] = outer["root"].iloc[0]
        found["path"] = [[{"before": b, "after": a} for b, a in [*path, *above]] for path in paths]
        return found

    met = _blocks(sources, height).groupBy("g", "block").cogroup(above.groupBy("g", "block"))
    return met.applyInPandas(prove, OUTER)
