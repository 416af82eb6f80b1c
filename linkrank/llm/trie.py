"""Shared beginnings of conversations, as a z-fast trie built by batches of joins.

The trie holds compacted nodes only: a node stands for all depths after its parent's, as far as nothing
branches or ends. It is found under its handle, the hash of the beginning whose length is the
two-fattest number of those depths (the one with most trailing zero bits). A conversation finds
the deepest node that it runs through by a binary search over such lengths, one join a step, whatever the
number of nodes above; another join finds the edge on which it leaves. A batch then cuts the
edges that were left half-way and adds nodes below; every batch is several times as large as the trie so
far. Sums over subtrees are made on compacted nodes by pointer doubling, and only at the end
do edges unfold to one row per depth.

A beginning is named by two 64-bit hashes, which add up over its turns, and its depth.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.plans import Scratch

BATCHES = (1, 5, 16)  # of 16 parts of the conversations, where each batch ends
STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], "u8")
STRINGS = "conv long, n int, p1 array<long>, p2 array<long>, sums array<long>"
NODE = (
    "e int, x1 long, x2 long, p int, q1 long, q2 long,"
    " edge1 array<long>, edge2 array<long>, sums array<long>"
)
NODE_NAMES = [one.split()[0] for one in NODE.split(", ")]
ENDS = "n int, x1 long, x2 long, first long, ids binary"
IDS_AT_ONCE = 100_000


def turn_lists(
    conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv, turns``: the turns of every conversation in order, as ``turn, t1, t2, chars``.

    Null turn numbers come first, equal ones by a hash of role and text; null roles and texts
    are empty. Rows without an id belong to no conversation. A turn is two hashes and the number of its
    code points, so texts stay where they are; a conversation is one row of 28 bytes a turn.
    """
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return (
        conversations.where(F.col(id).isNotNull())
        .select(
            F.col(id).cast("long").alias("conv"),
            F.struct(
                F.col(turn).cast("long").alias("turn"),
                F.xxhash64(who, said).alias("t1"),
                F.xxhash64(F.lit(1), said, who).alias("t2"),
                F.char_length(said).cast("long").alias("chars"),
            ).alias("turn"),
        )
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    )


def _strings(lists: DataFrame) -> DataFrame:
    """``STRINGS``: the hashes and code points of every beginning of a conversation."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column("t1")
            sizes = turns.value_lengths().to_numpy().astype("i8")
            ends = np.cumsum(sizes)
            place = np.arange(len(turns.flatten())) - np.repeat(ends - sizes, sizes)
            offsets = pa.array(np.append(0, ends).astype("i4"))

            def added(values: np.ndarray) -> pa.Array:
                total = np.append(values[:0], np.cumsum(values))
                before = np.append(np.zeros(1, values.dtype), total)[ends - sizes]
                total -= np.repeat(before, sizes)
                return pa.ListArray.from_arrays(offsets, pa.array(total.view("i8")))

            columns = [batch.column("conv"), pa.array(sizes.astype("i4"))]
            for lane, name in enumerate(("t1", "t2")):
                powers = np.full(int(sizes.max(initial=0)) + 1, STEP[lane])
                powers = np.multiply.accumulate(powers)
                hashes = batch.column(name).flatten().to_numpy(zero_copy_only=False).view("u8")
                columns.append(added(hashes * powers[place]))
            chars = batch.column("chars").flatten().to_numpy(zero_copy_only=False)
            columns.append(added(chars.astype("i8")))
            yield pa.RecordBatch.from_arrays(columns, ["conv", "n", "p1", "p2", "sums"])

    parts = lists.select("conv", "turns.t1", "turns.t2", "turns.chars")
    return parts.mapInArrow(sums, STRINGS)


def _at(array: str, depth: str) -> str:
    """The value for a depth of beginnings, which are listed from depth 1."""
    return f"IF({depth} = 0, 0L, get({array}, {depth} - 1))"


def _two_fattest(low: str, high: str) -> str:
    """The number in (low, high] with most trailing zero bits."""
    return f"({high} & shiftleft(-1, length(bin({low} ^ {high})) - 1))"


def _located(strings: DataFrame, trie: DataFrame, steps: int) -> DataFrame:
    """Adds the exit of every string: depth ``a`` of the last node that it runs through, the edge
    ``e, x1, x2`` below, if it goes on along one, and the depth ``l`` at which it leaves the trie."""
    handles = trie.selectExpr(
        "e AS he", "x1 AS hx1", "x2 AS hx2", "p AS hp", f"{_two_fattest('p', 'e')} AS f",
        f"get(edge1, {_two_fattest('p', 'e')} - p - 1) AS k1",
        f"get(edge2, {_two_fattest('p', 'e')} - p - 1) AS k2",
    )
    state = strings.withColumns({"a": F.lit(0), "b": F.col("n")})
    for _ in range(steps):
        asked = state.withColumn("f", F.expr(f"IF(a < b, {_two_fattest('a', 'b')}, -1)"))
        # what is settled meets nothing, and each at a place of its own
        asked = asked.selectExpr(
            "*",
            "IF(f < 0, conv, get(p1, f - 1)) AS k1",
            "IF(f < 0, 0L, get(p2, f - 1)) AS k2",
        )
        met = asked.join(handles, ["f", "k1", "k2"], "left")
        runs = "(he <= n AND get(p1, he - 1) = hx1 AND get(p2, he - 1) = hx2)"
        state = met.selectExpr(
            *strings.columns,
            f"CASE WHEN f < 0 OR he IS NULL THEN a WHEN {runs} THEN he ELSE hp END AS a",
            f"CASE WHEN f < 0 THEN b WHEN he IS NULL THEN f - 1 WHEN {runs} THEN b ELSE hp END AS b",
        )
    edges = trie.selectExpr(
        "p AS a", "edge1[0] AS k1", "edge2[0] AS k2", "e", "x1", "x2", "edge1", "edge2"
    )
    asked = state.selectExpr(
        *strings.columns,
        "a",
        "IF(a < n, get(p1, a), conv) AS k1",
        "IF(a < n, get(p2, a), NULL) AS k2",
    )
    shared = (
        "IF(e IS NULL, 0, size(filter(sequence(0, least(n - a, size(edge1)) - 1),"
        " i -> get(p1, a + i) = edge1[i] AND get(p2, a + i) = edge2[i])))"
    )
    return asked.join(edges, ["a", "k1", "k2"], "left").selectExpr(
        *strings.columns, "a", "e", "x1", "x2", f"a + {shared} AS l"
    )


def _nodes_between(low: str, high: str, p1: str, p2: str, sums: str, base: str) -> list[str]:
    """``NODE`` for an edge from depth ``low`` to ``high``, out of arrays that begin after ``base``.

    ``sums`` begins one depth before the others, with the sum at ``base``.
    """
    return [
        f"{high} AS e",
        f"get({p1}, {high} - {base} - 1) AS x1",
        f"get({p2}, {high} - {base} - 1) AS x2",
        f"{low} AS p",
        f"slice({p1}, {low} - {base} + 1, {high} - {low}) AS edge1",
        f"slice({p2}, {low} - {base} + 1, {high} - {low}) AS edge2",
        f"slice({sums}, {low} - {base} + 1, {high} - {low} + 1) AS sums",
    ]


def _cut(trie: DataFrame, located: DataFrame) -> DataFrame:
    """The trie with a node wherever a string leaves, or ends on, an edge half-way."""
    cuts = located.where("l < e").groupBy("e", "x1", "x2").agg(
        F.sort_array(F.collect_set("l")).alias("cuts")
    )
    parts = (
        trie.join(cuts, ["e", "x1", "x2"], "left")
        .withColumn("depths", F.expr("concat(array(p), coalesce(cuts, CAST(array() AS array<int>)), array(e))"))
        .selectExpr("*", "explode(sequence(1, size(depths) - 1)) AS i")
        .selectExpr("*", "depths[i - 1] AS low", "depths[i] AS high", "p AS base")
    )
    return parts.selectExpr(
        *_nodes_between("low", "high", "edge1", "edge2", "sums", "base"),
        "IF(low = base, q1, get(edge1, low - base - 1)) AS q1",
        "IF(low = base, q2, get(edge2, low - base - 1)) AS q2",
    ).select(*NODE_NAMES)


def _added(scratch: Scratch, located: DataFrame, name: str) -> DataFrame:
    """The nodes of what the strings of a batch have beyond the trie.

    Depths where strings end or part become nodes; each is made by the smallest conversation through it.
    """
    deeper = located.where("l < n")
    depths = deeper.selectExpr(
        "conv", "n", "explode(sequence(l + 1, n)) AS d", "p1", "p2"
    ).selectExpr(
        "conv", "d", "p1[d - 1] AS k1", "p2[d - 1] AS k2",
        "IF(d < n, p1[d], NULL) AS next1", "IF(d < n, p2[d], NULL) AS next2", "d = n AS ends",
    )
    nodes = (
        depths.groupBy("d", "k1", "k2")
        .agg(
            F.expr("bool_or(ends) OR min(next1) <> max(next1) OR min(next2) <> max(next2) AS node"),
            F.min("conv").alias("maker"),
        )
        .where("node")
        .drop("node")
    )
    own = (
        depths.select("conv", "d", "k1", "k2")
        .join(nodes, ["d", "k1", "k2"])
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("d", F.expr("maker = conv AS made")))).alias("nodes"))
    )
    own = scratch.write(own, name)
    edges = (
        deeper.join(own, "conv")
        .selectExpr(
            "p1", "p2", "concat(array(0L), sums) AS sums", "l", "nodes", "posexplode(nodes) AS (i, node)"
        )
        .where("node.made")
        .selectExpr("*", "IF(i = 0, l, nodes[i - 1].d) AS low", "node.d AS high")
    )
    return edges.selectExpr(
        *_nodes_between("low", "high", "p1", "p2", "sums", "0"),
        f"{_at('p1', 'low')} AS q1",
        f"{_at('p2', 'low')} AS q2",
    ).select(*NODE_NAMES)


def _trie(scratch: Scratch, strings: DataFrame) -> DataFrame:
    """``NODE`` of all strings: the compacted nodes but the root."""
    longest = strings.agg(F.max("n")).first()[0] or 0
    part = F.pmod(F.xxhash64("conv", F.lit(7)), F.lit(BATCHES[-1]))
    trie, begin = strings.sparkSession.createDataFrame([], NODE), 0
    for k, end in enumerate(BATCHES):
        batch = strings.where((part >= begin) & (part < end) & (F.col("n") > 0))
        steps = longest.bit_length() if k else 0
        located = scratch.write(_located(batch, trie, steps), f"located-{k}")
        new = _added(scratch, located, f"own-{k}")
        trie = scratch.write(_cut(trie, located).unionByName(new), f"trie-{k}")
        begin = end
    return trie


def _ends(convs: DataFrame) -> DataFrame:
    """``n, x1, x2, ends_sha256``: the hash of the ids that end at a beginning, in order.

    Ids are sorted over partitions and joined to long strings there, so a third of all conversations
    that are equal come as few rows, and pass through the hash as a stream.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def piece() -> pa.RecordBatch:
            text = ",".join(map(str, ids)).encode()
            return pa.RecordBatch.from_pylist(
                [dict(zip(["n", "x1", "x2", "first", "ids"], [*key, ids[0], text], strict=True))],
                pa.schema([("n", pa.int32()), ("x1", pa.int64()), ("x2", pa.int64()),
                           ("first", pa.int64()), ("ids", pa.binary())]),
            )

        for batch in batches:
            found = []
            for *one, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if one != key or len(ids) >= IDS_AT_ONCE:
                    if ids:
                        found.append(piece())
                    key, ids = one, []
                ids.append(conv)
            if found:
                yield pa.Table.from_batches(found).combine_chunks().to_batches()[0]
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, sha256()
        for batch in batches:
            done: list[tuple] = []
            for n, x1, x2, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (n, x1, x2) != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (n, x1, x2), sha256(ids)
                else:
                    state.update(b"," + ids)
            yield _digests(done)
        if key is not None:
            yield _digests([(*key, state.hexdigest())])

    ends = convs.selectExpr("n", f"{_at('p1', 'n')} AS x1", f"{_at('p2', 'n')} AS x2", "conv")
    ordered = ends.repartitionByRange("n", "x1", "x2", "conv")
    pieces = ordered.sortWithinPartitions("n", "x1", "x2", "conv").mapInArrow(join, ENDS)
    met = pieces.repartition("n", "x1", "x2").sortWithinPartitions("n", "x1", "x2", "first")
    return met.mapInArrow(digest, "n int, x1 long, x2 long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    names = ["n", "x1", "x2", "ends_sha256"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.string()]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


TOTALS = ("m", "md", "c", "leaves")


def _subtree_sums(scratch: Scratch, nodes: DataFrame) -> DataFrame:
    """``node, least`` and ``TOTALS`` over each node's subtree, from ``node, up`` and its own values.

    Pointer doubling: a round adds what the nodes have whose pointer leads here, and sets every pointer to
    where that node's pointer leads, so a chain of nodes takes the logarithm of its length.
    """
    state = scratch.write(nodes, "sums-0")
    done = 0
    while state.where("up IS NOT NULL").limit(1).count():
        below = state.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(
            *(F.sum(name).alias(f"{name}_") for name in TOTALS), F.min("least").alias("least_")
        )
        jumps = state.where("up IS NOT NULL").select(
            F.col("node").alias("up"), F.col("up").alias("far")
        )
        moved = state.join(below, "node", "left").join(jumps, "up", "left")
        state = scratch.write(
            moved.select(
                "node",
                F.col("far").alias("up"),
                *(F.expr(f"{name} + coalesce({name}_, 0) AS {name}") for name in TOTALS),
                F.least("least", "least_").alias("least"),
            ),
            f"sums-{done + 1}",
        )
        scratch.drop(f"sums-{done}")
        done += 1
    return state


def prefix_nodes(lists: DataFrame) -> DataFrame:
    """The nodes of the trie over ``conv, turns`` (see :func:`turn_lists`), one row per beginning.

    ``conv_id`` is the smallest conversation that begins like this, ``parent_conv_id`` that of the beginning
    one turn shorter; ``n_convs`` counts the conversations, ``n_children`` the beginnings one turn longer, ``n_leaves`` those of the subtree
    without any. ``saved_tokens`` adds up over the subtree the code points of a node's last turn, for
    all its conversations but one. ``ends_sha256`` is the hash of the ids of the conversations that end here, ascending
    and joined by commas. A conversation without turns is the root's; without any there is no root and
    no row. ``conv`` is unique. Equal conversations of any number are one string of the trie.
    """
    scratch = Scratch(lists.sparkSession)
    convs = scratch.write(_strings(lists), "convs")
    key = {"x1": F.expr(_at("p1", "n")), "x2": F.expr(_at("p2", "n"))}
    ends = (
        convs.select("conv", "n", *(value.alias(name) for name, value in key.items()))
        .groupBy("n", "x1", "x2")
        .agg(F.count(F.lit(1)).alias("m"), F.min("conv").alias("least"))
    )
    ends = scratch.write(ends, "ends")
    distinct = ends.select(F.col("least").alias("conv"))
    trie = _trie(scratch, scratch.write(convs.join(distinct, "conv"), "strings"))
    digests = scratch.write(_ends(convs), "digests")

    root = convs.limit(1).selectExpr(
        "0 AS e", "0L AS x1", "0L AS x2", "CAST(NULL AS INT) AS p", "0L AS q1", "0L AS q2",
        "array(0L) AS sums",
    )
    nodes = trie.select(*root.columns).unionByName(root)
    children = trie.groupBy(
        F.col("p").alias("e"), F.col("q1").alias("x1"), F.col("q2").alias("x2")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    full = (
        nodes.join(children, ["e", "x1", "x2"], "left")
        .join(ends.withColumnRenamed("n", "e"), ["e", "x1", "x2"], "left")
        .join(digests.withColumnRenamed("n", "e"), ["e", "x1", "x2"], "left")
        .selectExpr(
            "struct(e, x1, x2) AS node",
            "IF(p IS NULL, NULL, struct(p AS e, q1 AS x1, q2 AS x2)) AS up",
            "coalesce(m, 0L) AS m",
            "coalesce(m, 0L) * element_at(sums, -1) AS md",
            "element_at(sums, -1) - sums[0] AS c",
            "IF(n_children IS NULL, 1L, 0L) AS leaves",
            "least", "p", "e", "sums", "coalesce(n_children, 0L) AS n_children", "ends_sha256",
        )
    )
    full = scratch.write(full, "nodes")
    totals = _subtree_sums(scratch, full.select("node", "up", *TOTALS, "least"))
    totals = totals.select("node", *TOTALS, "least")
    parents = totals.select(F.col("node").alias("up"), F.col("least").alias("above"))
    edges = (
        full.select("node", "up", "p", "e", "sums", "n_children", "ends_sha256")
        .join(totals, "node")
        .join(parents, "up", "left")
    )
    nothing = sha256(b"").hexdigest()
    # a row for each depth of an edge; the root is an edge of no length, at depth 0
    unfolded = edges.selectExpr("*", "explode(sequence(coalesce(p + 1, 0), e)) AS depth").selectExpr(
        "*", "IF(p IS NULL, 0L, sums[depth - p - 1]) AS before"
    )
    return unfolded.selectExpr(
        "least AS conv_id",
        "CAST(depth AS LONG) AS depth",
        "CASE WHEN p IS NULL THEN NULL WHEN depth = p + 1 THEN above ELSE least END AS parent_conv_id",
        "m AS n_convs",
        "IF(depth = e, n_children, 1L) AS n_children",
        "leaves AS n_leaves",
        "md - before * m - (c - (before - sums[0])) AS saved_tokens",
        f"IF(depth = e, coalesce(ends_sha256, '{nothing}'), '{nothing}') AS ends_sha256",
    )
