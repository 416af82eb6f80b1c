"""Approximate nearest neighbours by cosine: an NN-descent graph, its links searched greedily both ways.

Vectors of one direction are one node, so a vector that a third of all rows share costs one node's work.
First neighbours come from blocks of vectors that are close in a random order; then every round
joins each node's neighbours, and those it is a neighbour of, with one another and keeps the best. A pair
is only compared if one of the two is new there, so rounds get cheaper as the lists settle.
Vectors travel as directions of four bytes per component. Lists hold cosines less 1, so that those of
near copies differ; the answers are all vectors of the nodes kept, scored on the originals.

In a search the links stay where they are, with the directions of the nodes they lead to. A round moves
the queries to the nodes they expand, and back only what beats the worst node a query keeps.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkrank.plans import Scratch, heaviest, salted_join

NEIGHBOURS = 20
ORDERS = 4  # random orders for the first neighbours
BLOCK = 128  # vectors of a block, all compared with each other
SETTLED = 0.01  # joins end when a round changes no larger part of the neighbours
ENTRIES = 64  # nodes every search starts from
WIDTH = 512  # best nodes a search keeps; it ends when all of them have been expanded
STEP = 128  # nodes a search expands in a round
NODES_PER_PARTITION = 50_000  # whose links lie together
SEED = 11
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_AT_ONCE = 256  # of 10 KB or so, with the directions of all neighbours, that a worker holds

LISTS = "u long, v binary, s binary"  # a node, its neighbours (int64) and their cosines less 1 (float32)
# a node's list with the number of its neighbours, and which of them the last round brought (a byte each)
GRAPH = LISTS + ", new binary, n_new long, n long"
NAMES, TYPES = ["u", "v", "s"], [pa.int64(), pa.binary(), pa.binary()]


@dataclass(frozen=True)
class NeighbourGraph:
    scratch: Scratch
    nodes: DataFrame  # node, unit (its direction, a float32 per component)
    points: DataFrame  # point, node, x: the distinct vectors
    rows: DataFrame  # point, id
    graph: DataFrame  # GRAPH
    links: DataFrame  # u, members (int64), units: both ways, at most twice the neighbours


def usable(vector: str) -> Column:
    """Whether a vector is there, finite in all components and not zero."""
    inf = "CAST('Infinity' AS DOUBLE)"
    return F.expr(
        f"{vector} IS NOT NULL AND size({vector}) > 0 AND forall({vector}, c ->"
        f" c IS NOT NULL AND NOT isnan(c) AND abs(c) < {inf}) AND exists({vector}, c -> c <> 0)"
    )


def _table(column: pa.Array) -> np.ndarray:
    """Directions, a row each."""
    return _directions(b"".join(column.to_pylist()), len(column))


def _directions(codes: bytes, n: int) -> np.ndarray:
    x = np.frombuffer(codes, "<f4").reshape(n, -1).astype("f8")
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _codes(vectors: list, width: int) -> np.ndarray:
    x = np.zeros((len(vectors), width))
    for k, one in enumerate(vectors):
        x[k, : len(one)] = one
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square is beyond a double
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype("<f4")


def _lists(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = (
        [u for u, _, _ in rows],
        [v.astype("<i8").tobytes() for _, v, _ in rows],
        [s.astype("<f4").tobytes() for _, _, s in rows],
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], NAMES
    )


def build_graph(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    neighbours: int = NEIGHBOURS,
    settled: float = SETTLED,
) -> NeighbourGraph:
    """The neighbour graph of all usable rows.

    Rows without an id, or with a vector that is null, empty, zero or not finite, take no
    part. Shorter vectors count as continued with zeros.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.where(F.col(id).isNotNull() & usable(vector)).select(
        F.col(id).cast("long").alias("id"), F.col(vector).alias("x")
    )
    # points are named by the smallest id and a hash
    named = rows.groupBy("x").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    named = scratch.write(named.select("x", F.xxhash64("least", "x").alias("point"), "n"), "classes")
    width, most = named.agg(F.max(F.size("x")), F.max("n")).first()
    width, hot = width or 1, heaviest(named, "x", "n", at_most=most or 0)
    named = named.drop("n")
    members = scratch.write(salted_join(rows, named, "x", hot).select("point", "id"), "members")

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = _codes(batch.column("x").to_pylist(), width)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([row.tobytes() for row in codes])],
                    [*batch.schema.names, "unit"],
                )

    coded = named.mapInArrow(unit, named.select("*").schema.add("unit", "binary"))
    points = scratch.write(coded.withColumn("node", F.xxhash64("unit")), "points")
    nodes = scratch.write(points.groupBy("node").agg(F.first("unit").alias("unit")), "nodes")
    with _small_batches(nodes.sparkSession):
        lists = _blocks(nodes, 0, width, neighbours)
        for order in range(1, ORDERS):
            lists = lists.unionByName(_blocks(nodes, order, width, neighbours))
        graph = scratch.write(_best(lists.withColumn("found", F.lit(True)), neighbours), "graph-0")
        done, (changed, entries) = 0, _changes(graph)
        while changed > settled * entries:
            found = _local_joins(scratch, nodes, graph, neighbours, done)
            both = graph.select("u", "v", "s", F.lit(False).alias("found")).unionByName(
                found.withColumn("found", F.lit(True))
            )
            better = scratch.write(_best(both, neighbours), f"graph-{done + 1}")
            scratch.drop(f"graph-{done}", f"pairs-{done}")
            graph, done = better, done + 1
            changed, entries = _changes(graph)
        links = scratch.write(_links(nodes, graph, neighbours), "links")
    return NeighbourGraph(scratch, nodes, points, members, graph, links)


def _blocks(nodes: DataFrame, order: int, width: int, neighbours: int) -> DataFrame:
    """Neighbours within blocks of consecutive vectors of a random order.

    The order is that of the signs of random projections, so near vectors are often near in it.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng((SEED, order)).standard_normal((width, 32))
        for batch in batches:
            if batch.num_rows:
                signs = _table(batch.column("unit")) @ planes > 0
                codes = signs @ (1 << np.arange(32, dtype="i8"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), batch.column("unit"), pa.array(codes)],
                    ["node", "unit", "code"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        units: list[bytes] = []

        def block(n: int) -> pa.RecordBatch:
            members, x = np.array(ids[:n], "i8"), _directions(b"".join(units[:n]), n)
            del ids[:n], units[:n]
            return _lists(_all_pairs(members, x, neighbours))

        for batch in batches:
            ids += batch.column("node").to_pylist()
            units += batch.column("unit").to_pylist()
            while len(ids) >= 2 * BLOCK:
                yield block(BLOCK)
        if ids:  # fewer than two blocks: one, so that none is tiny
            yield block(len(ids))

    coded = nodes.select("node", "unit").mapInArrow(code, "node long, unit binary, code long")
    ordered = coded.repartitionByRange("code", "node").sortWithinPartitions("code", "node")
    return ordered.mapInArrow(compare, LISTS)


def _all_pairs(members: np.ndarray, x: np.ndarray, neighbours: int) -> list[tuple]:
    """The nearest others of each member."""
    if len(members) < 2:
        return [(int(u), np.empty(0, "i8"), np.empty(0, "f4")) for u in members]
    near = x @ x.T - 1
    np.fill_diagonal(near, -np.inf)
    k = min(neighbours, len(members) - 1)
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return [(int(u), members[b], near[i, b]) for i, (u, b) in enumerate(zip(members, best, strict=True))]


def _best(lists: DataFrame, neighbours: int) -> DataFrame:
    """``GRAPH``: one list per node with its nearest distinct neighbours, nearest first.

    A node gets a list per order or per node that joined it, so the lists that meet are few. What no list
    from before (``found`` is false) holds is new.
    """
    met = lists.groupBy("u").agg(F.collect_list(F.struct("v", "s", "found")).alias("lists"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, fresh = [], []
            for u, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                v = np.frombuffer(b"".join(one["v"] for one in found), "<i8")
                s = np.frombuffer(b"".join(one["s"] for one in found), "<f4")
                best = _top(v, s, neighbours)
                known = b"".join(one["v"] for one in found if not one["found"])
                rows.append((u, *best))
                fresh.append(~np.isin(best[0], np.frombuffer(known, "<i8")))
            columns = [
                *_lists(rows).columns,
                pa.array([one.tobytes() for one in fresh], pa.binary()),
                pa.array([int(one.sum()) for one in fresh], pa.int64()),
                pa.array([len(one) for one in fresh], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*NAMES, "new", "n_new", "n"])

    return met.mapInArrow(merge, GRAPH)


def _top(v: np.ndarray, s: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((v, -s))
    v, s = v[order], s[order]
    keep = np.sort(np.unique(v, return_index=True)[1])[:n]
    return v[keep], s[keep]


def _changes(graph: DataFrame) -> tuple[int, int]:
    """How many neighbours are new, and how many there are."""
    return tuple(n or 0 for n in graph.agg(F.sum("n_new"), F.sum("n")).first())


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows here hold the vectors of all neighbours; plans made inside pass few of them at a time."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(int(before), ROWS_AT_ONCE) if int(before) > 0 else ROWS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def _both_ways(graph: DataFrame, neighbours: int, turn: int = 0) -> DataFrame:
    """``center, member, new``: a node's neighbours, and nodes that have it as theirs.

    Of the latter as many as it may have itself, new ones first and then by a hash: a node may be near to very
    many. Each ``turn`` chooses others.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = batch.column("u").to_numpy(), [np.frombuffer(b, "<i8") for b in batch.column("v").to_pylist()]
            sizes = [len(one) for one in v]
            new = np.frombuffer(b"".join(batch.column("new").to_pylist()), "?")
            pairs = [np.repeat(u, sizes), np.concatenate([np.empty(0, "i8"), *v]), new]
            yield pa.RecordBatch.from_arrays([pa.array(one) for one in pairs], ["center", "member", "new"])

    pairs = graph.select("u", "v", "new").mapInArrow(split, "center long, member long, new boolean")
    near = Window.partitionBy("center").orderBy(F.desc("new"), F.xxhash64("center", "member", F.lit(turn)))
    back = (
        pairs.select(F.col("member").alias("center"), F.col("center").alias("member"), "new")
        .withColumn("place", F.row_number().over(near))
        .where(F.col("place") <= neighbours)
        .drop("place")
    )
    return pairs.unionByName(back).groupBy("center", "member").agg(F.bool_or("new").alias("new"))


def _local_joins(
    scratch: Scratch, nodes: DataFrame, graph: DataFrame, neighbours: int, turn: int
) -> DataFrame:
    """Compare the neighbours of every node with one another: neighbours of neighbours.

    Nodes that have it as their neighbour take part too. Of two members one is new, or they have
    met before; where none is new nothing is fetched. Only what would enter a member's list is passed on.
    """

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(b, "<f4") for b in batch.column("s").to_pylist()]
            low = [float(one[-1]) if len(one) >= neighbours else -3.0 for one in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), pa.array(low, pa.float32())], ["node", "low"]
            )

    known = graph.select("u", "s").mapInArrow(lowest, "node long, low float")
    told = nodes.select("node", "unit").join(known, "node").withColumnRenamed("node", "member")
    members = (
        _both_ways(graph, neighbours, turn)
        .groupBy("center")
        .agg(F.collect_list(F.struct("member", "new")).alias("all"), F.bool_or("new").alias("any"))
        .where("any")
        .selectExpr("center", "inline(all)")
    )
    groups = (
        scratch.write(members, f"pairs-{turn}")
        .join(told, "member")
        .groupBy("center")
        .agg(F.collect_list(F.struct("member", "unit", "low", "new")).alias("members"))
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("members")
            ends = np.cumsum(column.value_lengths().to_numpy())
            member, unit, low, new = column.flatten().flatten()
            member, low, unit = member.to_numpy(), low.to_numpy(), _table(unit)
            new = new.to_numpy(zero_copy_only=False)
            rows = []
            for a, b in zip([0, *ends[:-1]], ends, strict=True):
                ids, x, fresh = member[a:b], unit[a:b], new[a:b]
                near = (x @ x.T - 1).astype("f4")
                np.fill_diagonal(near, -9.0)
                better = (near > low[a:b, None]) & (fresh[:, None] | fresh)
                for i in np.flatnonzero(better.any(axis=1)):
                    others = np.flatnonzero(better[i])
                    rows.append((int(ids[i]), ids[others], near[i, others]))
            yield _lists(rows)

    return groups.select("members").mapInArrow(join, LISTS)


def _links(nodes: DataFrame, graph: DataFrame, neighbours: int) -> DataFrame:
    """A row per node with the nodes that its links lead to, both ways, and their directions."""
    groups = (
        _both_ways(graph, neighbours)
        .join(nodes.select(F.col("node").alias("member"), "unit"), "member")
        .groupBy(F.col("center").alias("u"))
        .agg(F.collect_list(F.struct("member", "unit")).alias("found"))
    )
    # one string of bytes each: numbers in the machine's order, as numpy reads them
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members, units = [], []
            for found in batch.column("found").to_pylist():
                members.append(np.array([one["member"] for one in found], "<i8").tobytes())
                units.append(b"".join(one["unit"] for one in found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), pa.array(members, pa.binary()), pa.array(units, pa.binary())],
                ["u", "members", "units"],
            )

    return groups.mapInArrow(packed, "u long, members binary, units binary")


def search(
    index: NeighbourGraph, queries: DataFrame, k: int = 5, width: int = WIDTH, step: int = STEP
) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` nearest rows found for every query row.

    ``queries`` has ``query_id, x``. A query that is itself in the graph starts from its own node, and the
    row with its id isn't an answer. All start from ENTRIES fixed nodes and their links too. Scores are cosines of
    the original vectors in double precision; ties go to the smaller id, and fewer rows than ``k``
    come back only if there are no more. Queries with an unusable vector have no answer.
    """
    with _small_batches(queries.sparkSession):
        owned, state = _searched(index, queries, width, step)
        answers = _answers(index, owned, state, k)
        return index.scratch.write(answers, f"answers-{uuid4().hex[:8]}")


def _searched(
    index: NeighbourGraph, queries: DataFrame, width: int, step: int
) -> tuple[DataFrame, DataFrame]:
    """The queries with their nodes, and the best nodes found for each."""
    scratch, nodes, links = index.scratch, index.nodes, index.links
    asked = queries.where(F.col("query_id").isNotNull() & usable("x")).select(
        F.col("query_id").cast("long").alias("query_id"), "x"
    )
    n_nodes = nodes.count()
    width_of = len(nodes.select("unit").first()[0]) // 4 if n_nodes else 1
    owned = asked.join(index.points.select("x", "point", "node"), "x", "left")
    owned = owned.withColumn("q", F.coalesce("point", F.xxhash64(F.lit("outside"), "x")))
    owned = scratch.write(owned.select("query_id", "q", "node", "x"), "queries")
    start_ids, start_x, expanded = _starts(nodes, links, width_of)

    schema = "q long, unit binary, v binary, s binary, seen binary, open int"
    names = ["q", "unit", "v", "s", "seen", "open"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        types = [pa.int64(), *[pa.binary()] * 4, pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
        )

    def state_of(q: int, unit: bytes, v: np.ndarray, s: np.ndarray, seen: np.ndarray) -> tuple:
        """The best nodes, best first; what is worse can't come back, as the worst one only rises."""
        order = np.lexsort((v, -s))[:width]
        v, s, seen = v[order].astype("<i8"), s[order].astype("<f4"), seen[order]
        return (q, unit, v.tobytes(), s.tobytes(), seen.tobytes(), int((~seen).sum()))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for q, node, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                unit = _codes([x], max(width_of, len(x)))[0][:width_of].tobytes()
                v, s, seen = start_ids, start_x @ _query(unit) - 1, expanded
                if node is not None:
                    other = v != node
                    v, s = np.append(v[other], node), np.append(s[other], 0.0)
                    seen = np.append(seen[other], False)
                rows.append(state_of(q, unit, v, s, seen))
            yield batch_of(rows)

    once = owned.groupBy("q").agg(F.first("node").alias("node"), F.first("x").alias("x"))
    state = scratch.write(once.mapInArrow(begin, schema), "search-0")

    def frontier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query at the nodes it expands next, with the score that a node must beat."""
        for batch in batches:
            qs, units, lows, us = [], [], [], []
            for q, unit, v, s, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                v, s = np.frombuffer(v, "<i8"), np.frombuffer(s, "<f4")
                chosen = v[np.flatnonzero(~np.frombuffer(seen, "?"))[:step]]
                qs += [q] * len(chosen)
                units += [unit] * len(chosen)
                lows += [float(s[-1]) if len(s) >= width else -3.0] * len(chosen)
                us += chosen.tolist()
            columns = [(qs, pa.int64()), (units, pa.binary()), (lows, pa.float32()), (us, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in columns], ["q", "unit", "low", "u"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for q, unit, low, members, units in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(members, "<i8")
                near = (_directions(units, len(ids)) @ _query(unit) - 1).astype("f4")
                better = np.flatnonzero(near > low)
                if len(better):
                    rows.append((q, ids[better], near[better]))
            yield _lists(rows)

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for q, unit, v, s, seen, lists in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                v, s, seen = np.frombuffer(v, "<i8"), np.frombuffer(s, "<f4"), np.frombuffer(seen, "?").copy()
                seen[np.flatnonzero(~seen)[:step]] = True
                new = np.frombuffer(b"".join(one["v"] for one in lists or ()), "<i8")
                near = np.frombuffer(b"".join(one["s"] for one in lists or ()), "<f4")
                new, first = np.unique(new, return_index=True)
                fresh = ~np.isin(new, v)
                v, s = np.append(v, new[fresh]), np.append(s, near[first[fresh]])
                seen = np.append(seen, np.zeros(int(fresh.sum()), "?"))
                rows.append(state_of(q, unit, v, s, seen))
            yield batch_of(rows)

    cores = nodes.sparkSession.sparkContext.defaultParallelism
    placed = (
        links.repartition(max(cores, -(-n_nodes // NODES_PER_PARTITION)), "u")
        .sortWithinPartitions("u")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    done = 0
    while state.agg(F.max("open")).first()[0]:
        at_work = state.where("open > 0").select("q", "unit", "v", "s", "seen")
        found = (
            at_work.mapInArrow(frontier, "q long, unit binary, low float, u long")
            .join(placed.hint("merge"), "u")
            .select("q", "unit", "low", "members", "units")
            .mapInArrow(compare, LISTS)
            .groupBy(F.col("u").alias("q"))
            .agg(F.collect_list(F.struct("v", "s")).alias("lists"))
        )
        moved = state.select("q", "unit", "v", "s", "seen").join(found, "q", "left")
        state = scratch.write(moved.mapInArrow(advance, schema), f"search-{done + 1}")
        scratch.drop(f"search-{done}")
        done += 1
    placed.unpersist()

    return owned, state


def _query(unit: bytes) -> np.ndarray:
    """A query's direction; shorter, or zero, if components of it lie beyond the width of the nodes."""
    x = np.frombuffer(unit, "<f4").astype("f8")
    n = np.linalg.norm(x)
    return x / n if abs(n - 1) < 1e-6 else x


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """In double precision, also where squares would be beyond it; the shorter one goes on with zeros."""
    n = min(len(a), len(b))
    square = (a @ a, b @ b)
    if not all(1e-290 < one < 1e290 for one in square):
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        square = (a @ a, b @ b)
    return float(a[:n] @ b[:n] / (np.sqrt(square[0]) * np.sqrt(square[1])))


def _starts(
    nodes: DataFrame, links: DataFrame, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where every search starts: ENTRIES nodes and those their links lead to, so the rows are bounded.

    The entries count as expanded. They are no key of a join that all queries would meet at.
    """
    entries = nodes.select("node", "unit").orderBy(F.xxhash64("node", F.lit(SEED))).limit(ENTRIES)
    found = {}
    for row in links.join(F.broadcast(entries.select(F.col("node").alias("u"))), "u").collect():
        ids, size = np.frombuffer(row.members, "<i8").tolist(), len(row.units) * 8 // len(row.members)
        found |= {v: (row.units[k * size : (k + 1) * size], False) for k, v in enumerate(ids)}
    found |= {row.node: (bytes(row.unit), True) for row in entries.collect()}
    if not found:
        return np.empty(0, "i8"), np.zeros((0, width)), np.empty(0, "?")
    codes = b"".join(bytes(code) for code, _ in found.values())
    return (
        np.array(list(found), "i8"),
        _directions(codes, len(found)),
        np.array([expanded for _, expanded in found.values()]),
    )


def _answers(index: NeighbourGraph, owned: DataFrame, state: DataFrame, k: int) -> DataFrame:
    """Exact scores of all vectors of the nodes that were kept, their rows, and the ranks."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            qs, vs = [], []
            for q, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chosen = np.frombuffer(v, "<i8")
                qs += [q] * len(chosen)
                vs += chosen.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(qs, pa.int64()), pa.array(vs, pa.int64())], ["q", "node"]
            )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("qx").to_pylist(), batch.column("x").to_pylist(), strict=True)
            scores = [cosine(np.array(a, "f8"), np.array(b, "f8")) for a, b in both]
            yield pa.RecordBatch.from_arrays(
                [batch.column("q"), batch.column("point"), pa.array(scores, pa.float64())],
                ["q", "point", "score"],
            )

    vectors = owned.groupBy("q").agg(F.first("x").alias("qx"))
    pairs = state.select("q", "v").mapInArrow(best, "q long, node long")
    scored = (
        pairs.join(index.points, "node")
        .join(vectors, "q")
        .select("q", "point", "qx", "x")
        .mapInArrow(score, "q long, point long, score double")
    )
    by_id = Window.partitionBy("point").orderBy("id")
    members = (
        index.rows.distinct()
        .withColumn("place", F.row_number().over(by_id))
        .where(F.col("place") <= k + 1)
        .drop("place")
    )
    order = [F.desc("score"), F.asc("id")]
    per_vector = (
        scored.join(members, "point")
        .withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(*order)))
        .where(F.col("place") <= k + 1)
        .select("q", "id", "score")
    )
    answers = owned.select("query_id", "q").distinct().join(per_vector, "q")
    answers = answers.where(F.col("id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(*order))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score"
    )
