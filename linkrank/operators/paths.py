"""Hop distances and shortest paths by level-synchronous breadth-first search."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions import part_count
from linkrank.operators.graph import vertex_degrees
from linkrank.plans import NumberedGraph, Scratch, adjacency, encode_edges, index_vertices, spread
from linkrank.plans.layout import VertexIndex

FEW = 500_000  # vertices of a level that may be broadcast: 8 MB of numbers
LEVEL = "vid long, parent long, met boolean"


@dataclass
class _Search:
    """A search along links that stay in place.

    Every level is a table of its own, ``vid, parent, met``, so what is written adds up to the vertices
    reached, once each. A level's vertices go to the links; what they reach and no level has yet
    is the next one. Numbers are in id order: the least parent has the smallest id.
    """

    scratch: Scratch
    name: str
    index: VertexIndex
    links: DataFrame
    degree: str  # the index column that counts these links
    sizes: list[int] = field(default_factory=list)  # vertices of each level

    def path(self, depth: int) -> str:
        # a start that may be found again stands beside the folder of those that may not
        return f"{self.name}/depth={depth}" if depth or self.closed else f"{self.name}-start"

    def begin(self, start: DataFrame, closed: bool = True) -> _Search:
        """Level 0; ``closed`` if it is not to be found again."""
        self.closed = closed
        row = start.selectExpr("vid", "CAST(NULL AS LONG) AS parent", "CAST(NULL AS BOOLEAN) AS met")
        self.scratch.write(row, self.path(0))
        self.sizes.append(self.level(0).count())
        return self

    def level(self, depth: int) -> DataFrame:
        return self.scratch.read(self.path(depth), LEVEL)

    def advance(self, meet: DataFrame | None = None) -> tuple[int, int]:
        """Find the next level; its size, and how many of it are in ``meet`` (``vid``)."""
        depth, size = len(self.sizes), self.sizes[-1]
        reached = _reached(self.level(depth - 1), size, self.links, self.index, self.degree)
        new = reached.groupBy("vid").agg(F.min("parent").alias("parent"))
        if depth > 1 or self.closed:
            new = _without(self.scratch, new, self.seen(), sum(self.sizes), f"{self.name}-new/{depth}")
        if meet is None:
            new = new.withColumn("met", F.lit(None).cast("boolean"))
        else:
            new = new.join(meet.select("vid", F.lit(True).alias("met")), "vid", "left")
        self.scratch.write(new.select("vid", "parent", "met"), self.path(depth))
        size, met = self.level(depth).agg(F.count("vid"), F.count("met")).first()
        self.sizes.append(size)
        return size, met

    def followed(self) -> int:
        """How many links the levels before the last one have."""
        depth = len(self.sizes) - 1
        levels = self.level(0).select("vid")
        if depth > 1:
            levels = levels.union(self.seen().where((F.col("depth") > 0) & (F.col("depth") < depth)).select("vid"))
        degrees = self.index.table.select("vid", self.degree)
        return levels.join(degrees, "vid").agg(F.sum(self.degree)).first()[0] or 0 if depth else 0

    def seen(self) -> DataFrame:
        return self.scratch.read(self.name, LEVEL + ", depth int")

    def parents(self, vid: int, depth: int) -> list[int]:
        """The vertices before ``vid``, which is in level ``depth``, back to the start.

        Each step reads one level's table, of which it keeps one row.
        """
        found = []
        while depth:
            vid = self.level(depth).where(F.col("vid") == vid).first()["parent"]
            found.append(vid)
            depth -= 1
        return found

    def drop(self) -> None:
        self.links.unpersist()
        self.scratch.drop(self.name, f"{self.name}-start", f"{self.name}-new", "index", "encoded")


def _reached(
    level: DataFrame, size: int, links: DataFrame, index: VertexIndex, degree: str
) -> DataFrame:
    """``vid, parent`` for every link from the vertices of a level.

    A few vertices are broadcast to the links. More are sent to them by (vid, part).
    """
    if size <= FEW:
        at = links.join(F.broadcast(level.select("vid")), "vid")
        return at.selectExpr("vid AS parent", "explode(targets) AS vid").select("vid", "parent")
    parts = index.table.select("vid", part_count(degree).alias("parts"))
    return spread(level.select("vid").join(parts, "vid"), links, "vid AS parent")


def _without(
    scratch: Scratch, new: DataFrame, seen: DataFrame, n_seen: int, name: str
) -> DataFrame:
    """The rows of ``new`` whose vertex was not seen.

    If very many were seen, and few are new, these are broadcast to them rather than all that was seen moved.
    """
    if n_seen > FEW:
        new = scratch.write(new, name)
        if new.count() <= FEW:
            known = seen.select("vid").join(F.broadcast(new.select("vid")), "vid", "left_semi")
            return new.join(known, "vid", "left_anti")
    return new.join(seen.select("vid"), "vid", "left_anti")


def _searches(
    edges: DataFrame | None, numbered: NumberedGraph | None, *directions: str
) -> list[_Search]:
    """A search per direction, ``out`` or ``into``, over a stored graph or one numbered here."""
    degrees = {"out": "out_degree", "into": "in_degree"}
    if numbered is not None:
        scratch = Scratch(numbered.index.table.sparkSession)
        return [
            _Search(scratch, d, numbered.index, numbered.links(d), degrees[d]) for d in directions
        ]
    scratch = Scratch(edges.sparkSession)
    index = index_vertices(scratch, vertex_degrees(edges))
    encoded = encode_edges(edges, index)
    if len(directions) > 1:
        encoded = scratch.write(encoded, "encoded")
    found = []
    for d in directions:
        vid, target = ("u", "v") if d == "out" else ("v", "u")
        links = encoded.select(
            F.col(vid).alias("vid"), F.col(target).alias("target"), F.col(degrees[d]).alias("degree")
        )
        found.append(_Search(scratch, d, index, adjacency(links, index.n_links), degrees[d]))
    return found


def _vertex(index: VertexIndex, node: str) -> DataFrame:
    return index.table.where(F.col("id") == F.lit(node)).select("vid")


@dataclass(frozen=True)
class PathSearch:
    """What a search for a path came to."""

    path: DataFrame  # step, node; empty without a path
    hops: int | None  # None without a path
    exhausted: bool  # whether there is no path; else it was found, or the search gave up
    levels: int  # that were expanded
    links_followed: int

    def summary(self) -> DataFrame:
        """One row: ``found, hops, exhausted, levels, links_followed``."""
        row = (self.hops is not None, self.hops, self.exhausted, self.levels, self.links_followed)
        return self.path.sparkSession.createDataFrame(
            [row], "found boolean, hops int, exhausted boolean, levels int, links_followed long"
        )


def find_path(
    edges: DataFrame | None,
    source: str,
    target: str,
    max_depth: int | None = None,
    both_ways: bool = False,
    numbered: NumberedGraph | None = None,
) -> PathSearch:
    """One shortest directed path of at least one hop; from a vertex to itself the shortest cycle.

    Of several shortest paths it is the one whose vertices have the smallest ids, from the target back.
    With ``max_depth`` the search gives up after so many hops; ``exhausted`` tells that from there
    being no path. ``both_ways`` searches from both ends, always on the side with the smaller level, and follows links
    through half the hops from either; the path is the same.
    """
    sides = _searches(edges, numbered, "out", *(["into"] if both_ways else []))
    forward, index = sides[0], sides[0].index
    spark, closed = index.table.sparkSession, source != target
    ends = [_vertex(index, node) for node in (source, target)]
    for side, end in zip(sides, ends, strict=False):
        side.begin(end, closed)
    goal = sides[-1].level(0) if both_ways else ends[1]
    vids, exhausted, levels = [], not all(end.count() for end in ends), 0
    while not exhausted and not vids and (max_depth is None or levels < max_depth):
        side = min(sides, key=lambda one: one.sizes[-1])
        other = sides[sides.index(side) - 1]
        size, met = side.advance(other.level(len(other.sizes) - 1) if both_ways else goal)
        levels += 1
        if met:
            vids = _joined(*sides) if both_ways else _back(forward, goal.first()["vid"])
        exhausted = not size
    names = {
        row.vid: row.id
        for row in index.table.where(F.col("vid").isin(vids)).select("vid", "id").collect()
    }
    result = PathSearch(
        spark.createDataFrame([(k, names[v]) for k, v in enumerate(vids)], "step int, node string"),
        len(vids) - 1 if vids else None,
        exhausted,
        levels,
        sum(side.followed() for side in sides),
    )
    for side in sides:
        side.drop()
    return result


def _back(search: _Search, vid: int) -> list[int]:
    return [vid, *search.parents(vid, len(search.sizes) - 1)][::-1]


def _joined(forward: _Search, backward: _Search) -> list[int]:
    """The path through the vertices where both sides have met.

    From these on, the vertices of shortest paths are those of the backward levels that links lead
    to; each has its least predecessor among them, as it would have in a search from the source alone.
    """
    middle, behind = len(forward.sizes) - 1, len(backward.sizes) - 1
    walk = _Search(forward.scratch, "walk", forward.index, forward.links, forward.degree)
    meeting = forward.level(middle).join(backward.level(behind).select("vid"), "vid", "left_semi")
    walk.begin(meeting.select("vid"), closed=False)
    for depth in range(behind - 1, -1, -1):
        on = _reached(
            walk.level(len(walk.sizes) - 1), walk.sizes[-1], walk.links, walk.index, walk.degree
        ).join(backward.level(depth).select("vid"), "vid", "left_semi")
        step = on.groupBy("vid").agg(F.min("parent").alias("parent"), F.lit(True).alias("met"))
        walk.sizes.append(0)
        walk.sizes[-1] = walk.scratch.write(step, walk.path(len(walk.sizes) - 1)).count()
    last = walk.level(behind).agg(F.min("vid")).first()[0]
    rest = [last, *walk.parents(last, behind)]  # from the target to the middle
    path = [*rest, *forward.parents(rest[-1], middle)]
    walk.scratch.drop("walk", "walk-start")
    return path[::-1]


def shortest_path(
    edges: DataFrame | None,
    source: str,
    target: str,
    max_depth: int | None = None,
    numbered: NumberedGraph | None = None,
) -> DataFrame:
    """``step, node`` of one shortest directed path, empty if there is none; see :func:`find_path`."""
    return find_path(edges, source, target, max_depth, numbered=numbered).path


def bidirectional_path(
    edges: DataFrame | None,
    source: str,
    target: str,
    max_depth: int | None = None,
    numbered: NumberedGraph | None = None,
) -> DataFrame:
    """The path of :func:`shortest_path`, searched from both ends."""
    return find_path(edges, source, target, max_depth, True, numbered).path


def bfs_frontier_sizes(
    edges: DataFrame | None,
    source: str,
    max_depth: int | None = None,
    numbered: NumberedGraph | None = None,
) -> DataFrame:
    """``depth, n_nodes, exhausted``: the vertices first reached at each depth from 1 on.

    ``exhausted`` in all rows if no vertex is left to be reached; else the search gave up at ``max_depth``.
    """
    (search,) = _searches(edges, numbered, "out")
    search.begin(_vertex(search.index, source))
    while search.sizes[-1] and (max_depth is None or len(search.sizes) <= max_depth):
        search.advance()
    exhausted = not search.sizes[-1]
    search.drop()
    sizes = [(depth, n, exhausted) for depth, n in enumerate(search.sizes) if depth and n]
    spark = search.index.table.sparkSession
    return spark.createDataFrame(sizes, "depth int, n_nodes long, exhausted boolean")


def distances_to(
    edges: DataFrame | None,
    target: str,
    max_depth: int | None = None,
    numbered: NumberedGraph | None = None,
) -> DataFrame:
    """``id, hops``: clicks from every vertex that can reach ``target`` to it (itself: 0)."""
    (search,) = _searches(edges, numbered, "into")
    search.begin(_vertex(search.index, target))
    while search.sizes[-1] and (max_depth is None or len(search.sizes) <= max_depth):
        search.advance()
    found = search.seen().select("vid", F.col("depth").alias("hops"))
    distances = found.join(search.index.table.select("vid", "id"), "vid").select("id", "hops")
    if not search.sizes[0]:
        spark = search.index.table.sparkSession
        distances = spark.createDataFrame([(target, 0)], "id string, hops int")
    result = search.scratch.write(distances, "result")
    search.drop()
    return result


def hop_histogram(distances: DataFrame) -> DataFrame:
    """``hops, n_nodes``."""
    return distances.groupBy("hops").agg(F.count(F.lit(1)).alias("n_nodes")).orderBy("hops")
