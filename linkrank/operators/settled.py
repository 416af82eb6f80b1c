"""Communities heard in both directions, whose labels come to rest by themselves."""

from __future__ import annotations

from math import log
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from linkrank.functions import part_count
from linkrank.operators.spreading import _numbered
from linkrank.plans import NumberedGraph, Scratch, heaviest, salted_join, spread
from linkrank.plans.layout import VertexIndex, name_labels, partitions_for

HISTORY = "iteration int, wanting long, moved long, converged boolean"
SHARE = 0.25  # votes are counted only near the last moves where these hear no larger part of the links
FEW_LINKS = 1_000_000  # of which all are heard again for less than finding out what is near
MANY_LINKS = 4_000_000  # from which votes are kept as a table that moves change, not counted anew
VOTES_PER_PARTITION = 2_000_000  # of that table, at first
FEW_CHANGES = 64  # of the votes of a vertex, that are looked up one by one
FEW_TOLD = 2_000_000  # draws that are all told: it takes less than a second step
ASKING = 3  # times as much as telling a draw takes asking a neighbour for one
ONCE = "filter(votes, x -> x.n = 2).back AS once"  # of ``votes``, a list of (n, back)
REST = "filter(votes, x -> x.n NOT IN (0, 2)) AS rest"
OWN_LABEL = "-get(filter(rest, x -> x.n % 2 = 1), 0).back AS label"
OWN = ("out_parts", "into_parts", "degree", "draw")  # what a vertex keeps besides its label
STEP, SHIFT, RANGE = 1103515245, 12345, 2**31  # of the draws, a new one each round


def settled_labels(
    vertices: DataFrame | None,
    edges: DataFrame | None,
    max_iter: int | None = None,
    numbered: NumberedGraph | None = None,
) -> DataFrame:
    """``id, label``; see :func:`settled_label_rounds`."""
    return settled_label_rounds(vertices, edges, max_iter, numbered)[0]


def settled_label_rounds(
    vertices: DataFrame | None,
    edges: DataFrame | None,
    max_iter: int | None = None,
    numbered: NumberedGraph | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Communities by votes along links of both directions, and what moved in each round.

    Every vertex starts with its own id as label and hears the vertices it links to and those that
    link to it, once a link; links to itself are not heard. It wants the label it hears most,
    the smallest one if several are, as soon as that is heard more often than its own. Of the
    vertices that want to change a set no two of which are linked does so at once: those with the
    largest draw among the neighbours that want to, the larger id if draws are equal. The set is
    one color of a coloring that is drawn anew each round, for those who want to move alone.

    A move makes more links run inside labels and none of its neighbours moves meanwhile, so
    labels cannot swap for ever: the rounds end when nobody wants to change, which is ``converged``,
    or after ``max_iter`` of them. ``wanting`` and ``moved`` count vertices. Vertices without other
    ones, null among them, keep their label. A round costs two exchanges of what the links carry:
    labels combined by (vertex, label), and one largest draw per vertex. Votes change only next to a move:
    once few links are there, only those vertices ask for labels, and all others keep their wish.
    From ``MANY_LINKS`` links the votes are a table that the moves of a round change: see :class:`_Votes`. Of the draws
    only the larger ones are told then: see :func:`_largest_draws`.
    """
    scratch, graph = _numbered(vertices, edges, numbered)
    spark = scratch.spark
    links = {direction: graph.links(direction) for direction in ("out", "into")}
    drawn = F.conv(F.substring(F.md5(F.coalesce("id", F.lit(""))), 1, 8), 16, 10).cast("long")
    state = graph.index.table.select(
        "vid",
        part_count("out_degree").alias("out_parts"),
        part_count("in_degree").alias("into_parts"),
        (F.col("out_degree") + F.col("in_degree")).alias("degree"),
        F.col("vid").alias("label"),
        (drawn % RANGE).alias("draw"),
    )
    if graph.index.n_links >= MANY_LINKS:
        history, labels = _rounds_on_votes(scratch, graph, state, max_iter)
    else:
        history, labels = _rounds_counting(scratch, graph.index, state, links, max_iter)
    result = scratch.write(name_labels(labels, graph.index), "result")
    for one in links.values():
        one.unpersist()
    scratch.drop("state")
    if numbered is None:
        graph.drop(scratch, "graph")
    return result, spark.createDataFrame(history, HISTORY)


def _rounds_counting(
    scratch: Scratch,
    index: VertexIndex,
    state: DataFrame,
    links: dict[str, DataFrame],
    max_iter: int | None,
) -> tuple[list[tuple], DataFrame]:
    """The history and ``vid, label``, with votes counted anew each round, or near the last moves."""
    history, written, near = [], [], None
    most = SHARE * 2 * index.n_links if index.n_links > FEW_LINKS else 0
    while max_iter is None or len(history) < max_iter:
        done = len(history) + 1
        seen = Observation()
        wishes = _wishes(state, links) if near is None else _renewed(state, *near, links)
        wishes = wishes.observe(seen, F.count_if("wants").alias("wanting"))
        wishes = scratch.write(wishes, f"wishes-{done}")
        wanting = seen.get["wanting"]
        scratch.drop(*written)
        written = [f"wishes-{done}"]
        if not wanting:
            history.append((done, 0, 0, True))
            state = wishes
            break
        seen = Observation()
        told = F.sum(F.when(F.col("moves"), F.col("degree"))).alias("told")
        moves = _moves(wishes, links).observe(seen, F.count_if("moves").alias("moved"), told)
        state = scratch.write(moves, f"labels-{done}")
        near = None
        if seen.get["told"] <= most:
            near = _near_moves(scratch, state, links, f"near-{done}", most)
        written += [f"labels-{done}", f"near-{done}"]
        history.append((done, wanting, seen.get["moved"], False))
    labels = scratch.write(state.select("vid", "label"), "state")
    scratch.drop(*written)
    return history, labels


class _Votes:
    """What every vertex hears, one row of lists per vertex, in buckets by vertex.

    ``n`` is twice the links over which a label is heard, and one more for the vertex's own label.
    So the largest ``n`` is odd where the vertex is content, and even where it wants that label. A move changes
    the votes of the neighbours alone: only these changes are exchanged, the lists stay in their buckets.
    A label is kept as ``back``, the number below zero, so the largest ``(n, back)`` is the label heard most, the
    smallest one. Most labels are heard over one link: ``once`` are those with an ``n`` of 2, ``rest`` has
    ``(n, back)`` of all others. The votes of a vertex with very many links are spread by label, ``part``.
    What else ``own`` tells of a vertex is kept beside its votes.
    """

    def __init__(self, scratch: Scratch, index: VertexIndex, own: DataFrame):
        self.scratch, self.own = scratch, own
        degrees = index.table.selectExpr("vid", "out_degree + in_degree AS degree")
        self.hot = heaviest(degrees, "vid", "degree", at_most=index.max_out + index.max_in)
        self.keys = ["vid"] if self.hot is None else ["vid", "part"]
        self.kept = [name for name in own.columns if name != "vid"]
        cores = scratch.spark.sparkContext.defaultParallelism
        self.buckets = max(cores, -(-(2 * index.n_links + index.n_vertices) // VOTES_PER_PARTITION))
        self.name, self.lists, self.done = None, None, 0

    @property
    def table(self) -> DataFrame | None:
        """The votes one by one, ``vid, label, n``."""
        if self.lists is None:
            return None
        labels = "explode(transform(concat(once, rest.back), back -> -back)) AS label"
        n = "coalesce(get(filter(rest, x -> x.back = -label), 0).n, 2L) AS n"
        return self.lists.selectExpr(*self.keys, "rest", labels).selectExpr(*self.keys, "label", n)

    def add(self, changes: DataFrame) -> None:
        """Write the lists with ``changes``, ``vid, label, n``, added to them."""
        if self.hot is not None:
            part = F.coalesce(F.pmod(F.xxhash64("label"), "buckets"), F.lit(0)).cast("int")
            changes = changes.join(F.broadcast(self.hot), "vid", "left").withColumn("part", part)
        changes = changes.select(*self.keys, "label", "n").repartition(self.buckets, *self.keys)
        changes = changes.groupBy(*self.keys, "label").agg(F.sum("n").alias("n")).where("n <> 0")
        changes = changes.groupBy(*self.keys).agg(F.expr("collect_list(struct(n, -label AS back)) AS changes"))
        if self.lists is None:
            lists = changes.withColumnRenamed("changes", "votes").selectExpr(*self.keys, ONCE, REST).join(self.own, "vid")
            if self.hot is not None:
                lists = lists.repartition(self.buckets, *self.keys)
        else:
            lists = self._merged(changes)
        before, self.name, self.done = self.name, f"linkrank_votes_{uuid4().hex}", self.done + 1
        # nearly all numbers of a file differ, so a dictionary of them is made for nothing
        writer = lists.write.bucketBy(self.buckets, *self.keys).option("parquet.enable.dictionary", "false")
        writer.option("path", self.scratch.path(f"votes-{self.done}")).saveAsTable(self.name)
        self.drop(before, self.done - 1)
        self.lists = self.scratch.spark.table(self.name)

    def _merged(self, changes: DataFrame) -> DataFrame:
        """The lists with the sums ``changes`` of (n, back) added; what is not heard any more leaves them."""
        # a part of a hub may get its first label; in all other rows is at least the own one
        lists = self.lists.join(changes.hint("shuffle_hash"), self.keys, "left" if self.hot is None else "full")
        names = [*self.keys, *self.kept, "changes"]
        if self.hot is not None:
            lists = lists.selectExpr(*names, "coalesce(once, array()) AS once", "coalesce(rest, array()) AS rest")
        # few changes are looked up one by one; of many that would take the product of both, so they are sorted
        lists = lists.selectExpr(
            *names,
            "once",
            "rest",
            f"IF(size(changes) <= {FEW_CHANGES}, changes.back, NULL) AS few",
            f"IF(size(changes) > {FEW_CHANGES}, sort_array(concat(transform(once, back -> struct(back AS back, 2L AS n)),"
            " transform(concat(rest, changes), x -> struct(x.back AS back, x.n AS n)))), NULL) AS many",
        ).selectExpr(
            *names, "once", "rest", "few", "many",
            "array_intersect(once, few) AS held",
            "IF(few IS NULL, NULL, filter(rest, x -> array_contains(few, x.back))) AS met",
        ).selectExpr(
            *names, "once", "rest", "few", "met",
            "IF(few IS NULL, transform(many, (x, i) -> struct(CASE"
            " WHEN get(many, i - 1).back <=> x.back THEN 0L"
            " WHEN get(many, i + 1).back <=> x.back THEN x.n + get(many, i + 1).n"
            " ELSE x.n END AS n, x.back AS back)),"
            " transform(changes, x -> struct(x.n + IF(array_contains(held, x.back), 2L,"
            " coalesce(get(filter(met, y -> y.back = x.back), 0).n, 0L)) AS n, x.back AS back))) AS votes",
        )
        lists = lists.selectExpr(*names, "once", "rest", "few", "met", f"{ONCE}_now", f"{REST}_now")
        others = "IF(size(met) = 0, rest, filter(rest, x -> NOT array_contains(few, x.back)))"
        return lists.selectExpr(
            *self.keys,
            *self.kept,
            "CASE WHEN changes IS NULL THEN once WHEN few IS NULL THEN once_now"
            " ELSE concat(array_except(once, few), once_now) END AS once",
            "CASE WHEN changes IS NULL THEN rest WHEN few IS NULL THEN rest_now"
            f" ELSE concat({others}, rest_now) END AS rest",
        )

    def drop(self, name: str | None, done: int) -> None:
        if name is not None:
            self.scratch.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.scratch.drop(f"votes-{done}")

    def wishes(self) -> DataFrame:
        """``vid, label, best`` of those that want another label, and what is kept beside the votes."""
        most = self.lists.withColumn("top", F.array_max("rest"))
        most = most.selectExpr(
            "*", "greatest(top.n, IF(size(once) > 0, 2L, 0L)) AS n", "-IF(top.n > 2, top.back, array_max(once)) AS best"
        )
        if self.hot is None:
            most = most.where("n % 2 = 0")
        most = most.selectExpr("vid", *self.kept, "n", OWN_LABEL, "best")
        if self.hot is not None:
            most = most.groupBy("vid").agg(
                *(F.max(name).alias(name) for name in (*self.kept, "n", "label")),
                F.expr("max_by(best, struct(n, -best))").alias("best"),
            ).where("n % 2 = 0")
        return most.drop("n")

    def labels(self) -> DataFrame:
        return self.lists.selectExpr("vid", OWN_LABEL).where("label IS NOT NULL")


def _rounds_on_votes(
    scratch: Scratch,
    graph: NumberedGraph,
    state: DataFrame,
    max_iter: int | None,
) -> tuple[list[tuple], DataFrame]:
    """The history and ``vid, label``, with votes kept and changed next to moves."""
    index, links = graph.index, _both_ways(graph)
    votes = _Votes(scratch, index, state.selectExpr("vid", "greatest(out_parts, into_parts) AS parts", "draw"))
    heard = links.selectExpr("vid", "explode(targets) AS label", "2L AS n")
    votes.add(state.selectExpr("vid", "label", "1L AS n").unionByName(heard))
    history, step, shift = [], 1, 0  # the draws of a round are those of the first times step, plus shift
    while max_iter is None or len(history) < max_iter:
        done = len(history) + 1
        seen = Observation()
        wishes = votes.wishes().withColumn("draw", F.expr(f"(draw * {step}L + {shift}L) % {RANGE}L"))
        wishes = scratch.write(wishes.observe(seen, F.count("vid").alias("wanting")), f"wishes-{done}")
        wanting = seen.get["wanting"]
        if not wanting:
            scratch.drop(f"wishes-{done}")
            history.append((done, 0, 0, True))
            break
        moves, moved = _largest_draws(scratch, wishes, links, votes.hot, _floor(index, wanting), f"moves-{done}")
        heard = _told(moves, links, "inline(array(struct(label, -2L AS n), struct(best AS label, 2L AS n)))")
        moving = moves.selectExpr(
            "vid", "inline(array(struct(label, -1L AS n), struct(best AS label, 1L AS n)))"
        )
        votes.add(moving.unionByName(heard))
        scratch.drop(f"wishes-{done}", f"moves-{done}", f"moves-{done}-open")
        history.append((done, wanting, moved, False))
        step, shift = step * STEP % RANGE, (shift * STEP + SHIFT) % RANGE
    labels = scratch.write(votes.labels(), "state")
    votes.drop(votes.name, votes.done)
    links.unpersist()
    return history, labels


def _both_ways(graph: NumberedGraph) -> DataFrame:
    """``vid, part, targets``, the links of both directions, without those to itself; the caller unpersists it."""
    out, into = (graph.index.table.sparkSession.table(graph.tables[way]) for way in ("out", "into"))
    both = out.selectExpr("vid", "part", "targets AS told").join(
        into.selectExpr("vid", "part", "targets AS heard"), ["vid", "part"], "full"
    )
    targets = "array_remove(concat(coalesce(told, array()), coalesce(heard, array())), vid) AS targets"
    rows = both.selectExpr("vid", "part", targets)
    rows = rows.repartition(partitions_for(out, graph.index.n_links), "vid", "part")
    return rows.sortWithinPartitions("vid", "part").persist(StorageLevel.MEMORY_AND_DISK)


def _told(state: DataFrame, links: DataFrame, *columns: str) -> DataFrame:
    """What every vertex of ``state`` tells its neighbours along the links of :func:`_both_ways`."""
    return spread(state.withColumn("sender", F.col("vid")), links, *columns)


def _floor(index: VertexIndex, wanting: int) -> int:
    """The draw from which vertices tell it, so that these and those that then have to ask are few.

    With d neighbours that want to, a part q that tells leaves about (1-q)^(d+1) to ask. That takes ``ASKING`` times
    as much, so the cost is least for q = ln(ASKING * (d+1)) / (d+1).
    """
    links = 2 * index.n_links
    if links * wanting <= FEW_TOLD * index.n_vertices:
        return 0
    rivals = links * wanting / index.n_vertices**2 + 1
    return max(int(RANGE * (1 - log(ASKING * rivals) / rivals)), 0)


def _largest_draws(
    scratch: Scratch, wishes: DataFrame, links: DataFrame, hot: DataFrame | None, floor: int, name: str
) -> tuple[DataFrame, int]:
    """Of ``wishes`` those whose draw is larger than that of all neighbours that want to, and their number.

    The larger id counts if draws are equal. Draws from ``floor`` are told to all neighbours, which is the end of
    most wishes. Who has a smaller one and heard none of these asks its neighbours.
    """
    told = _told(wishes.where(f"draw >= {floor}"), links, "sender", "draw AS rival")
    if hot is not None:
        told = told.groupBy("vid").agg(F.expr("max(struct(rival, sender)) AS top")).select("vid", "top.*")
    larger = "struct(rival, sender) > struct(draw, wishes.vid)"
    seen = Observation()
    moves = wishes.alias("wishes").join(told.alias("told"), F.expr(f"wishes.vid = told.vid AND {larger}"), "left_anti")
    counts = (F.count("vid").alias("moved"), F.count_if(F.col("draw") < floor).alias("open"))
    moves = scratch.write(moves.observe(seen, *counts), name)
    if not seen.get["open"]:
        return moves, seen.get["moved"]
    asks = _told(moves.where(f"draw < {floor}"), links, "sender", "draw AS sent")
    beaten = salted_join(asks, wishes.where(f"draw < {floor}").select("vid", "draw"), "vid", hot)
    beaten = beaten.where("struct(sent, sender) < struct(draw, vid)").selectExpr("sender AS vid").distinct()
    seen = Observation()
    moves = moves.join(beaten, "vid", "left_anti").observe(seen, F.count("vid").alias("moved"))
    return scratch.write(moves, f"{name}-open"), seen.get["moved"]


def _along(state: DataFrame, links: dict[str, DataFrame], *columns: str) -> DataFrame:
    """What every vertex of ``state`` tells its neighbours in both directions, not itself."""
    told = None
    for direction, adjacent in links.items():
        senders = state.withColumns({"parts": F.col(f"{direction}_parts"), "sender": F.col("vid")})
        rows = spread(senders, adjacent, "sender", *columns).where("vid <> sender").drop("sender")
        told = rows if told is None else told.unionByName(rows)
    return told


def _wishes(state: DataFrame, links: dict[str, DataFrame]) -> DataFrame:
    """The state with ``best``, the label heard most, and ``wants``: it is heard more than the own one."""
    return _counted(state, _along(state, links, "label"))


def _counted(state: DataFrame, heard: DataFrame) -> DataFrame:
    """The wishes of the vertices of ``state`` from the labels they hear, ``vid, label``.

    The state rides along as votes that count nothing, so there is no join after the count.
    """
    kept = state.selectExpr("vid", "label", "0L AS n", *OWN)
    heard = heard.selectExpr("vid", "label", "1L AS n", *(f"NULL AS {name}" for name in OWN))
    # counting by (vertex, label) first keeps a vertex with many links off a single task
    votes = kept.unionByName(heard).groupBy("vid", "label").agg(
        F.sum("n").alias("n"), *(F.max(name).alias(name) for name in OWN)
    )
    return (
        votes.groupBy("vid")
        .agg(
            *(F.max(name).alias(name) for name in OWN),
            F.expr("max(label) FILTER (WHERE draw IS NOT NULL)").alias("label"),
            F.expr("max(n) FILTER (WHERE draw IS NOT NULL)").alias("n_own"),
            F.max("n").alias("n_best"),
            F.expr("min_by(label, struct(-n, label))").alias("best"),
        )
        .selectExpr("vid", *OWN, "label", "best", "n_best > n_own AS wants")
    )


def _near_moves(
    scratch: Scratch, state: DataFrame, links: dict[str, DataFrame], name: str, most: float
) -> tuple[DataFrame, int] | None:
    """The state of the vertices linked with one that moved, and how many links these have.

    None if that is more than ``most``.
    """
    seen = Observation()
    told = _along(state.where("moves").select("vid", *OWN), links).distinct()
    near = state.select("vid", *OWN, "label").join(told, "vid", "left_semi")
    near = scratch.write(near.observe(seen, F.sum("degree").alias("asked")), name)
    asked = seen.get["asked"] or 0
    return (near, asked) if asked <= most else None


def _renewed(
    state: DataFrame, near: DataFrame, n_asked: int, links: dict[str, DataFrame]
) -> DataFrame:
    """The wishes if only the vertices of ``near`` hear anything new.

    These ask their neighbours for labels, split where very many ask the same one. The others want what
    they wanted; who moved got it, as no neighbour of theirs moved.
    """
    asked = _along(near, links, "sender AS asker")
    hot = heaviest(asked.groupBy("vid").agg(F.count(F.lit(1)).alias("n")), "vid", "n", at_most=n_asked)
    heard = salted_join(asked, state.select("vid", "label"), "vid", hot).selectExpr("asker AS vid", "label")
    others = state.join(near.select("vid"), "vid", "left_anti")
    return others.drop("moves").unionByName(_counted(near, heard))


def _moves(wishes: DataFrame, links: dict[str, DataFrame]) -> DataFrame:
    """The state after those moved whose draw is larger than that of all neighbours that want to."""
    wanting = wishes.where("wants").select("vid", *OWN)
    rivals = _along(wanting, links, "struct(draw, sender) AS rival").groupBy("vid").agg(
        F.max("rival").alias("rival")
    )
    moves = "wants AND (rival IS NULL OR rival < struct(draw, vid AS sender))"
    return (
        wishes.join(rivals, "vid", "left")
        .withColumn("moves", F.expr(moves))
        .selectExpr(
            "vid",
            "out_parts",
            "into_parts",
            "degree",
            f"(draw * {STEP} + {SHIFT}) % {RANGE} AS draw",
            "IF(moves, best, label) AS label",
            "best",
            "wants AND NOT moves AS wants",
            "moves",
        )
    )
