"""The same results in SQL over the given tables.

Loops of a fixed number of rounds are written out; those that run to their end are recursive.
"""

from __future__ import annotations

from registry.graphs import ROWS_SQL, edges_sql
from registry.queries import SOURCE, TARGET

ITERATIONS, DAMPING = 20, 0.85
VOTE_ROUNDS = 20


def query(ctes: list[str], select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + f"\n{select}"


def base(graph: str) -> list[str]:
    return [
        edges_sql(graph),
        "v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e)",
        "o AS MATERIALIZED (SELECT src, COUNT(*) AS n FROM e GROUP BY src)",
        "i AS MATERIALIZED (SELECT dst, COUNT(*) AS n FROM e GROUP BY dst)",
        """d AS MATERIALIZED (
            SELECT id, COALESCE(o.n, 0) AS out_degree, COALESCE(i.n, 0) AS in_degree
            FROM v LEFT JOIN o ON o.src = id LEFT JOIN i ON i.dst = id)""",
    ]


def ranks(graph: str, redistribute: bool = False) -> list[str]:
    def idle(k: int) -> str:
        """The rank that pages without links leave to all."""
        return (
            f"""+ CAST({DAMPING} AS DOUBLE) * (SELECT COALESCE(SUM(r.rank), 0) FROM r{k} r
                JOIN d USING (id) WHERE out_degree = 0) / (SELECT COUNT(*) FROM v)"""
            if redistribute
            else ""
        )

    rounds = ["r0 AS (SELECT id, CAST(1 AS DOUBLE) / (SELECT COUNT(*) FROM v) AS rank FROM v)"]
    for k in range(1, ITERATIONS + 1):
        rounds.append(
            f"""r{k} AS MATERIALIZED (
            SELECT v.id, (1 - CAST({DAMPING} AS DOUBLE)) / (SELECT COUNT(*) FROM v) {idle(k - 1)}
                + CAST({DAMPING} AS DOUBLE) * COALESCE(t.got, 0) AS rank
            FROM v LEFT JOIN (
                SELECT e.dst, SUM(r.rank / o.n) AS got
                FROM e JOIN r{k - 1} r ON r.id = e.src JOIN o ON o.src = e.src GROUP BY e.dst
            ) t ON t.dst = v.id)"""
        )
    return base(graph) + rounds


LAST = f"r{ITERATIONS}"


def rank_history(column: str, rounds: list[int]) -> str:
    parts = [
        f"""SELECT {k} AS iteration, ROUND(MAX(a.rank), 10) AS max_rank,
            ROUND(SUM(ABS(a.rank - b.rank)), 10) AS l1_delta
        FROM r{k} a JOIN r{k - 1} b ON a.id = b.id"""
        for k in rounds
    ]
    return query(
        ranks("page_link"), f"SELECT iteration, {column} FROM ({' UNION ALL '.join(parts)})"
    )


def components(graph: str) -> list[str]:
    """A label only spreads to larger ids, so the component's smallest one reaches all of it."""
    return base(graph) + [
        "u AS MATERIALIZED (SELECT src AS v1, dst AS v2 FROM e UNION SELECT dst, src FROM e)",
        """c(id, component) AS (
            SELECT id, id FROM v
            UNION SELECT u.v2, c.component FROM c JOIN u ON u.v1 = c.id
            WHERE c.component < u.v2)""",
        """w AS MATERIALIZED (
            SELECT id, MIN(component) AS component FROM c GROUP BY id)""",
    ]


def on_components(select: str) -> str:
    return query(components("page_link"), select, recursive=True)


def settled_ranks(graph: str) -> list[str]:
    """Rounds go on until ranks stand still."""
    return base(graph) + [
        f"""r(id, rank, before) AS (
            SELECT id, CAST(1 AS DOUBLE) / (SELECT COUNT(*) FROM v), CAST(0 AS DOUBLE) FROM v
            UNION ALL
            SELECT p.id, (1 - CAST({DAMPING} AS DOUBLE)) / (SELECT COUNT(*) FROM v)
                + CAST({DAMPING} AS DOUBLE) * COALESCE(t.got, 0), p.rank
            FROM r p LEFT JOIN (
                SELECT e.dst, SUM(q.rank / o.n) AS got
                FROM e JOIN r q ON q.id = e.src JOIN o ON o.src = e.src GROUP BY e.dst
            ) t ON t.dst = p.id
            WHERE (SELECT SUM(ABS(rank - before)) FROM r) > 1e-14)"""
    ]


def label_rounds(graph: str) -> str:
    """Labels changed per round, up to the first round without a change."""
    rounds = [
        "u AS MATERIALIZED (SELECT src AS v1, dst AS v2 FROM e UNION SELECT dst, src FROM e)",
        """m(iteration, id, label, changed) AS (
            SELECT 0, id, id, 1 FROM v
            UNION ALL
            SELECT iteration + 1, id, new, COUNT(*) FILTER (WHERE new <> label) OVER () FROM (
                SELECT p.iteration, p.id, p.label, LEAST(p.label, COALESCE(t.label, p.label)) AS new
                FROM m p LEFT JOIN (
                    SELECT u.v1 AS id, MIN(q.label) AS label
                    FROM u JOIN m q ON q.id = u.v2 GROUP BY u.v1
                ) t ON t.id = p.id
                WHERE p.changed > 0))""",
    ]
    return query(
        base(graph) + rounds,
        """SELECT DISTINCT iteration, changed, changed = 0 AS converged FROM m WHERE iteration > 0""",
        recursive=True,
    )


def hubs(graph: str) -> list[str]:
    rounds = ["h0 AS (SELECT id, CAST(1 AS DOUBLE) AS score FROM v)"]
    for k in range(1, ITERATIONS + 1):
        for made, sent, here, there in (("a", f"h{k - 1}", "dst", "src"), ("h", f"a{k}", "src", "dst")):
            rounds.append(
                f"""{made}{k} AS MATERIALIZED (
            SELECT id, got / NULLIF(SQRT(SUM(got * got) OVER ()), 0) AS score FROM (
                SELECT v.id, COALESCE(SUM(s.score), 0) AS got
                FROM v LEFT JOIN e ON e.{here} = v.id LEFT JOIN {sent} s ON s.id = e.{there}
                GROUP BY v.id))"""
            )
    return base(graph) + rounds


def votes(graph: str) -> list[str]:
    rounds = ["l0 AS (SELECT id, id AS label FROM v)"]
    for k in range(1, VOTE_ROUNDS + 1):
        rounds.append(
            f"""l{k} AS MATERIALIZED (
            SELECT p.id, COALESCE(t.label, p.label) AS label
            FROM l{k - 1} p LEFT JOIN (
                SELECT src, label, ROW_NUMBER() OVER (
                    PARTITION BY src ORDER BY COUNT(*) DESC, label) AS place
                FROM e JOIN l{k - 1} q ON q.id = e.dst GROUP BY src, label
            ) t ON t.src = p.id AND t.place = 1)"""
        )
    return base(graph) + rounds


def settled(graph: str, select: str) -> str:
    """Rounds of ``x`` go on as long as somebody wants to change; the last one only says that nobody does."""
    rounds = [
        """n AS MATERIALIZED (
            SELECT src AS a, dst AS b FROM e WHERE src <> dst
            UNION ALL SELECT dst, src FROM e WHERE src <> dst)""",
        """x(iteration, id, label, draw, wanting, moved) AS (
            SELECT 0, id, id, CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 2147483648,
                CAST(1 AS BIGINT), CAST(0 AS BIGINT) FROM v
            UNION ALL
            SELECT iteration + 1, id, CASE WHEN moves THEN best ELSE label END,
                (draw * 1103515245 + 12345) % 2147483648,
                COUNT(*) FILTER (wants) OVER (), COUNT(*) FILTER (moves) OVER ()
            FROM (
                WITH votes AS (
                    SELECT n.a AS id, q.label, COUNT(*) AS n
                    FROM n JOIN x q ON q.id = n.b GROUP BY n.a, q.label
                ), best AS (
                    SELECT id, label, n FROM votes
                    QUALIFY ROW_NUMBER() OVER (PARTITION BY id ORDER BY n DESC, label) = 1
                ), wishes AS MATERIALIZED (
                    SELECT p.iteration, p.id, p.label, p.draw, b.label AS best,
                        COALESCE(b.n > COALESCE(o.n, 0), FALSE) AS wants
                    FROM x p LEFT JOIN best b ON b.id = p.id
                    LEFT JOIN votes o ON o.id = p.id AND o.label = p.label
                    WHERE p.wanting > 0
                ), rivals AS (
                    SELECT n.a AS id, MAX({'draw': w.draw, 'id': w.id}) AS rival
                    FROM n JOIN wishes w ON w.id = n.b WHERE w.wants GROUP BY n.a
                )
                SELECT w.*, wants AND (
                    rival IS NULL OR rival < {'draw': w.draw, 'id': w.id}) AS moves
                FROM wishes w LEFT JOIN rivals r ON r.id = w.id))""",
    ]
    return query(base(graph) + rounds, select, recursive=True)


VOTED = f"l{VOTE_ROUNDS}"


def on_votes(select: str, graph: str = "page_link") -> str:
    return query(votes(graph), select)


def changes(prefix: str, rounds: int, ctes: list[str], extra: str = "") -> str:
    """Rows per round up to the first one without a change."""
    parts = [
        f"""SELECT {k} AS iteration,
            COUNT(*) FILTER (WHERE a.label <> b.label) AS changed,
            COUNT(*) FILTER (WHERE a.label <> b.label) = 0 AS converged {extra}
        FROM {prefix}{k} a JOIN {prefix}{k - 1} b ON a.id = b.id"""
        for k in range(1, rounds + 1)
    ]
    return query(
        ctes + [f"h AS MATERIALIZED ({' UNION ALL '.join(parts)})"],
        f"""SELECT * FROM h WHERE iteration <= COALESCE(
            (SELECT MIN(iteration) FROM h WHERE changed = 0), {rounds})""",
    )


def levels(source: str, reverse: bool = False, cycle: bool = False) -> list[str]:
    """``b``: every node reached, with its depth and its least parent; in a cycle the source is one of them."""
    src, dst = ("dst", "src") if reverse else ("src", "dst")
    seed = "" if cycle else source
    return base("part_next") + [
        f"""b(node, depth, parent) USING KEY (node) AS (
            SELECT '{seed}', 0, CAST(NULL AS VARCHAR)
            UNION
            SELECT e.{dst}, MIN(f.depth) + 1, MIN(e.{src})
            FROM b f JOIN e ON e.{src} = CASE f.depth WHEN 0 THEN '{source}' ELSE f.node END
            WHERE NOT EXISTS (SELECT 1 FROM recurring.b s WHERE s.node = e.{dst})
            GROUP BY e.{dst})"""
    ]


def path(source: str, target: str, select: str = "SELECT step, node FROM p") -> str:
    return query(
        levels(source, cycle=source == target)
        + [
            f"""p(step, node) AS (
                SELECT depth, node FROM b WHERE node = '{target}' AND depth > 0
                UNION ALL
                SELECT p.step - 1, f.parent FROM p JOIN b f ON f.node = p.node WHERE p.step > 0)""",
        ],
        select,
        recursive=True,
    )


def level_sizes(columns: str, ctes: list[str], first: int) -> str:
    return query(
        ctes,
        f"SELECT {columns}, COUNT(*) AS n_nodes FROM b WHERE depth >= {first} GROUP BY depth",
        recursive=True,
    )


PAIRS = base("page_link") + [
    """w(id, node, hops) USING KEY (id, node) AS (
        SELECT id, id, 0 FROM v
        UNION
        SELECT w.id, e.dst, MIN(w.hops) + 1 FROM w JOIN e ON e.src = w.node
        WHERE NOT EXISTS (SELECT 1 FROM recurring.w s WHERE s.id = w.id AND s.node = e.dst)
        GROUP BY w.id, e.dst)""",
]


def modularity_parts() -> str:
    return """(SELECT COUNT(*) FROM e) AS m,
        (SELECT COUNT(*) FROM e JOIN l20 a ON a.id = e.src JOIN l20 b ON b.id = e.dst
         WHERE a.label = b.label) AS i"""


DUMP = """
    SELECT l_orderkey AS source_id, 'Part''s_\\' || l_partkey || '_(7,0,' AS target_title
    FROM lineitem
    UNION ALL
    SELECT l_orderkey, 'Supplier_"' || l_suppkey || '"' FROM lineitem WHERE l_linenumber % 2 = 0
    UNION ALL
    SELECT l_orderkey, 'Supplier_"' || l_suppkey || '"' FROM lineitem WHERE l_linenumber % 2 = 0"""

ORACLES: dict[str, str] = {
    "read_edge_csv": query(base("page_link"), "SELECT src, dst FROM e"),
    "parse_link_dump": DUMP,
    "edge_csv_sink": DUMP,
    "resolve_page_ids": f"""SELECT 'Order_' || o_orderkey AS src, target_title AS dst
        FROM ({DUMP}) JOIN orders ON o_orderkey = source_id""",
    "dedup_edges": f"SELECT DISTINCT src, dst FROM ({ROWS_SQL['cust_supp']})",
    "vertices": query(base("part_next"), "SELECT id FROM v"),
    "out_degrees": query(base("part_next"), "SELECT src, n AS out_degree FROM o"),
    "in_degrees": query(base("part_next"), "SELECT dst, n AS in_degree FROM i"),
    "vertex_degrees": query(base("cust_supp"), "SELECT id, out_degree, in_degree FROM d"),
    "build_graph": query(base("page_link"), "SELECT id, out_degree, in_degree FROM d"),
    "graph_stats": query(
        base("cust_supp"),
        """SELECT v AS n_vertices, e AS n_edges,
            ROUND(CAST(e AS DOUBLE) / GREATEST(v, 1), 8) AS avg_out_degree
        FROM (SELECT (SELECT COUNT(*) FROM v) AS v, (SELECT COUNT(*) FROM e) AS e)""",
    ),
    "top_in_degree": query(
        base("cust_supp"),
        "SELECT id, in_degree, out_degree FROM d ORDER BY in_degree DESC, id LIMIT 10",
    ),
    "pagerank": query(ranks("part_next"), f"SELECT id, ROUND(rank, 10) AS rank FROM {LAST}"),
    "pagerank_with_sinks": query(
        ranks("page_link"), f"SELECT id, ROUND(rank, 10) AS rank FROM {LAST}"
    ),
    "pagerank_progress": rank_history("max_rank", [1, 5, 10, 15, 20]),
    "pagerank_convergence": rank_history("l1_delta", list(range(1, ITERATIONS + 1))),
    "pagerank_topk": query(
        ranks("part_next"),
        f"SELECT id, ROUND(rank, 10) AS rank FROM {LAST} ORDER BY {LAST}.rank DESC, id LIMIT 50",
    ),
    "vertex_index": query(
        base("page_link"), "SELECT id, ROW_NUMBER() OVER (ORDER BY id) - 1 AS vid FROM v"
    ),
    "undirected_edges": query(
        base("part_next"),
        "SELECT src AS v1, dst AS v2 FROM e UNION SELECT dst, src FROM e",
    ),
    "connected_components": on_components("SELECT id, component FROM w"),
    "wcc_progress": label_rounds("page_link"),
    "component_sizes": on_components(
        "SELECT component, COUNT(*) AS size FROM w GROUP BY component"
    ),
    "component_count": on_components("SELECT COUNT(DISTINCT component) AS n_components FROM w"),
    "component_sinks": on_components(
        "SELECT id, component, COUNT(*) OVER (PARTITION BY component) AS size FROM w"
    ),
    "giant_component_share": on_components(
        """SELECT MAX(size) AS giant_size,
            ROUND(CAST(MAX(size) AS DOUBLE) / SUM(size), 8) AS share
        FROM (SELECT COUNT(*) AS size FROM w GROUP BY component)"""
    ),
    "label_propagation": on_votes(f"SELECT id, label FROM {VOTED}"),
    "label_propagation_dense": on_votes(f"SELECT id, label FROM {VOTED}", "part_next"),
    "lpa_progress": changes(
        "l", VOTE_ROUNDS, votes("part_next"), ", COUNT(DISTINCT a.label) AS n_communities"
    ),
    "settled_labels": settled(
        "page_link", "SELECT id, label FROM x WHERE iteration = (SELECT MAX(iteration) FROM x)"
    ),
    "settled_label_rounds": settled(
        "part_next",
        """SELECT DISTINCT iteration, wanting, moved, wanting = 0 AS converged
        FROM x WHERE iteration > 0""",
    ),
    "community_sizes": on_votes(
        f"SELECT label, COUNT(*) AS count FROM {VOTED} GROUP BY label"
    ),
    "community_count": on_votes(f"SELECT COUNT(DISTINCT label) AS n_communities FROM {VOTED}"),
    "modularity": on_votes(
        f"""SELECT ROUND(i / (2.0 * m) - x / (4.0 * m * m), 8) AS modularity FROM (
            SELECT {modularity_parts()}, (
                SELECT SUM(CAST(k AS DOUBLE) * k / (2.0 * (SELECT COUNT(*) FROM e))) FROM (
                    SELECT SUM(o.n) AS k FROM o JOIN {VOTED} c ON c.id = o.src GROUP BY c.label)
            ) AS x)"""
    ),
    "modularity_directed": on_votes(
        f"""SELECT ROUND(CAST(i AS DOUBLE) / m - x / (CAST(m AS DOUBLE) * m), 8) AS modularity
        FROM (SELECT {modularity_parts()}, (
            SELECT SUM(CAST(a AS DOUBLE) * b) FROM (
                SELECT SUM(d.out_degree) AS a, SUM(d.in_degree) AS b
                FROM d JOIN {VOTED} c ON c.id = d.id GROUP BY c.label)) AS x)"""
    ),
    "intra_community_edges": on_votes(f"SELECT i AS n_intra FROM (SELECT {modularity_parts()})"),
    "community_degree": on_votes(
        f"""SELECT c.label, CAST(SUM(o.n) AS BIGINT) AS total_degree
        FROM o JOIN {VOTED} c ON c.id = o.src GROUP BY c.label"""
    ),
    "community_sink": on_votes(f"SELECT id, label FROM {VOTED}"),
    "in_degree_histogram": query(
        base("cust_supp"), "SELECT in_degree, COUNT(*) AS count FROM d GROUP BY in_degree"
    ),
    "out_degree_histogram": query(
        base("cust_supp"), "SELECT out_degree, COUNT(*) AS count FROM d GROUP BY out_degree"
    ),
    "authority_scores": query(
        base("part_next"),
        """SELECT dst, in_degree, hub_weight,
            ROUND(in_degree * LN(1 + hub_weight), 6) AS authority_score
        FROM (SELECT e.dst, COUNT(*) AS in_degree, CAST(SUM(o.n) AS BIGINT) AS hub_weight
            FROM e JOIN o ON o.src = e.src GROUP BY e.dst)""",
    ),
    "hub_scores": query(
        base("part_next"),
        """SELECT id, out_degree, in_degree,
            ROUND(out_degree * LN(1 + in_degree), 6) AS hub_score FROM d""",
    ),
    "shortest_path": path(SOURCE, TARGET),
    "bidirectional_path": path(SOURCE, TARGET),
    "shortest_cycle": path(SOURCE, SOURCE),
    "path_search": path(
        SOURCE,
        TARGET,
        "SELECT COUNT(*) > 0 AS found, MAX(step) AS hops, COUNT(*) = 0 AS exhausted FROM p",
    ),
    "bfs_frontier_sizes": level_sizes("depth, TRUE AS exhausted", levels(SOURCE), 1),
    "distance_to_target": level_sizes("depth AS hops", levels(SOURCE, reverse=True), 0),
    "hop_distribution": query(
        PAIRS,
        """SELECT hops, CAST(SUM(n) OVER (ORDER BY hops) AS DOUBLE) AS n_pairs, CAST(n AS DOUBLE) AS new_pairs,
            ROUND(SUM(n) OVER (ORDER BY hops) / SUM(n) OVER (), 4) AS share
        FROM (SELECT hops, COUNT(*) AS n FROM w GROUP BY hops)""",
        recursive=True,
    ),
    "hits": query(
        hubs("part_next"),
        f"""SELECT id, ROUND(h.score, 9) AS hub, ROUND(a.score, 9) AS authority
        FROM h{ITERATIONS} h JOIN a{ITERATIONS} a USING (id)""",
    ),
    "pagerank_redistributed": query(
        ranks("page_link", redistribute=True), f"SELECT id, ROUND(rank, 10) AS rank FROM {LAST}"
    ),
    "pagerank_residual": query(
        settled_ranks("page_link") + [
            "z AS (SELECT * FROM r QUALIFY ROW_NUMBER() OVER (PARTITION BY id ORDER BY ABS(rank - before)) = 1)"
        ],
        "SELECT id, ROUND(rank, 9) AS rank FROM z",
        recursive=True,
    ),
    "numbered_graph": query(
        ranks("part_next")
        + components("part_next")[len(base("part_next")):]
        + votes("part_next")[len(base("part_next")):]
        + levels(SOURCE, reverse=True)[len(base("part_next")):],
        f"""SELECT v.id, ROUND(r.rank, 10) AS rank, w.component, l.label, b.depth AS hops
        FROM v JOIN {LAST} r ON r.id = v.id JOIN w ON w.id = v.id JOIN {VOTED} l ON l.id = v.id
        LEFT JOIN b ON b.node = v.id""",
        recursive=True,
    ),
    "power_law_fit": query(
        base("part_next") + [
            "t AS (SELECT in_degree AS x, COUNT(*) AS n FROM d WHERE in_degree > 0 GROUP BY in_degree)",
            """tails AS (
                SELECT a.x AS x_min, b.x, b.n, SUM(b.n) OVER w AS n_tail, COUNT(*) OVER w AS kinds,
                    1 + SUM(b.n) OVER w / SUM(b.n * LN(b.x / (a.x - 0.5))) OVER w AS alpha,
                    SUM(b.n) OVER (PARTITION BY a.x ORDER BY b.x) AS upto
                FROM t a JOIN t b ON b.x >= a.x WINDOW w AS (PARTITION BY a.x))""",
        ],
        """SELECT x_min, CAST(n_tail AS BIGINT) AS n_tail, ROUND(alpha, 6) AS alpha,
            ROUND(MAX(ABS(CAST(upto AS DOUBLE) / n_tail - (1 - POW((x + 0.5) / (x_min - 0.5), 1 - alpha)))), 6) AS distance
        FROM tails WHERE kinds > 1 GROUP BY ALL ORDER BY MAX(ABS(CAST(upto AS DOUBLE) / n_tail
            - (1 - POW((x + 0.5) / (x_min - 0.5), 1 - alpha)))), x_min LIMIT 1""",
    ),
    "rank_degree_spearman": query(
        ranks("part_next") + [
            f"q AS (SELECT d.id, in_degree, out_degree, ROUND(r.rank, 10) AS rank FROM d JOIN {LAST} r ON r.id = d.id)",
            "places AS (SELECT " + ", ".join(
                f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS p_{c}"
                for c in ("rank", "in_degree", "out_degree")
            ) + " FROM q)",
        ],
        """SELECT ROUND(CORR(p_rank, p_in_degree), 6) AS corr_in,
            ROUND(CORR(p_rank, p_out_degree), 6) AS corr_out FROM places""",
    ),
    "rank_degree_profile": query(
        ranks("part_next"),
        f"""SELECT d.id, in_degree, out_degree, ROUND(r.rank, 10) AS rank
        FROM d JOIN {LAST} r ON r.id = d.id""",
    ),
    "top_by_metric": query(
        ranks("part_next")
        + [
            f"""long AS (
            SELECT 'rank' AS metric, id, rank AS value FROM {LAST}
            UNION ALL SELECT 'in_degree', id, CAST(in_degree AS DOUBLE) FROM d
            UNION ALL SELECT 'out_degree', id, CAST(out_degree AS DOUBLE) FROM d)"""
        ],
        """SELECT metric, position, id, ROUND(value, 10) AS value FROM (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY metric ORDER BY value DESC, id) AS position FROM long)
        WHERE position <= 10""",
    ),
    "rank_degree_corr": query(
        ranks("part_next"),
        f"""SELECT ROUND(CORR(r.rank, in_degree), 6) AS corr_in,
            ROUND(CORR(r.rank, out_degree), 6) AS corr_out
        FROM d JOIN {LAST} r ON r.id = d.id""",
    ),
    "power_law_alpha": query(
        base("page_link"),
        """SELECT COUNT(*) AS n_tail, ROUND(1 + COUNT(*) / SUM(LN(in_degree / 0.5)), 6) AS alpha
        FROM d WHERE in_degree >= 1""",
    ),
}
ORACLES["pagerank_sinks"] = ORACLES["pagerank_topk"]
