"""The operators again, as plain loops over small Python graphs."""

from __future__ import annotations

from collections import Counter, defaultdict


def vertex_set(edges):
    return {end for edge in edges for end in edge}


def degrees(edges):
    known = {v: [0, 0] for v in vertex_set(edges)}
    for src, dst in edges:
        known[src][0] += src is not None
        known[dst][1] += dst is not None
    return {v: tuple(pair) for v, pair in known.items()}


def pagerank(edges, iterations=20, damping=0.85):
    ends, out = vertex_set(edges), Counter(src for src, _ in edges)
    rank = {v: 1 / len(ends) for v in ends}
    for _ in range(iterations):
        got = defaultdict(float)
        for src, dst in edges:
            if src is not None and dst is not None:
                got[dst] += rank[src] / out[src]
        rank = {v: (1 - damping) / len(ends) + damping * got[v] for v in ends}
    return rank


def components(edges):
    label = {v: v for v in vertex_set(edges)}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            if a is None or b is None:
                continue
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def label_propagation(edges, max_iter=20):
    label = {v: v for v in vertex_set(edges)}
    history = []
    for done in range(1, max_iter + 1):
        votes = defaultdict(Counter)
        for src, dst in edges:
            if src is not None and dst is not None:
                votes[src][label[dst]] += 1
        new = dict(label)
        for v, heard in votes.items():
            new[v] = min(heard, key=lambda name: (-heard[name], name))
        changed = sum(new[v] != label[v] for v in label)
        label = new
        history.append((done, changed, len(set(label.values()))))
        if not changed:
            break
    return label, history


def hops(edges, source):
    """Depth from ``source`` of every vertex reached in one or more steps, cycles included."""
    out = defaultdict(set)
    for src, dst in edges:
        if src is not None and dst is not None:
            out[src].add(dst)
    depth, level, found = 0, {source}, {}
    while level:
        depth += 1
        level = {dst for src in level for dst in out[src] if dst not in found}
        found.update(dict.fromkeys(level, depth))
    return found
