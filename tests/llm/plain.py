"""The operators again as plain loops over all rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(key) -> bool:
    return zlib.crc32(("" if key is None else str(key)).encode()) % 4 == 2


def packed(rows: list[tuple], tokenizer, capacity: int = 1024, end: int = 2) -> Counter:
    """How often each ``doc_id, piece, start, length, crc`` occurs."""
    pieces = Counter()
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        edges = [len(ids)]
        while edges[0] > capacity:
            edges.insert(0, edges[0] - capacity)
        start = 0
        for piece, stop in enumerate(edges):
            crc = zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())
            pieces[doc_id, piece, start, stop - start, crc] += 1
            start = stop
    return pieces


def first_fit_decreasing(lengths: list[int], capacity: int) -> int:
    room: list[int] = []
    for n in sorted(lengths, reverse=True):
        for k, left in enumerate(room):
            if n <= left:
                room[k] -= n
                break
        else:
            room.append(capacity - n)
    return len(room)


def fingerprint(text: str | None, size: int = 3) -> int:
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles if words]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def fingerprint_groups(codes: list[int], names: list, bits: int = 3) -> list:
    """The smallest name of each code's component, comparing all pairs of distinct codes."""
    distinct = sorted(set(codes))
    parent = {code: code for code in distinct}

    def root(code):
        while parent[code] != code:
            code = parent[code]
        return code

    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    least: dict = {}
    for code, name in zip(codes, names, strict=True):
        if name is not None:
            least[root(code)] = min(name, least.get(root(code), name))
    return [least.get(root(code)) for code in codes]


def nearest(ids: list, vectors: list, asked: list, k: int) -> dict:
    """Per asked id the scores and ids of the nearest others."""
    usable = [
        (i, np.array(v, "f8")) for i, v in zip(ids, vectors, strict=True)
        if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)
    ]
    x = np.array([v / np.sqrt(v @ v) for _, v in usable])
    found = {}
    for place, (i, _) in enumerate(usable):
        if i in asked:
            scores = x @ x[place]
            order = sorted(
                (-score, j) for (j, _), score in zip(usable, scores.tolist(), strict=True) if j != i
            )
            found[i] = [(-score, j) for score, j in order[:k]]
    return found


ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def known_secrets(text: str | None) -> list[tuple[int, int, int]]:
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


UPPER, LOW, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


def alphabet_of(run: str) -> str:
    def made_of(chars):
        return set(run) <= set(chars)

    if not (set(run) & set(DIGITS) and set(run) & set(UPPER + LOW)):
        return ""
    if made_of(DIGITS + "abcdef") or made_of(DIGITS + "ABCDEF"):
        return DIGITS + "abcdef"
    if made_of(UPPER + "234567"):
        return UPPER + "234567"
    if made_of(DIGITS + UPPER):
        return DIGITS + UPPER
    if made_of(DIGITS + LOW):
        return DIGITS + LOW
    if not (set(run) & set(LOW) and set(run) & set(UPPER)):
        return ""
    if made_of(UPPER + LOW + DIGITS):
        return UPPER + LOW + DIGITS
    return UPPER + LOW + DIGITS + ("-_" if set(run) & set("-_") else "+/")


def tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(run: str, alphabet: str, bins: int = 8) -> float:
    """Bonferroni over the three tests, with the exact normal tail."""
    if len(alphabet) == 16:
        run = run.lower()
    x = [max(0, alphabet.find(c)) for c in run]
    n, a, df = len(x), len(alphabet), bins - 1
    cells = Counter(v * bins // a for v in x)
    chi = bins / n * sum(c * c for c in cells.values()) - n
    uniform = ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    side = [2 * v >= a for v in x]
    above = sum(side)
    runs = 1 + sum(p != q for p, q in zip(side, side[1:], strict=False))
    product = 2 * above * (n - above)
    spread = max(1e-9, product * (product - n) / (n * n * (n - 1)))
    runs_z = abs(runs - (product / n + 1)) / math.sqrt(spread)
    mean = sum(x) / n
    var = sum((v - mean) ** 2 for v in x)
    cov = sum((p - mean) * (q - mean) for p, q in zip(x, x[1:], strict=False))
    serial_z = abs(cov / max(1e-9, var) + 1 / n) * math.sqrt(n)
    return min(1.0, 3 * min(tail(uniform), 2 * tail(runs_z), 2 * tail(serial_z)))


def all_secrets(texts: list) -> list[list[tuple[int, int, int]]]:
    """Known shapes and the runs that pass for random, per text."""
    tested = []
    for row, text in enumerate(texts):
        for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text or ""):
            alphabet = alphabet_of(m[0])
            if alphabet:
                step = math.ceil(randomness(m[0], alphabet) * 2000)
                tested.append((row, m.start(), m.end(), math.floor(2 * math.log2(len(m[0]))), step))
    limit = {}
    for kind in {one[3] for one in tested}:
        steps = sorted(one[4] for one in tested if one[3] == kind)
        level = min(0.1, 2.0 / 2 ** (kind / 2))
        passing = [s for k, s in enumerate(steps, 1) if s / 2000 <= level * k / len(steps)]
        limit[kind] = max(passing, default=-1)
    spans = [known_secrets(text) for text in texts]
    for row, start, end, kind, step in tested:
        covered = any(a <= start and b >= end for a, k, b in spans[row] if k < 3)
        if step > limit[kind] and not covered:
            spans[row].append((start, 3, end))
    return [sorted(found) for found in spans]


def digest(spans: list[tuple[int, int, int]], kinds=("assign", "access", "hex", "random")) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def without_repeats(rows: list[tuple], window: int = 13) -> list[tuple]:
    """``id, n_words, n_removed, text`` of every row, windows compared as tuples."""
    first: dict[tuple, int] = {}
    lists = [(key, WORD.findall(text or "")) for key, text in rows]
    for key, words in lists:
        for k in range(len(words) - window + 1):
            seq = tuple(words[k : k + window])
            if key is not None and key <= first.get(seq, key):
                first[seq] = key
    out = []
    for key, words in lists:
        gone = set()
        for k in range(len(words) - window + 1):
            if key is not None and first[tuple(words[k : k + window])] < key:
                gone.update(range(k, k + window))
        kept = " ".join(word for k, word in enumerate(words) if k not in gone)
        out.append((key, len(words), len(gone), kept))
    return out


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple]]:
    """The conversations ``conv_id, turn, role, text`` with beginnings from another one."""
    turns: dict[int, list] = {}
    for key, turn, role, text in rows:
        if key is not None:
            turns.setdefault(key, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {key: [one[2:] for one in sorted(some, key=lambda t: t[:2])] for key, some in turns.items()}
    result = {}
    for key, some in own.items():
        h = zlib.crc32(str(key).encode()) % 6
        result[key] = own.get(key - key % 100, [])[:h] + some[h:]
    return result


def prefix_nodes(convs: dict[int, list[tuple]]) -> list[tuple]:
    """A row per distinct beginning, from a dictionary of all of them."""
    members: dict[tuple, list[int]] = {}
    for key, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(key)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, keys in members.items():
        own = (len(keys) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += own
            leaves[path[:d]] += children[path] == 0
    out = []
    for path, keys in members.items():
        ends = sorted(key for key in keys if len(convs[key]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(keys), len(path), parent, len(keys), children[path], leaves[path], saved[path],
                    sha256(",".join(map(str, ends)))))
    return out


def leaf(values: tuple) -> str:
    return sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes: list[str], fan: int = 16) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root over the nodes and, for each, what stands before and after it on every level."""
    paths: list[list] = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, own in enumerate(place):
            run = own // fan * fan
            paths[k].append(("".join(nodes[run:own]), "".join(nodes[own + 1 : run + fan])))
            place[k] = own // fan
        nodes = [sha256("".join(nodes[k : k + fan])) for k in range(0, len(nodes), fan)]
    return nodes[0], paths


def manifest(rows: list[tuple]) -> list[tuple]:
    """The manifest of rows ``doc_id, source, lang, n_chars, text``, checked on lower-cased texts."""
    sources: dict = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        some = sorted(sources[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((some, *climb([leaf(row) for row in some])))
    root, tops = climb([subroot for _, subroot, _ in trees])
    out = []
    for (some, subroot, paths), top in zip(trees, tops, strict=True):
        for row, path in zip(some, paths, strict=True):
            found = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4]:
                found = (*row[:4], row[4].translate(LOWER))
            folded = leaf(found)
            for before, after in path + top:
                folded = sha256(before + folded + after)
            proof = sha256("".join(before + after for before, after in path + top))
            out.append((row[0], leaf(row), subroot, root, proof, folded, folded == root))
    return out
