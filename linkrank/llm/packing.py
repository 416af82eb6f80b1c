"""Packing documents into token sequences by best-two-fit.

Bins are planned on the histogram of piece lengths: pieces of one length are interchangeable, so
the plan has at most as many kinds of pieces as the capacity, whatever the corpus, and still
packs all of it together instead of shard by shard. Each piece then finds its bin from its rank
among the pieces of its length.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from linkrank.llm.common import ROWS_AT_ONCE, free_name, pieces
from linkrank.plans import Scratch

CAPACITY = 1024
END_OF_TEXT = 2
LEAST_PARTS = (16, 12, 8, 6, 4)  # replacements of at least these parts of the capacity, besides any
# Fixed value: the pattern by which byte-level pre-tokenizers part a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters whose class no edition of Unicode has changed: blanks, Latin, Greek, Cyrillic, common
# punctuation, kana and ideographs.
PLAIN = re.compile(
    r"[\t\n\r\x20-\x7e\xa1-\u024f\u0391-\u03a1\u03a3-\u03ff\u0400-\u045f"
    r"\u2010-\u2027\u20ac\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5]*"
)


class Encoder:
    """Ids of a text as little-endian 32-bit integers, equal to those of ``tokenizers``.

    A plain byte-level vocabulary whose merges are numbered in their order has the same ids in
    ``tiktoken``, which is several times faster. Other vocabularies, and texts with control
    tokens or characters beyond PLAIN, are left to ``tokenizers``.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        with open(tokenizer_path, encoding="utf-8") as file:
            self.fast = _same_in_tiktoken(json.load(file))

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or "<|" in text or not PLAIN.fullmatch(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4")


def _same_in_tiktoken(description: dict):
    """The vocabulary as a ``tiktoken`` encoding, or None if its ids might differ."""
    import tiktoken

    model, split = description["model"], description.get("pre_tokenizer") or {}
    if (
        model["type"] != "BPE"
        or description.get("normalizer")
        or split.get("type") != "ByteLevel"
        or split.get("add_prefix_space")
        or not split.get("use_regex", True)
    ):
        return None
    # a byte-level token is written with a character per byte: printable bytes as themselves,
    # the others, in order, from character 256 on
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    byte_of = {chr(byte): byte for byte in printable}
    byte_of |= {chr(256 + k): byte for k, byte in enumerate(others)}
    vocabulary = model["vocab"]
    merged = [
        vocabulary["".join(pair.split(" ") if isinstance(pair, str) else pair)]
        for pair in model["merges"]
    ]
    if any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
        return None
    special = {token["content"] for token in description.get("added_tokens", ())}
    ranks = {
        bytes(byte_of[char] for char in token): number
        for token, number in vocabulary.items()
        if token not in special
    }
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def encoder(tokenizer_path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(tokenizer_path)


def tokenized_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    capacity: int = CAPACITY,
    end: int = END_OF_TEXT,
) -> DataFrame:
    """The pieces of every row: its other columns with ``piece, start, length, ids``.

    The ids of a row are its tokens and then ``end``; a null text is an empty one. Rows of more
    than ``capacity`` ids are cut into full pieces behind a first one that may be shorter. ``ids``
    is binary, 4 little-endian bytes an id. ``shard`` is the task that made the piece and
    ``rank`` its number among the shard's pieces of the same length. Columns of ``docs`` with one
    of these names give way to the new ones.
    """
    new = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(),
           "shard": pa.int64(), "rank": pa.int64()}
    kept = [name for name in docs.columns if name != text and name not in new]
    content = free_name(kept, "text")
    source = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias(content))
    schema = source.select(*kept).schema
    for name, kind in new.items():
        schema = schema.add(name, from_arrow_type(kind))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(tokenizer_path), Counter()
        shard, tail = TaskContext.get().partitionId(), np.array([end], "<u4").tobytes()
        for batch in batches:
            for part in pieces(batch):
                rows, made = [], {name: [] for name in new}
                for row, value in enumerate(part.column(content).to_pylist()):
                    ids = encode(value).tobytes() + tail
                    n = len(ids) // 4
                    first = n - capacity * ((n - 1) // capacity)
                    edges = [0, *range(first, n + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        rows.append(row)
                        cells = (piece, a, b - a, ids[4 * a : 4 * b], shard, seen[b - a])
                        for name, cell in zip(new, cells, strict=True):
                            made[name].append(cell)
                        seen[b - a] += 1
                arrays = [part.column(name).take(pa.array(rows, pa.int64())) for name in kept]
                arrays += [pa.array(made[name], kind) for name, kind in new.items()]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, *new])

    return source.mapInArrow(cut, schema)


def best_two_fit(
    counts: list[int], capacity: int, least: int = 1
) -> list[tuple[int, list[int]]]:
    """``(bins, lengths)`` of every kind of bin, for ``counts[length]`` pieces of each length.

    A bin is filled greedily, the largest piece that fits first. Then, if room is left, its
    smallest piece is replaced by the two unpacked pieces of ``least`` tokens or more that fill
    the room it leaves best, if they fill it better than the piece itself. The same bin is made
    as often as the counts allow.
    """
    left = list(counts)
    plan = []
    top = capacity
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return plan
        filled: list[int] = []
        gap, length = capacity, top
        while True:
            length = min(length, gap)
            while length and left[length] <= filled.count(length):
                length -= 1
            if not length:
                break
            fits = min(gap // length, left[length] - filled.count(length))
            filled += [length] * fits
            gap -= fits * length
        if gap and len(filled) > 1:
            smallest = filled[-1]
            pair = _best_pair(left, Counter(filled), gap + smallest, smallest, least)
            if pair:
                filled[-1:] = pair
        uses = Counter(filled)
        bins = min(left[length] // n for length, n in uses.items())
        for length, n in uses.items():
            left[length] -= bins * n
        plan.append((bins, sorted(filled, reverse=True)))


def _best_pair(
    left: list[int], uses: Counter, room: int, better_than: int, least: int
) -> list[int] | None:
    """The two free lengths from ``least`` with the largest sum up to ``room``, above a bound."""
    largest = [0] * (room + 1)  # largest free length up to each
    for length in range(1, room + 1):
        free = left[length] > uses[length]
        largest[length] = length if free else largest[length - 1]
    best, pair = better_than, None
    for a in range(room - least, least - 1, -1):
        if 2 * a <= best:
            break
        if largest[a] != a:
            continue
        b = largest[min(a, room - a)]
        if b == a and left[a] - uses[a] < 2:
            b = largest[a - 1]
        if b >= least and a + b > best:
            best, pair = a + b, [a, b]
    return pair


def fewest_bins(counts: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """The best-two-fit plan with the fewest bins: with any replacement, or with larger pieces only.

    Small pieces are worth more later, as fillers, than in early replacements; how small depends on
    the lengths at hand.
    """
    least = [1, *(max(1, capacity // part) for part in LEAST_PARTS)]
    plans = (best_two_fit(counts, capacity, n) for n in least)
    return min(plans, key=lambda plan: sum(bins for bins, _ in plan))


def _places(plan: list[tuple[int, list[int]]], capacity: int) -> dict[int, np.ndarray]:
    """Per length, runs of ranks as rows ``first rank, pieces a bin, first bin, offset``."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {n: [] for n in range(1, capacity + 1)}
    ranks = [0] * (capacity + 1)
    first_bin = 0
    for bins, lengths in plan:
        offset = 0
        for length, n in sorted(Counter(lengths).items(), reverse=True):
            runs[length].append((ranks[length], n, first_bin, offset))
            ranks[length] += bins * n
            offset += n * length
        first_bin += bins
    return {length: np.array(rows, "i8") for length, rows in runs.items() if rows}


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    capacity: int = CAPACITY,
    end: int = END_OF_TEXT,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """Pack all rows of ``docs`` into as few sequences of ``capacity`` tokens as it can.

    Returns one row per piece: the other columns of ``docs``, ``piece, start, length``, what
    ``carry`` computes from the piece (its ``ids``, unless told otherwise), and the
    ``sequence_id`` and the ``offset`` of the piece in it. Sequences are filled from 0 without
    gaps. Null and empty texts are pieces of one token, repeated rows are packed once each, an
    empty table gives no rows. Columns named like a new one are replaced.
    """
    carry = {"ids": F.col("ids")} if carry is None else carry
    cut = tokenized_pieces(docs, tokenizer_path, text, capacity, end)
    kept = [name for name in cut.columns if name not in ("ids", *carry)]
    scratch = Scratch(docs.sparkSession)
    made = scratch.write(
        cut.select(*kept, *(column.alias(name) for name, column in carry.items())), "pieces"
    )

    # the number of pieces of each length, and of those in the shards before each shard
    counts = scratch.write(
        made.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n")), "counts"
    )
    totals = {row[0]: row[1] for row in counts.groupBy("length").agg(F.sum("n")).collect()}
    plan = fewest_bins([totals.get(n, 0) for n in range(capacity + 1)], capacity)
    before = Window.partitionBy("length").orderBy("shard")
    bases = counts.select(
        "length", "shard", (F.sum("n").over(before) - F.col("n")).alias("base_rank")
    )
    runs = _places(plan, capacity)
    ranked = made.withColumnsRenamed({"rank": "own_rank"}).join(
        bases, ["length", "shard"]
    )

    hidden = ("own_rank", "base_rank", "shard")
    shown = [name for name in made.columns if name not in ("rank", "shard")]
    schema = made.select(*shown).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 8 * ROWS_AT_ONCE):
                length = part.column("length").to_numpy()
                rank = part.column("own_rank").to_numpy() + part.column("base_rank").to_numpy()
                sequence, offset = np.empty(len(length), "i8"), np.empty(len(length), "i8")
                for n in np.unique(length):
                    mine = length == n
                    rows = runs[n]
                    run = rows[np.searchsorted(rows[:, 0], rank[mine], "right") - 1]
                    within = rank[mine] - run[:, 0]
                    sequence[mine] = run[:, 2] + within // run[:, 1]
                    offset[mine] = run[:, 3] + n * (within % run[:, 1])
                arrays = [part.column(name) for name in shown]
                arrays += [pa.array(sequence), pa.array(offset)]
                yield pa.RecordBatch.from_arrays(arrays, [*shown, "sequence_id", "offset"])

    return ranked.select(*shown, *hidden[:2]).mapInArrow(place, schema)
