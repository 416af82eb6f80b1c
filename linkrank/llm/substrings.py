"""Removal of word sequences that an earlier document has, found through fixed-block anchors.

Every document is cut into blocks of 7 words that do not overlap; these are the reference blocks.
A window of 13 words holds a whole block wherever it lies, so if a window of one document occurs in
another, one of its rolling 7-word windows meets a block there: an anchor. Around anchors only,
hits are extended to windows of 13 words, compared by 96 bits of hash or more; windows that
overlap add up to the maximal repeats.

Words are hashed in chunks of documents that are written once. A chunk sends each distinct hash
once, packed by bucket of hashes, so that a passage which a third of all documents share is one
entry per chunk, and gets back a bit for each. Nothing is compared pair by pair, and texts are moved
only to meet those bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from linkrank.plans import Scratch

WINDOW = 13
CHUNK_BYTES = 1 << 22  # of text, at least; a longer text is a chunk of its own
ENTRIES_PER_BUCKET = 2_000_000
WORDS_AT_ONCE = 1 << 16
SEED = 29

CHUNKS = "chunk long, n_words long, ids binary, known binary, ends binary, data binary"
GRAMS = "bucket long, chunk long, entries binary"
WINDOWS = "bucket long, chunk long, high binary, low binary, ids binary"
BITS = "chunk long, bucket long, bits binary"
RESULT = "id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, text string"

_random = np.random.default_rng(SEED)
LETTERS = _random.integers(1, 1 << 63, (2, 256), "u8") * np.uint64(2) + np.uint64(1)
STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], "u8")  # odd: powers never vanish
PLACES = _random.integers(1, 1 << 63, (2, 4096), "u8") * np.uint64(2) + np.uint64(1)
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def block_of(window: int) -> int:
    """The longest block of which any window holds a whole one, wherever the blocks begin."""
    return (window + 1) // 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Chunk:
    """The words of a chunk: where they begin and end, and the document of each."""

    def __init__(self, row: dict):
        self.data = np.frombuffer(ZstdDecompressor().decompress(row["data"]), "u1")
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.known = np.frombuffer(row["known"], "?")
        inside = ~SPACE[self.data]
        edges = np.flatnonzero(np.diff(inside, prepend=False))  # the data ends with a space
        self.starts, self.ends = edges[::2], edges[1::2]
        self.doc = np.searchsorted(np.frombuffer(row["ends"], "<i8"), self.starts, "right")
        self.first = np.searchsorted(self.doc, np.arange(len(self.ids) + 1))  # a word per document

    def words(self, lane: int) -> np.ndarray:
        """A hash per word."""
        longest = int((self.ends - self.starts).max(initial=1))
        powers = np.ones(longest, "u8")
        if longest > 1:
            powers[1:] = STEP[lane]
            powers = np.multiply.accumulate(powers)
        found = np.empty(len(self.starts), "u8")
        for a in range(0, len(found), WORDS_AT_ONCE):
            starts, ends = self.starts[a : a + WORDS_AT_ONCE], self.ends[a : a + WORDS_AT_ONCE]
            sizes = ends - starts
            at = np.cumsum(sizes) - sizes
            place = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
            letters = LETTERS[lane][self.data[np.repeat(starts, sizes) + place]]
            found[a : a + WORDS_AT_ONCE] = np.add.reduceat(letters * powers[place], at)
        return _mixed(found)

    def sequences(self, words: np.ndarray, size: int, lane: int) -> np.ndarray:
        """A hash per start of ``size`` consecutive words; some run on into the next document."""
        n = max(0, len(words) - size + 1)
        found = np.zeros(n, "u8")
        for k in range(size):
            found += words[k : k + n] * PLACES[lane][k]
        return _mixed(found)

    def whole(self, size: int) -> np.ndarray:
        """Whether ``size`` words from here are of one document, one that has an id."""
        n = max(0, len(self.doc) - size + 1)
        return (self.doc[:n] == self.doc[size - 1 :][:n]) & self.known[self.doc[:n]]


class _Grams:
    """The distinct 7-word hashes of a chunk, in order, and which of them each place has."""

    def __init__(self, chunk: _Chunk, words: np.ndarray, size: int):
        self.at = np.flatnonzero(chunk.whole(size))
        hashes = chunk.sequences(words, size, 0)[self.at]
        self.values, self.entry = np.unique(hashes, return_inverse=True)
        doc = chunk.doc[self.at]
        self.block = np.zeros(len(self.values), "?")
        self.block[self.entry[(self.at - chunk.first[doc]) % size == 0]] = True
        low, high = np.full(len(self.values), len(chunk.ids)), np.full(len(self.values), -1)
        np.minimum.at(low, self.entry, doc)
        np.maximum.at(high, self.entry, doc)
        self.shared = low < high  # by documents of this chunk


class _Windows:
    """The distinct windows of a chunk that hold an anchor, with the smallest id that has each."""

    def __init__(self, chunk: _Chunk, anchors: np.ndarray, words: np.ndarray, size: int, block: int):
        near = np.cumsum(np.append(0, anchors))
        whole = chunk.whole(size)
        n = len(whole)
        held = near[size - block + 1 :][:n] > near[:n] if n else whole
        self.at = np.flatnonzero(whole & held)
        high = chunk.sequences(words, size, 0)[self.at]
        low = chunk.sequences(chunk.words(1), size, 1)[self.at].astype("<u4")
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))[: len(high)]
        self.entry = np.empty(len(order), "i8")
        self.entry[order] = np.cumsum(new) - 1
        self.high, self.low = high[new], low[new]
        self.id = chunk.ids[chunk.doc[self.at]]
        self.least = np.full(len(self.high), np.iinfo("i8").max)
        np.minimum.at(self.least, self.entry, self.id)


def _buckets(hashes: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each hash; in the order of the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype("i8")


def _by_bucket(hashes: np.ndarray, n: int) -> Iterator[tuple[int, slice]]:
    """The buckets of ordered hashes, and where their part lies."""
    bucket = _buckets(hashes, n)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(bucket)], strict=False):
        yield int(bucket[a]), slice(int(a), int(b))


def _bits(answers: list[dict] | None, hashes: np.ndarray, n: int) -> np.ndarray:
    """The answers to a chunk, a bit for each of its ordered hashes."""
    found = np.zeros(len(hashes), "?")
    got = {one["bucket"]: one["bits"] for one in answers or ()}
    for bucket, part in _by_bucket(hashes, n):
        if bucket in got:
            bits = np.unpackbits(np.frombuffer(got[bucket], "u1"), count=part.stop - part.start)
            found[part] = bits.view("?")
    return found


def _written(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [one.split()[0] for one in schema.split(", ")]
    types = [pa.int64() if one.endswith("long") else pa.binary() for one in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
    )


def _chunks(docs: DataFrame) -> DataFrame:
    """``CHUNKS`` from ``id, text``: some documents in a row, their texts compressed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[bytes] = []
        sizes = done = 0

        def chunk() -> pa.RecordBatch:
            nonlocal sizes, done
            data = b"\n".join([*texts, b""])
            inside = ~SPACE[np.frombuffer(data, "u1")]
            row = (
                (TaskContext.get().partitionId() << 33) + done,
                int((np.diff(inside, prepend=False) & inside).sum()),
                np.array([0 if x is None else x for x in ids], "<i8").tobytes(),
                np.array([x is not None for x in ids], "?").tobytes(),
                np.cumsum([len(text) + 1 for text in texts]).astype("<i8").tobytes(),
                ZstdCompressor(level=3).compress(data),
            )
            ids.clear(), texts.clear()
            sizes, done = 0, done + 1
            return _written(CHUNKS, [row])

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(doc_id)
                texts.append(text or b"")
                sizes += len(texts[-1])
                if sizes >= CHUNK_BYTES:
                    yield chunk()
        if ids:
            yield chunk()

    return docs.mapInArrow(pack, CHUNKS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _grams(chunks: DataFrame, size: int, buckets: int) -> DataFrame:
    """``GRAMS``: 30 bits of hash, whether it is a block here, whether documents here share it.

    A bucket has some 2 million entries whatever the corpus, so 30 bits beside the bucket's mistake
    one hash in 500 for another; that costs work, not results.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = _Chunk(row)
            grams = _Grams(chunk, chunk.words(0), size)
            packed = (grams.values << np.uint64(2)).astype("<u4")
            packed |= grams.block.astype("<u4") | grams.shared.astype("<u4") << np.uint32(1)
            parts = _by_bucket(grams.values, buckets)
            yield _written(GRAMS, [(b, row["chunk"], packed[at].tobytes()) for b, at in parts])

    return chunks.mapInArrow(send, GRAMS)


def _anchors(grams: DataFrame) -> DataFrame:
    """``BITS``: which hashes are a block somewhere and occur in two documents or more."""

    def meet(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, "<u4") for x in table.column("entries").to_pylist()]
        entries = np.concatenate(parts)
        order = np.argsort(entries >> 2, kind="stable")
        keys, flags = entries[order] >> 2, entries[order] & 3
        starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] + 1))
        any_flag = np.bitwise_or.reduceat(flags, starts)
        often = np.diff(np.append(starts, len(keys)))
        live = (any_flag & 1 > 0) & ((often > 1) | (any_flag & 2 > 0))
        found = np.empty(len(keys), "?")
        found[order] = np.repeat(live, often)
        return _answers(table, [len(x) for x in parts], found)

    return grams.groupBy("bucket").applyInArrow(meet, BITS)


def _answers(table: pa.Table, sizes: list[int], found: np.ndarray) -> pa.Table:
    bits = [np.packbits(x).tobytes() for x in np.split(found, np.cumsum(sizes)[:-1])]
    columns = [table.column("chunk"), table.column("bucket"), pa.array(bits, pa.binary())]
    return pa.Table.from_arrays(columns, ["chunk", "bucket", "bits"])


def _anchored(row: dict, size: int, block: int, buckets: int) -> tuple[_Chunk, _Windows]:
    chunk = _Chunk(row)
    words = chunk.words(0)
    grams = _Grams(chunk, words, block)
    live = np.zeros(max(0, len(words) - block + 1), "?")
    live[grams.at] = _bits(row["anchors"], grams.values, buckets)[grams.entry]
    return chunk, _Windows(chunk, live, words, size, block)


def _windows(chunks: DataFrame, size: int, block: int, buckets: int, many: int) -> DataFrame:
    """``WINDOWS``: the windows around anchors, with the smallest id in the chunk that has each."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            _, found = _anchored(row, size, block, buckets)
            rows = []
            for bucket, part in _by_bucket(found.high, many):
                # windows of one document side by side, as their ids compress well then
                order = np.argsort(found.least[part], kind="stable")
                columns = (x[part][order].tobytes() for x in (found.high, found.low, found.least))
                rows.append((bucket, row["chunk"], *columns))
            yield _written(WINDOWS, rows)

    return chunks.mapInArrow(send, WINDOWS)


def _earlier(windows: DataFrame) -> DataFrame:
    """``BITS``: which windows a smaller id than the chunk's has, in the order of their hashes."""

    def meet(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, "<u8") for x in table.column("high").to_pylist()]
        high = np.concatenate(parts)
        low = np.frombuffer(b"".join(table.column("low").to_pylist()), "<u4")
        ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), "<i8")
        order = np.lexsort((ids, low, high))
        high, low, ids = high[order], low[order], ids[order]
        new = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))[: len(high)]
        smallest = np.repeat(ids[new], np.diff(np.append(np.flatnonzero(new), len(ids))))
        later = np.empty(len(ids), "?")
        later[order] = smallest < ids
        # chunks expect their hashes in order
        part = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        back = np.lexsort((low[np.argsort(order)], np.concatenate(parts), part))
        return _answers(table, [len(x) for x in parts], later[back])

    return windows.groupBy("bucket").applyInArrow(meet, BITS)


def _cut(chunks: DataFrame, size: int, block: int, buckets: int, many: int) -> DataFrame:
    """The documents without the words that windows of earlier ones cover."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk, found = _anchored(row, size, block, buckets)
            later = _bits(row["earlier"], found.high, many)[found.entry]
            later |= found.id > found.least[found.entry]
            edges = np.zeros(len(chunk.starts) + 1, "i8")
            np.add.at(edges, found.at[later], 1)
            np.add.at(edges, found.at[later] + size, -1)
            yield _result(chunk, np.cumsum(edges)[:-1] > 0)

    return chunks.mapInArrow(cut, RESULT)


def _result(chunk: _Chunk, removed: np.ndarray) -> pa.RecordBatch:
    n_docs = len(chunk.ids)
    n_words = np.diff(chunk.first)
    n_removed = np.bincount(chunk.doc[removed], minlength=n_docs)
    # the bytes of the words that stay, a space after each
    starts, ends, doc = chunk.starts[~removed], chunk.ends[~removed], chunk.doc[~removed]
    edges = np.zeros(len(chunk.data) + 1, "i1")
    edges[starts] += 1
    edges[ends + 1] -= 1
    data = chunk.data.copy()
    data[ends] = 0x20
    kept = data[np.cumsum(edges, dtype="i1")[:-1] > 0].tobytes()
    size = np.bincount(doc, weights=ends - starts + 1, minlength=n_docs).astype("i8")
    stop = np.cumsum(size)
    texts = [kept[b - n : max(b - 1, b - n)] for b, n in zip(stop.tolist(), size.tolist(), strict=True)]
    # runs of removed words, apart where a document begins
    begins = np.flatnonzero(removed & (np.diff(chunk.doc, prepend=-1).astype("?") | ~np.append(False, removed[:-1])))
    finish = np.append(removed, False)[1:] & np.append(np.diff(chunk.doc) == 0, False)
    stops = np.flatnonzero(removed & ~finish) + 1
    base = chunk.first[chunk.doc[begins]]
    spans = pa.StructArray.from_arrays(
        [pa.array(begins - base), pa.array(stops - base)], ["start", "end"]
    )
    offsets = np.searchsorted(chunk.doc[begins], np.arange(n_docs + 1)).astype("i4")
    return pa.RecordBatch.from_arrays(
        [
            pa.array(chunk.ids, mask=~chunk.known),
            pa.array(n_words, pa.int64()),
            pa.array(n_removed, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), spans),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ],
        ["id", "n_words", "n_removed", "spans", "text"],
    )


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``id, n_words, n_removed, spans, text`` for every row of ``docs`` (ids are longs).

    A word goes if a window of ``window`` words that covers it also occurs in a row with a smaller
    id. ``spans`` are the runs of words that went, from word to word, and ``text`` is what stays,
    joined by single spaces. Null and empty texts, and those of fewer words than a window, stay as they
    are and come back empty or as their words. A row without an id takes no words from others and
    loses none. Rows with one id take nothing from one another; repeated rows stay repeated. Columns
    other than the two named are not read, whatever their names; an empty table gives no rows.

    A task holds about 4 MB of text at a time, or the one text that is longer: some 60 bytes for
    every byte of it.
    """
    scratch = Scratch(docs.sparkSession)
    block = block_of(window)
    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    chunks = scratch.write(_chunks(source), "chunks")
    cores = docs.sparkSession.sparkContext.defaultParallelism
    total = chunks.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(cores, -(-total // ENTRIES_PER_BUCKET))
    anchors = scratch.write(_per_chunk(_anchors(_grams(chunks, block, buckets)), "anchors"), "anchors")
    near = chunks.join(anchors, "chunk", "left")
    windows = _windows(near, window, block, buckets, buckets)
    earlier = scratch.write(_per_chunk(_earlier(windows), "earlier"), "earlier")
    found = _cut(near.join(earlier, "chunk", "left"), window, block, buckets, buckets)
    return found.withColumnRenamed("id", id)


def _per_chunk(bits: DataFrame, name: str) -> DataFrame:
    """The answers to a chunk in a row: a bit for each of its distinct hashes."""
    return bits.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))
