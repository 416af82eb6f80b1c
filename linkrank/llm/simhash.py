"""Near-duplicate groups from SimHash fingerprints, linked through anchor points.

Fingerprints that differ in at most 3 bits differ in at most 1 bit in one of two disjoint
31-bit halves. The anchors of a half are the words of the [31, 26] Hamming code: every half is
within distance 1 of exactly one anchor (covering radius 1), its home. A half within distance 1
of another is within radius plus threshold, 2, of that one's home; there are at most 16 anchors
that near. So a fingerprint is copied to those, and compared there with the ones at home.

Where very many are at home at one anchor, the bits outside the half are cut into four blocks. Three bits that
differ leave one block equal, so there only those are compared that share a block as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import LOWER, UPPER, free_name, pieces
from linkrank.llm.components import star_labels
from linkrank.plans import Scratch, heaviest, salted_join

BITS = 3  # fingerprints that differ in no more bits are linked
SHINGLE = 3
HALF = 31
CROWD = 4_096  # fingerprints at home at an anchor from which they meet by blocks of their other bits, too
BLOCKS = BITS + 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TO_LOWER = str.maketrans(UPPER, LOWER)
SEED = 42
HASHES_AT_ONCE = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles as an unsigned number; 0 without words."""
    words = WORD.findall((text or "").translate(TO_LOWER))
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [" ".join(words)]
    else:
        shingles = map(" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), "<u8")
    ones = np.zeros(64, "i8")
    for start in range(0, len(hashes), HASHES_AT_ONCE):
        some = hashes[start : start + HASHES_AT_ONCE].view("u1").reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > len(hashes)).tolist())


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The other columns of ``docs`` with ``fingerprint`` (a long with these 64 bits)."""
    kept = [name for name in docs.columns if name not in (text, "fingerprint")]
    content = free_name(kept, "text")
    source = docs.select(*kept, F.col(text).alias(content))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = [fingerprint(x, shingle) for x in part.column(content).to_pylist()]
                arrays = [part.column(name) for name in kept]
                arrays.append(pa.array(np.array(found, "u8").view("i8")))
                yield pa.RecordBatch.from_arrays(arrays, [*kept, "fingerprint"])

    return source.mapInArrow(fold, source.select(*kept).schema.add("fingerprint", "long"))


def _half(which: int) -> Column:
    return F.shiftright("u", HALF * which).bitwiseAND(F.lit((1 << HALF) - 1))


def _syndrome(half: Column) -> Column:
    """0 for an anchor, else the place (from 1) of the bit to flip for the one at distance 1."""
    bits = []
    for k in range(5):
        mask = sum(1 << place - 1 for place in range(1, HALF + 1) if place >> k & 1)
        odd = F.bit_count(half.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1))
        bits.append(F.shiftleft(odd, k))
    return sum(bits[1:], bits[0])


def anchored(codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``side, anchor, u`` for the home anchors and for all anchors within distance 2."""
    sides = F.explode(
        F.array(*(F.struct(F.lit(k).alias("side"), _half(k).alias("half")) for k in (0, 1)))
    )
    halves = (
        codes.select("u", sides.alias("x"))
        .select("u", "x.side", "x.half")
        .withColumn("flip", _syndrome(F.col("half")))
    )
    home = F.expr("IF(flip = 0, half, half ^ shiftleft(1L, flip - 1))")
    pairs = F.expr(
        "transform(filter(sequence(1, 31), i -> i < (i ^ flip)),"
        " i -> half ^ shiftleft(1L, i - 1) ^ shiftleft(1L, (i ^ flip) - 1))"
    )
    near = F.expr("flip <> 0")
    homes = halves.select("side", home.alias("anchor"), "u")
    copies = halves.select(
        "side",
        F.explode(F.when(near, F.concat(F.array(home), pairs)).otherwise(F.array(home))).alias(
            "anchor"
        ),
        F.col("u").alias("v"),
    )
    return homes, copies


def crowds(codes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``side, anchor`` where ``crowd`` fingerprints or more are at home: at most one for that many of a side."""
    homes, _ = anchored(codes)
    return homes.groupBy("side", "anchor").count().where(F.col("count") >= crowd).drop("count")


def _other_bits(side: int) -> list[int]:
    """Masks of the blocks of the bits that do not belong to the half of this side."""
    places = [k for k in range(64) if not HALF * side <= k < HALF * (side + 1)]
    masks = []
    for block in range(BLOCKS):
        part = places[block * len(places) // BLOCKS : (block + 1) * len(places) // BLOCKS]
        mask = sum(1 << k for k in part)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _in_blocks(rows: DataFrame, crowded: DataFrame, code: str) -> DataFrame:
    """The rows with ``block, value``: one for each block at a crowded anchor, else a single one."""
    masks = [f"array({', '.join(f'{m}L' for m in _other_bits(side))})" for side in (0, 1)]
    blocks = (
        f"transform(IF(side = 0, {masks[0]}, {masks[1]}),"
        f" (m, k) -> named_struct('block', k, 'value', {code} & m))"
    )
    return (
        rows.join(crowded.withColumn("crowded", F.lit(True)), ["side", "anchor"], "left")
        .selectExpr(
            "side",
            "anchor",
            code,
            f"inline(IF(crowded IS NULL, array(named_struct('block', -1, 'value', 0L)), {blocks}))",
        )
    )


def links(codes: DataFrame, bits: int = BITS, crowded: DataFrame | None = None) -> DataFrame:
    """The pairs ``u, v`` of distinct fingerprints ``u`` that differ in at most ``bits`` (3) bits.

    A pair may come more than once. At the anchors of ``crowded`` (see :func:`crowds`) fingerprints meet by
    anchor and block, which loses no pair.
    """
    if bits > BITS:
        raise ValueError(f"anchors cover at most {BITS} differing bits")
    homes, copies = anchored(codes)
    keys = ["side", "anchor"]
    if crowded is not None:
        homes, copies = _in_blocks(homes, crowded, "u"), _in_blocks(copies, crowded, "v")
        keys += ["block", "value"]
    near = F.expr(f"u < v AND bit_count(u ^ v) <= {bits}")
    same = [homes[key] == copies[key] for key in keys]
    return homes.join(copies, [*same, near]).select("u", "v")


def simhash_groups(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    bits: int = BITS,
) -> DataFrame:
    """``id, text_hash, fingerprint, component, component_id`` for every row of ``docs``.

    Groups are the connected components of fingerprints that differ in at most ``bits`` bits, and
    are named by their smallest id. Rows with equal fingerprints are one vertex, so groups of
    exact copies of any size cost one comparison. Null and empty texts, and those without words, have
    fingerprint 0. A null id takes part, but names a group only if nothing else is in it. Repeated
    rows stay repeated; an empty table gives no rows. ``text_hash`` tells rows with one id apart, and
    ``component``, a fingerprint, the groups of rows with one id.
    """
    scratch = Scratch(docs.sparkSession)
    keyed = docs.select(
        F.col(id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )
    rows = scratch.write(fingerprints(keyed, "text", shingle), "fingerprints")
    classes = scratch.write(
        rows.groupBy(F.col("fingerprint").alias("u")).agg(
            F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")
        ),
        "classes",
    )
    codes = classes.select("u")
    crowded = scratch.write(crowds(codes), "crowds")
    pairs = links(codes, bits, None if crowded.isEmpty() else crowded)
    pairs = scratch.write(pairs, "links")
    return named_groups(scratch, rows, classes, pairs, id)


def named_groups(
    scratch: Scratch, rows: DataFrame, classes: DataFrame, pairs: DataFrame, id: str = "doc_id"
) -> DataFrame:
    """The result of :func:`simhash_groups` from the links ``u, v`` between fingerprints.

    ``rows`` has ``doc_id, text_hash, fingerprint``, and ``classes`` ``u, first, n``: the least id and
    the number of rows of each fingerprint.
    """
    labels = star_labels(scratch, pairs)
    linked = scratch.write(classes.join(labels, "u"), "linked")
    names = linked.groupBy("label").agg(
        F.min("first").alias("component_id"), F.count(F.lit(1)).alias("members")
    )
    giants = heaviest(names, "label", "members")
    named = (
        classes.join(linked.select("u"), "u", "left_anti")
        .select("u", F.col("u").alias("component"), F.col("first").alias("component_id"), "n")
        .unionByName(
            salted_join(linked, names.drop("members"), "label", giants).select(
                "u", F.col("label").alias("component"), "component_id", "n"
            )
        )
    )
    named = scratch.write(named.withColumnRenamed("u", "fingerprint"), "named")
    hot = heaviest(named, "fingerprint", "n")
    return salted_join(rows, named.drop("n"), "fingerprint", hot).select(
        F.col("doc_id").alias(id), "text_hash", "fingerprint", "component", "component_id"
    )


def without_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """One row of every group of :func:`simhash_groups`, unchanged: that with the smallest id.

    Of rows that share this id, the one with the smallest hash of its text stays, of equal rows any one. A row
    without an id stays only if its group has no id. Null and empty texts are one group. An empty
    table stays empty; columns may have any names. Equal rows are reduced to one before they meet.
    """
    key, hashed = free_name(docs.columns, "_key"), free_name(docs.columns, "_hash")
    groups = simhash_groups(docs, id, text, shingle, bits)
    first = F.struct(F.col(id).isNotNull().alias("known"), F.col(id).alias("id"), "text_hash")
    chosen = (
        groups.where(F.col(id).eqNullSafe(F.col("component_id")))
        .groupBy("component")
        .agg(F.min(first).alias("row"))
        .select(_row_key(F.col("row.id")).alias(key), F.col("row.text_hash").alias(hashed))
    )
    keyed = docs.withColumns({key: _row_key(F.col(id)), hashed: F.xxhash64(text)})
    one = keyed.groupBy(key, hashed).agg(F.first(F.struct(*docs.columns)).alias("row"))
    return one.join(chosen, [key, hashed], "left_semi").select("row.*")


def _row_key(id: Column) -> Column:
    """The id as text, whatever its type, and a text that no id has for null."""
    return F.coalesce(F.concat(F.lit("="), id.cast("string")), F.lit(""))
