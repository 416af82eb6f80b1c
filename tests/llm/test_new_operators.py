"""Prefix trie, substring removal and manifest against plain loops, on the given tables and on hard cases."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import plain  # noqa: E402

from linkrank.llm import merkle, queries, substrings, trie  # noqa: E402
from linkrank.llm.common import ascii_lower  # noqa: E402


def rows_of(spark, tables, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{tables}/{name}.parquet").select(*columns).collect()]


def ordered(rows):
    return sorted((tuple(row) for row in rows), key=repr)


# --- prefix trie ---

TURNS = "conv_id long, turn long, role string, text string"


def test_op11(spark, tables):
    rows = rows_of(spark, tables, "conversations", "conv_id", "turn", "role", "text")
    found = queries.op11_prefix_trie(spark, tables).collect()
    assert ordered(found) == ordered(plain.prefix_nodes(plain.rebuilt(rows)))


def trie_of(spark, convs):
    rows = [(key, k, *turn) for key, turns in convs.items() for k, turn in enumerate(turns)]
    frame = spark.createDataFrame(rows, TURNS)
    return ordered(trie.prefix_nodes(trie.turn_lists(frame)).collect())


def test_trie_of_bushy_conversations(spark):
    rng = random.Random(3)
    convs = {}
    for key in range(400):
        convs[key] = [(rng.choice("ab"), rng.choice(["", "x", "yé"])) for _ in range(rng.randint(1, 12))]
    for key in range(400, 520):  # copies of one conversation
        convs[key] = convs[7]
    assert trie_of(spark, convs) == ordered(plain.prefix_nodes(convs))


def test_trie_of_long_conversations(spark):
    """Every beginning of a long conversation is one of its own, and others leave it half-way."""
    long = [("u", f"t{k}") for k in range(150)]
    convs = {key: long[: key + 1] for key in range(150)}
    convs |= {1000 + key: [*long[: 17 * key], ("u", "other"), ("u", f"{key % 2}")] for key in range(9)}
    assert trie_of(spark, convs) == ordered(plain.prefix_nodes(convs))


def test_trie_nulls_ties_and_repeats(spark, tmp_path):
    rows = [(0, None, "u", "first"), (0, 1, None, None), (0, 2, "", ""), (5, 1, "u", "x"),
            (5, 1, "u", "x"), (None, 1, "u", "lost"), (-7, 3, "u", "x" * 100_000), (1, 1, "u", "only"),
            (4, 0, "u", "only"), (199, 0, "u", "only"), (2, 0, "u", "a"), (2, 0, "u", "a")]
    frame = spark.createDataFrame(rows, TURNS).withColumns(
        {name: F.lit("kept?") for name in ("conv", "turns", "n", "p1", "t1", "chars", "e", "least")}
    )
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    found = queries.op11_prefix_trie(spark, str(tmp_path)).collect()
    expected = plain.rebuilt([row for row in rows if row[0] != -7])
    expected[-7] = plain.rebuilt([(100, *row[1:]) for row in rows if row[0] == -7])[100]
    h = plain.zlib.crc32(b"-7") % 6
    expected[-7] = [("u", "x" * 100_000)][h:]  # -7 - -7 % 100 is 0 in SQL
    head = plain.rebuilt(rows)[0]
    expected[-7] = head[:h] + expected[-7]
    assert ordered(found) == ordered(plain.prefix_nodes(expected))
    assert any(row.depth == 0 and row.parent_conv_id is None for row in found)
    assert trie.prefix_nodes(trie.turn_lists(frame.limit(0))).count() == 0


def test_two_fattest(spark):
    for low, high in [(0, 1), (0, 5), (4, 7), (5, 7), (6, 7), (7, 8), (0, 398), (256, 398)]:
        best = max(range(low + 1, high + 1), key=lambda f: f & -f)
        assert spark.range(1).selectExpr(trie._two_fattest(str(low), str(high))).first()[0] == best


# --- substrings ---


def test_op12(spark, tables):
    rows = rows_of(spark, tables, "documents", "doc_id", "text")
    expected = [(i, n, gone, plain.sha256(text)) for i, n, gone, text in plain.without_repeats(rows)]
    assert ordered(queries.op12_substrings(spark, tables).collect()) == ordered(expected)


def repeats_of(spark, rows, **kwargs):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return substrings.without_repeats(frame, **kwargs)


@pytest.mark.parametrize("window", [2, 5, 8])
def test_windows_of_a_small_vocabulary(spark, window, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 200)
    rng = random.Random(window)
    rows = []
    for key in range(120):
        words = [rng.choice(["a", "b", "é", "dd"]) for _ in range(rng.randint(0, 30))]
        rows.append((rng.choice([key, key, key // 2, None]), rng.choice([" ", "\n", " \t"]).join(words)))
    found = [(r.doc_id, r.n_words, r.n_removed, r.text) for r in repeats_of(spark, rows, window=window).collect()]
    assert ordered(found) == ordered(plain.without_repeats(rows, window))


def test_passages_anywhere_in_large_groups(spark, monkeypatch):
    """A passage that most documents share, at any place in each, and copies of whole documents."""
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 4000)
    rng = random.Random(1)

    def words(n):
        return [f"w{rng.randint(0, 5000)}" for _ in range(n)]

    passage, short = words(40), words(12)
    rows = []
    for key in range(300):
        own = words(rng.randint(0, 40))
        rows.append((key, " ".join(own[: key % 9] + (passage if key % 3 else short) + own[key % 9 :])))
    rows += [(1000 + key, rows[5][1]) for key in range(200)]
    rng.shuffle(rows)
    found = [(r.doc_id, r.n_words, r.n_removed, r.text) for r in repeats_of(spark, rows).collect()]
    assert ordered(found) == ordered(plain.without_repeats(rows))


def test_substrings_nulls_long_texts_and_repeats(spark):
    long = " ".join(f"word{k % 70_000}" for k in range(140_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, long), (5, "x " + long), (5, "x " + long), (None, long),
            (6, "no repeat here"), (7, "y" * 300_000), (7, None), (8, "a\x00b   c\x1cd " * 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {name: F.lit("kept?") for name in ("id", "chunk", "n_words", "spans", "bits", "data")}
    )
    found = substrings.without_repeats(frame).collect()
    assert ordered((r.doc_id, r.n_words, r.n_removed, r.text) for r in found) == ordered(plain.without_repeats(rows))
    for row in found:
        assert sum(s.end - s.start for s in row.spans) == row.n_removed
    assert substrings.without_repeats(frame.limit(0)).count() == 0


# --- manifest ---

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def lowered(frame):
    touched = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return F.when(touched, ascii_lower(F.col("text"))).otherwise(F.col("text"))


def test_op13(spark, tables):
    rows = rows_of(spark, tables, "documents", *merkle.COLUMNS)
    found = queries.op13_manifest(spark, tables).collect()
    assert ordered(found) == ordered(plain.manifest(rows))
    assert {row.verified for row in found} == {True, False}


def test_manifest_of_several_tiers(spark):
    """One source of more than a superblock of superblocks, and more sources than a superblock has."""
    rows = [(k, "hot", None, None, f"T{k}") for k in range(4500)]
    rows += [(k, f"s{k:03}", "en", k, None) for k in range(290)]
    frame = spark.createDataFrame(rows, DOCS)
    found = merkle.manifest(frame, suspect={"text": lowered(frame)}, height=1)
    assert ordered(found.collect()) == ordered(plain.manifest(rows))


def test_manifest_nulls_long_texts_and_repeats(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "", "", 0, ""),
            (2, "é", "de", -5, "Ä" * 300_000), (2, "é", "de", -5, "other"), (7, "zz", None, 3, "A:b-")]
    rows += [(9, "many", "en", 1, "Same")] * 40
    frame = spark.createDataFrame(rows, DOCS)
    wide = frame.withColumns({name: F.lit("kept?") for name in ("g", "id", "leaf", "rank", "n", "digest", "found")})
    found = merkle.manifest(wide, suspect={"text": lowered(wide)}).collect()
    assert ordered(found) == ordered(plain.manifest(rows))
    one = spark.createDataFrame(rows[:1], DOCS)
    assert ordered(merkle.manifest(one).collect()) == ordered(plain.manifest(rows[:1]))
    proofs = merkle.manifest(frame, with_proofs=True).collect()
    assert all(plain.sha256("".join(p.before + p.after for p in r.proof)) == r.proof_sha256 for r in proofs)
    assert merkle.manifest(frame.limit(0)).count() == 0
