"""The registered queries over whole tables, against SQL or plain loops."""

import glob
import math
import os
import sys
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import plain  # noqa: E402

from linkrank.llm import queries  # noqa: E402
from linkrank.llm.oracles import LLM_ORACLES  # noqa: E402


def rows_of(spark, tables, name, *columns):
    frame = spark.read.parquet(f"{tables}/{name}.parquet").select(*columns)
    return [tuple(row) for row in frame.collect()]


def comparable(value):
    return float(f"{value:.9g}") if isinstance(value, float) and math.isfinite(value) else value


@pytest.mark.parametrize("name", LLM_ORACLES)
def test_against_sql(spark, tables, name):
    database = duckdb.connect()
    for path in glob.glob(f"{tables}/*.parquet"):
        database.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    frame = queries.LLM_QUERIES[name](spark, tables)
    names = sorted(frame.columns)
    found = [tuple(comparable(row[n]) for n in names) for row in frame.collect()]
    sql = database.sql(LLM_ORACLES[name])
    assert sorted(sql.columns) == names
    places = [sql.columns.index(n) for n in names]
    expected = [tuple(comparable(row[p]) for p in places) for row in sql.fetchall()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert found


def test_op1(spark, tables):
    from tokenizers import Tokenizer

    found = queries.op1_packing(spark, tables).collect()
    pieces = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    docs = rows_of(spark, tables, "documents", "doc_id", "text")
    assert pieces == plain.packed(docs, Tokenizer.from_file(queries.tokenizer_path()))
    sequences = defaultdict(list)
    for row in found:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    lengths = [row.length for row in found]
    assert len(sequences) <= plain.first_fit_decreasing(lengths, 1024)
    assert len(sequences) <= 1.02 * -(-sum(lengths) // 1024) + 1


def test_op4(spark, tables):
    found = {row.doc_id: row for row in queries.op4_langid(spark, tables).collect()}
    langs = dict(rows_of(spark, tables, "documents", "doc_id", "lang"))
    assert found.keys() == langs.keys()
    assert all(row.held_out == plain.held_out(key) for key, row in found.items())
    assert all(0 <= row.score <= 1 for row in found.values())
    held = [key for key, row in found.items() if row.held_out]
    right = sum(found[key].lang_pred == langs[key] for key in held)
    assert right >= 0.95 * len(held)


def test_op6(spark, tables):
    docs = rows_of(spark, tables, "documents", "doc_id", "text")
    codes = [plain.fingerprint(text) for _, text in docs]
    ids = [doc_id for doc_id, _ in docs]
    groups = plain.fingerprint_groups(codes, ids)
    expected = sorted(zip(ids, (f"{code:016x}" for code in codes), groups, strict=True))
    assert sorted(tuple(row) for row in queries.op6_simhash(spark, tables).collect()) == expected


def test_op8(spark, tables):
    found = {row.doc_id: row for row in queries.op8_quality_classifier(spark, tables).collect()}
    labels = dict(rows_of(spark, tables, "labels", "doc_id", "quality"))
    assert len(found) == len(rows_of(spark, tables, "documents", "doc_id"))
    assert all(row.predicted == (row.score >= 0.7) for row in found.values())
    held = [key for key in labels if plain.held_out(key)]
    assert all(found[key].held_out for key in held)
    right = sum(found[key].predicted == labels[key] for key in held)
    assert right >= 0.93 * len(held)


def test_op9(spark, tables):
    vectors = rows_of(spark, tables, "embeddings", "vec_id", "embedding")
    ids = [i for i, _ in vectors]
    expected = plain.nearest(ids, [v for _, v in vectors], {i for i in ids if i % 50 == 0}, 5)
    found = defaultdict(list)
    for row in queries.op9_nearest(spark, tables).orderBy("query_id", "rank").collect():
        found[row.query_id].append((row.score, row.vec_id))
        assert row.rank == len(found[row.query_id])
    assert found.keys() == expected.keys()
    hits = 0
    for query, answers in expected.items():
        assert len(found[query]) == len(answers)
        least = answers[-1][0] - 1e-9
        hits += sum(score >= least for score, _ in found[query])
        assert sorted(found[query], key=lambda x: (-x[0], x[1])) == found[query]
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_op10(spark, tables):
    docs = rows_of(spark, tables, "documents", "doc_id", "text")
    spans = plain.all_secrets([text for _, text in docs])
    expected = []
    for (doc_id, _), found in zip(docs, spans, strict=True):
        base = [one for one in found if one[1] < 3]
        counts = [sum(kind == k for _, kind, _ in found) for k in (0, 1, 2)]
        expected.append((doc_id, *counts, plain.sha256(plain.digest(base)), plain.digest(found)))
    found = sorted(tuple(row) for row in queries.op10_secrets(spark, tables).collect())
    assert found == sorted(expected)
