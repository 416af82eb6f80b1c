"""The two classifiers again without Spark, from the same rows: equal scores."""

import math
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import plain  # noqa: E402

from linkrank.llm import langid, quality_classifier, queries  # noqa: E402


def test_op8_scores(spark, tables):
    """Class densities from covariances and determinants, without Cholesky factors or sums."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    x = {r.doc_id: np.array(r.features) for r in quality_classifier.with_features(docs).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{tables}/labels.parquet").collect()}
    known = [key for key in x if labels.get(key) is not None and not plain.held_out(key)]
    rows, y = np.array([x[key] for key in known]), np.array([labels[key] for key in known])
    scale = rows.std(axis=0)
    scale[rows.var(axis=0) <= 1e-10] = 1.0
    rows = rows / scale
    classes = []
    for kind in (0, 1):
        some = rows[y == kind]
        cov = np.cov(some, rowvar=False, bias=True)
        sphere = max(np.trace(cov) / len(scale), 1e-3) * np.eye(len(scale))
        cov = 0.9 * cov + 0.1 * sphere
        classes.append((some.mean(axis=0), cov, math.log(len(some) / len(rows))))

    def density(one, mean, cov, prior):
        far = one / scale - mean
        return prior - np.linalg.slogdet(cov)[1] / 2 - far @ np.linalg.solve(cov, far) / 2

    found = {r.doc_id: r.score for r in queries.op8_quality_classifier(spark, tables).collect()}
    assert found.keys() == x.keys()
    for key, one in x.items():
        odds = np.clip(density(one, *classes[1]) - density(one, *classes[0]), -30, 30)
        assert found[key] == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-7)


def test_op4_weights(spark, tables):
    """Document frequencies and regression steps one coordinate at a time."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs)
    rows = [r for r in docs.collect() if r.lang is not None and not plain.held_out(r.doc_id)]
    grams = {r.doc_id: langid.ngrams(r.text) for r in rows}
    df = np.zeros(langid.BUCKETS)
    for found, _ in grams.values():
        df[found] += 1
    idf = np.log((1 + len(rows)) / (1 + df)) + 1
    assert model.idf == pytest.approx(idf)
    named = [(r.doc_id, grams[r.doc_id][1].astype("<u4").tobytes(), r.lang) for r in rows]
    order = spark.createDataFrame(named, "id long, counts binary, lang string")
    order = [r.id for r in order.orderBy(F.xxhash64("id", "counts"), "id", "lang").collect()]
    languages = sorted({r.lang for r in rows})
    lang = {r.doc_id: languages.index(r.lang) for r in rows}
    examples = [key for key in order if len(grams[key][0])]
    z = [dict() for _ in languages]
    n = [dict() for _ in languages]

    def weight(k, j):
        at = z[k].get(j, 0.0)
        if abs(at) <= langid.L1:
            return 0.0
        below = (langid.BETA + math.sqrt(n[k].get(j, 0.0))) / langid.ALPHA + langid.L2
        return -(at - math.copysign(langid.L1, at)) / below

    for _ in range(langid.EPOCHS):
        for key in (key for k, key in enumerate(examples) if k % langid.CALIBRATE):
            found, counts = grams[key]
            x = langid.weighted(found, counts, idf)
            w = [[weight(k, j) for j in found.tolist()] for k in range(len(languages))]
            logits = [sum(a * b for a, b in zip(x.tolist(), one, strict=True)) for one in w]
            top = max(logits)
            whole = sum(math.exp(v - top) for v in logits)
            for k, logit in enumerate(logits):
                error = math.exp(logit - top) / whole - (lang[key] == k)
                for j, value, old in zip(found.tolist(), x.tolist(), w[k], strict=True):
                    g, before = error * value, n[k].get(j, 0.0)
                    z[k][j] = z[k].get(j, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / langid.ALPHA * old
                    n[k][j] = before + g * g
    expected = np.zeros((langid.BUCKETS, len(languages)))
    for k in range(len(languages)):
        for j in z[k]:
            expected[j, k] = weight(k, j)
    assert list(model.languages) == languages
    assert np.abs(model.weights - expected).max() < 1e-9
