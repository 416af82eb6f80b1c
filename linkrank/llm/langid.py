"""Language identification: sparse multinomial regression on TF-IDF character n-grams.

Document frequencies cover all learning rows. The weights are learned from a sample of them by
follow-the-regularised-leader steps with an L1 and an L2 penalty, and a temperature found on
rows that the weights haven't seen calibrates the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import free_name, held_out, pieces

BUCKETS = 1 << 15  # hashed n-grams of 1, 2 and 3 characters
SAMPLE = 4_000  # at most so many learning rows, spread evenly over the languages
LEAST = 20  # but so many of each language, if there are
EPOCHS = 3
ALPHA, BETA = 0.5, 1.0  # step sizes
L1, L2 = 0.02, 0.05  # elastic net
CALIBRATE = 5  # every so many-th sampled row is for the temperature
UNDETERMINED = "und"
CODES_AT_ONCE = 1 << 20


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Per code point its lower-case letter, or 0 for what is no letter."""
    table = np.zeros(0x110000, "u4")
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text's n-grams and how often each occurs; none without letters.

    Words are runs of letters in lower case; n-grams see their borders, but nothing else
    between them.
    """
    counts = np.zeros(BUCKETS, "i8")
    codes = letters()[np.frombuffer((text or "").encode("utf-32-le"), "<u4")]
    if not codes.any():
        return np.empty(0, "i8"), np.empty(0, "i8")
    codes = np.concatenate(([0], codes, [0])).astype("u4")
    inside = codes != 0
    codes = codes[inside | np.concatenate(([True], inside[:-1]))]
    for start in range(0, len(codes), CODES_AT_ONCE):
        part = codes[start : start + CODES_AT_ONCE + 2]
        last = start + CODES_AT_ONCE + 2 >= len(codes)
        one = part * np.uint32(0x9E3779B1)
        two = (one[:-1] + part[1:]) * np.uint32(0x85EBCA6B)
        three = (two[:-1] + part[2:]) * np.uint32(0xC2B2AE35)
        for grams in (one, two, three):
            grams = grams if last else grams[:CODES_AT_ONCE]
            counts += np.bincount(grams >> np.uint32(17), minlength=BUCKETS)
        if last:
            break
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages, mostly zero
    temperature: float

    def vector(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weighted(found, counts, self.idf)

    def predict(self, text: str | None) -> tuple[str, float]:
        found, counts = ngrams(text)
        if not len(found) or not self.languages:
            return UNDETERMINED, 0.0
        logits = self.vector(found, counts) @ self.weights[found]
        chance = softmax(logits / self.temperature)
        best = int(np.argmax(chance))
        return self.languages[best], float(chance[best])


def weighted(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length 1."""
    x = (1.0 + np.log(counts)) * idf[found]
    return x / max(np.linalg.norm(x), 1e-12)


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max())
    return powers / powers.sum()


def _gram_columns(rows: DataFrame, kept: list[str], text: str) -> DataFrame:
    """``kept`` and the sparse counts of each text as binary columns."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = [ngrams(x) for x in part.column(text).to_pylist()]
                arrays = [part.column(name) for name in kept]
                arrays.append(pa.array([a.astype("<u2").tobytes() for a, _ in found]))
                arrays.append(pa.array([b.astype("<u4").tobytes() for _, b in found]))
                yield pa.RecordBatch.from_arrays(arrays, [*kept, "found", "counts"])

    schema = rows.select(*kept).schema.add("found", "binary").add("counts", "binary")
    return rows.select(*kept, text).mapInArrow(grams, schema)


def document_frequencies(rows: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many of all rows each bucket occurs, and the number of rows with a letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, "i8"), 0
        for batch in batches:
            for part in pieces(batch):
                for x in part.column(0).to_pylist():
                    found, _ = ngrams(x)
                    total[found] += 1
                    n += len(found) > 0
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*used.tolist(), BUCKETS], pa.int64()),
             pa.array([*total[used].tolist(), n], pa.int64())], ["bucket", "n"],
        )

    sums = rows.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket")
    total = np.zeros(BUCKETS + 1, "i8")
    for bucket, n in sums.agg(F.sum("n")).collect():
        total[bucket] = n
    return total[:BUCKETS], int(total[BUCKETS])


def ftrl(
    examples: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int, epochs: int = EPOCHS
) -> np.ndarray:
    """Weights after passes over ``(buckets, values, language)`` in the given order."""
    z, n = np.zeros((BUCKETS, n_languages)), np.zeros((BUCKETS, n_languages))
    for _ in range(epochs):
        for found, x, language in examples:
            zs, ns = z[found], n[found]
            w = _weights(zs, ns)
            error = softmax(x @ w)
            error[language] -= 1.0
            gradient = np.outer(x, error)
            squares = ns + gradient**2
            z[found] = zs + gradient - (np.sqrt(squares) - np.sqrt(ns)) / ALPHA * w
            n[found] = squares
    return _weights(z, n)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def best_temperature(logits: np.ndarray, languages: np.ndarray) -> float:
    """The temperature with the least log-loss, on a grid from 1/20 to 20."""
    grid = np.geomspace(0.05, 20, 121)
    losses = []
    for temperature in grid:
        scaled = logits / temperature
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        picked = scaled[np.arange(len(languages)), languages]
        losses.append(np.mean(np.log(np.exp(scaled).sum(axis=1)) - picked))
    return float(grid[int(np.argmin(losses))])


def train(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
    sample: int = SAMPLE,
) -> LanguageModel:
    """Learn from rows that aren't held out and have a language.

    Document frequencies count all of them. The regression learns from at most about ``sample``
    rows (LEAST of each language), chosen by a hash of id and text, as many of each
    language as it has.
    """
    rows = docs.where(~held_out(id) & F.col(lang).isNotNull()).select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    per_language = {row[0]: row[1] for row in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(per_language))
    if not languages:
        return LanguageModel((), np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), 1.0)
    df, n = document_frequencies(rows, "text")
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    quota = max(LEAST, sample // len(languages))
    share = F.create_map(
        *(F.lit(x) for name in languages for x in (name, min(1.0, quota / per_language[name])))
    )
    chance = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40)) / float(1 << 40)
    drawn = rows.where(chance < share[F.col("lang")])
    place = {name: k for k, name in enumerate(languages)}
    # in an order that does not depend on the partitions, and so is what a bound leaves
    grams = _gram_columns(drawn, ["id", "lang"], "text").orderBy(
        F.xxhash64("id", "counts"), "id", "lang"
    ).limit(2 * quota * len(languages))
    examples = []
    for row in grams.collect():
        found, counts = np.frombuffer(row.found, "<u2").astype("i8"), np.frombuffer(row.counts, "<u4")
        if len(found):
            examples.append((found, weighted(found, counts, idf), place[row.lang]))
    learned = [one for k, one in enumerate(examples) if k % CALIBRATE] or examples
    held = examples[::CALIBRATE]
    weights = ftrl(learned, len(languages))
    temperature = 1.0
    if held:
        logits = np.array([x @ weights[found] for found, x, _ in held])
        temperature = best_temperature(logits, np.array([y for _, _, y in held]))
    return LanguageModel(languages, idf, weights, temperature)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` with ``lang_pred`` and ``score``.

    Null, empty and letterless texts get ``und`` and 0, as does everything if no language was
    learned. Ties go to the language that sorts first; repeated rows get equal predictions.
    """
    kept = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    content = free_name(kept, "text")
    source = docs.select(*kept, F.col(text).alias(content))
    schema = source.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = [model.predict(x) for x in part.column(content).to_pylist()]
                arrays = [part.column(name) for name in kept]
                arrays.append(pa.array([a for a, _ in found], pa.string()))
                arrays.append(pa.array([b for _, b in found], pa.float64()))
                yield pa.RecordBatch.from_arrays(arrays, [*kept, "lang_pred", "score"])

    return source.mapInArrow(apply, schema)
