"""Quality scores from a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from linkrank.llm.common import held_out
from linkrank.llm.text_stats import COUNTS, derived

KEEP_FROM = 0.7  # scores from here on are predicted to be good
SHRINKAGE = 0.1  # share of the spherical covariance in every class covariance
CLIP = 30.0  # largest log-odds

# Features: logarithms of ratios, arcsine roots of shares (both even out the spread). A ratio to
# nothing is 0.
RATIOS = {
    "log_words": ("n_words", None),
    "log_lines": ("n_lines", None),
    "log_word_length": ("word_chars", "n_words"),
    "log_line_words": ("n_words", "n_lines"),
}
SHARES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "n_letters"),
    "digits": ("n_digits", "word_chars"),
    "alpha_words": ("n_alpha_words", "n_words"),
    "stutters": ("n_stutters", "n_words"),
    "distinct": ("n_distinct", "n_words"),
    "ends": ("n_ends", "word_chars"),
    "shouts": ("n_shouts", "word_chars"),
    "other": ("n_other", "word_chars"),
}
FEATURES = (*RATIOS, *SHARES)


def features_of(counts: np.ndarray) -> np.ndarray:
    """The features of rows of COUNTS; an empty text has zeros."""

    def ratio(part: str, whole: str | None) -> np.ndarray:
        below = np.ones(len(counts)) if whole is None else counts[:, COUNTS.index(whole)]
        return np.where(below > 0, counts[:, COUNTS.index(part)] / np.maximum(below, 1), 0.0)

    columns = [np.log1p(ratio(*pair)) for pair in RATIOS.values()]
    columns += [np.arcsin(np.sqrt(np.minimum(ratio(*pair), 1.0))) for pair in SHARES.values()]
    return np.stack(columns, axis=1)


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` and an array ``features``."""

    def lists(counts: np.ndarray) -> list[pa.Array]:
        x = features_of(counts)
        return [pa.array(list(x), pa.list_(pa.float64()))]

    return derived(docs, text, {"features": ArrayType(DoubleType())}, lists)


@dataclass(frozen=True)
class Discriminant:
    """Means and inverse Cholesky factors of both classes, in standardised features."""

    shift: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]
    offsets: tuple[float, ...]  # log prior - log determinant / 2

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of the good class; with one class or none learned, its share or 1/2."""
        if len(self.means) < 2:
            return np.full(len(features), self.offsets[0])
        x = (features - self.shift) / self.scale
        density = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets, strict=True):
            density.append(offset - 0.5 * np.square((x - mean) @ factor.T).sum(axis=1))
        return 1.0 / (1.0 + np.exp(-np.clip(density[1] - density[0], -CLIP, CLIP)))


def labelled(labels: DataFrame, id: str = "doc_id", label: str = "quality") -> DataFrame:
    """One label per id: the majority of its non-null ones, a tie counts as bad."""
    return (
        labels.where(F.col(label).isNotNull() & F.col(id).isNotNull())
        .groupBy(F.col(id).alias("label_id"))
        .agg((F.avg(F.when(F.col(label) == 1, 1.0).otherwise(0.0)) > 0.5).cast("int").alias("y"))
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    shrinkage: float = SHRINKAGE,
) -> Discriminant:
    """Learn from all labelled rows of ``docs`` that aren't held out; only these texts are counted.

    The class sums are one aggregate over them; nothing else reaches the driver.
    """
    p = len(FEATURES)
    known = docs.select(F.col(id).alias("label_id"), F.col(text).alias("text")).where(
        ~held_out("label_id")
    )
    # labels grow with the documents, so these are dealt by id at every size and probe the labels' hashes
    known = known.join(labelled(labels, id, label).hint("shuffle_hash"), "label_id").select("y", "text")
    known = with_features(known, "text")
    x = [F.col("features")[i] for i in range(p)]
    sums = [F.sum(x[i]) for i in range(p)]
    products = [F.sum(x[i] * x[j]) for i in range(p) for j in range(i, p)]
    found = {
        row[0]: (row[1], np.array(row[2 : 2 + p], "f8"), np.array(row[2 + p :], "f8"))
        for row in known.groupBy("y").agg(F.count(F.lit(1)), *sums, *products).collect()
    }
    if len(found) < 2:
        share = float(next(iter(found), 0.5))
        return Discriminant(np.zeros(p), np.ones(p), (), (), (share,))
    total = sum(n for n, _, _ in found.values())
    moments = {}
    for y, (n, s, upper) in found.items():
        square = np.zeros((p, p))
        square[np.triu_indices(p)] = upper
        square = square + np.triu(square, 1).T
        moments[y] = (n, s / n, square / n)
    shift = sum(n * m for n, m, _ in moments.values()) / total
    spread = sum(n * np.diag(q) for n, _, q in moments.values()) / total - shift**2
    scale = np.sqrt(np.where(spread > 1e-10, spread, 1.0))
    means, factors, offsets = [], [], []
    for y in (0, 1):
        n, mean, square = moments[y]
        cov = (square - np.outer(mean, mean)) / np.outer(scale, scale)
        sphere = max(np.trace(cov) / p, 1e-3) * np.eye(p)
        factor = np.linalg.cholesky((1 - shrinkage) * cov + shrinkage * sphere)
        means.append((mean - shift) / scale)
        factors.append(np.linalg.inv(factor))
        offsets.append(float(np.log(n / total) - np.log(np.diag(factor)).sum()))
    return Discriminant(shift, scale, tuple(means), tuple(factors), tuple(offsets))


def scored(docs: DataFrame, model: Discriminant, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``score`` instead of its text, or beside it."""

    def scores(counts: np.ndarray) -> list[pa.Array]:
        return [pa.array(model.score(features_of(counts)))]

    return derived(docs, text, {"score": "double"}, scores, keep_text)


def scored_documents(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The other columns of ``docs`` with ``score``. Texts are read twice, to learn and to score.

    Null and empty texts have the counts of a text without words, and are learned from and scored as
    such; texts are read whole. Repeated rows are scored alike, and each counts when learning; rows without an
    id are scored but not learned from. An empty table has no rows. A column ``score`` is replaced.
    """
    model = fit(docs, labels, id, text)
    return scored(docs, model, text)


def good_documents(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text scores at least ``keep_from``.

    Null and empty texts are scored like any other; repeated rows are all kept or all rejected. Without
    labels of both kinds there is nothing to tell them apart by: with good ones only, or none, all
    rows stay.
    """
    model = fit(docs, labels, id, text)
    if not model.means and model.offsets[0] >= 0.5:
        return docs
    others = [F.col(name) for name in docs.columns if name != text]
    rows = docs.select(F.struct(*others, F.lit(0)).alias("row"), F.col(text).alias("body"))
    good = scored(rows, model, "body", keep_text=True).where(F.col("score") >= keep_from)
    return good.select(
        *(F.col("body" if name == text else f"row.`{name}`").alias(name) for name in docs.columns)
    )
