"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes ratios.

Each text is the set of its character n-grams, hashed into buckets. A bucket's naive Bayes
log-count ratio ``r`` compares how often it occurs in toxic and in other texts; the linear
model is a logistic regression on the features ``r`` of the buckets present. The score is
its probability, with the intercept moved from the balanced sample to the share of toxic
rows among all labelled ones.

Nulls: a null text counts as empty and gets the probability of no features. Labels that
are null, not 0 or 1, or both for one id are not used. Without labels of both kinds every
score is that share of label 1. Texts are read whole at any length. Repeated rows are scored
alike; an id on several rows trains once. An empty table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove.llm.common import first_of_each, held_out, table
from callgrove.llm.labelled import Row, balanced_sample, fitted, kept_rows, labels_of, scored
from callgrove.llm.ngrams import char_ngrams

BUCKETS = 1 << 18
SIZES = (3, 4, 5)
THRESHOLD = 0.7
#: Bound of the labelled sample: rows of either label that the fit takes.
PER_CLASS = 2500
FOLDS, HELD_OUT = 3, 1


def features(text: str) -> np.ndarray:
    """Distinct n-gram buckets of a text."""
    return first_of_each(char_ngrams(text, SIZES, BUCKETS), _stamps())


_scratch: list[np.ndarray] = []


def _stamps() -> np.ndarray:
    if not _scratch:
        _scratch.append(np.zeros(BUCKETS, np.int64))
    return _scratch[0]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        z = self.bias + float(self.weights[features(text)].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit_rows(rows: list[Row], share: float, epochs: int = 12) -> Model:
    """Log-count ratios, then AdaGrad steps of the regression on the scaled features."""
    y = np.array([label for label, _, _ in rows])
    if len(rows) == 0 or y.min() == y.max():
        bounded = min(max(share, 1e-4), 1 - 1e-4)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(bounded / (1 - bounded))))
    counts = np.zeros((2, BUCKETS))
    for label, found, _ in rows:
        counts[label, found] += 1
    smoothed = counts + 0.5
    smoothed /= smoothed.sum(axis=1, keepdims=True)
    # Buckets seen in a single text say nothing about others.
    ratio = np.where(counts.sum(axis=0) > 1, np.log(smoothed[1] / smoothed[0]), 0).astype(np.float32)
    weights = np.zeros(BUCKETS, np.float32)
    squares = np.full(BUCKETS, 1e-2, np.float32)
    bias, bias_square = 0.0, 1e-2
    order = np.random.default_rng(7)
    cost = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            label, found, _ = rows[i]
            scale = ratio[found]
            z = bias + float((weights[found] * scale).sum(dtype=np.float64))
            error = cost[i] * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label)
            gradient = error * scale + 1e-5 * weights[found]
            squares[found] += gradient * gradient
            weights[found] -= 0.1 * gradient / np.sqrt(squares[found])
            bias_square += error * error
            bias -= 0.1 * error / np.sqrt(bias_square)
    bounded = min(max(share, 1e-4), 1 - 1e-4)
    return Model(weights * ratio, float(bias + np.log(bounded / (1 - bounded))))


def fit(spark: SparkSession, sf_dir: str, per_class: int = PER_CLASS) -> Model:
    labels = labels_of(spark, sf_dir, "toxic", FOLDS, HELD_OUT)
    sample, share = balanced_sample(labels, per_class)
    docs = table(spark, sf_dir, "documents")
    return fitted(docs, sample, features, lambda rows: fit_rows(rows, share))


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return scored(docs, lambda text: shared.value.score(text))


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose score is below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return kept_rows(docs, lambda text: shared.value.score(text), lambda score: score < threshold)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity_scores(table(spark, sf_dir, "documents"), fit(spark, sf_dir))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
