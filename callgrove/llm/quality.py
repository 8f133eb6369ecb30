"""Quality by supervised subword embeddings.

Words and the character n-grams inside them are hashed into buckets, each with a learned
vector. A document is the mean of its vectors; a linear layer and a softmax give the
probability of label 1. Beside them two buckets stand for a word that repeats the one before
and for one that does not; they go beyond the plain method, as bad texts of repeated words
never seen are told by nothing else. Vectors and layer are trained together by stochastic gradient
descent in numpy. As the mean and the layer are linear, scoring sums one number a bucket.

Nulls: a null text counts as empty; a text without words has the zero vector. Labels that
are null, not 0 or 1, or both for one id are not used. Without labels of both kinds every
score is the share of label 1. Texts are read whole at any length. Repeated rows are scored
alike; an id on several rows trains once. An empty table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove.llm.common import held_out, table
from callgrove.llm.labelled import Row, balanced_sample, fitted, kept_rows, labels_of, scored
from callgrove.llm.ngrams import subwords

BUCKETS = 1 << 17
SIZES = (2, 3, 4)
WIDTH = 12
THRESHOLD = 0.7
#: Bound of the labelled sample: rows of either label that the fit takes.
PER_CLASS = 2000
FOLDS, HELD_OUT = 4, 2


def features(text: str) -> np.ndarray:
    return subwords(text, SIZES, BUCKETS)


@dataclass(frozen=True)
class Model:
    """``margins``: each bucket's vector times the difference of the two output rows."""

    margins: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        found = features(text)
        mean = float(self.margins[found].mean(dtype=np.float64)) if len(found) else 0.0
        return float(1 / (1 + np.exp(-np.clip(self.bias + mean, -40, 40))))


def fit_rows(rows: list[Row], share: float, epochs: int = 8, rate: float = 0.5) -> Model:
    y = np.array([label for label, _, _ in rows])
    bounded = min(max(share, 1e-4), 1 - 1e-4)
    if len(rows) == 0 or y.min() == y.max():
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(bounded / (1 - bounded))))
    random = np.random.default_rng(11)
    vectors = ((random.random((BUCKETS, WIDTH), np.float32) - 0.5) / WIDTH).astype(np.float32)
    layer = np.zeros((2, WIDTH), np.float32)
    bias = np.zeros(2, np.float32)
    cost = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    parts_of = [(times / max(1, times.sum())).astype(np.float32) for _, _, times in rows]
    total, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            step = rate * (1 - done / total)
            done += 1
            found, parts = rows[i][1], parts_of[i]
            hidden = parts @ vectors[found]
            logits = layer @ hidden + bias
            softmax = np.exp(logits - logits.max())
            softmax /= softmax.sum()
            error = softmax.astype(np.float32)
            error[y[i]] -= 1
            error *= np.float32(cost[i])
            back = error @ layer
            layer -= step * np.outer(error, hidden)
            bias -= 0.1 * step * error
            # Steps of frequent buckets are as long as in an update for each occurrence.
            vectors[found] -= (step * 40 * parts)[:, None] * back
    difference = layer[1] - layer[0]
    moved = float(bias[1] - bias[0] + np.log(bounded / (1 - bounded)))
    return Model(vectors @ difference, moved)


def fit(spark: SparkSession, sf_dir: str, per_class: int = PER_CLASS) -> Model:
    labels = labels_of(spark, sf_dir, "quality", FOLDS, HELD_OUT)
    sample, share = balanced_sample(labels, per_class)
    docs = table(spark, sf_dir, "documents")
    return fitted(docs, sample, features, lambda rows: fit_rows(rows, share))


def quality_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return scored(docs, lambda text: shared.value.score(text))


def of_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose score reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return kept_rows(docs, lambda text: shared.value.score(text), lambda score: score >= threshold)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_scores(table(spark, sf_dir, "documents"), fit(spark, sf_dir))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
