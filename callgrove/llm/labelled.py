"""Labelled documents for training, and scoring of whole texts in Arrow batches."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove.llm.common import held_out, table


def labels_of(
    spark: SparkSession, sf_dir: str, label: str, modulus: int, remainder: int
) -> DataFrame:
    """(doc_id, y) of rows outside the held-out fold; ids with both labels are left out."""
    rows = table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("y"))
    rows = rows.where("doc_id is not null and y in (0, 1)").where(
        ~held_out(F.col("doc_id"), modulus, remainder)
    )
    return (
        rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("_top")).where("y = _top")
        .select("doc_id", "y")
    )


def balanced_sample(labels: DataFrame, per_class: int) -> tuple[DataFrame, float]:
    """At most ``per_class`` rows of each label, by hash order, and the share of label 1.

    The share covers all labelled rows. The sample is bounded, so joins may broadcast it.
    """
    counts = {row["y"]: row["n"] for row in labels.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [labels.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    return chosen[0].unionByName(chosen[1]), share


Row = tuple[int, np.ndarray, np.ndarray]


def counted(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and how often each occurs."""
    found, times = np.unique(features, return_counts=True)
    return found.astype(np.int32), times.astype(np.int32)


def fitted(
    docs: DataFrame,
    sample: DataFrame,
    featurize: Callable[[str], np.ndarray],
    fit_rows: Callable[[list[Row]], Any],
) -> Any:
    """Model of the sampled documents, learned in one task; the driver gets the model alone.

    An id that is on several rows counts once, with the least of its texts. Tasks turn texts
    into counted features; one task takes all of them in the order of their ids, which the
    sample bounds.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found, times = counted(featurize(batch.column("text")[i].as_py() or ""))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, 1), batch.column("y").slice(i, 1),
                        pa.array([found.tobytes()], pa.binary()), pa.array([times.tobytes()], pa.binary()),
                    ],
                    ["doc_id", "y", "found", "times"],
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (int(y), np.frombuffer(found, np.int32), np.frombuffer(times, np.int32))
            for batch in batches
            for y, found, times in zip(*(batch.column(c).to_pylist() for c in ("y", "found", "times")), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_rows(rows))], pa.binary())], ["model"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    once = joined.groupBy("doc_id").agg(F.min("y").cast("int").alias("y"), F.min("text").alias("text"))
    rows = once.mapInArrow(count, f"doc_id {kind}, y int, found binary, times binary")
    models = rows.repartition(1).sortWithinPartitions("doc_id").mapInArrow(learn, "model binary").collect()
    return pickle.loads(models[0]["model"]) if models else fit_rows([])


def scored(docs: DataFrame, score: Callable[[str], float]) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, score), whole texts, nulls as empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [score(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values, pa.float64())], ["doc_id", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def kept_rows(docs: DataFrame, score: Callable[[str], float], keep: Callable[[float], bool]) -> DataFrame:
    """Rows of ``docs`` whose text's score passes ``keep``; all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([keep(score(text.as_py() or "")) for text in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
