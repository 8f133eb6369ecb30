"""Corpus pipeline: quality, toxicity, near duplicates, packing.

Every stage takes the documents that its predecessor kept. All but the last return the
columns of documents; the last returns the pieces of the packed sequences. The classifiers
learn from the labels of the whole documents table, whatever earlier stages removed.

Nulls: a null text counts as empty in every stage; a null ``doc_id`` stays null, and of a
group of near copies it is kept only if no other has an id. Empty texts are scored like
others; texts without words share one fingerprint, so one of them stays. Texts are read
whole at any length. Ties and repeated rows: equal texts get equal scores, so the first two
stages keep or drop them together; of a group of near copies the smallest id stays, of equal
ids the text with the smallest hash, and rows equal in both count once. An empty table gives
no rows. Other columns are passed through all stages but the last, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from callgrove.llm import packing, quality, simhash, toxicity
from callgrove.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A quality score below this rejects. Lower than the query's threshold for label 1:
#: between the two lie mostly short clean texts, which have to stay.
QUALITY_REJECT = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.of_quality(docs, quality.fit(spark, sf_dir), QUALITY_REJECT)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return toxicity.without_toxic(docs, toxicity.fit(spark, sf_dir))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of 3-word shingles link at 3 or fewer bits."""
    return simhash.one_of_each(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return packing.packed(docs, with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: The stages are learned models, a similarity join with components, and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs)
    return docs
