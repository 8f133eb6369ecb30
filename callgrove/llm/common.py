"""Tables, stored intermediates and small numpy helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove.plans.lineage import scratch_folder

#: White space that separates words: the six ASCII characters.
WHITE_SPACE = " \t\n\x0b\x0c\r"


def code_on_workers(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package; clusters ship it."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    code_on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back, lineage cut."""
    spark = df.sparkSession
    path = scratch_folder(spark, "llm")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Words of a text, separated by ASCII white space; a null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), lambda word: word != "")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def in_batches(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that what is derived from long texts stays small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def mixed(values: np.ndarray) -> np.ndarray:
    """Finalize 64-bit hashes so that every bit depends on all of the input."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def first_of_each(values: np.ndarray, stamps: np.ndarray) -> np.ndarray:
    """Distinct ``values`` in linear time; ``stamps`` is scratch indexed by value."""
    order = np.arange(len(values), dtype=stamps.dtype)
    stamps[values] = order
    return values[stamps[values] == order]
