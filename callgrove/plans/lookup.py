"""Joins of a large, possibly skewed side with a table of unique keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrove.plans.lineage import cut, cut_and_observe

#: Largest table that is sent to every executor.
BROADCAST_BYTES = 48 * 1024 * 1024


def measured_bytes(table: DataFrame, width: Column | int = 64) -> float:
    """Size of a table whose rows take ``width`` bytes."""
    row_bytes = F.lit(width) if isinstance(width, int) else width
    return table.agg(F.coalesce(F.sum(row_bytes.cast("double")), F.lit(0.0))).first()[0]


#: A key is heavy from this share of the rows on.
HEAVY_SHARE = 1 / 256
#: Buckets of key hashes whose rows are counted before any key is.
_BUCKETS = 8192


def heavy_keys(big: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that hold at least ``HEAVY_SHARE`` of the rows, with ``_ways``, the tasks for each.

    Rows are counted by buckets of key hashes, so what is shuffled does not grow with the
    number of keys.  A heavy key makes its bucket heavy; only the keys of such buckets, if
    there are any, are counted themselves.  At most 1 / ``HEAVY_SHARE`` keys come out.
    """
    bucket = F.pmod(F.xxhash64(*on), F.lit(_BUCKETS))
    full = big.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    counted, seen = cut_and_observe(full, rows=F.sum("_rows"))
    least = max(2.0, HEAVY_SHARE * (seen.get("rows") or 0))
    heavy = [row["_bucket"] for row in counted.where(F.col("_rows") >= least).collect()]
    ways = F.ceil(F.col("_rows") / least * 2).cast("int")
    counts = big.where(bucket.isin(heavy)).groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    return cut(counts.where(F.col("_rows") >= least).select(*on, ways.alias("_ways")))


def lookup(
    big: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    *,
    table_bytes: float,
    spread: Sequence[str],
    how: str = "inner",
    skewed: bool = True,
) -> DataFrame:
    """Join ``big`` with a table of known size.

    Up to ``BROADCAST_BYTES`` the table is broadcast and ``big`` is not moved.
    Beyond that both sides are shuffled on the keys.  Rows of a heavy key go to as many tasks
    as its share asks for, by a salt from the ``spread`` columns; only the table's rows of
    such keys are repeated.  They are looked for by a job of its own, except where the caller
    knows that ``big`` is not ``skewed``.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported lookup type: {how}")
    if table_bytes <= BROADCAST_BYTES:
        return big.join(F.broadcast(table), list(on), how)
    found = heavy_keys(big, on) if skewed else None
    if found is None or found.isEmpty():
        return big.join(table, list(on), how)
    heavy = F.broadcast(found)
    ways = F.coalesce("_ways", F.lit(1))
    salted_big = big.join(heavy, list(on), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread), ways).cast("int")
    )
    salted_table = (
        table.join(heavy, list(on), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), ways - 1)))
        .drop("_ways")
    )
    return salted_big.drop("_ways").join(salted_table, [*on, "_salt"], how).drop("_salt")
