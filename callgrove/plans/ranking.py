"""Row numbers and top-k per group without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callgrove.plans.lineage import cut

#: Up to this k Spark trims every group on the map side of the shuffle
#: (``spark.sql.optimizer.windowGroupLimitThreshold``).
_TRIMMED_K = 1000


def number_rows(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """Add ``name``, the 0-based position of each row in its group.

    Rows are range-partitioned on group and order, so a large group spans many
    partitions.  Positions are counted per partition and shifted by the rows of the
    same group in earlier partitions.  Only a group that continues into a partition
    needs a shift, hence there are at most as many shifts as partitions.
    """
    keys = [F.col(g) for g in groups]
    ranged = cut(
        df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    )
    within = Window.partitionBy("_range", *groups)
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = (
        ranged.groupBy("_range", *groups)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_shift", F.sum("_rows").over(before))
        .where(F.col("_shift") > 0)
        .select("_range", *groups, "_shift")
    )
    local = ranged.withColumn(name, F.row_number().over(within.orderBy(*order)) - F.lit(1))
    return (
        local.join(F.broadcast(shifts), ["_range", *groups], "left")
        .withColumn(name, F.col(name) + F.coalesce("_shift", F.lit(0)).cast("long"))
        .drop("_range", "_shift")
    )


def running_sum(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], value: str, name: str
) -> DataFrame:
    """Add ``name``, the sum of ``value`` over the rows of the group up to and with this one.

    Works like :func:`number_rows`: sums per partition, shifted by those of the same group in
    earlier partitions; ``order`` must leave no ties.
    """
    keys = [F.col(g) for g in groups]
    ranged = cut(
        df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    )
    within = Window.partitionBy("_range", *groups).orderBy(*order)
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = (
        ranged.groupBy("_range", *groups)
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_shift", F.sum("_sum").over(before))
        .where(F.col("_shift").isNotNull())
        .select("_range", *groups, "_shift")
    )
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn(name, F.coalesce(F.sum(value).over(upto), F.lit(0.0)))
    return (
        local.join(F.broadcast(shifts), ["_range", *groups], "left")
        .withColumn(name, F.col(name) + F.coalesce("_shift", F.lit(0.0)))
        .drop("_range", "_shift")
    )


def top_k(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """Keep the first ``k`` rows of every group; ``order`` must leave no ties."""
    if k <= _TRIMMED_K:
        rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
        return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
    return number_rows(df, groups, order, "_rank").where(F.col("_rank") < k).drop("_rank")
