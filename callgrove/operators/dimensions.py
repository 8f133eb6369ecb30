"""Scans of the three dimensions and summaries of their shape."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from callgrove.profile import Profile


def metric_tree(profile: Profile) -> DataFrame:
    """One row per metric, parents before children."""
    return profile.metrics.orderBy("experiment_id", "ord").select(
        "experiment_id",
        F.col("metric").alias("name"),
        "display_name",
        "dtype",
        "uom",
        "description",
    )


def system_tree(profile: Profile) -> DataFrame:
    """One row per thread location, in thread order."""
    return profile.locations.orderBy("experiment_id", "thread_id").select(
        "experiment_id", "thread_id", "machine", "node", "process", "thread"
    )


def cnode_tree(profile: Profile) -> DataFrame:
    """One row per call-tree node with its parent and depth."""
    return profile.tree.orderBy("experiment_id", "cnode_id").select(
        "experiment_id",
        "cnode_id",
        "region_name",
        F.coalesce("file", F.lit("")).alias("file"),
        F.coalesce("line", F.lit(0).cast("long")).alias("line"),
        "parent_id",
        "depth",
    )


def layout_summary(profile: Profile) -> DataFrame:
    """Distinct processes and thread names per compute node."""
    return (
        profile.locations.groupBy("experiment_id", "machine", "node")
        .agg(
            F.count_distinct("process").alias("processes"),
            F.count_distinct("thread").alias("threads"),
        )
        .orderBy("experiment_id", "machine", "node")
    )


def layout_sketches(profile: Profile) -> DataFrame:
    """Sketches of the process and thread names of each compute node, for any later merge."""
    return profile.locations.groupBy("experiment_id", "machine", "node").agg(
        F.hll_sketch_agg("process").alias("processes"), F.hll_sketch_agg("thread").alias("threads")
    )


def layout_estimate(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Approximate distinct processes and thread names by ``keys``, over all that they leave out.

    Sketches merge, so names seen in many experiments count once without a look at the
    locations.  With the default size of 4096 registers an estimate is off by at most 3.3 %
    in 19 of 20 cases.
    """
    return sketches.groupBy(*keys).agg(
        *(
            F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name)
            for name in ("processes", "threads")
        )
    )


def tree_size(profile: Profile) -> DataFrame:
    """Number of call-tree nodes and the greatest depth per experiment."""
    return profile.tree.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("nodes"), F.max("depth").alias("max_depth")
    )


def region_names(profile: Profile, ids: DataFrame) -> DataFrame:
    """Add ``name`` to rows keyed by node; unknown ids show as their number."""
    names = profile.cnodes.select("experiment_id", "cnode_id", "region_name")
    return (
        ids.join(names, ["experiment_id", "cnode_id"], "left")
        .withColumn("name", F.coalesce("region_name", F.col("cnode_id").cast("string")))
        .drop("region_name")
    )
