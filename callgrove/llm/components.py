"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callgrove.plans.lineage import cut, cut_and_observe

_MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v), root the smallest node reachable.

    Each round keeps the components and brings their edges nearer to stars, in a number
    of rounds about logarithmic in their diameter. Minima are taken by a partial
    aggregation; only edges are joined with them, so a hub is one row on one side of a
    join whose other side adaptive execution may split.
    """
    current = cut(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    signature = None
    for _ in range(_MAX_ROUNDS):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = (
            both.where("v > u").join(lowest, "u")
            .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        )
        large = cut(large)
        lows = large.groupBy("u").agg(F.min("v").alias("low"))
        joined = large.join(lows, "u")
        small = (
            joined.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(lows.select("u", F.col("low").alias("v")))
            .where("u <> v").distinct()
        )
        current, seen = cut_and_observe(
            small,
            n=F.count(F.lit(1)),
            h=F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
        )
        if (seen["n"], seen["h"]) == signature:
            break
        signature = (seen["n"], seen["h"])
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
