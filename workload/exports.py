"""Text reports written from a profile collection, as input for the bulk loaders.

Every report is a folder ``.../experiment_id=N`` of part files, so no report passes
through a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove import Profile
from callgrove.functions.columns import call_path, path_class
from callgrove.operators.inspection import node_values
from callgrove.operators.stats import flat_profile
from callgrove.plans.lineage import scratch_folder


def new_folder(spark: SparkSession, name: str) -> str:
    return scratch_folder(spark, name)


def _csv(rows: DataFrame, folder: str) -> str:
    rows.write.partitionBy("experiment_id").option("header", True).csv(folder)
    return folder


def _text(rows: DataFrame, folder: str) -> str:
    """Write ``experiment_id, key, line`` in the order of the array ``key``."""
    ordered = rows.repartitionByRange("experiment_id", "key").sortWithinPartitions(
        "experiment_id", "key"
    )
    ordered.select("experiment_id", "line").write.partitionBy("experiment_id").text(folder)
    return folder


def stat_reports(profile: Profile, folder: str) -> str:
    stats = profile.stat(("time", "visits"))
    return _csv(
        stats.select(
            "experiment_id",
            F.col("metric").alias("cube::Metric"),
            F.col("routine").alias("Routine"),
            F.col("count").alias("Count"),
            F.col("sum").alias("Sum"),
            F.col("mean").alias("Mean"),
            F.col("variance").alias("Variance"),
            F.col("minimum").alias("Minimum"),
            F.col("maximum").alias("Maximum"),
        ),
        folder,
    )


def flat_reports(profile: Profile, folder: str) -> str:
    """Flat profiles of all routines."""
    rows = flat_profile(profile, None)
    return _csv(
        rows.select(
            "experiment_id",
            F.col("routine").alias("cube::Region"),
            F.col("count").alias("Number of Calls"),
            F.col("sum").alias("Exclusive Time"),
        ),
        folder,
    )


def dump_reports(profile: Profile, folder: str) -> str:
    """Wide per-thread dumps of all three metrics."""
    wide = (
        profile.facts.groupBy("experiment_id", "cnode_id", "thread_id")
        .pivot("metric", ["time", "visits", "bytes"])
        .agg(F.sum("value"))
    )
    return _csv(
        wide.select(
            "experiment_id",
            F.col("cnode_id").alias("Cnode ID"),
            F.col("thread_id").alias(" Thread ID"),
            "time",
            "visits",
            "bytes",
        ),
        folder,
    )


def basic_reports(profile: Profile, folder: str) -> str:
    fields = profile.info_basic()
    lines = F.array(
        F.concat(F.lit("Number of nodes    : "), "nodes"),
        F.lit("Processes per node : 0"),
        F.concat(F.lit("Number of processes: "), "processes"),
        F.concat(F.lit("Wallclock time     : "), F.col("wallclock_time").cast("string")),
    )
    rows = fields.select("experiment_id", F.posexplode(lines).alias("_at", "line"))
    return _text(rows.withColumn("key", F.array("_at")), folder)


def tree_reports(profile: Profile, folder: str) -> str:
    nodes = node_values(profile, "time", inclusive=True)
    line = F.concat(
        F.lit("|  "),
        F.col("value").cast("string"),
        F.lit(" |"),
        F.repeat(F.lit("  |"), F.col("depth").cast("int")),
        F.lit("  * "),
        "region_name",
    )
    top = profile.experiments.select(
        "experiment_id",
        F.array().cast("array<bigint>").alias("key"),
        F.lit("|            Time | Diff-Calltree").alias("line"),
    )
    body = nodes.select("experiment_id", F.col("ids").alias("key"), line.alias("line"))
    return _text(top.unionByName(body), folder)


def calltree_reports(profile: Profile, folder: str) -> str:
    nodes = node_values(profile, "time", inclusive=True)
    cls = path_class(F.col("path_class"), F.col("region_name"))
    line = F.concat(
        F.col("value").cast("string"),
        F.lit(" ("),
        F.col("pct").cast("string"),
        F.lit("%)   "),
        F.repeat(F.lit("| "), F.col("depth").cast("int")),
        F.lit("+ "),
        "region_name",
        F.lit("      "),
        call_path(cls, F.col("names")),
    )
    top = profile.experiments.select(
        "experiment_id",
        F.array().cast("array<bigint>").alias("key"),
        F.lit("Reading profile... done.").alias("line"),
    )
    body = nodes.select("experiment_id", F.col("ids").alias("key"), line.alias("line"))
    return _text(top.unionByName(body), folder)
