"""A checked profile from loaded reports.

Dump reports hold the values, summary reports the wall-clock time and the size of the
system; a call tree and, if there are any, metrics and locations come as tables.  What fits
nowhere is not in the profile but among the rejects, with the number of values it had.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrove import model
from callgrove.plans.lineage import cut
from callgrove.plans.lookup import lookup, measured_bytes
from callgrove.profile import Profile

_CELL = ["experiment_id", "metric", "cnode_id", "thread_id"]


class Built(NamedTuple):
    """A profile, and what was left out: ``experiment_id, reason, values``."""

    profile: Profile
    rejects: DataFrame


def profile_from_reports(
    dumps: DataFrame,
    summaries: DataFrame,
    cnodes: DataFrame,
    *,
    metrics: DataFrame | None = None,
    locations: DataFrame | None = None,
) -> Built:
    """Combine rows of ``load_dump`` and ``load_basic`` with a call tree.

    A value is rejected where its cell is incomplete or given more than once, where its node
    is not in the tree of its experiment, and where its thread is not among the locations.
    Empty values of a dump are no values.  Experiments are those that have a dump; one
    without a summary has no wall-clock time.  A summary whose processes do not match the
    locations is rejected, and so is one without a dump.

    Without ``metrics`` each metric of a dump is described by its name alone, in the order of
    the names; without ``locations`` each thread of a dump is a location of its own.
    """
    complete = F.lit(True)
    for key in _CELL:
        complete = complete & F.col(key).isNotNull()
    given = dumps.where(F.col("value").isNotNull())
    cells = (
        given.groupBy(*_CELL)
        .agg(F.count(F.lit(1)).alias("_times"), F.min("value").alias("value"))
        .withColumn("_complete", complete)
    )
    nodes = cnodes.select("experiment_id", "cnode_id").distinct().withColumn("_node", F.lit(True))
    judged = lookup(
        cells,
        nodes,
        ["experiment_id", "cnode_id"],
        table_bytes=measured_bytes(nodes, 32),
        spread=["metric", "thread_id"],
        how="left",
        # Cells are unique here: a node has one for each metric and thread at most, and a tree
        # that is not broadcast has over a million nodes.  So the dumps are parsed once only.
        skewed=False,
    )
    if locations is not None:
        threads = locations.select("experiment_id", "thread_id").distinct()
        threads = threads.withColumn("_thread", F.lit(True))
        judged = lookup(
            judged,
            threads,
            ["experiment_id", "thread_id"],
            table_bytes=measured_bytes(threads, 32),
            spread=["metric", "cnode_id"],
            how="left",
        )
    else:
        judged = judged.withColumn("_thread", F.lit(True))
    reason = (
        F.when(~F.col("_complete"), F.lit("incomplete cell"))
        .when(F.col("_times") > 1, F.lit("value given more than once"))
        .when(F.col("_node").isNull(), F.lit("unknown call-tree node"))
        .when(F.col("_thread").isNull(), F.lit("unknown thread"))
    )
    judged = cut(judged.withColumn("reason", reason).select(*_CELL, "value", "_times", "reason"))
    facts = judged.where("reason is null").select([f.name for f in model.FACTS])
    lost = (
        judged.where("reason is not null")
        .groupBy("experiment_id", "reason")
        .agg(F.sum("_times").alias("values"))
    )

    measured = cut(
        given.where(F.col("experiment_id").isNotNull() & F.col("metric").isNotNull())
        .select("experiment_id", "metric")
        .distinct()
    )
    dumped = measured.select("experiment_id").distinct()
    if metrics is None:
        metrics = _plain_metrics(measured)
    if locations is None:
        locations = _plain_locations(facts)
    known = dumped.withColumn("_dumped", F.lit(True))
    places = (
        locations.groupBy("experiment_id")
        .agg(F.count_distinct(*_present("machine", "node", "process")).alias("_processes"))
        .join(known, "experiment_id", "right")
    )
    named = locations.where(F.col("process").isNotNull()).select("experiment_id").distinct()
    places = places.join(named.withColumn("_named", F.lit(True)), "experiment_id", "left")
    compared = summaries.select("experiment_id", "processes", "wallclock_time").join(
        places, "experiment_id", "left"
    )
    fault = F.when(F.col("_dumped").isNull(), F.lit("summary without a dump")).when(
        F.col("_named") & (F.col("processes") != F.col("_processes")),
        F.concat(
            F.lit("summary has "),
            F.col("processes").cast("string"),
            F.lit(" processes, the locations have "),
            F.col("_processes").cast("string"),
        ),
    )
    compared = cut(compared.withColumn("reason", fault))
    experiments = dumped.join(
        compared.where("reason is null").select("experiment_id", "wallclock_time"),
        "experiment_id",
        "left",
    )
    bad = compared.where("reason is not null").select(
        "experiment_id", "reason", F.lit(0).cast("long").alias("values")
    )
    only = lambda table: table.join(dumped, "experiment_id", "left_semi")
    profile = Profile(experiments, only(metrics), only(locations), only(cnodes), facts)
    # The facts' threads were held against the locations above.
    profile._threads_checked = True
    return Built(profile, lost.unionByName(bad))


def _present(*names: str) -> list[Column]:
    """Names with a missing one as text of its own: a count of distinct rows passes over nulls."""
    return [F.coalesce(F.concat(F.lit("="), name), F.lit("")) for name in names]


def _plain_metrics(measured: DataFrame) -> DataFrame:
    """A metric for each name of a dump; its place is that of the name."""
    listed = measured.groupBy("experiment_id").agg(F.sort_array(F.collect_set("metric")).alias("_all"))
    missing = F.lit(None).cast("string")
    return listed.select("experiment_id", F.posexplode("_all").alias("_at", "metric")).select(
        "experiment_id",
        "metric",
        F.col("metric").alias("display_name"),
        missing.alias("dtype"),
        missing.alias("uom"),
        missing.alias("description"),
        missing.alias("parent_metric"),
        F.col("_at").cast("long").alias("ord"),
    )


def _plain_locations(facts: DataFrame) -> DataFrame:
    """A location for each thread id; sums over threads are one location of all."""
    missing = F.lit(None).cast("string")
    name = F.when(F.col("thread_id") == model.ALL_THREADS, F.lit("all")).otherwise(
        F.concat(F.lit("thread "), F.col("thread_id").cast("string"))
    )
    return (
        facts.select("experiment_id", "thread_id")
        .distinct()
        .select(
            "experiment_id",
            "thread_id",
            missing.alias("machine"),
            missing.alias("node"),
            missing.alias("process"),
            name.alias("thread"),
        )
    )
