"""Inspections: value dumps, call-tree views and the experiment summary."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callgrove.errors import UnknownMetricError
from callgrove.functions.columns import call_path, path_class, percent_of, tree_label
from callgrove.functions.selection import id_filter
from callgrove.model import ALL_THREADS
from callgrove.operators.tree import combined_classes, in_preorder, roll_up
from callgrove.plans.lookup import lookup

if TYPE_CHECKING:
    from callgrove.profile import Profile

_NODE = ["experiment_id", "cnode_id"]


def require_metrics(profile: Profile, metrics: Sequence[str]) -> None:
    """Raise unless every metric exists in at least one experiment."""
    wanted = set(metrics)
    if not wanted:
        raise UnknownMetricError("no metric given")
    missing = wanted - profile.seen_metrics(wanted)
    if missing:
        raise UnknownMetricError(f"unknown metric: {', '.join(sorted(missing))}")


def of_metrics(profile: Profile, metrics: Sequence[str]) -> DataFrame:
    """Facts of the given metrics (a partition filter on stored facts).

    Joins on the node would drop facts without a key in some branches of a plan only;
    dropping them here lets the branches share one scan and one shuffle.
    """
    require_metrics(profile, metrics)
    return profile.facts.where(
        F.col("metric").isin(list(metrics))
        & F.col("experiment_id").isNotNull()
        & F.col("cnode_id").isNotNull()
    )


def over_threads(facts: DataFrame) -> DataFrame:
    """Sum over all threads: ``experiment_id, metric, cnode_id, value``."""
    return facts.groupBy("experiment_id", "metric", "cnode_id").agg(F.sum("value").alias("value"))


def of_known_nodes(profile: Profile, cells: DataFrame, spread: Sequence[str]) -> DataFrame:
    """Rows whose node is in the tree.  Values of unknown nodes count nowhere.

    Stored collections know whether they have any, then this is no join.
    """
    if profile._nodes_checked:
        return cells
    known = profile.tree.select(*_NODE)
    size = profile.tree_size.bytes(32)
    return lookup(cells, known, _NODE, table_bytes=size, spread=spread, how="left_semi")


def metric_values(profile: Profile, metric: str) -> DataFrame:
    """Exclusive values of one metric; values of unknown nodes are dropped."""
    facts = of_metrics(profile, [metric]).select(*_NODE, "thread_id", "value")
    return of_known_nodes(profile, facts, ["thread_id"])


def dump(
    profile: Profile,
    metrics: Sequence[str] = ("time",),
    cnodes: str = "all",
    threads: str = "aggr",
    z: str = "excl",
) -> DataFrame:
    """Long-form values: ``experiment_id, cnode_id, thread_id, metric, value``.

    ``cnodes`` and ``threads`` are selections (``all`` or ``0,1,5-10``); threads may
    also be ``aggr``, one row per node summed over threads with thread id -1.
    ``z`` chooses exclusive (``excl``) or inclusive (``incl``) values.
    """
    if z not in ("incl", "excl"):
        raise ValueError(f"z must be 'incl' or 'excl', got {z!r}")
    facts = of_metrics(profile, metrics)
    chosen_nodes = id_filter(cnodes)
    if z == "excl" and chosen_nodes is not None:
        facts = facts.where(chosen_nodes(F.col("cnode_id")))
    if threads.strip().lower() == "aggr":
        cells = over_threads(facts)
    else:
        chosen_threads = id_filter(threads)
        if chosen_threads is not None:
            facts = facts.where(chosen_threads(F.col("thread_id")))
        cells = facts.select("experiment_id", "metric", "cnode_id", "thread_id", "value")
    if z == "incl":
        cells = roll_up(cells, profile.tree, profile.tree_size, onto=chosen_nodes)
    else:
        spread = [c for c in ("metric", "thread_id") if c in cells.columns]
        cells = of_known_nodes(profile, cells, spread)
    if "thread_id" not in cells.columns:
        cells = cells.withColumn("thread_id", F.lit(ALL_THREADS).cast("long"))
    return cells.select("experiment_id", "cnode_id", "thread_id", "metric", "value")


def node_values(profile: Profile, metric: str, inclusive: bool) -> DataFrame:
    """All tree columns of every node with ``value`` and ``pct``.

    Nodes without values count as 0.  Percentages refer to the inclusive total of
    the experiment.  Experiments that do not have the metric are left out.
    """
    own = of_known_nodes(profile, over_threads(of_metrics(profile, [metric])), ["metric"])
    values = roll_up(own, profile.tree, profile.tree_size) if inclusive else own
    totals = own.groupBy("experiment_id").agg(F.sum("value").alias("_total"))
    measured = profile.metrics.where(F.col("metric") == metric).select("experiment_id")
    scope = measured.join(totals, "experiment_id", "left")
    in_scope = lookup(
        profile.tree,
        scope,
        ["experiment_id"],
        table_bytes=48.0 * profile.tree_size.experiments,
        spread=["cnode_id"],
    )
    return (
        in_scope.join(values.select(*_NODE, "value"), _NODE, "left")
        .withColumn("value", F.coalesce("value", F.lit(0.0)))
        .withColumn("pct", percent_of(F.col("value"), F.col("_total")))
        .drop("_total")
    )


def calltree(
    profile: Profile,
    metric: str = "time",
    threshold: float = 0.0,
    inclusive: bool = True,
    combined: bool = False,
) -> DataFrame:
    """One row per node in pre-order with value, percentage and call path.

    A positive ``threshold`` keeps nodes whose percentage reaches it in magnitude.
    ``combined`` gives user code that leads to MPI or OpenMP the class ``COM``.
    """
    rows = calltree_rows(profile, metric, threshold, inclusive, combined)
    return in_preorder(rows).drop("ids")


def calltree_rows(
    profile: Profile,
    metric: str,
    threshold: float = 0.0,
    inclusive: bool = True,
    combined: bool = False,
) -> DataFrame:
    """The rows of :func:`calltree` and their paths ``ids``, in any order."""
    nodes = node_values(profile, metric, inclusive)
    if threshold > 0:
        nodes = nodes.where(F.abs("pct") >= threshold)
    if combined:
        nodes = nodes.drop("path_class").join(combined_classes(profile.tree), _NODE)
    cls = path_class(F.col("path_class"), F.col("region_name"))
    return nodes.select(
        *_NODE,
        F.col("region_name").alias("name"),
        call_path(cls, F.col("names")).alias("callpath"),
        cls.alias("path_class"),
        "value",
        "pct",
        "depth",
        "ids",
    )


def info(profile: Profile, metric: str = "time") -> DataFrame:
    """Inclusive values of a metric as an indented tree, in pre-order."""
    nodes = node_values(profile, metric, inclusive=True)
    return in_preorder(nodes).select(
        "experiment_id",
        F.lit(metric).alias("metric"),
        "value",
        "cnode_id",
        F.col("region_name").alias("name"),
        "depth",
    )


def tree_view(profile: Profile, metric: str = "time") -> DataFrame:
    """Text tree: value, percentage of the total and the indented name."""
    nodes = node_values(profile, metric, inclusive=True)
    return in_preorder(nodes).select(
        *_NODE, "value", "pct", tree_label(F.col("depth"), F.col("region_name")).alias("label")
    )


def info_basic(profile: Profile) -> DataFrame:
    """Nodes, processes and wall-clock time per experiment.

    Where no wall-clock time is stored, the longest time any location spent in the
    whole tree stands in for it.
    """
    layout = profile.locations.groupBy("experiment_id").agg(
        F.count_distinct("machine", "node").alias("nodes"),
        F.count_distinct("machine", "node", "process").alias("processes"),
    )
    longest = (
        profile.facts.where(F.col("metric") == "time")
        .groupBy("experiment_id", "thread_id")
        .agg(F.sum("value").alias("value"))
        .groupBy("experiment_id")
        .agg(F.max("value").alias("_longest"))
    )
    return (
        profile.experiments.join(layout, "experiment_id", "left")
        .join(longest, "experiment_id", "left")
        .select(
            "experiment_id",
            F.coalesce("nodes", F.lit(0).cast("long")).alias("nodes"),
            F.coalesce("processes", F.lit(0).cast("long")).alias("processes"),
            F.coalesce("wallclock_time", "_longest").alias("wallclock_time"),
        )
    )
