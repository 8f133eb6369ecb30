"""Analyses on top of the inspections: hot spots, error bars, imbalance, changes."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrove.functions.columns import class_label, inclusive_name
from callgrove.functions.selection import id_filter
from callgrove.operators.dimensions import region_names
from callgrove.operators.inspection import calltree_rows, dump, of_metrics
from callgrove.operators.stats import routine_stats
from callgrove.plans.lineage import cut_and_observe
from callgrove.plans.lookup import lookup
from callgrove.plans.ranking import top_k

if TYPE_CHECKING:
    from collections.abc import Sequence

    from callgrove.profile import Profile

_NODE = ["experiment_id", "cnode_id"]
_PLOTTED = ("USR", "MPI")


def of_classes(rows: DataFrame, classes: Sequence[str] = _PLOTTED) -> DataFrame:
    """Keep call paths of the given classes."""
    return rows.where(F.col("path_class").isin(list(classes)))


def top_self_time(profile: Profile, k: int = 15, metric: str = "time") -> DataFrame:
    """The ``k`` nodes of each experiment with the largest exclusive value.

    User code and MPI only, smallest first as for a horizontal bar chart.
    """
    rows = of_classes(calltree_rows(profile, metric, inclusive=False))
    best = top_k(rows, ["experiment_id"], [F.desc("value"), F.asc("cnode_id")], k)
    return best.orderBy("experiment_id", "value", F.desc("cnode_id")).select(
        *_NODE, "name", "value", class_label(F.col("path_class")).alias("label")
    )


def inclusive_error_bars(profile: Profile, metrics: Sequence[str] = ("time",)) -> DataFrame:
    """Mean of every routine over the locations with its distance to both extremes."""
    stats = routine_stats(profile, metrics)
    return (
        stats.withColumn("name", inclusive_name(F.col("routine")))
        .where(F.col("name").isNotNull())
        .select(
            "experiment_id",
            "metric",
            "region_id",
            F.col("name").alias("routine"),
            "mean",
            (F.col("mean") - F.col("minimum")).alias("err_low"),
            (F.col("maximum") - F.col("mean")).alias("err_high"),
        )
    )


def hottest_nodes(
    profile: Profile, k: int, metric: str = "time", threads: str = "all"
) -> DataFrame:
    """The ``k`` nodes of each experiment with the largest exclusive value.

    ``mean_value`` and ``peak`` describe the values on the chosen threads.
    """
    chosen = id_filter(threads)
    value = F.col("value")
    on_threads = value if chosen is None else F.when(chosen(F.col("thread_id")), value)
    own = (
        of_metrics(profile, [metric])
        .groupBy(*_NODE)
        .agg(
            F.sum("value").alias("total"),
            F.avg(on_threads).alias("mean_value"),
            F.max(on_threads).alias("peak"),
        )
    )
    return top_k(own, ["experiment_id"], [F.desc("total"), F.asc("cnode_id")], k)


def thread_values(
    profile: Profile, nodes: DataFrame, metric: str = "time", threads: str = "all"
) -> DataFrame:
    """Exclusive value of the given nodes on each thread, with their region names.

    The nodes are stored and counted, so that few of them are broadcast however large the
    tree is.
    """
    named, seen = cut_and_observe(region_names(profile, nodes), rows=F.count(F.lit(1)))
    cells = dump(profile, (metric,), threads=threads).drop("metric")
    size = 128.0 * (seen.get("rows") or 0)
    return lookup(cells, named, _NODE, table_bytes=size, spread=["thread_id"])


def hottest_node_threads(profile: Profile, metric: str = "time", threads: str = "all") -> DataFrame:
    """Values per thread of the hottest node of each experiment, in thread order."""
    rows = thread_values(profile, hottest_nodes(profile, 1, metric), metric, threads)
    return rows.orderBy("experiment_id", "thread_id").select(*_NODE, "thread_id", "name", "value")


def thread_imbalance(
    profile: Profile, k: int = 10, metric: str = "time", threads: str = "all"
) -> DataFrame:
    """Values per thread of the ``k`` hottest nodes with their mean over the threads.

    ``imbalance`` is the largest value over the mean; nodes without values on the
    chosen threads do not appear.
    """
    nodes = hottest_nodes(profile, k, metric, threads)
    mean_value = F.col("mean_value")
    ratio = F.when(mean_value != 0, F.col("peak") / mean_value).otherwise(F.lit(0.0))
    rows = thread_values(profile, nodes, metric, threads)
    return rows.orderBy("experiment_id", "cnode_id", "thread_id").select(
        *_NODE, "thread_id", "name", "value", "mean_value", ratio.alias("imbalance")
    )


def top_changes(delta: Profile, k: int = 15, metric: str = "time") -> DataFrame:
    """The ``k`` user-code or MPI paths of a difference that changed most.

    Sorted by value: positive where the first operand of the difference has more.
    """
    rows = of_classes(calltree_rows(delta, metric, inclusive=True))
    order: list[Column] = [F.desc(F.abs("value")), F.asc("callpath")]
    best = top_k(rows, ["experiment_id"], order, k)
    return best.orderBy("experiment_id", "value", "callpath").select(
        "experiment_id", "name", "callpath", "value", "pct", "depth"
    )
