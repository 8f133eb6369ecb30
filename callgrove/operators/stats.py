"""Per-routine statistics over the thread locations of each experiment."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrove.operators.inspection import of_metrics, over_threads, require_metrics
from callgrove.plans.lookup import lookup
from callgrove.plans.ranking import number_rows, top_k

if TYPE_CHECKING:
    from callgrove.profile import Profile

_NODE = ["experiment_id", "cnode_id"]
_GROUP = ["experiment_id", "metric", "region_id", "inclusive"]
_QUARTILES = {"quartile_25": 0.25, "median": 0.5, "quartile_75": 0.75}
#: Most locations of an experiment whose samples are sorted as one array each.
_SORTED_LOCATIONS = 1 << 14


def routine_stats(
    profile: Profile,
    metrics: Sequence[str] = ("time",),
    routines: Sequence[str] | None = None,
    *,
    ddof: int = 1,
    quartiles: bool = False,
    rank_error: float | None = None,
) -> DataFrame:
    """Two rows per metric and routine, ``INCL(name)`` and ``EXCL(name)``.

    The sample holds one value per thread location; locations without a value count
    as 0 and are added arithmetically, never as rows.  A value is inclusive for every
    routine on its call path, once even where the routine calls itself.  ``ddof`` is
    1 for the sample variance and 0 for the population variance.  Only routines in
    ``routines`` are kept; ``None`` or an empty sequence keeps all.

    Quartiles are exact, interpolated between ranks.  A sample has at most one value per
    location, so those of experiments with up to ``_SORTED_LOCATIONS`` locations are sorted as
    arrays, in the one aggregation of the other statistics; larger experiments take a
    distributed sort of their values.  With ``rank_error`` they come from mergeable sketches in the one aggregation of
    the other statistics: the value whose rank differs from the wanted one by at most that
    share of the present values, 99 times out of 100, without interpolation.  Zeros of
    absent locations have their exact weight in both.
    """
    profile.check_threads()
    sketched = quartiles and rank_error is not None
    if sketched and not 0 < rank_error < 1:
        raise ValueError(f"rank_error must lie between 0 and 1, got {rank_error}")
    per_thread = _per_thread(profile, metrics, routines)
    locations = profile.locations.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("locations")
    )
    exact = quartiles and not sketched
    large = locations.where(F.col("locations") > _SORTED_LOCATIONS).select("experiment_id")
    ranked = None
    if exact and not large.isEmpty():
        order = [F.col("value"), F.col("thread_id")]
        ranked = number_rows(
            per_thread.join(F.broadcast(large), "experiment_id", "left_semi"), _GROUP, order, "_rank"
        )
        per_thread = ranked.drop("_rank").unionByName(
            per_thread.join(F.broadcast(large), "experiment_id", "left_anti")
        )
    # Routines without any value take part as rows without a value.
    named = profile.cnodes.where(_chosen(F.col("region_name"), routines)).select(
        "experiment_id", "region_id", "region_name"
    )
    all_rows = per_thread.select(*_GROUP, "value", "thread_id").unionByName(
        _routines(profile, named, metrics).withColumn("thread_id", F.lit(None).cast("long"))
    )
    if ranked is not None:
        all_rows = all_rows.join(
            F.broadcast(large.withColumn("_large", F.lit(True))), "experiment_id", "left"
        )
    moments = _present_moments()
    if exact:
        kept = F.col("value") if ranked is None else F.when(F.col("_large").isNull(), F.col("value"))
        moments += [
            F.count("thread_id").alias("_stored"),
            F.sort_array(F.collect_list(kept)).alias("_values"),
        ]
    if sketched:
        size = F.lit(sketch_size(rank_error / 2))
        moments += [
            F.kll_sketch_agg_double("value", size).alias("_sketch"),
            F.count_if(F.col("value") < 0).alias("_negative"),
        ]
    present = all_rows.groupBy(*_GROUP).agg(*moments)
    size = profile.tree_size
    placed = lookup(
        present, locations, ["experiment_id"], table_bytes=32.0 * size.experiments, spread=["region_id"]
    )
    rows = placed.join(named.distinct(), ["experiment_id", "region_id"])
    extra: list[Column | str] = []
    if sketched:
        extra = [_sketched_quantile(share, rank_error).alias(name) for name, share in _QUARTILES.items()]
    elif exact:
        extra = [_sorted_quantile(share).alias(name) for name, share in _QUARTILES.items()]
        if ranked is not None:
            far = _quartiles(ranked, locations)
            far = far.select(*_GROUP, *(F.col(name).alias(f"_{name}") for name in _QUARTILES))
            rows = rows.join(far, _GROUP, "left")
            extra = [
                F.coalesce(f"_{name}", _sorted_quantile(share)).alias(name)
                for name, share in _QUARTILES.items()
            ]
    moments = _moments(F.col("locations"), ddof)
    return rows.select(
        "experiment_id",
        "metric",
        _label().alias("routine"),
        "region_id",
        *moments[:-1],
        *extra,
        moments[-1],
    )


def sketch_size(rank_error: float) -> int:
    """Parameter k of a KLL sketch whose ranks are off by at most ``rank_error``, 99 of 100 times."""
    # Error curve of KLL sketches, and the sizes that they may have.
    size = math.ceil((2.296 / rank_error) ** (1 / 0.9723))
    return min(max(size, 8), 65535)


def _sketched_quantile(share: float, rank_error: float) -> Column:
    """Value at rank floor((locations - 1) * share), zeros of absent locations included.

    They stand behind the negative values: ranks below are those of the sketch, ranks above
    are shifted by them.  A sketch gives values at fixed ranks only, so the nearest one of a
    grid is taken, at most half of ``rank_error`` away; the other half is the sketch's.
    """
    n, negative = F.col("_n"), F.col("_negative")
    absent = F.col("locations") - n
    rank = F.floor((F.col("locations") - 1) * F.lit(share))
    stored = F.when(rank < negative, rank).otherwise(rank - absent)
    steps = math.ceil(1 / rank_error)
    grid = F.array(*(F.lit(i / steps) for i in range(steps + 1)))
    values = F.kll_sketch_get_quantile_double("_sketch", grid)
    at = F.round((stored + 0.5) / n * steps).cast("int")
    is_zero = (n == 0) | ((rank >= negative) & (rank < negative + absent))
    return F.when(is_zero, F.lit(0.0)).otherwise(F.get(values, at))


def _sorted_quantile(share: float) -> Column:
    """Quantile by linear interpolation between ranks, from the sorted present values.

    Absent locations are zeros between the negative and the other values.  Stored values that
    are null come first and count as 0.
    """
    n, stored, values = F.col("_n"), F.col("_stored"), F.col("_values")
    absent, empty = F.col("locations") - stored, stored - n
    below = F.size(F.filter(values, lambda value: value < 0)) + empty

    def value_at(rank: Column) -> Column:
        index = F.when(rank < below, rank - empty).when(
            rank >= below + absent, rank - empty - absent
        )
        return F.coalesce(F.get(values, index.cast("int")), F.lit(0.0))

    at = (F.col("locations") - 1) * F.lit(share)
    weight = at - F.floor(at)
    return value_at(F.floor(at)) * (1 - weight) + value_at(F.floor(at) + 1) * weight


def _label() -> Column:
    kind = F.when(F.col("inclusive"), F.lit("INCL(")).otherwise(F.lit("EXCL("))
    return F.concat(kind, "region_name", F.lit(")"))


def _present_moments() -> list[Column]:
    """Aggregates of the values that there are."""
    return [
        F.count("value").alias("_n"),
        F.sum("value").alias("_sum"),
        F.var_pop("value").alias("_var"),
        F.min("value").alias("_min"),
        F.max("value").alias("_max"),
    ]


def _moments(size: Column, ddof: int) -> list[Column]:
    """Statistics of a sample of ``size`` values, those that are absent counting as 0."""
    zero, n = F.lit(0.0), F.col("_n")
    total = F.coalesce("_sum", zero)
    absent = size - n
    mean_present = F.when(n > 0, total / n).otherwise(zero)
    # Squared deviations of the present values, plus the term that merging them
    # with a block of zeros adds.
    spread = n * F.coalesce("_var", zero) + F.when(
        size > 0, n * absent / size * mean_present * mean_present
    ).otherwise(zero)
    minimum = F.when(absent > 0, F.least(F.coalesce("_min", zero), zero)).otherwise(F.col("_min"))
    maximum = F.when(absent > 0, F.greatest(F.coalesce("_max", zero), zero)).otherwise(
        F.col("_max")
    )
    return [
        size.alias("count"),
        total.alias("sum"),
        (total / F.nullif(size, F.lit(0))).alias("mean"),
        F.when(size > ddof, spread / (size - ddof)).alias("variance"),
        minimum.alias("minimum"),
        maximum.alias("maximum"),
    ]


def thread_stats(
    profile: Profile,
    metrics: Sequence[str] = ("time",),
    routines: Sequence[str] | None = None,
    *,
    ddof: int = 1,
) -> DataFrame:
    """The statistics of :func:`routine_stats` for each thread, over a routine's nodes.

    The sample of ``EXCL(name)`` holds the exclusive value of every node of the routine on
    the thread, that of ``INCL(name)`` the inclusive value of its outermost nodes, so that
    the sum counts a routine that calls itself once.  Nodes without a value on the thread
    count as 0.  Threads without any value of a routine have no row.
    """
    profile.check_threads()
    facts = of_metrics(profile, metrics)
    above = F.transform(
        F.arrays_zip("regions", "names", "ids"),
        lambda step, at: F.struct(
            step["regions"].alias("region_id"),
            step["ids"].alias("node"),
            step["names"].alias("name"),
            (F.array_position("regions", step["regions"]) == at + 1).alias("outermost"),
        ),
    )
    outer = F.filter(above, lambda step: step["outermost"] & _chosen(step["name"], routines))
    own = F.when(
        _chosen(F.col("region_name"), routines),
        F.array(_charge(F.col("region_id"), F.col("cnode_id"), False)),
    ).otherwise(F.array().cast("array<struct<region_id:bigint,node:bigint,inclusive:boolean>>"))
    charged = F.concat(
        F.transform(outer, lambda step: _charge(step["region_id"], step["node"], True)), own
    )
    paths = profile.tree.select(*_NODE, charged.alias("_charged")).where(F.size("_charged") > 0)
    placed = lookup(
        facts, paths, _NODE, table_bytes=profile.tree_size.bytes(72, 24), spread=["metric", "thread_id"]
    )
    keys = [*_GROUP, "thread_id"]
    nodes = (
        placed.select("experiment_id", "metric", "thread_id", "value", F.inline("_charged"))
        .groupBy(*keys, "node")
        .agg(F.sum("value").alias("value"))
    )
    present = nodes.groupBy(*keys).agg(*_present_moments())
    inside = F.slice("regions", F.lit(1), F.size("regions") - 1)
    outermost = F.count_if(~F.array_contains(inside, F.col("region_id")))
    sizes = (
        profile.tree.where(_chosen(F.col("region_name"), routines))
        .groupBy("experiment_id", "region_id", "region_name")
        .agg(F.count(F.lit(1)).alias("_all"), outermost.alias("_outermost"))
        .select(
            "experiment_id",
            "region_id",
            "region_name",
            F.explode(
                F.create_map(F.lit(True), F.col("_outermost"), F.lit(False), F.col("_all"))
            ).alias("inclusive", "_nodes"),
        )
    )
    sized = lookup(
        present,
        sizes,
        ["experiment_id", "region_id", "inclusive"],
        table_bytes=profile.tree_size.bytes(96),
        spread=["metric", "thread_id"],
    )
    return sized.select(
        "experiment_id",
        "metric",
        _label().alias("routine"),
        "region_id",
        "thread_id",
        *_moments(F.col("_nodes"), ddof),
    )


def _charge(region: Column, node: Column, inclusive: bool) -> Column:
    return F.struct(
        region.alias("region_id"), node.alias("node"), F.lit(inclusive).alias("inclusive")
    )


def _chosen(name: Column, routines: Sequence[str] | None) -> Column:
    return name.isin(list(routines)) if routines else F.lit(True)


def _routines(profile: Profile, named: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Every routine of an experiment for each requested metric the experiment has.

    A routine may come up once per node; the caller groups the rows anyway.
    """
    wanted = list(dict.fromkeys(metrics))
    measured = profile.metrics.where(F.col("metric").isin(wanted)).select(
        "experiment_id", "metric"
    )
    return (
        named.select(
            "experiment_id",
            "region_id",
            F.explode(F.array(*(F.lit(m) for m in wanted))).alias("metric"),
        )
        .join(measured, ["experiment_id", "metric"], "left_semi")
        .withColumn("inclusive", F.explode(F.array(F.lit(True), F.lit(False))))
        .withColumn("value", F.lit(None).cast("double"))
    )


def _per_thread(
    profile: Profile, metrics: Sequence[str], routines: Sequence[str] | None
) -> DataFrame:
    """Value of each routine on each thread, both inclusive and exclusive."""
    facts = of_metrics(profile, metrics)
    on_path = F.array_distinct(
        F.transform(
            F.filter(
                F.arrays_zip("regions", "names"), lambda step: _chosen(step["names"], routines)
            ),
            lambda step: step["regions"],
        )
    )
    own = F.when(_chosen(F.col("region_name"), routines), F.array("region_id")).otherwise(
        F.array().cast("array<bigint>")
    )
    charged = F.concat(
        F.transform(
            on_path,
            lambda region: F.struct(region.alias("region_id"), F.lit(True).alias("inclusive")),
        ),
        F.transform(
            own, lambda region: F.struct(region.alias("region_id"), F.lit(False).alias("inclusive"))
        ),
    )
    paths = profile.tree.select(*_NODE, charged.alias("_charged")).where(F.size("_charged") > 0)
    size = profile.tree_size.bytes(72, 16)
    placed = lookup(facts, paths, _NODE, table_bytes=size, spread=["metric", "thread_id"])
    return (
        placed.select("experiment_id", "metric", "thread_id", "value", F.inline("_charged"))
        .groupBy(*_GROUP, "thread_id")
        .agg(F.sum("value").alias("value"))
    )


def _quartiles(ranked: DataFrame, locations: DataFrame) -> DataFrame:
    """Exact quartiles by linear interpolation between ranks, of samples too large for an array.

    ``_rank`` comes from a distributed sort of the values.  The zeros of absent
    locations sit between the negative and the other values: they push up the ranks
    of the latter and fill every rank that no stored value takes.
    """
    stored = ranked.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("_stored"))
    sized = ranked.join(stored, _GROUP).join(locations, "experiment_id")
    shift = F.when(F.col("value") >= 0, F.col("locations") - F.col("_stored")).otherwise(F.lit(0))
    placed = sized.withColumn("_rank", F.col("_rank") + shift)
    columns = []
    for name, share in _QUARTILES.items():
        at = (F.col("locations") - 1) * F.lit(share)
        weight = at - F.floor(at)
        lower = F.sum(F.when(F.col("_rank") == F.floor(at), F.col("value") * (1 - weight)))
        upper = F.sum(F.when(F.col("_rank") == F.floor(at) + 1, F.col("value") * weight))
        columns.append(
            (F.coalesce(lower, F.lit(0.0)) + F.coalesce(upper, F.lit(0.0))).alias(name)
        )
    return placed.groupBy(*_GROUP).agg(*columns)


def flat_profile(profile: Profile, top_n: int | None) -> DataFrame:
    """The ``top_n`` routines of each experiment by exclusive time, all of them for ``None``.

    ``count`` is the number of calls (metric ``visits``) and ``sum`` the exclusive
    time; the other statistics are null.
    """
    require_metrics(profile, ["time"])
    facts = profile.facts.where(F.col("metric").isin("time", "visits"))
    by_node = over_threads(facts)
    regions = profile.cnodes.select(*_NODE, "region_id", "region_name")
    zero = F.lit(0.0)
    routines = (
        regions.join(by_node, _NODE, "left")
        .groupBy("experiment_id", "region_id", F.col("region_name").alias("routine"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("metric") == "visits", F.col("value"))), zero).alias(
                "_calls"
            ),
            F.coalesce(F.sum(F.when(F.col("metric") == "time", F.col("value"))), zero).alias("sum"),
        )
    )
    best = routines
    if top_n is not None:
        best = top_k(routines, ["experiment_id"], [F.desc("sum"), F.asc("region_id")], top_n)
    missing = F.lit(None).cast("double")
    return best.orderBy("experiment_id", F.desc("sum"), "region_id").select(
        "experiment_id",
        F.lit("time").alias("metric"),
        "routine",
        "region_id",
        F.round("_calls").cast("long").alias("count"),
        "sum",
        missing.alias("mean"),
        missing.alias("variance"),
        missing.alias("minimum"),
        missing.alias("maximum"),
    )
