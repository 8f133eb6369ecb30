"""Every operator as a query ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callgrove import Profile, SystemDimension, model
from callgrove.operators import algebra, analysis, dimensions, inspection, tree
from callgrove.plans.lookup import lookup, measured_bytes
from callgrove.sources import builder, reports
from workload import exports
from workload.profiles import open_profile, order_profile

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round double columns: the last bits of a sum depend on its order."""
    return df.withColumns({name: F.round(name, places) for name, places in digits.items()})


def _year_pairs(profile: Profile, first: str, second: str) -> DataFrame:
    """Each year with the next one, where there is one."""
    years = profile.experiments.select("experiment_id")
    following = years.select((F.col("experiment_id") - 1).alias("experiment_id"))
    return years.join(following, "experiment_id", "left_semi").select(
        F.col("experiment_id").alias("result_id"),
        F.col("experiment_id").alias(first),
        (F.col("experiment_id") + 1).alias(second),
    )


def _cells(profile: Profile, digits: int = 4) -> DataFrame:
    """Facts of an algebra result by names instead of ids."""
    paths = profile.tree.select(
        "experiment_id", "cnode_id", F.array_join("names", "/").alias("path")
    )
    places = profile.locations.select("experiment_id", "thread_id", "process", "thread")
    named = lookup(
        profile.facts.join(paths, ["experiment_id", "cnode_id"]),
        places,
        ["experiment_id", "thread_id"],
        table_bytes=measured_bytes(places),
        spread=["metric", "cnode_id"],
    )
    return named.select(
        "experiment_id",
        "metric",
        "path",
        "process",
        "thread",
        F.round("value", digits).alias("value"),
    )


# Dimensions and values


@query
def metric_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_profile(spark, sf_dir).metric_tree


@query
def system_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_profile(spark, sf_dir).system_tree


@query
def cnode_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_profile(spark, sf_dir).cnode_tree


@query
def metric_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(open_profile(spark, sf_dir).values("time"), value=4)


@query
def tree_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.tree_size(open_profile(spark, sf_dir))


@query
def layout_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.layout_summary(open_profile(spark, sf_dir))


@query
def layout_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of seven experiments merged; few names are counted exactly."""
    sketches = dimensions.layout_sketches(open_profile(spark, sf_dir))
    return dimensions.layout_estimate(sketches, ["machine", "node"])


@query
def preorder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = tree.preorder_rows(open_profile(spark, sf_dir).tree)
    return numbered.select(
        "experiment_id", "row_no", "cnode_id", F.array_join("ids", "/").alias("id_path")
    )


# Inspection


@query
def calltree_incl(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = open_profile(spark, sf_dir).calltree("time", inclusive=True)
    return _rounded(rows, value=4, pct=6)


@query
def calltree_excl(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = open_profile(spark, sf_dir).calltree("time", inclusive=False)
    return _rounded(rows, value=4, pct=6)


@query
def calltree_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = open_profile(spark, sf_dir).calltree("bytes", threshold=1.5, inclusive=True)
    return _rounded(rows, value=4, pct=6)


@query
def info_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(open_profile(spark, sf_dir).info("visits"), value=4)


@query
def tree_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(inspection.tree_view(open_profile(spark, sf_dir)), value=4, pct=6)


@query
def info_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(open_profile(spark, sf_dir).info_basic(), wallclock_time=4)


@query
def calltree_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of user code that lead to MPI or OpenMP are COM."""
    rows = open_profile(spark, sf_dir).calltree("visits", combined=True)
    return _rounded(rows, value=4, pct=6)


@query
def dump_incl_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inclusive values by running sums over pre-order intervals."""
    profile = open_profile(spark, sf_dir)
    own = inspection.over_threads(profile.facts)
    nodes = tree.with_intervals(profile.tree)
    rows = tree.roll_up_by_intervals(own, nodes, profile.tree_size)
    return _rounded(rows, value=4)


@query
def dump_aggr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(open_profile(spark, sf_dir).dump(("time", "bytes")), value=4)


@query
def dump_thread(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = open_profile(spark, sf_dir).dump(("time", "visits"), threads="all")
    return _rounded(rows, value=4)


@query
def dump_incl(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = open_profile(spark, sf_dir).dump(("time",), threads="all", z="incl")
    return _rounded(rows, value=4)


@query
def dump_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selection strings are the operator under test."""
    rows = open_profile(spark, sf_dir).dump(
        ("time", "visits"), cnodes="0,1,3-5,100-124", threads="0-7,21", z="incl"
    )
    return _rounded(rows, value=4)


@query
def exclusive_from_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = open_profile(spark, sf_dir)
    cells = profile.facts.where(F.col("metric") == "time")
    nodes, size = profile.tree, profile.tree_size
    return _rounded(tree.self_values(tree.roll_up(cells, nodes, size), nodes, size), value=4)


# Statistics


@query
def stat_routines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stat_digits(open_profile(spark, sf_dir).stat(("time", "visits")))


@query
def stat_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routine filter is the operator under test."""
    rows = open_profile(spark, sf_dir).stat(
        ("time",), routines=("main", "ASIA", "EUROPE", "NATION_7", "NATION_12"), ddof=0
    )
    return _stat_digits(rows)


@query
def stat_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = open_profile(spark, sf_dir).stat(("time",), quartiles=True)
    return _rounded(
        rows.select(
            "experiment_id", "metric", "region_id", "routine", "quartile_25", "median", "quartile_75"
        ),
        quartile_25=6,
        median=6,
        quartile_75=6,
    )


@query
def stat_quartiles_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups no larger than the sketch, which then holds every value."""
    rows = open_profile(spark, sf_dir).stat(("time",), quartiles=True, rank_error=0.01)
    return _rounded(
        rows.select(
            "experiment_id", "metric", "region_id", "routine", "quartile_25", "median", "quartile_75"
        ),
        quartile_25=4,
        median=4,
        quartile_75=4,
    )


@query
def stat_per_thread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routine of a customer is the market segment, so samples are many nodes."""
    profile = open_profile(spark, sf_dir, segments=True)
    return _stat_digits(profile.stat(("time", "visits"), per_thread=True))


@query
def stat_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(open_profile(spark, sf_dir).stat(top_n=25), sum=4)


def _stat_digits(rows: DataFrame) -> DataFrame:
    return _rounded(rows, sum=4, mean=6, variance=0, minimum=4, maximum=4)


# Algebra


@query
def diff_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = open_profile(spark, sf_dir)
    return _cells(algebra.diff_pairs(profile, _year_pairs(profile, "minuend", "subtrahend")))


@query
def diff_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full years against the same years without the threads from 4 on."""
    whole = open_profile(spark, sf_dir)
    part = open_profile(spark, sf_dir, max_line=4)
    return _cells(whole.diff(part, SystemDimension.REDUCE))


@query
def diff_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = open_profile(spark, sf_dir)
    pairs = _year_pairs(profile, "minuend", "subtrahend")
    return _cells(algebra.diff_pairs(profile, pairs, system_dim=SystemDimension.COLLAPSE))


@query
def merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd years have time and visits, even years visits and bytes."""
    profile = open_profile(spark, sf_dir, split_metrics=True)
    groups = algebra.pair_groups(_year_pairs(profile, "first", "second"))
    return _cells(algebra.merge_groups(profile, groups))


@query
def mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = open_profile(spark, sf_dir)
    groups = profile.experiments.select(F.lit(0).cast("long").alias("result_id"), "experiment_id")
    return _cells(algebra.mean_groups(profile, groups), 5)


@query
def cmp_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every year against the next."""
    profile = open_profile(spark, sf_dir)
    return algebra.cmp_pairs(profile, _year_pairs(profile, "left", "right")).summary


@query
def cmp_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full years against the same years without the threads from 4 on."""
    whole = open_profile(spark, sf_dir)
    part = open_profile(spark, sf_dir, max_line=4)
    return _rounded(whole.cmp(part, rel_tol=1e-9).details, left=4, right=4)


@query
def cmp_slashed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations moved below the root under the name ``region/nation``: other paths, equal text."""
    whole = open_profile(spark, sf_dir)
    nodes = whole.cnodes.select([f.name for f in model.CNODES])
    upper = nodes.select(
        "experiment_id", F.col("cnode_id").alias("parent_id"), F.col("region_name").alias("_above")
    )
    is_nation = F.col("cnode_id").between(100, 999)
    name = F.concat("_above", F.lit("/"), "region_name")
    moved = (
        nodes.join(upper, ["experiment_id", "parent_id"], "left")
        .withColumn("region_name", F.when(is_nation, name).otherwise(F.col("region_name")))
        .withColumn("parent_id", F.when(is_nation, F.lit(0)).otherwise(F.col("parent_id")))
        .drop("_above")
    )
    other = Profile(whole.experiments, whole.metrics, whole.locations, moved, whole.facts)
    return whole.cmp(other).summary


@query
def diff_calltree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An algebra result is a profile again: the call tree of a difference."""
    profile = open_profile(spark, sf_dir)
    pairs = _year_pairs(profile, "minuend", "subtrahend")
    delta = algebra.diff_pairs(profile, pairs, system_dim=SystemDimension.COLLAPSE)
    rows = delta.calltree("time", inclusive=True)
    return _rounded(
        rows.select("experiment_id", "name", "callpath", "value", "depth"), value=4
    )


# Analyses


@query
def top_self_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analysis.top_self_time(open_profile(spark, sf_dir)), value=4)


@query
def stat_incl_errorbars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = analysis.inclusive_error_bars(open_profile(spark, sf_dir), ("time", "bytes"))
    return _rounded(rows, mean=6, err_low=5, err_high=5)


@query
def hottest_cnode_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analysis.hottest_node_threads(open_profile(spark, sf_dir)), value=4)


@query
def imbalance_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean is compared as the sum of a node's values and their number."""
    rows = analysis.thread_imbalance(open_profile(spark, sf_dir))
    n = F.count(F.lit(1)).over(Window.partitionBy("experiment_id", "cnode_id"))
    counted = rows.select(
        "experiment_id", "cnode_id", "thread_id", "name", "value", "imbalance",
        n.alias("values"), (F.col("mean_value") * n).alias("total"),
    )
    return _rounded(counted, value=4, total=4, imbalance=6)


@query
def diff_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = open_profile(spark, sf_dir)
    pairs = _year_pairs(profile, "minuend", "subtrahend")
    delta = algebra.diff_pairs(profile, pairs, system_dim=SystemDimension.COLLAPSE)
    rows = analysis.top_changes(delta)
    return _rounded(rows.drop("pct"), value=4)


# Report loaders: reports are written from the tables and read back


@query
def load_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = exports.stat_reports(
        open_profile(spark, sf_dir), exports.new_folder(spark, "stat")
    )
    return _stat_digits(reports.load_stat(spark, folder, parts=True).rows.drop("report"))


@query
def load_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = exports.flat_reports(
        open_profile(spark, sf_dir), exports.new_folder(spark, "flat")
    )
    return _rounded(reports.load_flat(spark, folder, parts=True).rows.drop("report"), sum=4)


@query
def load_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = exports.basic_reports(
        open_profile(spark, sf_dir), exports.new_folder(spark, "basic")
    )
    rows = reports.load_basic(spark, folder, parts=True).rows.drop("report")
    return _rounded(rows, wallclock_time=4)


@query
def load_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = exports.tree_reports(
        open_profile(spark, sf_dir), exports.new_folder(spark, "tree")
    )
    return _rounded(reports.load_tree(spark, folder, parts=True).rows.drop("report"), value=4)


@query
def load_calltree(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = exports.calltree_reports(
        open_profile(spark, sf_dir), exports.new_folder(spark, "calltree")
    )
    rows = reports.load_calltree(spark, folder, parts=True).rows.drop("report")
    return _rounded(rows, value=4, pct=6)


@query
def load_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = exports.dump_reports(
        open_profile(spark, sf_dir), exports.new_folder(spark, "dump")
    )
    return _rounded(reports.load_dump(spark, folder, parts=True).rows.drop("report"), value=4)


@query
def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat-profile reports are no dumps and have no statistics columns."""
    folder = exports.flat_reports(
        open_profile(spark, sf_dir), exports.new_folder(spark, "flat")
    )
    return (
        _reasons("dump", reports.load_dump(spark, folder, parts=True))
        .unionByName(_reasons("stat", reports.load_stat(spark, folder, parts=True)))
        .unionByName(_reasons("tree", reports.load_tree(spark, folder, parts=True)))
    )


def _built(spark: SparkSession, sf_dir: str, threads: int) -> builder.Built:
    """Dumps and summaries of a collection, joined with its tree and the first threads."""
    profile = open_profile(spark, sf_dir)
    dumps = exports.dump_reports(profile, exports.new_folder(spark, "dump"))
    basics = exports.basic_reports(profile, exports.new_folder(spark, "basic"))
    return builder.profile_from_reports(
        reports.load_dump(spark, dumps, parts=True).rows,
        reports.load_basic(spark, basics, parts=True).rows,
        profile.cnodes,
        metrics=profile.metrics,
        locations=profile.locations.where(F.col("thread_id") < threads),
    )


@query
def profile_from_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call tree of a profile that was built from its reports."""
    rows = _built(spark, sf_dir, 35).profile.calltree("time", inclusive=True)
    return _rounded(rows, value=4, pct=6)


@query
def profile_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations without the last process: its values and the summary's processes fit nowhere."""
    return _built(spark, sf_dir, 28).rejects


def _reasons(kind: str, loaded: reports.Loaded) -> DataFrame:
    year: Column = F.regexp_extract("report", r"(\d+)$", 1).cast("long")
    return loaded.rejects.select(
        F.lit(kind).alias("loader"), year.alias("experiment_id"), "reason"
    )


@query
def calltree_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call tree straight from the order tables: no stored paths to start from."""
    rows = order_profile(spark, sf_dir).calltree("time", inclusive=True)
    return _rounded(rows, value=4, pct=6)
