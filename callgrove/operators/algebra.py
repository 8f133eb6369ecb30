"""Profile algebra: difference, merge, mean and comparison.

Operands are laid out as rows: every table carries ``result_id`` (which result the
row contributes to), ``ord`` (position of the operand) and ``n`` (operands of that
result).  One plan therefore computes any number of results, and a mean over ten
thousand experiments is one aggregation, not ten thousand joins.

Nodes are aligned by their path of names, locations by their names.  A cell that an
operand lacks counts as 0.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callgrove.errors import SystemMismatchError, UnknownExperimentError
from callgrove.functions.columns import hash_id
from callgrove.model import SystemDimension
from callgrove.operators.tree import with_depth
from callgrove.plans.lineage import cut_and_observe
from callgrove.plans.lookup import lookup, measured_bytes

if TYPE_CHECKING:
    from callgrove.profile import Profile

_OPERAND = ["result_id", "ord"]
_PLACE = ["machine", "node", "process", "thread"]
_CELL = ["result_id", "metric", "cnode_id", "thread_id"]
_SEEDS = 8
#: Most operands whose experiment ids are listed in a partition filter.
_LISTED_IDS = 1024
#: Locations up to which a node's cells are few enough for one task, whatever their share.
_FEW_PLACES = 16_384


@dataclass(frozen=True)
class Operands:
    """Operand tables, each with ``result_id``, ``ord`` and ``n``."""

    metrics: DataFrame
    locations: DataFrame
    tree: DataFrame
    facts: DataFrame


@dataclass(frozen=True)
class Aligned:
    """Facts on common node and location ids, with the common dimensions."""

    facts: DataFrame
    tree: DataFrame
    locations: DataFrame
    #: Nodes of the operands with ``_path``, the common id.
    nodes: DataFrame
    #: Whether a node has at most ``_FEW_PLACES`` values of a metric in an operand.
    few_places: bool


@dataclass(frozen=True)
class CompareResult:
    """Outcome of a comparison: a row per result and a row per difference."""

    summary: DataFrame
    details: DataFrame

    @property
    def equal(self) -> bool:
        """Whether no result has a difference (runs the comparison)."""
        return self.summary.where(~F.col("equal")).isEmpty()


# Operand layout


def _from_profiles(profiles: tuple[Profile, ...]) -> Operands:
    """Operands given as separate profiles.

    Pinned profiles are combined whatever their ids; otherwise each experiment is
    combined with the experiments of the same id.
    """
    for profile in profiles:
        profile.check_threads()
    if all(p.pinned for p in profiles):
        result = F.lit(profiles[0].experiment_id).cast("long")
    else:
        result = F.col("experiment_id")

    def stack(table: str) -> DataFrame:
        parts = [
            _table(p, table)
            .withColumn("result_id", result)
            .withColumn("ord", F.lit(i))
            .withColumn("n", F.lit(len(profiles)))
            .drop("experiment_id")
            for i, p in enumerate(profiles)
        ]
        stacked = parts[0]
        for part in parts[1:]:
            stacked = stacked.unionByName(part)
        return stacked

    return Operands(stack("metrics"), stack("locations"), stack("tree"), stack("facts"))


def _from_groups(profile: Profile, groups: DataFrame) -> Operands:
    """Operands given as rows ``result_id, ord, experiment_id`` over one collection.

    The groups go into every table, so they are computed once and kept.
    """
    whole = Window.partitionBy("result_id")
    counted = groups.withColumn("n", F.count(F.lit(1)).over(whole).cast("int"))
    known = profile.experiments.select("experiment_id", F.lit(True).alias("_known")).distinct()
    used = counted.join(known, "experiment_id", "left")
    uses, seen = cut_and_observe(
        used.select("experiment_id", "result_id", "ord", "n", "_known"),
        rows=F.count(F.lit(1)),
        unknown=F.count_if(F.col("_known").isNull()),
        example=F.min(F.when(F.col("_known").isNull(), F.col("experiment_id"))),
        low=F.min("experiment_id"),
        high=F.max("experiment_id"),
    )
    if seen.get("unknown"):
        raise UnknownExperimentError(
            f"{seen['unknown']} operands are experiments that do not exist, e.g. {seen['example']}"
        )
    uses = uses.drop("_known")
    rows = seen.get("rows", 0)
    # Folders of other experiments are not read: a list of ids where it is short, else their range.
    part_of = F.col("experiment_id").between(seen.get("low"), seen.get("high"))
    if rows <= _LISTED_IDS:
        listed = [row.experiment_id for row in uses.select("experiment_id").distinct().collect()]
        part_of = F.col("experiment_id").isin(listed)
    profile.check_threads()

    def assign(table: str, spread: list[str]) -> DataFrame:
        used = lookup(
            _table(profile, table).where(part_of),
            uses,
            ["experiment_id"],
            table_bytes=64.0 * rows,
            spread=spread,
        )
        return used.drop("experiment_id")

    return Operands(
        assign("metrics", ["metric"]),
        assign("locations", ["thread_id"]),
        assign("tree", ["cnode_id"]),
        assign("facts", ["cnode_id", "thread_id"]),
    )


def _table(profile: Profile, name: str) -> DataFrame:
    table = getattr(profile, name)
    return table.withColumnRenamed("ord", "_pos") if name == "metrics" else table


# Alignment


def _key_id(keys: Sequence[str], seed: int) -> Column:
    """Hash of the keys; it also tells which of them are null, as a hash passes over nulls."""
    return hash_id(F.lit(seed), *keys, *(F.isnull(k) for k in keys))


def _path_id(names: Column, seed: int) -> Column:
    """Id of a path of names: each step hashes the id above it and its name."""
    return F.aggregate(names, F.lit(seed).cast("long"), lambda above, name: hash_id(above, name))


def _path_ids(names: Column, seed: int) -> Column:
    """Ids of all prefixes of a path, the path itself last, in one pass."""
    return F.aggregate(
        names,
        F.array().cast("array<bigint>"),
        lambda ids, name: F.array_append(
            ids, hash_id(F.coalesce(F.try_element_at(ids, F.lit(-1)), F.lit(seed).cast("long")), name)
        ),
    )


def _hashed(
    table: DataFrame, keys_of: Callable[[int], Sequence[Column]], id_of: Callable[[int], Column]
) -> tuple[int, int]:
    """Seed under which different keys of a result have different ids, and the rows.

    Ids are 63-bit hashes of what they stand for, so they need no numbering and stay
    the same through nested operations.  A clash is next to impossible, but it would
    add up unrelated values, hence the check.  Rows are moved once, by their id, and not
    sorted: different keys of an id are counted by hashing.
    """
    for seed in range(_SEEDS):
        keys = {f"_key{i}": key for i, key in enumerate(keys_of(seed))}
        kinds = (
            table.select("result_id", id_of(seed).alias("_id"), *(k.alias(n) for n, k in keys.items()))
            .repartition("result_id", "_id")
            .groupBy("result_id", "_id", *keys)
            .agg(F.count(F.lit(1)).alias("_rows"))
        )
        clashes, rows = (
            kinds.groupBy("result_id", "_id")
            .agg(F.count(F.lit(1)).alias("_kinds"), F.sum("_rows").alias("_rows"))
            .agg(F.count_if(F.col("_kinds") > 1), F.coalesce(F.sum("_rows"), F.lit(0)))
            .first()
        )
        if not clashes:
            return seed, rows
    raise RuntimeError("no collision-free ids")


def _last_step(seed: int) -> list[Column]:
    """What tells a path from others of the same id: the id of the path above it, and its name.

    Paths above are in the table themselves.  The shortest paths that clash differ in one of
    the two, so their whole names need not be compared.
    """
    above = F.when(
        F.size("names") > 1, _path_id(F.slice("names", F.lit(1), F.size("names") - 1), seed)
    )
    return [above, F.element_at("names", -1)]


def _common_tree(tree: DataFrame, seed: int) -> DataFrame:
    """Union of the operand trees; a shared node keeps the attributes of the first.

    ``seed`` is free of clashes, so an id stands for one path.  Rows are moved by id before
    they are combined: the wide rows are not sorted in the tasks that read them, where a task
    has as many as a file split holds.
    """
    first = F.min_by(
        F.struct("names", "region_name", "file", "line", "path_class"), F.struct("ord", "cnode_id")
    )
    merged = (
        tree.select("*", _path_id(F.col("names"), seed).alias("_path"))
        .repartition("result_id", "_path")
        .groupBy("result_id", "_path")
        .agg(first.alias("_first"))
    )
    merged = merged.select(
        F.col("result_id").alias("experiment_id"),
        F.col("_path").alias("cnode_id"),
        "_first.*",
        _path_ids(F.col("_first.names"), seed).alias("ids"),
        F.transform("_first.names", lambda name: hash_id(name)).alias("regions"),
    )
    return with_depth(
        merged.select(
            "experiment_id",
            "cnode_id",
            F.element_at("regions", -1).alias("region_id"),
            "region_name",
            "file",
            "line",
            F.get("ids", F.size("ids") - 2).alias("parent_id"),
            "path_class",
            "ids",
            "regions",
            "names",
        )
    )


def _place_label() -> Column:
    """Names of a location as text; a missing one shows, so that labels stay apart."""
    return F.concat_ws("/", *(F.coalesce(c, F.lit("(none)")) for c in _PLACE))


def _same_system_rows(locations: DataFrame) -> int:
    """Number of location rows, after checking that all operands have the same ones."""
    place = _place_label()
    uneven = F.col("_has") != F.col("_n")
    rows, wrong, example = (
        locations.groupBy("result_id", *_PLACE)
        .agg(
            F.count_distinct("ord").alias("_has"),
            F.max("n").alias("_n"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .agg(
            F.coalesce(F.sum("_rows"), F.lit(0)),
            F.count_if(uneven),
            F.min(F.when(uneven, F.struct("result_id", place.alias("place")))),
        )
        .first()
    )
    if wrong:
        raise SystemMismatchError(
            f"operands of result {example.result_id} differ in their system dimension,"
            f" e.g. location {example.place}; use REDUCE or COLLAPSE"
        )
    return rows


def _first_ids(locations: DataFrame) -> DataFrame:
    """Add ``place``, the thread id that a location has in the first operand.

    A location may lack some of its names; nulls are names like others.
    """
    keys = ["result_id", *_PLACE]
    ids = locations.groupBy(*(F.col(c).alias(f"_{c}") for c in keys)).agg(
        F.min(F.struct("ord", "thread_id"))["thread_id"].alias("place")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return locations.join(ids, same).drop(*(f"_{c}" for c in keys))


def _move(facts: DataFrame, places: DataFrame, rows: int) -> DataFrame:
    """Replace the thread ids of the operands by those of the result."""
    moved = lookup(
        facts,
        places.select(*_OPERAND, "thread_id", "place"),
        [*_OPERAND, "thread_id"],
        table_bytes=64.0 * rows,
        spread=["metric", "cnode_id"],
    )
    return moved.drop("thread_id").withColumnRenamed("place", "thread_id")


def _sum_places(facts: DataFrame, *places: str) -> DataFrame:
    """Sum over the location columns that are not in ``places``, per operand."""
    return facts.groupBy(*_OPERAND, "n", "metric", "cnode_id", *places).agg(
        F.sum("value").alias("value")
    )


def _location_rows(places: DataFrame, keys: list[str]) -> DataFrame:
    names = [F.col(c) if c in keys else F.lit("all").alias(c) for c in _PLACE]
    return places.select(
        F.col("result_id").alias("experiment_id"), F.col("place").alias("thread_id"), *names
    ).distinct()


def _align(
    operands: Operands, system_dim: SystemDimension, *, same_system: bool = True
) -> Aligned:
    if system_dim is SystemDimension.COLLAPSE:
        places = operands.locations.withColumn("place", F.lit(0).cast("long"))
        locations = _location_rows(places, [])
        facts = _sum_places(operands.facts).withColumn("thread_id", F.lit(0).cast("long"))
        few_places = True
    elif system_dim is SystemDimension.KEEP and same_system:
        rows = _same_system_rows(operands.locations)
        places = _first_ids(operands.locations)
        locations = _location_rows(places, _PLACE)
        facts = _move(operands.facts, places, rows)
        few_places = rows <= _FEW_PLACES
    else:
        keys = _PLACE if system_dim is SystemDimension.KEEP else _PLACE[:3]
        names = [F.col(key) for key in keys]
        seed, rows = _hashed(operands.locations, lambda _: names, lambda s: _key_id(keys, s))
        places = operands.locations.withColumn("place", _key_id(keys, seed))
        locations = _location_rows(places, keys)
        facts = _move(operands.facts, places, rows)
        if keys != _PLACE:
            facts = _sum_places(facts, "thread_id")
        few_places = rows <= _FEW_PLACES
    seed, rows = _hashed(operands.tree, _last_step, lambda s: _path_id(F.col("names"), s))
    nodes = operands.tree.select(
        *_OPERAND, "cnode_id", _path_id(F.col("names"), seed).alias("_path")
    )
    summed = system_dim is not SystemDimension.KEEP
    placed = lookup(
        facts,
        nodes,
        [*_OPERAND, "cnode_id"],
        table_bytes=64.0 * rows,
        spread=["metric", "thread_id"],
        # Sums have a row for each metric and process at most, other facts one for each metric
        # and location: no node is heavy. Cells that are there twice only make a task longer.
        skewed=not (summed or few_places),
    )
    placed = placed.drop("cnode_id").withColumnRenamed("_path", "cnode_id")
    return Aligned(placed, _common_tree(operands.tree, seed), locations, nodes, few_places)


def _combined_metrics(metrics: DataFrame) -> DataFrame:
    """Union of the metrics; attributes and order from the first operand that has one."""
    attributes = ["display_name", "dtype", "uom", "description", "parent_metric"]
    first = F.min_by(F.struct(*attributes, "ord", "_pos"), F.col("ord"))
    return (
        metrics.groupBy("result_id", "metric")
        .agg(first.alias("_first"))
        .select(
            F.col("result_id").alias("experiment_id"),
            "metric",
            *(F.col(f"_first.{a}") for a in attributes),
            (F.col("_first.ord").cast("long") * F.lit(1 << 32) + F.col("_first._pos")).alias("ord"),
        )
    )


def _result(
    operands: Operands, aligned: Aligned, value: Column, pinned: int | None, *, by_node: bool = False
) -> Profile:
    """The profile of ``value`` over the operands' facts.

    ``by_node`` says that only one or two operands have a value for a cell. Nothing is
    gained by combining values before they are moved then, so they are moved by node, as
    the tree is, and later joins with the tree need not move them again.
    """
    from callgrove.profile import Profile

    cells = aligned.facts
    if by_node and aligned.few_places:
        cells = cells.repartition("result_id", "cnode_id")
    facts = (
        cells.groupBy(*_CELL)
        .agg(value.alias("value"))
        .withColumnRenamed("result_id", "experiment_id")
    )
    experiments = (
        operands.metrics.select(F.col("result_id").alias("experiment_id"))
        .distinct()
        .withColumn("wallclock_time", F.lit(None).cast("double"))
    )
    result = Profile(
        experiments,
        _combined_metrics(operands.metrics),
        aligned.locations,
        aligned.tree.drop("depth"),
        facts.select("experiment_id", "metric", "cnode_id", "thread_id", "value"),
        experiment_id=pinned,
    )
    # Its facts come from the operands' locations.
    result._threads_checked = True
    return result


# Difference


def diff(
    minuend: Profile,
    subtrahend: Profile,
    *,
    system_dim: SystemDimension = SystemDimension.KEEP,
) -> Profile:
    """``minuend`` minus ``subtrahend``: positive where the first has more."""
    operands = _from_profiles((minuend, subtrahend))
    return _diff(operands, system_dim, minuend.experiment_id)


def diff_pairs(
    profile: Profile,
    pairs: DataFrame,
    *,
    system_dim: SystemDimension = SystemDimension.KEEP,
) -> Profile:
    """A difference per row ``result_id, minuend, subtrahend`` of experiment ids."""
    return _diff(_from_groups(profile, pair_groups(pairs)), system_dim, None)


def pair_groups(pairs: DataFrame) -> DataFrame:
    sides = F.array(
        *(
            F.struct(F.lit(i).cast("long").alias("ord"), F.col(side).alias("experiment_id"))
            for i, side in enumerate(pairs.columns[1:])
        )
    )
    return pairs.select(F.col(pairs.columns[0]).alias("result_id"), F.inline(sides))


def _diff(operands: Operands, system_dim: SystemDimension, pinned: int | None) -> Profile:
    aligned = _align(operands, system_dim)
    signed = F.when(F.col("ord") == 0, F.col("value")).otherwise(-F.col("value"))
    return _result(operands, aligned, F.sum(signed), pinned, by_node=True)


# Mean


def mean(
    *profiles: Profile, system_dim: SystemDimension = SystemDimension.KEEP
) -> Profile:
    """Cell-wise mean over all operands; a cell an operand lacks counts as 0."""
    _require_two("mean", profiles)
    return _mean(_from_profiles(profiles), system_dim, profiles[0].experiment_id)


def mean_groups(
    profile: Profile,
    groups: DataFrame,
    *,
    system_dim: SystemDimension = SystemDimension.KEEP,
) -> Profile:
    """A mean per ``result_id`` over the rows ``result_id, experiment_id``."""
    # The same experiment may be there more than once, each counts as an operand.
    running = F.row_number().over(Window.partitionBy("result_id").orderBy("experiment_id"))
    ordered = groups.withColumn("ord", running.cast("long"))
    return _mean(_from_groups(profile, ordered), system_dim, None)


def _mean(operands: Operands, system_dim: SystemDimension, pinned: int | None) -> Profile:
    aligned = _align(operands, system_dim)
    return _result(operands, aligned, F.sum("value") / F.max("n"), pinned)


# Merge


def merge(
    *profiles: Profile, system_dim: SystemDimension = SystemDimension.KEEP
) -> Profile:
    """Union of the metrics; a shared metric comes whole from the first that has it."""
    _require_two("merge", profiles)
    return _merge(_from_profiles(profiles), system_dim, profiles[0].experiment_id)


def merge_groups(
    profile: Profile,
    groups: DataFrame,
    *,
    system_dim: SystemDimension = SystemDimension.KEEP,
) -> Profile:
    """A merge per ``result_id`` over the rows ``result_id, ord, experiment_id``."""
    return _merge(_from_groups(profile, groups), system_dim, None)


def _merge(operands: Operands, system_dim: SystemDimension, pinned: int | None) -> Profile:
    owners = operands.metrics.groupBy("result_id", "metric").agg(F.min("ord").alias("ord"))
    chosen = lookup(
        operands.facts,
        owners,
        ["result_id", "metric", "ord"],
        table_bytes=measured_bytes(owners),
        spread=["cnode_id", "thread_id"],
        how="left_semi",
    )
    narrowed = Operands(operands.metrics, operands.locations, operands.tree, chosen)
    return _result(operands, _align(narrowed, system_dim), F.sum("value"), pinned, by_node=True)


def _require_two(name: str, profiles: tuple[Profile, ...]) -> None:
    if len(profiles) < 2:
        raise ValueError(f"{name}() needs at least 2 profiles, got {len(profiles)}")


# Comparison


def cmp(left: Profile, right: Profile, *, rel_tol: float = 0.0) -> CompareResult:
    """Compare metrics, locations, call trees and values of two profiles."""
    return _cmp(_from_profiles((left, right)), rel_tol)


def cmp_pairs(profile: Profile, pairs: DataFrame, *, rel_tol: float = 0.0) -> CompareResult:
    """A comparison per row ``result_id, left, right`` of experiment ids."""
    return _cmp(_from_groups(profile, pair_groups(pairs)), rel_tol)


def _presence(table: DataFrame, kind: str, keys: Sequence[str], item: Column) -> DataFrame:
    """Members of a dimension that only one of the two operands has.

    Members are told apart by their key columns; ``item`` is only what they are called.
    """
    has = [F.max((F.col("ord") == i).cast("double")) for i in (0, 1)]
    return (
        table.groupBy("result_id", *keys)
        .agg(has[0].alias("left"), has[1].alias("right"))
        .where(F.col("left") != F.col("right"))
        .withColumn("item", item)
        .withColumn("kind", F.lit(kind))
    )


def _cmp(operands: Operands, rel_tol: float) -> CompareResult:
    aligned = _align(operands, SystemDimension.KEEP, same_system=False)
    sides = [
        F.coalesce(F.sum(F.when(F.col("ord") == i, F.col("value"))), F.lit(0.0)) for i in (0, 1)
    ]
    left, right = F.col("left"), F.col("right")
    slack = F.greatest(F.abs(left), F.abs(right)) * F.lit(rel_tol)
    # Values that are not finite are equal to themselves only.
    finite = (F.abs(left) < F.lit(math.inf)) & (F.abs(right) < F.lit(math.inf))
    unequal = ~left.eqNullSafe(right) & ~(finite & (F.abs(left - right) <= slack))
    cells = (
        aligned.facts.groupBy(*_CELL)
        .agg(sides[0].alias("left"), sides[1].alias("right"))
        .where(unequal)
    )
    presence = [
        _presence(operands.metrics, "metric", ["metric"], F.col("metric")),
        _presence(operands.locations, "location", _PLACE, _place_label()),
    ]
    # The summary counts rows; names are attached to the details alone.
    lone_nodes = _presence(aligned.nodes, "cnode", ["_path"], F.lit(None).cast("string"))
    counted = cells.select("result_id")
    for rows in [*presence, lone_nodes]:
        counted = counted.unionByName(rows.select("result_id"))
    found = counted.groupBy("result_id").agg(F.count(F.lit(1)).alias("_found"))
    summary = (
        operands.metrics.select("result_id")
        .distinct()
        .join(found, "result_id", "left")
        .select(
            F.col("result_id").alias("experiment_id"),
            F.col("_found").isNull().alias("equal"),
            F.coalesce("_found", F.lit(0).cast("long")).alias("n_diff"),
        )
    )

    paths = aligned.tree.select(
        F.col("experiment_id").alias("result_id"),
        "cnode_id",
        F.array_join("names", "/").alias("_path"),
    )
    places = aligned.locations.select(
        F.col("experiment_id").alias("result_id"), "thread_id", _place_label().alias("_place")
    )
    columns = ["result_id", "kind", "item", "left", "right"]
    details = (
        cells.join(paths, ["result_id", "cnode_id"])
        .join(places, ["result_id", "thread_id"])
        .withColumn("item", F.concat_ws(" @ ", "metric", "_path", "_place"))
        .withColumn("kind", F.lit("value"))
        .select(columns)
    )
    named = lone_nodes.drop("item").withColumnRenamed("_path", "cnode_id")
    named = named.join(paths, ["result_id", "cnode_id"]).withColumnRenamed("_path", "item")
    for rows in [*presence, named]:
        details = details.unionByName(rows.select(columns))
    return CompareResult(summary, details.withColumnRenamed("result_id", "experiment_id"))
