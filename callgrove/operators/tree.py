"""Call-tree operators: root paths, roll-up to inclusive values and back."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrove.errors import TreeError
from callgrove.functions.columns import DEFAULT_CLASS, path_class
from callgrove.plans.lineage import cut, cut_and_observe
from callgrove.plans.lookup import lookup
from callgrove.plans.ranking import number_rows, running_sum

_NODE = ["experiment_id", "cnode_id"]
_PATH = ["ids", "regions", "names"]


def with_paths(cnodes: DataFrame) -> DataFrame:
    """Add ``depth`` and the root-to-node arrays ``ids``, ``regions``, ``names``.

    Paths of the inner nodes are built first, by doubling; a leaf then takes the path of its
    parent and itself.  Most nodes are leaves, so they are moved once, or not at all where
    the inner nodes are few, and not in every round.
    """
    nodes = cut(
        cnodes.select(
            "experiment_id",
            "cnode_id",
            "region_id",
            "region_name",
            "file",
            "line",
            "parent_id",
            "path_class",
        )
    )
    links = nodes.where(F.col("parent_id").isNotNull()).select(
        "experiment_id", F.col("parent_id").alias("cnode_id")
    )
    parents, seen = cut_and_observe(links.distinct(), rows=F.count(F.lit(1)))
    parent_bytes = 32.0 * (seen.get("rows") or 0)
    is_inner = F.coalesce("_inner", F.lit(False))
    marked = lookup(
        nodes,
        parents.withColumn("_inner", F.lit(True)),
        _NODE,
        table_bytes=parent_bytes,
        spread=["region_id", "region_name"],
        how="left",
    )
    inner = cut(marked.where(is_inner).drop("_inner"))
    missing = parents.join(inner.select(*_NODE), _NODE, "left_anti")
    _refuse_dangling(nodes, missing)
    inner = _inner_paths(inner)
    size = inner.agg(F.coalesce(F.sum(F.size("ids") * 48 + 64), F.lit(0))).first()[0]
    return with_depth(
        inner.select(nodes.columns + _PATH).unionByName(
            _leaf_paths(marked.where(~is_inner).drop("_inner"), inner, float(size))
        )
    )


def _refuse_dangling(nodes: DataFrame, missing: DataFrame) -> None:
    if missing.isEmpty():
        return
    above = missing.select(F.col("experiment_id").alias("_experiment"), F.col("cnode_id").alias("_parent"))
    lost = F.col("experiment_id").eqNullSafe(F.col("_experiment")) & (F.col("parent_id") == F.col("_parent"))
    count = nodes.join(above, lost, "left_semi").count()
    raise TreeError(f"{count} call-tree nodes refer to a missing parent")


def _leaf_paths(leaves: DataFrame, inner: DataFrame, inner_bytes: float) -> DataFrame:
    """Paths of nodes without children, from those of their parents."""
    above = inner.select(
        "experiment_id",
        F.col("cnode_id").alias("parent_id"),
        *(F.col(name).alias(f"_{name}") for name in _PATH),
    )
    placed = lookup(
        leaves,
        above,
        ["experiment_id", "parent_id"],
        table_bytes=inner_bytes,
        spread=["cnode_id"],
        how="left",
    )
    own = {"ids": F.col("cnode_id"), "regions": F.col("region_id"), "names": _own_name()}
    joined = {
        name: F.when(F.col("parent_id").isNull(), F.array(step)).otherwise(
            F.concat(F.col(f"_{name}"), F.array(step))
        )
        for name, step in own.items()
    }
    return placed.select(*leaves.columns, *(path.alias(name) for name, path in joined.items()))


def _own_name() -> Column:
    return F.coalesce("region_name", F.lit(""))


def _inner_paths(nodes: DataFrame) -> DataFrame:
    """Nodes whose ancestors are all among them, with their paths.

    Every node starts with a path of itself and a link to its parent.  A round puts
    the path of the linked node in front and takes over its link, which doubles the
    covered distance: a tree of depth d needs log2(d + 1) rounds.  Each round is one
    equi-join, cut from its lineage so that the plan does not double as well.
    """
    state = nodes.select(
        *nodes.columns,
        F.col("parent_id").alias("_link"),
        F.array("cnode_id").alias("ids"),
        F.array("region_id").alias("regions"),
        F.array(_own_name()).alias("names"),
    )
    pending = True
    while pending:
        state, seen = cut_and_observe(
            _double(state),
            pending=F.count_if(F.col("_link").isNotNull()),
            cyclic=F.count_if(_own_ancestor()),
        )
        if seen.get("cyclic"):
            raise TreeError(f"{seen['cyclic']} call-tree nodes are their own ancestors")
        pending = seen.get("pending")
    return state.drop("_link")


def _own_ancestor() -> Column:
    """Whether a node shows up above itself; only an unfinished path can do that."""
    above = F.slice("ids", 1, F.size("ids") - 1)
    return F.col("_link").isNotNull() & F.array_contains(above, F.col("cnode_id"))


def _double(state: DataFrame) -> DataFrame:
    done = state.where(F.col("_link").isNull())
    open_ = state.where(F.col("_link").isNotNull()).alias("open")
    upper = state.select(
        F.col("experiment_id").alias("u_experiment"),
        F.col("cnode_id").alias("u_cnode"),
        F.col("_link").alias("u_link"),
        F.col("ids").alias("u_ids"),
        F.col("regions").alias("u_regions"),
        F.col("names").alias("u_names"),
    )
    joined = open_.join(
        upper,
        (F.col("experiment_id") == F.col("u_experiment")) & (F.col("_link") == F.col("u_cnode")),
    )
    grown = joined.select(
        *(F.col(f"open.{c}") for c in state.columns if c not in ("_link", *_PATH)),
        F.col("u_link").alias("_link"),
        F.concat("u_ids", "ids").alias("ids"),
        F.concat("u_regions", "regions").alias("regions"),
        F.concat("u_names", "names").alias("names"),
    )
    return done.unionByName(grown)


def with_depth(tree: DataFrame) -> DataFrame:
    """Add ``depth``, the number of ancestors."""
    return tree.withColumn("depth", F.size("ids").cast("long") - F.lit(1))


def in_preorder(df: DataFrame) -> DataFrame:
    """Sort so that parents precede children and siblings follow their ids."""
    return df.orderBy("experiment_id", "ids")


def preorder_rows(tree: DataFrame) -> DataFrame:
    """Add ``row_no``, the 0-based pre-order position of a node in its experiment."""
    return number_rows(tree, ["experiment_id"], [F.col("ids")], "row_no")


@dataclass(frozen=True)
class TreeSize:
    """Rows of a call-tree table, the total length of its paths and about how many experiments."""

    nodes: int
    steps: int
    experiments: int = 1

    def bytes(self, per_node: int, per_step: int = 0) -> float:
        """Size of a table with so many bytes per node and per path step."""
        return float(self.nodes * per_node + self.steps * per_step)


def measure(tree: DataFrame) -> TreeSize:
    """Measure a tree with one small job."""
    return TreeSize(
        *tree.agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum(F.size("ids")), F.lit(0)),
            F.approx_count_distinct("experiment_id"),
        ).first()
    )


def roll_up(
    cells: DataFrame,
    tree: DataFrame,
    size: TreeSize,
    onto: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Turn exclusive cell values into inclusive ones.

    ``cells`` holds ``experiment_id, metric, cnode_id[, thread_id], value`` with one
    row per key.  Each cell is charged to every node of its path; the sums are
    combined before the shuffle, so the many cells below one root arrive as one row
    per task.  ``onto`` restricts the nodes that receive values; cells that reach none
    of them are dropped by the join.
    """
    keys = [c for c in cells.columns if c not in ("cnode_id", "value")]
    spread = [c for c in keys if c != "experiment_id"]
    paths = tree.select(*_NODE, "ids")
    if onto is not None:
        paths = paths.withColumn("ids", F.filter("ids", onto)).where(F.size("ids") > 0)
    placed = lookup(cells, paths, _NODE, table_bytes=size.bytes(48, 8), spread=spread)
    # No path is empty.  The outer form keeps Spark from inferring a filter on the path
    # length, which would prune the scan here and so keep other branches from sharing it.
    return (
        placed.select(*keys, F.explode_outer("ids").alias("cnode_id"), "value")
        .groupBy(*keys, "cnode_id")
        .agg(F.sum("value").alias("value"))
        .select(*cells.columns)
    )


def with_intervals(tree: DataFrame) -> DataFrame:
    """``experiment_id, cnode_id, first, last``: pre-order position of a node and of its last descendant."""
    numbered = cut(
        number_rows(tree.select(*_NODE, "ids"), ["experiment_id"], [F.col("ids")], "first")
    )
    last = (
        numbered.select("experiment_id", F.explode("ids").alias("cnode_id"), "first")
        .groupBy(*_NODE)
        .agg(F.max("first").alias("last"))
    )
    return numbered.drop("ids").join(last, _NODE)


def roll_up_by_intervals(cells: DataFrame, intervals: DataFrame, size: TreeSize) -> DataFrame:
    """Inclusive values as differences of running sums, for trees that are very deep.

    The values below a node are those at the pre-order positions of its interval, that is the
    running sum at its end less the one before its beginning.  Each cell is one row and each
    node two for each metric (and thread) of its experiment, however deep the tree is;
    :func:`roll_up` has one row for each cell and ancestor before it combines them.  Sums are
    off by rounding errors relative to the total of the experiment.  Nodes without a value
    below them come out as 0 here.
    """
    keys = [c for c in cells.columns if c not in ("cnode_id", "value")]
    spread = [c for c in keys if c != "experiment_id"]
    placed = lookup(
        cells,
        intervals.select(*_NODE, "first"),
        _NODE,
        table_bytes=size.bytes(40),
        spread=spread,
    )
    nothing = F.lit(None).cast("long")
    values = placed.select(
        *keys, F.col("first").alias("_at"), nothing.alias("cnode_id"), "value", F.lit(0).alias("_sign")
    )
    ends = F.array(
        F.struct((F.col("first") - 1).alias("_at"), F.lit(-1).alias("_sign")),
        F.struct(F.col("last").alias("_at"), F.lit(1).alias("_sign")),
    )
    groups = cells.select(*keys).distinct()
    borders = groups.join(
        intervals.select("experiment_id", "cnode_id", F.inline(ends)), "experiment_id"
    ).select(*keys, "_at", "cnode_id", F.lit(None).cast("double").alias("value"), "_sign")
    # At equal positions a value comes before the borders that enclose it.
    order = [F.col("_at"), F.col("cnode_id").asc_nulls_first(), F.col("_sign")]
    summed = running_sum(values.unionByName(borders), keys, order, "value", "_sum")
    return (
        summed.where("_sign <> 0")
        .groupBy(*keys, "cnode_id")
        .agg(F.sum(F.col("_sign") * F.col("_sum")).alias("value"))
        .select(*cells.columns)
    )


def combined_classes(tree: DataFrame) -> DataFrame:
    """``experiment_id, cnode_id, path_class`` where paths down to MPI or OpenMP are ``COM``.

    A stored class stays; a path that is user code by its name becomes ``COM`` if a node
    below it is MPI or OpenMP.  Such nodes flag all nodes of their path, which is one
    aggregation, combined before the shuffle.
    """
    cls = path_class(F.col("path_class"), F.col("region_name"))
    classed = tree.select(*_NODE, "ids", F.col("path_class").alias("_stored"), cls.alias("path_class"))
    flagged = (
        classed.where(F.col("path_class").isin("MPI", "OMP"))
        .select("experiment_id", F.explode("ids").alias("cnode_id"))
        .distinct()
        .withColumn("_below", F.lit(True))
    )
    plain = F.col("_stored").isNull() & (F.col("path_class") == DEFAULT_CLASS)
    return classed.join(flagged, _NODE, "left").select(
        *_NODE,
        F.when(plain & F.col("_below"), F.lit("COM")).otherwise(F.col("path_class")).alias("path_class"),
    )


def self_values(inclusive: DataFrame, tree: DataFrame, size: TreeSize) -> DataFrame:
    """Turn inclusive values into exclusive ones: subtract the children.

    Each value counts for its node and, negated, for its parent; one aggregation
    over both contributions replaces a join of every node with its children.
    """
    keys = [c for c in inclusive.columns if c not in ("cnode_id", "value")]
    spread = [c for c in keys if c != "experiment_id"]
    parents = tree.select(*_NODE, "parent_id")
    linked = lookup(inclusive, parents, _NODE, table_bytes=size.bytes(40), spread=spread)
    charged = F.array(
        F.struct(F.col("cnode_id").alias("node"), F.col("value").alias("part")),
        F.struct(F.col("parent_id").alias("node"), (-F.col("value")).alias("part")),
    )
    return (
        linked.select(*keys, F.inline(charged))
        .where(F.col("node").isNotNull())
        .groupBy(*keys, F.col("node").alias("cnode_id"))
        .agg(F.sum("part").alias("value"))
        .select(*inclusive.columns)
    )

