from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from callgrove import TreeError, model
from callgrove.operators import tree
from tests.handmade import NODES, handmade_profile


def _chain(spark, length, experiment_id=1):
    rows = [
        (experiment_id, i, i, f"f{i}", None, None, i - 1 if i else None, None)
        for i in range(length)
    ]
    return spark.createDataFrame(rows, model.CNODES)


def test_paths_of_the_handmade_tree(profile):
    rows = {r.cnode_id: r for r in profile.tree.collect()}
    assert {k: r.depth for k, r in rows.items()} == {0: 0, 1: 1, 2: 2, 3: 1, 4: 1, 5: 0}
    assert rows[2].ids == [0, 1, 2]
    assert rows[2].regions == [10, 11, 11]
    assert rows[2].names == ["main", "work", "work"]


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5, 37])
def test_deep_chain(spark, length):
    paths = tree.with_paths(_chain(spark, length))
    rows = {r.cnode_id: r for r in paths.collect()}
    assert len(rows) == length
    for i in range(length):
        assert rows[i].ids == list(range(i + 1))
        assert rows[i].depth == i


def test_same_ids_in_several_experiments(spark):
    both = _chain(spark, 3, 1).unionByName(_chain(spark, 5, 2))
    depth = tree.with_paths(both).groupBy("experiment_id").agg(F.max("depth").alias("d"))
    assert {r.experiment_id: r.d for r in depth.collect()} == {1: 2, 2: 4}


def test_no_nodes(spark):
    assert tree.with_paths(_chain(spark, 0)).count() == 0


def test_dangling_parent(spark):
    rows = [(1, 0, 0, "a", None, None, None, None), (1, 1, 1, "b", None, None, 99, None)]
    with pytest.raises(TreeError, match="missing parent"):
        tree.with_paths(spark.createDataFrame(rows, model.CNODES))


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_cycle(spark, length):
    rows = [
        (1, i, i, "a", None, None, (i + 1) % length, None) for i in range(length)
    ] + [(1, 50, 50, "below", None, None, 0, None)]
    with pytest.raises(TreeError, match="own ancestors"):
        tree.with_paths(spark.createDataFrame(rows, model.CNODES))


def test_preorder_numbers(profile):
    rows = tree.preorder_rows(profile.tree).orderBy("row_no").collect()
    assert [r.cnode_id for r in rows] == [0, 1, 2, 3, 4, 5]
    assert [r.row_no for r in rows] == list(range(6))


def test_roll_up_and_back(profile):
    cells = profile.facts.where("metric = 'time'")
    rolled = tree.roll_up(cells, profile.tree, profile.tree_size)
    root = {r.thread_id: r.value for r in rolled.where("cnode_id = 0").collect()}
    assert root == {0: 18.0, 1: 7.0, 2: 33.0, 3: 12.0}
    back = tree.self_values(rolled, profile.tree, profile.tree_size).where("value <> 0")
    expected = {(r.cnode_id, r.thread_id): r.value for r in cells.collect()}
    assert {(r.cnode_id, r.thread_id): r.value for r in back.collect()} == expected


def test_roots_hold_everything(profile):
    rolled = tree.roll_up(profile.facts, profile.tree, profile.tree_size)
    roots = profile.tree.where("parent_id is null").select("experiment_id", "cnode_id")
    top = rolled.join(roots, ["experiment_id", "cnode_id"]).groupBy("metric").agg(
        F.sum("value").alias("v")
    )
    own = profile.facts.groupBy("metric").agg(F.sum("value").alias("v"))
    assert sorted(top.collect()) == sorted(own.collect())


def test_node_order_in_the_table_does_not_matter(spark):
    shuffled = handmade_profile(spark, nodes=list(reversed(NODES)))
    rows = {r.cnode_id: r.ids for r in shuffled.tree.collect()}
    assert rows[2] == [0, 1, 2]


def _comb(spark, depth: int):
    """A path of that depth with a leaf at every node."""
    nodes = [(i, i, f"f{i}", None, None, i - 1 if i else None) for i in range(depth)]
    nodes += [(1000 + i, 1000, "leaf", None, None, i) for i in range(depth)]
    values = {(i, i % 3): float(i + 1) for i in range(depth)} | {(1000 + i, 0): 0.5 for i in range(depth)}
    return handmade_profile(spark, metrics={"time": values}, nodes=nodes)


@pytest.mark.parametrize("depth", [1, 40])
def test_intervals_give_the_sums_of_paths(spark, depth):
    profile = _comb(spark, depth)
    nodes = tree.with_intervals(profile.tree)
    for keys in (["experiment_id", "metric"], ["experiment_id", "metric", "thread_id"]):
        cells = profile.facts.groupBy(*keys, "cnode_id").agg(F.sum("value").alias("value"))
        cells = cells.select(*keys, "cnode_id", "value")
        wanted = {
            tuple(r[k] for k in (*keys, "cnode_id")): r.value
            for r in tree.roll_up(cells, profile.tree, profile.tree_size).collect()
        }
        found = tree.roll_up_by_intervals(cells, nodes, profile.tree_size).collect()
        for r in found:
            assert r.value == pytest.approx(wanted.get(tuple(r[k] for k in (*keys, "cnode_id")), 0.0), abs=1e-9)
        assert len(found) >= len(wanted)


def test_intervals_hold_the_descendants(profile):
    spans = {r.cnode_id: (r.first, r["last"]) for r in tree.with_intervals(profile.tree).collect()}
    assert spans == {0: (0, 4), 1: (1, 2), 2: (2, 2), 3: (3, 3), 4: (4, 4), 5: (5, 5)}


def test_combined_classes(spark, profile):
    found = {r.cnode_id: r.path_class for r in tree.combined_classes(profile.tree).collect()}
    assert found == {0: "COM", 1: "USR", 2: "USR", 3: "MPI", 4: "MPI", 5: "USR"}
    stored = profile.tree.withColumn("path_class", F.when(F.col("cnode_id") == 0, F.lit("USR")))
    assert {r.path_class for r in tree.combined_classes(stored).where("cnode_id = 0").collect()} == {"USR"}
    rows = {r.cnode_id: r.callpath for r in profile.calltree(combined=True).collect()}
    assert rows[0] == "COM:/main" and rows[3] == "MPI:/main/MPI_Send"


def test_leaves_take_no_part_in_the_doubling(spark, monkeypatch):
    """A root with a hundred leaves: the rounds see the root alone."""
    rows = [(1, 0, 0, "main", None, None, None, None)]
    rows += [(1, i, i, f"f{i}", None, None, 0, None) for i in range(1, 101)]
    seen = []
    double = tree._double
    monkeypatch.setattr(tree, "_double", lambda state: seen.append(state.count()) or double(state))
    paths = tree.with_paths(spark.createDataFrame(rows, model.CNODES))
    assert {(r.cnode_id, tuple(r.names)) for r in paths.collect()} == {
        (0, ("main",)),
        *((i, ("main", f"f{i}")) for i in range(1, 101)),
    }
    assert seen == [1]


def test_dangling_nodes_of_a_null_experiment_count(spark):
    rows = [(None, 0, 0, "a", None, None, None, None), (None, 1, 1, "b", None, None, 0, None)]
    with pytest.raises(TreeError, match="1 call-tree nodes refer to a missing parent"):
        tree.with_paths(spark.createDataFrame(rows, model.CNODES))
