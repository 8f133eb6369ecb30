from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from callgrove import Profile, SystemDimension, SystemMismatchError
from callgrove.operators import algebra, analysis
from callgrove.plans import lookup as lookup_module
from tests.handmade import NODES, TIME, VISITS, handmade_profile

OTHER_TIME = {(0, 0): 4.0, (0, 3): 1.0, (1, 0): 10.0, (5, 1): 6.0}


@pytest.fixture(scope="module")
def other(spark):
    """The same locations; no second nested ``work``, but a new ``solve``."""
    nodes = [n for n in NODES if n[0] != 2] + [(6, 14, "solve", "s.f90", 1, 1)]
    times = {**OTHER_TIME, (6, 2): 7.0}
    return handmade_profile(spark, 2, metrics={"time": times}, nodes=nodes)


def _cells(profile, metric="time"):
    paths = profile.tree.select("experiment_id", "cnode_id", F.array_join("names", "/").alias("p"))
    places = profile.locations.select("experiment_id", "thread_id", "process", "thread")
    rows = (
        profile.facts.where(F.col("metric") == metric)
        .join(paths, ["experiment_id", "cnode_id"])
        .join(places, ["experiment_id", "thread_id"])
        .collect()
    )
    return {(r.p, r.process, r.thread): r.value for r in rows if r.value}


def test_diff(profile, other):
    delta = profile.diff(other)
    assert _cells(delta) == {
        ("main", "rank 0", "thread 0"): -3.0,
        ("main", "rank 0", "thread 1"): 2.0,
        ("main", "rank 1", "thread 0"): 3.0,
        ("main", "rank 1", "thread 1"): 3.0,
        ("main/work", "rank 1", "thread 0"): 30.0,
        ("main/work/work", "rank 0", "thread 0"): 5.0,
        ("main/work/work", "rank 0", "thread 1"): 5.0,
        ("main/MPI_Send", "rank 1", "thread 1"): 8.0,
        ("main/MPI_Send", "rank 0", "thread 0"): 2.0,
        ("init", "rank 0", "thread 1"): -6.0,
        ("main/work/solve", "rank 1", "thread 0"): -7.0,
    }
    assert delta.pinned


def test_diff_is_a_profile_again(profile, other):
    rows = profile.diff(other).calltree("time").collect()
    values = {r.callpath: r.value for r in rows}
    assert values["USR:/main"] == 70.0 - 22.0
    assert values["USR:/init"] == -6.0
    assert values["USR:/main/work/solve"] == -7.0
    depths = {r.callpath: r.depth for r in rows}
    assert depths["USR:/main/work/work"] == 2
    assert len(rows) == 6


def test_diff_with_itself_is_zero(profile):
    delta = profile.diff(profile)
    assert delta.facts.where("value <> 0").isEmpty()
    assert delta.tree.count() == 5  # equal siblings share a path


def test_diff_is_antisymmetric(profile, other):
    forth, back = _cells(profile.diff(other)), _cells(other.diff(profile))
    assert forth == {k: -v for k, v in back.items()}


def test_nested_results(profile, other):
    average = Profile.mean(profile, other)
    twice = Profile.mean(average, average)
    assert _cells(twice) == _cells(average)
    restored = Profile.mean(profile, other).diff(Profile.mean(other, profile))
    assert _cells(restored) == {}


def test_mean_counts_absent_cells_as_zero(profile, other):
    cells = _cells(Profile.mean(profile, other))
    assert cells[("main", "rank 0", "thread 0")] == 2.5
    assert cells[("main/work", "rank 1", "thread 0")] == 15.0
    assert cells[("main/work/solve", "rank 1", "thread 0")] == 3.5
    three = _cells(Profile.mean(profile, profile, other))
    assert three[("main", "rank 0", "thread 0")] == pytest.approx(2.0)


def test_mean_of_itself(profile):
    assert _cells(Profile.mean(profile, profile)) == _cells(profile.diff(profile.diff(profile)))


def test_merge_prefers_the_first(spark, profile):
    more = handmade_profile(spark, 2, metrics={"visits": {(0, 0): 99.0}, "bytes": {(1, 1): 3.0}})
    merged = Profile.merge(profile, more)
    assert _cells(merged, "visits")[("main", "rank 0", "thread 0")] == 1.0
    assert _cells(merged, "bytes") == {("main/work", "rank 0", "thread 1"): 3.0}
    assert [m.name for m in merged.metric_tree.collect()] == ["time", "visits", "bytes"]
    swapped = Profile.merge(more, profile)
    assert _cells(swapped, "visits") == {("main", "rank 0", "thread 0"): 99.0}


@pytest.mark.parametrize("operation", ["merge", "mean"])
@pytest.mark.parametrize("count", [0, 1])
def test_arity(profile, operation, count):
    with pytest.raises(ValueError, match=rf"{operation}\(\)"):
        getattr(Profile, operation)(*[profile] * count)


@pytest.fixture(scope="module")
def smaller(spark):
    return handmade_profile(spark, 3, threads=(0, 2))


def test_keep_needs_equal_systems(profile, smaller):
    with pytest.raises(SystemMismatchError, match="rank 0/thread 1"):
        profile.diff(smaller)
    with pytest.raises(SystemMismatchError):
        Profile.mean(smaller, profile)


def test_reduce_sums_threads_of_a_process(profile, smaller):
    delta = profile.diff(smaller, SystemDimension.REDUCE)
    assert _cells(delta) == {
        ("main", "rank 0", "all"): 2.0,
        ("main", "rank 1", "all"): 4.0,
        ("main/work/work", "rank 0", "all"): 5.0,
        ("main/MPI_Send", "rank 1", "all"): 8.0,
    }
    assert delta.locations.count() == 2


def test_collapse_leaves_one_location(profile, smaller):
    delta = profile.diff(smaller, SystemDimension.COLLAPSE)
    assert _cells(delta) == {
        ("main", "all", "all"): 6.0,
        ("main/work/work", "all", "all"): 5.0,
        ("main/MPI_Send", "all", "all"): 8.0,
    }
    assert delta.locations.count() == 1


def test_collapse_commutes_with_diff(profile, other):
    late = profile.diff(other).facts.groupBy("metric").agg(F.sum("value").alias("v"))
    early = profile.diff(other, SystemDimension.COLLAPSE).facts.groupBy("metric").agg(
        F.sum("value").alias("v")
    )
    assert sorted(late.collect()) == sorted(early.collect())


def test_cmp_equal(spark, profile):
    result = profile.cmp(handmade_profile(spark, 9))
    assert result.equal
    assert result.details.isEmpty()
    assert result.summary.first().n_diff == 0


def test_cmp_lists_every_difference(profile, other):
    result = profile.cmp(other)
    assert not result.equal
    found = {(r.kind, r.item): (r.left, r.right) for r in result.details.collect()}
    assert found[("metric", "visits")] == (1.0, 0.0)
    assert found[("cnode", "main/work/solve")] == (0.0, 1.0)
    assert found[("cnode", "main/work/work")] == (1.0, 0.0)
    assert found[("value", "time @ main @ cluster/node 0/rank 0/thread 0")] == (1.0, 4.0)
    assert not any(kind == "location" for kind, _ in found)
    assert len(found) == 3 + 11 + len(VISITS)


def test_cmp_of_different_systems(profile, smaller):
    kinds = [r.kind for r in profile.cmp(smaller).details.collect()]
    assert kinds.count("location") == 2


def test_cmp_tolerance(spark, profile):
    near = handmade_profile(
        spark, 4, metrics={"time": {k: v * (1 + 1e-9) for k, v in TIME.items()}, "visits": VISITS}
    )
    assert not profile.cmp(near).equal
    assert profile.cmp(near, rel_tol=1e-6).equal


def test_explicit_zero_equals_absent(spark, profile):
    padded = handmade_profile(
        spark, 4, metrics={"time": {**TIME, (5, 0): 0.0}, "visits": VISITS}
    )
    assert profile.cmp(padded).equal


@pytest.fixture(scope="module")
def both(profile, other):
    tables = ("experiments", "metrics", "locations", "cnodes", "facts")
    return Profile(*(getattr(profile, t).unionByName(getattr(other, t)) for t in tables))


def test_batches_equal_single_operations(spark, profile, other, both):
    pairs = spark.createDataFrame([(7, 1, 2), (8, 2, 1)], "result_id long, a long, b long")
    deltas = algebra.diff_pairs(both, pairs)
    assert _cells(deltas.experiment(7)) == _cells(profile.diff(other))
    assert _cells(deltas.experiment(8)) == _cells(other.diff(profile))
    groups = spark.createDataFrame([(5, 1), (5, 2)], "result_id long, experiment_id long")
    assert _cells(algebra.mean_groups(both, groups)) == _cells(Profile.mean(profile, other))
    ordered = spark.createDataFrame(
        [(5, 1, 2), (5, 0, 1)], "result_id long, ord long, experiment_id long"
    )
    merged = algebra.merge_groups(both, ordered)
    assert _cells(merged, "visits") == _cells(Profile.merge(profile, other), "visits")
    summary = algebra.cmp_pairs(both, pairs).summary.collect()
    assert {(r.experiment_id, r.equal) for r in summary} == {(7, False), (8, False)}


def test_collections_are_combined_by_experiment(both):
    delta = both.diff(both)
    assert delta.facts.where("value <> 0").isEmpty()
    assert {r.experiment_id for r in delta.experiments.collect()} == {1, 2}


def test_salted_lookups_give_the_same(spark, profile, other, both, monkeypatch):
    pairs = spark.createDataFrame([(7, 1, 2)], "result_id long, a long, b long")
    broadcast = (_cells(profile.diff(other)), _cells(algebra.diff_pairs(both, pairs)))
    monkeypatch.setattr(lookup_module, "BROADCAST_BYTES", -1)
    assert (_cells(profile.diff(other)), _cells(algebra.diff_pairs(both, pairs))) == broadcast


def test_clashing_ids_are_hashed_anew(profile, other, monkeypatch):
    expected = _cells(profile.diff(other))
    real = algebra.hash_id

    def weak(first, *rest):
        strong = real(first, *rest)
        seeded = bool(rest)
        return F.when(first == 0, F.lit(1).cast("long")).otherwise(strong) if seeded else strong

    monkeypatch.setattr(algebra, "hash_id", weak)
    assert _cells(profile.diff(other)) == expected


def test_top_changes(profile, other):
    delta = profile.diff(other, SystemDimension.COLLAPSE)
    rows = analysis.top_changes(delta, 3).collect()
    assert [(r.callpath, r.value) for r in rows] == [
        ("MPI:/main/MPI_Send", 10.0),
        ("USR:/main/work", 33.0),
        ("USR:/main", 48.0),
    ]


def test_output_dir(profile, other, tmp_path):
    target = str(tmp_path / "delta")
    stored = profile.diff(other, output_dir=target)
    assert _cells(stored) == _cells(profile.diff(other))
    with pytest.raises(Exception, match="already exists"):
        profile.diff(other, output_dir=target)


def test_batches_read_the_experiments_that_they_name(spark, tmp_path):
    parts = [handmade_profile(spark, i) for i in range(1, 8)]
    frames = {}
    for name in ("experiments", "metrics", "locations", "cnodes", "facts"):
        frames[name] = getattr(parts[0], name)
        for part in parts[1:]:
            frames[name] = frames[name].unionByName(getattr(part, name))
    stored = Profile(**frames).write(str(tmp_path / "seven"))
    pairs = spark.createDataFrame([(1, 2, 5)], "result_id long, minuend long, subtrahend long")
    delta = algebra.diff_pairs(stored, pairs)
    plan = delta.facts._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "experiment_id" in line]
    assert any("experiment_id" in line and "IN (2,5)" in line for line in filters)
    assert delta.facts.where("value <> 0").isEmpty()


def test_wide_tree_rows_are_not_sorted_where_they_are_read(profile, other):
    """They are moved by id first, so a task sorts a shuffle partition and not a file split."""
    tree = profile.diff(other).tree
    plan = tree._jdf.queryExecution().executedPlan().toString().splitlines()
    at = [i for i, line in enumerate(plan) if "SortAggregate" in line]
    moved = [i for i, line in enumerate(plan) if "Exchange" in line]
    assert at and moved and max(at) < min(moved)


def test_summaries_move_no_names(profile, other):
    """Nodes of one operand alone are counted by id; their names are for the details."""
    result = profile.cmp(other)
    plan = result.summary._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert keys and not any("names" in line for line in keys)
    named = result.details.where("kind = 'cnode'").collect()
    assert all(row["item"] for row in named)
    assert result.summary.first().n_diff == result.details.count()


def test_few_locations_need_no_search_for_heavy_nodes(profile, other, monkeypatch):
    want = [_cells(p) for p in (profile.merge(profile, other), profile.diff(other))]
    searched = []
    heavy = lookup_module.heavy_keys
    monkeypatch.setattr(lookup_module, "heavy_keys", lambda big, on: searched.append(on) or heavy(big, on))
    monkeypatch.setattr(lookup_module, "BROADCAST_BYTES", 0)
    assert [_cells(p) for p in (profile.merge(profile, other), profile.diff(other))] == want
    assert not [on for on in searched if "cnode_id" in on]
    monkeypatch.setattr(algebra, "_FEW_PLACES", 1)
    assert [_cells(p) for p in (profile.merge(profile, other), profile.diff(other))] == want
    assert [on for on in searched if "cnode_id" in on]


def test_values_are_moved_by_node_alone(profile, other):
    """The tree is dealt by node too, so a join of the two moves neither again."""
    for result in (profile.merge(profile, other), profile.diff(other)):
        plan = result.facts._jdf.queryExecution().executedPlan().toString()
        moves = [line for line in plan.splitlines() if "Exchange hashpartitioning(result_id" in line]
        assert moves
        assert not [line for line in moves if "cnode_id" in line and "metric#" in line]
