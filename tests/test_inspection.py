from __future__ import annotations

import pytest

from callgrove import Profile, UnknownMetricError
from callgrove.operators import dimensions, inspection
from tests.handmade import handmade_profile


def _by_node(df, column="value"):
    return {r.cnode_id: r[column] for r in df.collect()}


def test_dimensions(profile):
    metrics = profile.metric_tree.collect()
    assert [m.name for m in metrics] == ["time", "visits"]
    assert profile.metric_tree.columns[1:] == [
        "name", "display_name", "dtype", "uom", "description",
    ]
    places = profile.system_tree.collect()
    assert [p.process for p in places] == ["rank 0", "rank 0", "rank 1", "rank 1"]
    nodes = {n.cnode_id: n for n in profile.cnode_tree.collect()}
    assert (nodes[3].file, nodes[3].line) == ("", 0)
    assert nodes[5].parent_id is None
    assert nodes[2].depth == 2


def test_calltree_inclusive(profile):
    rows = profile.calltree("time").collect()
    assert [r.cnode_id for r in rows] == [0, 1, 2, 3, 4, 5]
    assert [r.value for r in rows] == [70.0, 50.0, 10.0, 8.0, 2.0, 0.0]
    assert rows[1].pct == pytest.approx(50 / 70 * 100)
    assert [r.callpath for r in rows] == [
        "USR:/main",
        "USR:/main/work",
        "USR:/main/work/work",
        "MPI:/main/MPI_Send",
        "MPI:/main/MPI_Send",
        "USR:/init",
    ]


def test_calltree_exclusive(profile):
    own = {0: 10.0, 1: 40.0, 2: 10.0, 3: 8.0, 4: 2.0, 5: 0.0}
    assert _by_node(profile.calltree("time", inclusive=False)) == own


def test_calltree_threshold(profile):
    kept = profile.calltree("time", threshold=14.0)
    assert set(_by_node(kept)) == {0, 1, 2}


def test_threshold_keeps_negative_shares(spark):
    less = handmade_profile(spark, metrics={"time": {(0, 0): 10.0, (1, 0): -5.0}})
    assert set(_by_node(less.calltree("time", threshold=50.0))) == {0, 1}


def test_total_of_zero(spark):
    flat = handmade_profile(spark, metrics={"time": {(0, 0): 5.0, (1, 0): -5.0}})
    assert set(_by_node(flat.calltree("time"), "pct").values()) == {0.0}


def test_explicit_path_class_wins(spark, profile):
    marked = Profile(
        profile.experiments,
        profile.metrics,
        profile.locations,
        profile.cnodes.selectExpr(
            "* except (path_class)", "if(cnode_id = 1, 'COM', null) as path_class"
        ),
        profile.facts,
    )
    classes = _by_node(marked.calltree("time"), "path_class")
    assert classes == {0: "USR", 1: "COM", 2: "USR", 3: "MPI", 4: "MPI", 5: "USR"}


def test_info(profile):
    rows = profile.info("visits").collect()
    assert [(r.name, r.value, r.depth) for r in rows][:4] == [
        ("main", 8.0, 0),
        ("work", 3.0, 1),
        ("work", 0.0, 2),
        ("MPI_Send", 4.0, 1),
    ]
    assert {r.metric for r in rows} == {"visits"}


def test_tree_view(profile):
    labels = [r.label for r in inspection.tree_view(profile).collect()]
    assert labels[:3] == ["main", "  work", "    work"]


def test_info_basic(spark, profile):
    row = profile.info_basic().first()
    assert (row.nodes, row.processes, row.wallclock_time) == (1, 2, 33.0)
    timed = handmade_profile(spark, wallclock=12.5)
    assert timed.info_basic().first().wallclock_time == 12.5


def test_values(profile):
    rows = profile.values("visits").collect()
    assert {(r.cnode_id, r.thread_id): r.value for r in rows}[(3, 3)] == 4.0


def test_values_of_unknown_nodes_are_dropped(spark):
    odd = handmade_profile(spark, metrics={"time": {(0, 0): 1.0, (77, 0): 9.0}})
    assert [r.cnode_id for r in odd.values("time").collect()] == [0]


def test_dump_aggregated(profile):
    rows = profile.dump(("time", "visits")).collect()
    assert {r.thread_id for r in rows} == {-1}
    assert {(r.metric, r.cnode_id): r.value for r in rows} == {
        ("time", 0): 10.0, ("time", 1): 40.0, ("time", 2): 10.0, ("time", 3): 8.0,
        ("time", 4): 2.0, ("visits", 0): 1.0, ("visits", 1): 3.0, ("visits", 3): 4.0,
    }
    assert profile.dump().columns == ["experiment_id", "cnode_id", "thread_id", "metric", "value"]


def test_dump_selected(profile):
    rows = profile.dump(("time",), cnodes="0,2-3", threads="1-3").collect()
    assert {(r.cnode_id, r.thread_id): r.value for r in rows} == {
        (0, 1): 2.0, (0, 2): 3.0, (0, 3): 4.0, (2, 1): 5.0, (3, 3): 8.0,
    }


def test_dump_inclusive(profile):
    rows = profile.dump(("time",), cnodes="1", threads="all", z="incl").collect()
    assert {r.thread_id: r.value for r in rows} == {0: 15.0, 1: 5.0, 2: 30.0}


@pytest.mark.parametrize(
    "arguments", [{"z": "both"}, {"cnodes": "1,x"}, {"threads": "5-2"}, {"cnodes": ""}]
)
def test_dump_bad_arguments(profile, arguments):
    with pytest.raises(ValueError):
        profile.dump(("time",), **arguments)


@pytest.mark.parametrize(
    "call",
    [
        lambda p: p.calltree("power"),
        lambda p: p.dump(("time", "power")),
        lambda p: p.stat(("power",)),
        lambda p: p.values("power"),
        lambda p: p.stat(()),
    ],
)
def test_unknown_metric(profile, call):
    with pytest.raises(UnknownMetricError):
        call(profile)


def test_experiments_without_the_metric_are_left_out(spark):
    first = handmade_profile(spark, 1)
    second = handmade_profile(spark, 2, metrics={"bytes": {(0, 0): 4.0}})
    both = Profile(
        *(
            getattr(first, t).unionByName(getattr(second, t))
            for t in ("experiments", "metrics", "locations", "cnodes", "facts")
        )
    )
    assert {r.experiment_id for r in both.calltree("bytes").collect()} == {2}
    assert {r.experiment_id for r in both.stat(("time",)).collect()} == {1}


def test_layout_and_size(profile):
    row = dimensions.layout_summary(profile).first()
    assert (row.processes, row.threads) == (2, 2)
    size = dimensions.tree_size(profile).first()
    assert (size.nodes, size.max_depth) == (6, 2)
