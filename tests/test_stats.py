from __future__ import annotations

import pytest

from callgrove.operators import analysis
from callgrove.plans import lookup as lookup_module
from tests.handmade import handmade_profile


_KNOWN: dict = {}


def _stats(profile, **options):
    key = (id(profile), repr(options))
    if key not in _KNOWN:
        _KNOWN[key] = {r.routine: r for r in profile.stat(("time",), **options).collect()}
    return _KNOWN[key]


def test_columns(profile):
    assert profile.stat().columns == [
        "experiment_id", "metric", "routine", "region_id", "count", "sum", "mean", "variance",
        "minimum", "maximum",
    ]


def test_every_routine_twice(profile):
    names = {"main", "work", "MPI_Send", "init"}
    assert set(_stats(profile)) == {f"{k}({n})" for n in names for k in ("INCL", "EXCL")}


def test_inclusive_main(profile):
    row = _stats(profile)["INCL(main)"]
    assert (row["count"], row["sum"], row["mean"], row["minimum"], row["maximum"]) == (
        4, 70.0, 17.5, 7.0, 33.0,
    )
    assert row.variance == pytest.approx(127.0)


def test_recursion_counts_once_and_absent_threads_are_zero(profile):
    for label in ("INCL(work)", "EXCL(work)"):
        row = _stats(profile)[label]
        assert (row["count"], row["sum"], row["minimum"], row["maximum"]) == (4, 50.0, 0.0, 30.0)
        assert row.variance == pytest.approx(175.0)


def test_siblings_of_one_region_add_up(profile):
    row = _stats(profile)["EXCL(MPI_Send)"]
    assert row["sum"] == 10.0
    assert row.variance == pytest.approx(43.0 / 3)


def test_population_variance(profile):
    assert _stats(profile, ddof=0)["INCL(work)"].variance == pytest.approx(131.25)


def test_routine_without_values(profile):
    row = _stats(profile)["INCL(init)"]
    assert (row["count"], row["sum"], row["mean"], row["variance"]) == (4, 0.0, 0.0, 0.0)
    assert (row["minimum"], row["maximum"]) == (0.0, 0.0)


def test_routine_filter(profile):
    assert set(_stats(profile, routines=["work"])) == {"INCL(work)", "EXCL(work)"}
    assert len(_stats(profile, routines=[])) == 8


def test_quartiles(profile):
    rows = _stats(profile, quartiles=True)
    work = rows["INCL(work)"]
    assert (work.quartile_25, work["median"], work.quartile_75) == (3.75, 10.0, 18.75)
    main = rows["EXCL(main)"]
    assert (main.quartile_25, main["median"], main.quartile_75) == (1.75, 2.5, 3.25)
    init = rows["EXCL(init)"]
    assert (init.quartile_25, init["median"], init.quartile_75) == (0.0, 0.0, 0.0)


def test_quartiles_with_negative_values(spark):
    from tests.handmade import handmade_profile

    cells = {(0, 0): -4.0, (0, 3): 8.0}
    rows = _stats(handmade_profile(spark, metrics={"time": cells}), quartiles=True)
    main = rows["EXCL(main)"]
    # sample: -4, 0, 0, 8
    assert (main.quartile_25, main["median"], main.quartile_75) == (-1.0, 0.0, 2.0)
    assert (main["minimum"], main["maximum"]) == (-4.0, 8.0)


def test_flat_profile(profile):
    rows = profile.stat(top_n=2).collect()
    assert [(r.routine, r["count"], r["sum"]) for r in rows] == [("work", 3, 50.0), ("main", 1, 10.0)]
    assert rows[0]["mean"] is None
    assert profile.stat(top_n=0).count() == 0


def test_error_bars(profile):
    rows = {r.routine: r for r in analysis.inclusive_error_bars(profile).collect()}
    assert set(rows) == {"main", "work", "MPI_Send", "init"}
    assert (rows["work"].err_low, rows["work"].err_high) == (12.5, 17.5)


def test_top_self_time(profile):
    rows = analysis.top_self_time(profile, 3).collect()
    assert [(r.name, r.value, r.label) for r in rows] == [
        ("work", 10.0, "user code"),
        ("main", 10.0, "user code"),
        ("work", 40.0, "user code"),
    ]


def test_hottest_threads(profile):
    rows = analysis.hottest_node_threads(profile).collect()
    assert [(r.cnode_id, r.thread_id, r.name, r.value) for r in rows] == [
        (1, 0, "work", 10.0),
        (1, 2, "work", 30.0),
    ]


def test_imbalance(profile):
    rows = analysis.thread_imbalance(profile, 2).collect()
    assert {r.cnode_id for r in rows} == {0, 1}
    assert {r.mean_value for r in rows if r.cnode_id == 0} == {2.5}
    assert {r.imbalance for r in rows if r.cnode_id == 0} == {1.6}
    restricted = analysis.thread_imbalance(profile, 2, threads="1")
    assert {(r.cnode_id, r.value) for r in restricted.collect()} == {(0, 2.0)}


def test_salted_lookups_give_the_same(profile, monkeypatch):
    def everything():
        return [
            sorted(profile.calltree("time").collect()),
            sorted(profile.dump(("time",), threads="all", z="incl").collect()),
            sorted(profile.values("time").collect()),
            sorted(profile.stat(("time",)).collect()),
            sorted(analysis.thread_imbalance(profile, 2).collect()),
        ]

    broadcast = everything()
    monkeypatch.setattr(lookup_module, "BROADCAST_BYTES", -1)
    assert everything() == broadcast


def test_statistics_per_thread(profile):
    rows = {(r.routine, r.thread_id): r for r in profile.stat(per_thread=True).collect()}
    # EXCL(work) on thread 0: nodes 1 and 2 with 10 and 5; INCL: the outermost node alone.
    own = rows["EXCL(work)", 0]
    assert (own["count"], own["sum"], own["mean"], own.variance) == (2, 15.0, 7.5, 12.5)
    assert (own.minimum, own.maximum) == (5.0, 10.0)
    all_ = rows["INCL(work)", 0]
    assert (all_["count"], all_["sum"], all_.variance) == (1, 15.0, None)
    # Two nodes of MPI_Send, one of them without a value on thread 3.
    send = rows["EXCL(MPI_Send)", 3]
    assert (send["count"], send["sum"], send.minimum, send.maximum) == (2, 8.0, 0.0, 8.0)
    assert rows["INCL(main)", 2]["sum"] == 33.0
    # Thread 2 has no value of MPI_Send, init has none at all.
    assert ("EXCL(MPI_Send)", 2) not in rows and not any("init" in name for name, _ in rows)


def test_statistics_per_thread_of_some_routines(profile):
    rows = profile.stat(("time", "visits"), ("work",), per_thread=True, ddof=0).collect()
    assert {r.routine for r in rows} == {"INCL(work)", "EXCL(work)"}
    assert {r.metric for r in rows} == {"time", "visits"}
    with pytest.raises(ValueError, match="per_thread"):
        profile.stat(top_n=3, per_thread=True)


@pytest.mark.parametrize("rank_error", [0.05, 0.01])
def test_sketched_quartiles_keep_their_rank_error(spark, rank_error):
    """4000 threads of which 1000 have no value; a fifth of the values is negative."""
    import numpy as np

    random = np.random.default_rng(3)
    values = {(0, t): float(v) for t, v in enumerate(random.normal(1.0, 1.2, 3000))}
    profile = handmade_profile(spark, metrics={"time": values}, threads=tuple(range(4000)))
    row = profile.stat(("time",), ("main",), quartiles=True, rank_error=rank_error).where("routine = 'EXCL(main)'").first()
    sample = np.sort(np.concatenate([list(values.values()), np.zeros(1000)]))
    for share, found in ((0.25, row.quartile_25), (0.5, row.median), (0.75, row.quartile_75)):
        wanted = int((len(sample) - 1) * share)
        low, high = np.searchsorted(sample, found), np.searchsorted(sample, found, side="right") - 1
        distance = 0 if low <= wanted <= high else min(abs(low - wanted), abs(high - wanted))
        assert distance <= rank_error * 3000
    exact = profile.stat(("time",), ("main",)).where("routine = 'EXCL(main)'").first()
    assert (row["count"], row["sum"]) == (4000, pytest.approx(exact["sum"]))


def test_sketched_quartiles_take_no_checkpoint(spark, profile):
    rows = profile.stat(quartiles=True, rank_error=0.05)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan.split("kll_sketch_agg")[1].split("Union")[0]
    small = {r.routine: r for r in rows.collect()}
    assert small["EXCL(init)"].median == 0.0
    assert small["EXCL(main)"].quartile_25 == 1.0
    with pytest.raises(ValueError, match="rank_error"):
        profile.stat(quartiles=True, rank_error=1.5)


def test_quartiles_by_arrays_and_by_ranks_are_the_same(spark, profile, monkeypatch):
    """Samples of few locations take no distributed sort; larger ones agree with them."""
    from callgrove.operators import stats

    values = [(1, 0, 0, -3.0), (1, 0, 1, -1.0), (1, 1, 2, 5.0), (1, 2, 3, None), (1, 2, 0, 2.0)]
    rows = [(e, "time", node, thread, value) for e, node, thread, value in values]
    mixed = type(profile)(
        profile.experiments, profile.metrics, profile.locations, profile.cnodes,
        spark.createDataFrame(rows, profile.facts.schema),
    )
    columns = ["routine", "count", "quartile_25", "median", "quartile_75"]

    def quartiles():
        found = mixed.stat(("time",), quartiles=True).select(columns).collect()
        return sorted((tuple(row) for row in found), key=str)

    monkeypatch.setattr(stats, "number_rows", None)
    by_arrays = quartiles()
    monkeypatch.undo()
    monkeypatch.setattr(stats, "_SORTED_LOCATIONS", 0)
    assert by_arrays == quartiles()
