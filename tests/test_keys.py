"""Missing names, unknown keys and values that are not finite."""

from __future__ import annotations

import math
import shutil

import pytest
from pyspark.sql import functions as F

from callgrove import Profile, SystemDimension
from callgrove.errors import KeyCheckError, UnknownExperimentError
from callgrove.operators import algebra
from callgrove.sources import reports
from tests.handmade import TIME, handmade_profile


def _with(profile: Profile, **tables) -> Profile:
    names = ["experiments", "metrics", "locations", "cnodes", "facts"]
    frames = {name: tables.get(name, getattr(profile, name)) for name in names}
    return Profile(**frames, experiment_id=profile.experiment_id)


def _nameless(spark, experiment_id: int) -> Profile:
    profile = handmade_profile(spark, experiment_id)
    return _with(profile, locations=profile.locations.withColumn("machine", F.lit(None).cast("string")))


def test_places_without_a_name_keep_their_cells(spark):
    a, b = _nameless(spark, 1), _nameless(spark, 2)
    assert Profile.mean(a, b).facts.count() == a.facts.count()
    zero = Profile.diff(a, b)
    assert zero.facts.count() == a.facts.count()
    assert zero.facts.where("value <> 0").count() == 0
    assert Profile.cmp(a, b).summary.first().equal


def test_place_without_a_name_differs_from_a_named_one(spark):
    a, b = _nameless(spark, 1), handmade_profile(spark, 2)
    kinds = {r.kind for r in Profile.cmp(a, b).details.collect()}
    assert "location" in kinds


def _two(spark, values) -> tuple[Profile, Profile]:
    return tuple(
        handmade_profile(spark, i, metrics={"time": {(0, 0): v}}) for i, v in enumerate(values, 1)
    )


@pytest.mark.parametrize("tolerance", [0.0, 0.5])
@pytest.mark.parametrize(
    ("left", "right", "equal"),
    [
        (1.0, math.inf, False), (math.inf, 1.0, False), (math.inf, -math.inf, False), (math.inf, math.inf, True),
        (1.0, math.nan, False), (math.nan, 1.0, False), (math.nan, math.nan, True), (1.0, 1.0, True),
    ],
)
def test_values_that_are_not_finite(spark, left, right, equal, tolerance):
    a, b = _two(spark, (left, right))
    assert Profile.cmp(a, b, rel_tol=tolerance).summary.first().equal is equal


def test_unknown_nodes_count_nowhere(spark, profile):
    extra = spark.createDataFrame([(1, "time", 77, 0, 180.0)], profile.facts.schema)
    more = _with(profile, facts=profile.facts.unionByName(extra))
    roots = {r["name"]: r.pct for r in more.calltree().where("depth = 0").collect()}
    assert roots["main"] == pytest.approx(100.0)
    nodes = lambda z: {r.cnode_id for r in more.dump(z=z).collect()}
    assert 77 not in nodes("excl") | nodes("incl")


def test_facts_of_unknown_threads_are_refused(spark, tmp_path):
    profile = handmade_profile(spark)
    less = _with(profile, locations=profile.locations.where("thread_id = 0"))
    lost = sum(1 for _, thread in TIME if thread != 0)
    with pytest.raises(KeyCheckError, match="facts of threads"):
        less.write(str(tmp_path / "p"))
    assert lost and not (tmp_path / "p").exists()


def _collection(spark) -> Profile:
    parts = [handmade_profile(spark, i) for i in (1, 2, 3)]
    merged = {}
    for name in ("experiments", "metrics", "locations", "cnodes", "facts"):
        first, *rest = (getattr(p, name) for p in parts)
        for other in rest:
            first = first.unionByName(other)
        merged[name] = first
    return Profile(**merged)


def test_operands_that_do_not_exist(spark):
    pairs = spark.createDataFrame([(1, 1, 99)], "result_id long, minuend long, subtrahend long")
    for mode in SystemDimension:
        with pytest.raises(UnknownExperimentError, match="99"):
            algebra.diff_pairs(_collection(spark), pairs, system_dim=mode)


def test_mean_of_an_experiment_with_itself(spark):
    groups = spark.createDataFrame([(1, 2), (1, 2)], "result_id long, experiment_id long")
    found = algebra.mean_groups(_collection(spark), groups)
    total = found.facts.where("metric = 'time'").agg(F.sum("value")).first()[0]
    assert total == pytest.approx(sum(TIME.values()))


def test_rows_do_not_depend_on_later_settings(spark, tmp_path):
    (tmp_path / "tree").mkdir()
    (tmp_path / "dump").mkdir()
    lines = ["| Time | Tree", *(f"| {i}.0 | * f{i}" for i in range(3000))]
    (tmp_path / "tree" / "run_1.txt").write_text("\n".join(lines) + "\n")
    dump = ["Cnode ID,time", *(f"{i},{i}.5" for i in range(3000))]
    (tmp_path / "dump" / "run_1.csv").write_text("\n".join(dump) + "\n")
    tree = reports.load_tree(spark, str(tmp_path / "tree")).rows
    cells = reports.load_dump(spark, str(tmp_path / "dump")).rows
    keys = ["leafNodeDefaultParallelism", "files.openCostInBytes", "files.maxPartitionBytes"]
    try:
        for key, value in zip(keys, ["37", "1", "900"], strict=True):
            spark.conf.set(f"spark.sql.{key}", value)
        assert tree.count() == 3000 and cells.count() == 3000
        assert tree.agg(F.max("cnode_id")).first()[0] == 2999
    finally:
        for key in keys:
            spark.conf.unset(f"spark.sql.{key}")


def test_two_reports_of_one_experiment_are_rejected(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "run_1.csv").write_text("Cnode ID,time\n0,1\n")
    (tmp_path / "a" / "run_2.csv").write_text("Cnode ID,time\n0,1\n")
    loaded = reports.load_dump(spark, str(tmp_path))
    assert [r.experiment_id for r in loaded.rows.collect()] == [2]
    assert {r.reason for r in loaded.rejects.collect()} == {"experiment id used twice"}


def test_very_long_quoted_cell(spark, tmp_path):
    name = 'long ""name"" ' * 3000
    header = "cube::Metric,Routine,Count,Sum,Mean,Variance,Minimum,Maximum"
    (tmp_path / "run_1.csv").write_text(f'{header}\ntime,"{name}",1,2,3,4,5,6\n')
    row = reports.load_stat(spark, str(tmp_path)).rows.first()
    assert row.routine == name.replace('""', '"') and row.maximum == 6.0


def test_comparison_tells_slashes_in_names_from_levels(spark):
    a = handmade_profile(spark, 1, nodes=[(0, 1, "init/x", None, None, None)], metrics={"time": {}})
    b = handmade_profile(
        spark, 2, nodes=[(0, 1, "init", None, None, None), (1, 2, "x", None, None, 0)], metrics={"time": {}}
    )
    found = Profile.cmp(a, b)
    assert not found.summary.first().equal
    assert found.summary.first().n_diff == 3
    assert sorted((r.item, r.left) for r in found.details.collect()) == [("init", 0.0), ("init/x", 0.0), ("init/x", 1.0)]


def test_comparison_tells_slashes_in_places(spark):
    sides = []
    for i, (machine, node) in enumerate([("x/y", "z"), ("x", "y/z"), (None, "z"), ("(none)", "z"), ("z", None)], 1):
        profile = handmade_profile(spark, i, threads=(0,), metrics={"time": {(0, 0): 1.0}})
        places = profile.locations.withColumn("machine", F.lit(machine).cast("string"))
        sides.append(_with(profile, locations=places.withColumn("node", F.lit(node).cast("string"))))
    for a, b in ((0, 1), (2, 3), (2, 4), (4, 4)):
        found = Profile.cmp(sides[a], sides[b]).summary.first()
        # Both places lack a partner, and so does the cell of each.
        assert (found.equal, found.n_diff) == ((True, 0) if a == b else (False, 4))
    mean = Profile.mean(sides[2], sides[4], system_dim=SystemDimension.REDUCE)
    assert mean.locations.count() == 2


@pytest.mark.parametrize("how", list(SystemDimension))
def test_algebra_refuses_facts_of_unknown_threads(spark, how):
    whole = handmade_profile(spark, 2)
    less = _with(handmade_profile(spark, 1), locations=whole.locations.where("thread_id <> 3"))
    for work in (
        lambda: Profile.mean(less, whole, system_dim=how),
        lambda: whole.diff(less, how),
        lambda: Profile.merge(less, whole, system_dim=how),
        lambda: whole.cmp(less),
    ):
        with pytest.raises(KeyCheckError, match="facts of threads"):
            work()


def test_statistics_refuse_facts_of_unknown_threads(spark):
    profile = handmade_profile(spark)
    less = _with(profile, locations=profile.locations.where("thread_id = 0"))
    with pytest.raises(KeyCheckError, match="facts of threads"):
        less.stat()


def test_stored_collections_are_checked_unless_written_here(spark, tmp_path):
    profile = handmade_profile(spark)
    profile.write(str(tmp_path / "own"))
    own = Profile.load(spark, str(tmp_path / "own"))
    assert own._threads_checked and own.experiment(1)._nodes_checked
    extra = spark.createDataFrame([(1, "time", 77, 0, 180.0)], profile.facts.schema)
    _with(profile, facts=profile.facts.unionByName(extra)).write(str(tmp_path / "more"))
    more = Profile.load(spark, str(tmp_path / "more"))
    assert more._threads_checked and not more._nodes_checked
    assert 77 not in {r.cnode_id for r in more.dump().collect()}
    shutil.copytree(tmp_path / "own", tmp_path / "foreign", ignore=shutil.ignore_patterns("checked"))
    profile.locations.where("thread_id <> 3").write.mode("overwrite").parquet(str(tmp_path / "foreign" / "locations"))
    foreign = Profile.load(spark, str(tmp_path / "foreign"), 1)
    assert not foreign._threads_checked and not foreign._nodes_checked
    with pytest.raises(KeyCheckError, match="thread 3 of experiment 1"):
        foreign.stat()


def test_path_ids_end_in_the_path_id(spark):
    names = spark.createDataFrame([(["a", "b", "c"],), (["a"],), (["a", ""],)], "names array<string>")
    rows = names.select(
        algebra._path_id(F.col("names"), 3).alias("one"), algebra._path_ids(F.col("names"), 3).alias("all")
    ).collect()
    assert [r.one for r in rows] == [r.all[-1] for r in rows]
    assert rows[0].all[0] == rows[1].one and len({r.one for r in rows}) == 3
