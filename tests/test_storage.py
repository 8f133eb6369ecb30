from __future__ import annotations

from pathlib import Path

import pytest

from callgrove import Profile, model
from callgrove.plans import lineage
from tests.handmade import handmade_profile


@pytest.fixture(scope="module")
def stored(spark, profile, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "one")
    profile.write(path)
    return path


def test_round_trip(spark, profile, stored):
    again = Profile.load(spark, stored)
    for table in model.TABLES:
        columns = model.TABLES[table].fieldNames()
        before = sorted(map(str, getattr(profile, table).select(columns).collect()))
        assert sorted(map(str, getattr(again, table).select(columns).collect())) == before
        assert getattr(again, table).select(columns).schema == model.TABLES[table]


def test_paths_are_stored(spark, stored):
    again = Profile.load(spark, stored)
    assert set(model.PATH_COLUMNS.fieldNames()) <= set(again.cnodes.columns)
    assert again.calltree("time").first().value == 70.0


def test_pruning(spark, stored):
    facts = Profile.load(spark, stored, 1).facts.where("metric = 'time'")
    plan = facts._jdf.queryExecution().executedPlan().toString()
    line = next(part for part in plan.splitlines() if "PartitionFilters" in part)
    filters = line.split("PartitionFilters: [")[1].split("]")[0]
    assert "experiment_id" in filters and "metric" in filters


def test_selections_reach_the_scan(spark, stored):
    rows = Profile.load(spark, stored).dump(("time",), cnodes="0,2-5", threads="1-3")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "cnode_id" in pushed and "thread_id" in pushed


def test_existing_folder(profile, stored):
    with pytest.raises(Exception, match="already exists"):
        profile.write(stored)


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="experiments"):
        Profile.load(spark, str(tmp_path))


def test_missing_column(spark, profile, tmp_path):
    path = str(tmp_path / "bad")
    profile.write(path)
    bad = profile.locations.drop("thread")
    bad.write.mode("overwrite").parquet(f"{path}/locations")
    with pytest.raises(ValueError, match="lacks column 'thread'"):
        Profile.load(spark, path)


def test_wrong_type(spark, profile, tmp_path):
    path = str(tmp_path / "bad")
    profile.write(path)
    bad = profile.metrics.selectExpr("* except (ord)", "cast(ord as string) as ord")
    bad.write.mode("overwrite").parquet(f"{path}/metrics")
    with pytest.raises(ValueError, match="'ord'.*string"):
        Profile.load(spark, path)


def test_one_experiment_of_many(spark, profile, tmp_path):
    second = handmade_profile(spark, 2)
    both = Profile(
        *(getattr(profile, t).unionByName(getattr(second, t)) for t in model.TABLES)
    )
    path = str(tmp_path / "both")
    both.write(path)
    one = Profile.load(spark, path, 2)
    assert one.pinned
    assert {r.experiment_id for r in one.calltree("time").collect()} == {2}
    assert Profile.load(spark, path, 1).cmp(one).equal


def test_scratch_is_removed_on_request(spark, tmp_path):
    """All folders and checkpoints of the session go; results that were written stay."""
    shared = Path(lineage.shared_dir(spark).removeprefix("file:"))
    folder = Path(lineage.scratch_folder(spark, "test").removeprefix("file:"))
    spark.range(3).write.parquet(str(folder))
    kept = handmade_profile(spark).write(str(tmp_path / "kept"))
    lineage.cut(spark.range(5))
    before = {p.name for p in shared.iterdir()}
    assert folder.name in before and any(name.startswith("rdd-") for name in before)
    saved = (dict(lineage._SCRATCH), dict(lineage._checkpoints))
    made = {Path(p.removeprefix("file:")).name for paths in saved for listed in paths.values() for p in listed}
    try:
        # Other tests still use what they made: only the newest of each kind is given up here.
        app = spark.sparkContext.applicationId
        newest = lineage._checkpoints[app][-1]
        lineage._SCRATCH[app], lineage._checkpoints[app] = [str(folder)], [newest]
        assert lineage.clear_scratch(spark) == 2
    finally:
        lineage._SCRATCH.update(saved[0])
        lineage._checkpoints.update(saved[1])
    after = {p.name for p in shared.iterdir()}
    assert before - after == {folder.name, Path(newest).name} and before - after <= made
    assert kept.facts.count() > 0


def test_stored_facts_do_not_meet_the_nodes(profile, tmp_path, monkeypatch):
    """Facts are computed and moved once; their nodes are checked by the stored keys."""
    from callgrove.sources import tables

    joined = []
    real = tables.lookup

    def watched(big, table, on, **options):
        joined.append(list(on))
        return real(big, table, on, **options)

    monkeypatch.setattr(tables, "lookup", watched)
    stored = profile.write(str(tmp_path / "once"))
    assert joined == [["experiment_id", "thread_id"]]
    assert stored._nodes_checked and stored.facts.count() == profile.facts.count()
