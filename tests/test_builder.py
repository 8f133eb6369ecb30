"""Profiles from reports: what fits is in the profile, the rest among the rejects."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from callgrove import model
from callgrove.sources import builder, reports
from tests.handmade import TIME, handmade_profile

DUMP = "Cnode ID,Thread ID,time,visits\n"
BASIC = "Number of nodes    : 1\nNumber of processes: {}\nWallclock time     : 12.5\n"


@pytest.fixture
def written(spark, tmp_path):
    """Loads dumps and summaries that are given as texts by experiment."""

    def load(dumps: dict, summaries: dict):
        for kind, texts in (("dump", dumps), ("basic", summaries)):
            (tmp_path / kind).mkdir()
            for number, text in texts.items():
                (tmp_path / kind / f"run_{number}.txt").write_text(text)
        return (
            reports.load_dump(spark, str(tmp_path / "dump")).rows,
            reports.load_basic(spark, str(tmp_path / "basic")).rows,
        )

    return load


def _reasons(built) -> dict:
    return {(r.experiment_id, r.reason): r["values"] for r in built.rejects.collect()}


def test_dump_and_summary_make_a_profile(spark, profile, written):
    lines = "".join(f"{node},{thread},{value},\n" for (node, thread), value in TIME.items())
    dumps, summaries = written({1: DUMP + lines}, {1: BASIC.format(2)})
    built = builder.profile_from_reports(
        dumps, summaries, profile.cnodes, metrics=profile.metrics, locations=profile.locations
    )
    assert _reasons(built) == {}
    want = {r.cnode_id: r.value for r in profile.calltree().collect()}
    assert {r.cnode_id: r.value for r in built.profile.calltree().collect()} == want
    assert built.profile.info_basic().first().wallclock_time == 12.5
    stored = sorted((r.routine, r["sum"]) for r in built.profile.stat().collect())
    assert stored == sorted((r.routine, r["sum"]) for r in profile.stat().collect())


def test_what_does_not_fit_is_rejected(spark, profile, written):
    lines = "0,0,1,2\n77,0,5,6\n1,9,3,\n2,0,4,4\n2,0,5,5\n,0,7,\n3,,8,9\n"
    dumps, summaries = written({1: DUMP + lines, 2: DUMP + "0,0,1,1\n"}, {1: BASIC.format(5), 3: BASIC.format(1)})
    two = handmade_profile(spark, 2)
    built = builder.profile_from_reports(
        dumps,
        summaries,
        profile.cnodes.unionByName(two.cnodes),
        metrics=profile.metrics.unionByName(two.metrics),
        locations=profile.locations.unionByName(two.locations),
    )
    assert _reasons(built) == {
        (1, "unknown call-tree node"): 2,
        (1, "unknown thread"): 1,
        (1, "value given more than once"): 4,
        (1, "incomplete cell"): 3,
        (1, "summary has 5 processes, the locations have 2"): 0,
        (3, "summary without a dump"): 0,
    }
    facts = {(r.experiment_id, r.metric, r.cnode_id, r.thread_id): r.value for r in built.profile.facts.collect()}
    assert facts == {(1, "time", 0, 0): 1.0, (1, "visits", 0, 0): 2.0, (2, "time", 0, 0): 1.0, (2, "visits", 0, 0): 1.0}
    assert {r.experiment_id: r.wallclock_time for r in built.profile.experiments.collect()} == {1: None, 2: None}


def test_metrics_and_locations_from_the_dump(spark, profile, written, tmp_path):
    dumps, summaries = written({1: "Cnode ID,visits,time\n0,1,2\n1,3,\n"}, {1: BASIC.format(7)})
    built = builder.profile_from_reports(dumps, summaries, profile.cnodes)
    assert _reasons(built) == {}
    assert [(r.name, r.display_name) for r in built.profile.metric_tree.collect()] == [("time", "time"), ("visits", "visits")]
    assert [(r.thread_id, r.thread) for r in built.profile.system_tree.collect()] == [(model.ALL_THREADS, "all")]
    again = built.profile.write(str(tmp_path / "stored"))
    assert {r.cnode_id: r.value for r in again.values("visits").collect()} == {0: 1.0, 1: 3.0}


def test_no_reports_make_an_empty_profile(spark, profile):
    empty = lambda schema: spark.createDataFrame([], schema)
    built = builder.profile_from_reports(
        empty("experiment_id long, cnode_id long, thread_id long, metric string, value double"),
        empty("experiment_id long, nodes long, processes long, wallclock_time double"),
        profile.cnodes,
    )
    assert built.profile.facts.isEmpty() and built.profile.tree.isEmpty() and built.rejects.isEmpty()
    assert built.profile.experiments.where(F.lit(True)).count() == 0


def test_dumps_are_not_searched_for_heavy_nodes(profile, written, monkeypatch):
    """Cells are unique, so the joined dumps need no job of their own before the join."""
    from callgrove.plans import lookup as lookup_module

    searched = []
    real = lookup_module.heavy_keys
    monkeypatch.setattr(
        lookup_module, "heavy_keys", lambda big, on: searched.append(list(on)) or real(big, on)
    )
    monkeypatch.setattr(lookup_module, "BROADCAST_BYTES", -1)
    dumps, summaries = written({1: DUMP + "0,0,1,2\n77,0,5,6\n"}, {1: BASIC.format(2)})
    built = builder.profile_from_reports(
        dumps, summaries, profile.cnodes, metrics=profile.metrics, locations=profile.locations
    )
    assert _reasons(built)[(1, "unknown call-tree node")] == 2
    assert ["experiment_id", "cnode_id"] not in searched
