"""Hard negatives: R-trees against brute force, odd rows, ties, SQL."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from callgrove.llm import common, rtree

SCHEMA = "vec_id long, embedding array<float>, label int, score double, anchor long, id string"


def _rows(n: int, width: int = 6, labels: int = 3, seed: int = 1):
    random = np.random.default_rng(seed)
    return [
        (i, [float(x) for x in random.normal(0, 0.6, width).astype(np.float32)], int(random.integers(labels)), 0.1, 2, "x")
        for i in range(n)
    ]


def _participants(rows):
    out = []
    for vec_id, vector, label, *_ in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        moved = (label + 1) % 10 if vec_id % 7 == 0 else label
        out.append((vec_id, moved, [math.floor(256 * float(np.float32(x))) for x in vector]))
    return out


def _plain(rows):
    taken, found = _participants(rows), []
    for i, (anchor, label, vector) in enumerate(taken):
        if anchor % 50:
            continue
        scores = [
            (-sum(x * y for x, y in zip(vector, v, strict=False)), other, own)
            for j, (other, own, v) in enumerate(taken)
            if i != j
        ]
        scores.sort()
        for score, positive, _ in [s for s in scores if s[2] == label][:5]:
            fits = [
                (o, -s) for s, o, own in scores if own != label and -50 * score <= -100 * s <= -95 * score
            ][:3]
            found += [(anchor, positive, k + 1, o, -score, s) for k, (o, s) in enumerate(fits)]
    return sorted(found)


def _got(spark, rows, **settings):
    common.code_on_workers(spark)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = rtree.hard_negatives(vectors, **settings).collect()
    return sorted(tuple(r) for r in found)


def test_equals_brute_force(spark):
    rows = _rows(700)
    assert _got(spark, rows, page=100, block=5) == _plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        *_rows(160, width=2, labels=2),
        (None, [0.5, 0.5], 1, 0.0, 0, ""), (50, None, 1, 0.0, 0, ""), (50, [0.1, None], 1, 0.0, 0, ""),
        (100, [nan, 0.1], 1, 0.0, 0, ""), (150, [inf, 0.1], 0, 0.0, 0, ""), (200, [0.1, 0.2], None, 0.0, 0, ""),
        (250, [], 1, 0.0, 0, ""), (300, [0.5], 0, 0.0, 0, ""), (-50, [0.5, 0.25, 9.0], 1, 0.0, 0, ""),
    ]
    assert _got(spark, rows, page=16) == _plain(rows)


def test_ties_and_repeated_rows(spark):
    base = [(i, [0.5, 0.25], i % 2, 0.0, 0, "") for i in range(60)] + [(i + 60, [0.25, 0.25], i % 3, 0.0, 0, "") for i in range(90)]
    rows = [*base, base[0], base[0], base[3]]
    found = _got(spark, rows, page=16)
    assert found == _plain(rows)
    assert found


def test_one_label_holds_nearly_all_rows(spark):
    rows = [(i, [1.0, 1.0, float(i % 3)], 0 if i % 40 else 1, 0.0, 0, "") for i in range(900)]
    assert _got(spark, rows, page=64, block=4) == _plain(rows)


def test_large_components_stay_exact(spark):
    random = np.random.default_rng(5)
    rows = [
        (i, [float(x) for x in (random.integers(1 << 12, 1 << 22, 3)).astype(np.float32)], i % 2, 0.0, 0, "")
        for i in range(120)
    ]
    assert _got(spark, rows, page=32) == _plain(rows)


def test_no_rows_and_no_anchors(spark):
    assert _got(spark, []) == []
    assert _got(spark, [(3, [0.1], 1, 0.0, 0, ""), (4, [0.2], 2, 0.0, 0, "")]) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_boxes_hold_their_rows_and_bounds_hold(seed):
    random = np.random.default_rng(seed)
    vectors = random.integers(-200, 200, (1500, 5))
    order = rtree.str_order(vectors, 16)
    assert sorted(order) == list(range(1500))
    tree = rtree.Tree(vectors[order], leaf=16, fanout=4)
    anchors = random.integers(-200, 200, (20, 5))
    for level, (low, high) in enumerate(zip(tree.lows, tree.highs, strict=True)):
        least, most = rtree.intervals(anchors, low, high)
        size = 16 * 4**level
        scores = anchors @ tree.vectors.T
        for box in range(len(low)):
            inside = scores[:, box * size : (box + 1) * size]
            assert (inside.min(axis=1) >= least[:, box]).all()
            assert (inside.max(axis=1) <= most[:, box]).all()


def test_boxes_outside_the_window_are_not_scored():
    random = np.random.default_rng(3)
    vectors = random.integers(0, 256, (4096, 2)).astype(float)
    vectors = vectors[rtree.str_order(vectors)]
    best = rtree.Best(1, 3)
    scored = rtree.search(
        rtree.Tree(vectors), np.arange(4096), np.arange(4096), np.array([[100.0, 40.0]]), np.array([-1]),
        np.array([[0]]), np.array([[9000.0]]), np.array([[9500.0]]), best,
    )
    scores = vectors @ np.array([100.0, 40.0])
    fits = sorted((-s, i) for i, s in enumerate(scores) if 9000 <= s <= 9500)[:3]
    assert sorted((-s, i) for s, i in zip(best.score, best.id, strict=True)) == fits
    assert scored < 4096 // rtree.LEAF / 3


def test_sql_gives_the_same(spark, tmp_path):
    common.code_on_workers(spark)
    rows = _rows(400, width=4)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = rtree.op12_hard_negatives(spark, str(tmp_path))
    connection = duckdb.connect()
    connection.sql(f"create view embeddings as select * from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    wanted = connection.sql(f"select {', '.join(found.columns)} from ({rtree.OP12_SQL})").fetchall()
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted) == _plain(rows)
