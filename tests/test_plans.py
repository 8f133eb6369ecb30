from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from callgrove.functions.selection import id_ranges
from callgrove.plans import lookup as lookup_module
from callgrove.plans import ranking
from callgrove.plans.lookup import lookup


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds half of the rows."""
    return spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 37).alias("g"),
        F.xxhash64("id").alias("v"),
    )


def test_number_rows_agrees_with_a_window(spark, skewed):
    numbered = ranking.number_rows(skewed, ["g"], [F.col("v")], "n")
    plain = F.row_number().over(Window.partitionBy("g").orderBy("v")) - 1
    wrong = numbered.withColumn("m", plain).where("n <> m")
    assert numbered.count() == 4000
    assert wrong.isEmpty()


def test_number_rows_descending(skewed):
    numbered = ranking.number_rows(skewed, ["g"], [F.desc("v")], "n")
    first = numbered.where("n = 0").select("g", "v")
    best = skewed.groupBy("g").agg(F.max("v").alias("v"))
    assert sorted(first.collect()) == sorted(best.collect())


def test_top_k_both_ways(skewed, monkeypatch):
    small = sorted(ranking.top_k(skewed, ["g"], [F.desc("v")], 5).collect())
    monkeypatch.setattr(ranking, "_TRIMMED_K", 0)
    assert sorted(ranking.top_k(skewed, ["g"], [F.desc("v")], 5).collect()) == small
    assert len(small) == 5 * 37


def test_top_k_trims_before_the_shuffle(skewed):
    plan = ranking.top_k(skewed, ["g"], [F.desc("v")], 5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_lookup_ways_agree(spark, skewed, how):
    table = spark.range(20).select(F.col("id").alias("g"), (F.col("id") * 2).alias("twice"))
    joined = [
        sorted(
            lookup(skewed, table, ["g"], table_bytes=size, spread=["v"], how=how).collect(),
            key=str,
        )
        for size in (0.0, 1e12)
    ]
    assert joined[0] == joined[1]


def test_large_lookups_are_salted_not_broadcast(spark, skewed):
    table = spark.range(20).select(F.col("id").alias("g"))
    joined = lookup(skewed, table, ["g"], table_bytes=1e12, spread=["v"])
    assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_type(spark, skewed):
    with pytest.raises(ValueError):
        lookup(skewed, skewed, ["g"], table_bytes=0, spread=["v"], how="right")


@pytest.mark.parametrize(
    ("text", "ranges"),
    [
        ("all", None),
        ("0", [(0, 0)]),
        ("0,1,5-10", [(0, 1), (5, 10)]),
        (" 7 - 9 , 8-12,3", [(3, 3), (7, 12)]),
    ],
)
def test_selection(text, ranges):
    assert id_ranges(text) == ranges


@pytest.mark.parametrize("text", ["", "a", "1,,2", "-3", "4-2", "1-2-3"])
def test_bad_selection(text):
    with pytest.raises(ValueError):
        id_ranges(text)


def test_heavy_keys_alone_are_salted(spark):
    """Half of the rows share a key: no task of the join gets more than a small part of them."""
    big = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("g"), F.col("id").alias("v")
    )
    heavy = {r.g: r._ways for r in lookup_module.heavy_keys(big, ["g"]).collect()}
    least = lookup_module.HEAVY_SHARE * 20_000
    assert heavy == {0: -(-10_000 * 2 // least)}
    table = spark.range(20_000).select(F.col("id").alias("g"), (F.col("id") * 2).alias("twice"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = lookup(big, table, ["g"], table_bytes=1e12, spread=["v"])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", 3)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in sizes) == 20_000
    # A salt takes at most half of the least heavy load, and few of them meet in one task.
    assert max(r["count"] for r in sizes) < 20_000 / 64 * 2.5


def test_running_sum_agrees_with_a_window(spark, skewed):
    rows = skewed.withColumn("w", (F.col("v") % 100).cast("double"))
    summed = ranking.running_sum(rows, ["g"], [F.col("v")], "w", "s")
    upto = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wrong = summed.withColumn("t", F.sum("w").over(upto)).where("abs(s - t) > 1e-6")
    assert summed.count() == 4000 and wrong.isEmpty()


def test_search_for_heavy_keys_keeps_no_row_for_each_key(spark, monkeypatch):
    """What is stored on the way depends on the number of buckets, not on that of the keys."""
    stored = []

    def watched(make):
        def run(df, **aggregates):
            stored.append(df.count())
            return make(df, **aggregates)

        return run

    for name in ("cut", "cut_and_observe"):
        if hasattr(lookup_module, name):
            monkeypatch.setattr(lookup_module, name, watched(getattr(lookup_module, name)))
    big = spark.range(50_000).select(F.col("id").alias("g"))
    assert lookup_module.heavy_keys(big, ["g"]).isEmpty()
    assert max(stored) <= 8192
