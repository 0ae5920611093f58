"""Sampled ranges, running totals, row numbers, medians and exact splits."""

import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from plymill.ml import prep
from plymill.operators import keyed


def test_one_huge_value_leaves_ranges_even(spark):
    rows = spark.range(20_000).select((F.col("id") * 37 % 20_011).cast("double").alias("x"))
    rows = rows.unionByName(spark.createDataFrame([(1e12,)], "x double"))
    sizes = [r.n for r in keyed.ranges(rows, "x", parts=16).groupBy("_range").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20_001 and max(sizes) < 2 * sum(sizes) / 16


def test_running_totals(spark):
    rng = random.Random(1)
    data = [(g, float(p) if p < 400 else 1e12, rng.randrange(9)) for g in ("a", "b", None) for p in rng.sample(range(401), 300)]
    expected = {}
    for g, p, v in data:
        before = sum(w for h, q, w in data if h == g and q < p)
        expected[g, p] = (v, before, before + v)
    frame = spark.createDataFrame([*data, ("a", None, 5)], "g string, p double, v int").repartition(5)
    found = {(r.g, r.p): (r.v, r.v_before, r.v_upto) for r in keyed.running_totals(frame, ["g"], "p", ["v"], parts=7).collect()}
    assert found == expected
    whole = {r.p: r.v_upto for r in keyed.running_totals(frame.filter("g = 'a'"), [], "p", ["v"]).collect()}
    assert whole == {p: u for (g, p), (_, _, u) in expected.items() if g == "a"}
    assert keyed.running_totals(frame.limit(0), ["g"], "p", ["v"]).count() == 0


def test_medians_with_outliers(spark):
    rng = random.Random(2)
    data = [(rng.choice([rng.random(), 1e12, -1e12, 5.0]), rng.randrange(4), None) for _ in range(2001)]
    frame = spark.createDataFrame([(a, b if i % 3 else None, c) for i, (a, b, c) in enumerate(data)], "a double, b int, c double")
    found = {r.feature: r.median for r in keyed.exact_medians(frame, ["a", "b", "c"]).collect()}
    assert found == {"a": statistics.median(r[0] for r in data), "b": statistics.median(r[1] for i, r in enumerate(data) if i % 3)}


def test_numbers_are_those_of_one_sort(spark):
    rng = random.Random(3)
    data = [(rng.randrange(50), f"k{i}") for i in range(1000)] + [(None, "n1"), (None, "n2")]
    frame = spark.createDataFrame(data, "x int, k string").repartition(6)
    found = {r.k: r.number for r in keyed.numbered(frame, [F.desc("x"), F.asc("k")], parts=9).collect()}
    order = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert found == {k: i for i, (_, k) in enumerate(order)}
    assert keyed.numbered(frame.limit(0), [F.asc("x")]).count() == 0


@pytest.mark.parametrize("share", [0.2, 0.5, 0.0, 1.0])
def test_exact_split(spark, share):
    data = [(f"g{i}", ["a", "b", "c", None][i * i % 7 % 4], i) for i in range(900)]
    frame = spark.createDataFrame(data, "k string, y string, wide int").repartition(4)
    expected = set()
    for label in ("a", "b", "c", None):
        own = sorted((hashlib.md5(f"42:{k}".encode()).hexdigest(), k) for k, y, _ in data if y == label)
        expected |= {k for _, k in own[: int(len(own) * share + 0.5)]}
    found = keyed.stratified_split(frame, "y", "k", share)
    assert found.columns == ["k", "y", "wide", "is_test"] and found.count() == 900
    assert {r.k for r in found.filter("is_test").collect()} == expected


def jobs(spark, build):
    """How many jobs ``build`` starts."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        frame = build()
        return frame, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_joins_start_no_job_while_planned(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), (None, 0)], "level string, y int")
    folded, n = jobs(spark, lambda: prep.fold_rare(frame, "level", 2))
    weighted, m = jobs(spark, lambda: prep.with_class_weights(frame, "y"))
    assert (n, m) == (0, 0)
    assert sorted(r.level or "" for r in folded.collect()) == ["", prep.RARE_LEVEL, "a", "a"]
    assert {(r.y, round(r.weight, 6)) for r in weighted.collect()} == {(1, 2.0), (0, round(4 / 6, 6))}


@pytest.mark.parametrize("share", [0.0001, 0.01, 0.37, 1.0])
def test_a_stratified_sample_is_the_share_that_the_split_marks(spark, share):
    frame = spark.range(9000).select((F.col("id") % 5000).alias("k"), F.when(F.col("id") % 7 > 1, F.col("id") % 3).alias("y"), F.col("id"))
    marked = keyed.stratified_split(frame, "y", "k", share, 5).filter("is_test").drop("is_test")
    sample = keyed.stratified_sample(frame, "y", "k", share, 5)
    assert sample.columns == frame.columns
    assert sorted(r["id"] for r in sample.collect()) == sorted(r["id"] for r in marked.collect())
