"""As-of and interval joins against plain versions, edges, and where hot keys go."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluiceway.operators.joins import asof_join, interval_join


def _asof(left, right):
    out = []
    for ident, key, at in left:
        seen = [(t, v) for k, t, v in right if k is not None and k == key and t is not None and at is not None and t <= at]
        out.append((ident, key, at, max(seen, key=lambda s: (s[0], s[1] is not None, s[1] or 0))[1] if seen else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_asof_against_a_plain_version(spark, seed):
    rng = random.Random(seed)
    some = lambda: rng.choice([None] + [1] * 9 + [2, 3])
    left = [(i, some(), rng.choice([None, *range(60)])) for i in range(500)]
    right = [(some(), rng.choice([None, *range(60)]), rng.choice([None, *range(5)])) for _ in range(200)]
    left += left[:20]
    a = spark.createDataFrame(left, "ident int, k int, at int")
    b = spark.createDataFrame(right, "k int, t int, v int")
    got = asof_join(a, b, ["k"], "at", "t", ["v"])
    assert got.columns == ["ident", "k", "at", "v"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == _asof(left, right)


def test_asof_edges(spark):
    a = spark.createDataFrame([(1, 5)], "k int, at int")
    b = spark.createDataFrame([], "k int, t int, v int")
    assert [tuple(r) for r in asof_join(a, b, ["k"], "at", "t", ["v"]).collect()] == [(1, 5, None)]
    assert asof_join(a.limit(0), b, ["k"], "at", "t", ["v"]).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        asof_join(a, b.withColumnRenamed("v", "at"), ["k"], "at", "t", ["at"])


def test_asof_spreads_one_key_over_tasks(spark):
    """With adaptive merging off, the last window's tasks share the rows of the only key."""
    rows = spark.range(0, 20_000, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("at"))
    marks = rows.where("at % 100 = 0").select("k", F.col("at").alias("t"), F.col("at").alias("mark"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = asof_join(rows, marks, ["k"], "at", "t", ["mark"])
        assert got.where("mark <> at - at % 100").count() == 0 and got.count() == 20_000
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 3 and max(sizes) < 12_000


def _overlaps(left, right):
    return sorted(
        ((*x, *y[1:]) for x in left for y in right if None not in (*x, *y) and x[0] == y[0] and x[1] <= x[2] and y[1] <= y[2] and x[1] <= y[2] and y[1] <= x[2]), key=str
    )


@pytest.mark.parametrize("step", [2, 8])
def test_intervals_of_mixed_lengths_against_all_pairs(spark, step):
    rng = random.Random(step)

    def some(n):
        out = []
        for i in range(n):
            start = rng.uniform(-50, 1000)
            out.append((rng.choice([1, 1, 1, 2, None]), start, start + rng.choice([0, 0, 0.5, 1, 5, 40, 900, -1]), i))
        return out + [(1, None, 5.0, -1), (1, 5.0, None, -2), (1, 7.0, 7.0, -3), (1, 7.0, 7.0, -3)]

    left, right = some(200), some(150)
    a = spark.createDataFrame(left, "k int, a double, b double, i int")
    b = spark.createDataFrame(right, "k int, c double, d double, j int")
    got = interval_join(a, b, ("a", "b"), ("c", "d"), ["k"], step)
    assert got.columns == ["k", "a", "b", "i", "c", "d", "j"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == _overlaps(left, right)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_intervals_without_keys_and_of_dates(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    left = [(day(i * 3), day(i * 3 + (60 if i % 7 == 0 else 1)), i) for i in range(40)]
    right = [(day(i), day(i), 100 + i) for i in range(0, 150, 2)]
    a, b = spark.createDataFrame(left, "a date, b date, i int"), spark.createDataFrame(right, "c date, d date, j int")
    want = sorted((x[2], y[2]) for x in left for y in right if x[0] <= y[1] and y[0] <= x[1])
    assert sorted((r.i, r.j) for r in interval_join(a, b, ("a", "b"), ("c", "d")).collect()) == want
    assert interval_join(a.limit(0), b.limit(0), ("a", "b"), ("c", "d")).count() == 0
    with pytest.raises(TypeError):
        interval_join(a.withColumn("a", F.lit("x")), b, ("a", "b"), ("c", "d"))
