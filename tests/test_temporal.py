import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from filmlens.operators import temporal as O
from filmlens.operators.grouping import cube_profile, pivot_counts

START = datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


@pytest.mark.parametrize("width", [O.HOUR, 7 * O.HOUR, 1000 * O.DAY])
@pytest.mark.parametrize("tolerance", [None, 5 * O.HOUR])
def test_as_of_join(spark, width, tolerance):
    rng = random.Random(5)
    keys = [None, "a", "a", "a", "b"]
    left = [(i, rng.choice(keys), rng.choice([None, *range(60)])) for i in range(150)]
    right = [(rng.choice(keys), rng.choice([None, *range(0, 60, 7)]), rng.randrange(5)) for _ in range(60)]
    lefts = spark.createDataFrame([(i, k, at(t)) for i, k, t in left], "i int, k string, t timestamp_ntz")
    rights = spark.createDataFrame([(k, at(t), v) for k, t, v in right], "k string, at timestamp_ntz, v int")
    got = {r.i: (r["at"], r.v) for r in O.as_of_join(lefts, rights, ["k"], "t", "at", ["v"], width, tolerance).collect()}
    want = {}
    for i, k, t in left:
        fit = [(u, v) for j, u, v in right if None not in (k, t, u) and j == k and u <= t and (tolerance is None or t - u <= 5)]
        want[i] = (at(max(fit)[0]), max(fit)[1]) if fit else (None, None)
    assert got == want


def test_as_of_join_refuses_clashes_and_takes_empty_sides(spark):
    left = spark.createDataFrame([(1, 5.0)], "k int, t double")
    right = spark.createDataFrame([], "k int, u double, v int")
    assert O.as_of_join(left, right, ["k"], "t", "u", ["v"], 1.0).collect() == [(1, 5.0, None, None)]
    assert O.as_of_join(left.limit(0), right, ["k"], "t", "u", ["v"], 1.0).collect() == []
    with pytest.raises(ValueError):
        O.as_of_join(left, right.withColumnRenamed("v", "t"), ["k"], "t", "u", ["t"], 1.0)


@pytest.mark.parametrize("width", [0.5, 3.0, 1e6])
def test_range_join(spark, width):
    rng = random.Random(6)
    points = [(i, rng.choice([None, rng.uniform(-50, 50), float(rng.randrange(-20, 20))])) for i in range(120)]
    bands = [(j, float(rng.randrange(-60, 60)), rng.choice([0.0, 1.0, 2.5, 40.0, 4000.0, -3.0])) for j in range(40)] + [(40, None, 1.0)]
    intervals = [(j, low, None if low is None else low + length) for j, low, length in bands]
    got = O.range_join(
        spark.createDataFrame(points, "i int, x double"), spark.createDataFrame(intervals, "j int, low double, high double"), "x", "low", "high", width
    )
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "__cell" in plan and "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString()
    want = sorted((i, j) for i, x in points for j, low, high in intervals if None not in (x, low) and low <= x < high)
    assert sorted((r.i, r.j) for r in got.collect()) == want
    none = spark.createDataFrame([], "j int, low double, high double")
    assert O.range_join(spark.createDataFrame(points, "i int, x double"), none, "x", "low", "high", width).collect() == []


@pytest.mark.parametrize("width", [2, 10_000])
def test_frames(spark, width):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, "hot", "hot", "cold"]), rng.choice([None, *range(40)]), rng.choice([None, 1, 2, 3])) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, k string, t int, v int")
    place = lambda r: (r[2] is not None, r[2] or 0, r[0])
    running = {r.i: r.s for r in O.running_sum(df, ["k"], ["t", "i"], "v", "s", width).collect()}
    before = {r.i: r.p for r in O.previous_row(df, ["k"], ["t", "i"], "v", "p", width).collect()}
    near = {r.i: (r.n, r.s) for r in O.rolling(df, ["k"], "t", 5, n=F.count("v"), s=F.sum("v")).collect()}
    for r in rows:
        mine = sorted((x for x in rows if x[1] == r[1]), key=place)
        upto = [x[3] for x in mine if place(x) <= place(r) and x[3] is not None]
        assert running[r[0]] == (sum(upto) if upto else None)
        earlier = [x for x in mine if place(x) < place(r)]
        assert before[r[0]] == (earlier[-1][3] if earlier else None)
        frame = [x[3] for x in mine if None not in (r[2], x[2], x[3]) and r[2] - 5 <= x[2] <= r[2]]
        assert near[r[0]] == ((len(frame), sum(frame) if frame else None) if r[2] is not None else (None, None))


def test_a_hot_key_is_spread_over_its_buckets(spark):
    df = spark.range(20_000).selectExpr("1 AS k", "id AS t", "id AS v")
    summed = O.running_sum(df, ["k"], ["t"], "v", "s", 1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = summed.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 3 and max(r["count"] for r in sizes) < 12_000
        assert summed.agg(F.max("s")).first()[0] == 20_000 * 19_999 // 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_cube_tells_null_values_from_sums(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), (None, 2)], "x string, y int")
    got = {tuple(r) for r in cube_profile(df, ["x", "y"], n=F.count(F.lit(1))).collect()}
    assert got == {
        (0, "a", 1, 1), (0, None, 1, 1), (0, None, 2, 1), (1, "a", None, 1), (1, None, None, 2),
        (2, None, 1, 2), (2, None, 2, 1), (3, None, None, 3),
    }
    assert {tuple(r) for r in pivot_counts(df, "y", "x", ["a"]).collect()} == {(1, 1, 1), (2, 0, 1)}
