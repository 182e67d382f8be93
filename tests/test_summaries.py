import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from filmlens.operators import nested as N
from filmlens.operators import sketches as K
from filmlens.plans.importance import ablation, permutation_importance, permuted_rows


def test_merged_sketches_keep_their_bounds(spark):
    df = spark.range(60_000).selectExpr("id % 7 AS day", "id % 5000 AS user", "IF(id % 10 = 0, NULL, CAST(id AS DOUBLE)) AS v")
    parts = K.sketch_parts(df, ["day"], ["user"], ["v"])
    merged = K.merge_parts(parts, []).select("n", K.distinct_estimate("user").alias("users"), K.quantile_estimate("v", 0.25).alias("q")).first()
    assert merged.n == 60_000
    assert abs(merged.users - 5000) < 0.06 * 5000
    assert abs(merged.q / 60_000 - 0.25) < 0.03


def test_sketches_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 1, 2.0)], "p string, u int, v double")
    parts = K.sketch_parts(df, ["p"], ["u"], ["v"])
    got = {r.p: (r.n, r.users, r.q) for r in parts.select("p", "n", K.distinct_estimate("u").alias("users"), K.quantile_estimate("v", 0.5).alias("q")).collect()}
    assert got == {"a": (1, 0, None), "b": (1, 1, 2.0)}
    assert K.merge_parts(parts, []).select(K.distinct_estimate("u")).first()[0] == 1
    assert K.sketch_parts(df.limit(0), ["p"], ["u"], ["v"]).collect() == []


TEXTS = [None, "", " , ", "Drama, Action", "Action", "Actions,Drama,Drama", "a,b,c"]


def test_token_lists_and_index(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    tokens = N.token_list(F.col("t"))
    want = [sorted({x.strip() for x in (t or "").split(",")} - {""}) for t in TEXTS]
    assert [sorted(r[0]) for r in df.orderBy("i").select(tokens).collect()] == want
    assert [r[0] for r in df.orderBy("i").select(N.has_any(tokens, ["Action", "c"])).collect()] == [bool({"Action", "c"} & set(w)) for w in want]
    assert [r[0] for r in df.orderBy("i").select(N.has_all(tokens, ["Action", "Drama"])).collect()] == [{"Action", "Drama"} <= set(w) for w in want]
    index = N.inverted_index(df, "i", tokens)
    assert sorted(map(tuple, index.collect())) == sorted((t, i) for i, w in enumerate(want) for t in w)
    assert {tuple(r) for r in N.search_index(index, ["Drama", "Action", "Drama"]).collect()} == {(3, 2)}
    assert {r.key for r in N.search_index(index, ["Drama", "Action"], 1).collect()} == {3, 4, 5}


def test_records(spark):
    rows = [(0, '{"k": 3, "s": "x"}'), (1, '{"k": "no"}'), (2, "broken {"), (3, None), (4, "{}")]
    got = {r.i: (r.p_k, r.p_s, r.j_valid) for r in N.parse_record(spark.createDataFrame(rows, "i int, j string"), "j", "k int, s string", "p_").collect()}
    assert got == {0: (3, "x", True), 1: (None, None, True), 2: (None, None, False), 3: (None, None, False), 4: (None, None, True)}


def test_a_permutation_moves_every_value_once(spark):
    rows = [(i, float(i)) for i in range(500)]
    moved = permuted_rows(spark.createDataFrame(rows, "i int, v double").repartition(7), "i", "v", "w").collect()
    assert sorted(r.w for r in moved) == [v for _, v in rows]
    assert sum(r.v == r.w for r in moved) < 10
    again = permuted_rows(spark.createDataFrame(rows[::-1], "i int, v double"), "i", "v", "w").collect()
    assert {(r.i, r.w) for r in moved} == {(r.i, r.w) for r in again}


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        a, b, c = rng.uniform(-1, 1), rng.uniform(-1, 1), rng.uniform(-1, 1)
        rows.append((i, a, b, c, 3 * a + b))
    df = spark.createDataFrame(rows, "i int, a double, b double, c double, y double")
    assembled = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    return df, assembled, LinearRegression(labelCol="y", featuresCol="features", predictionCol="p")


def test_permutation_importance_orders_inputs(fitted):
    _, rows, estimator = fitted
    groups = {"a": [0], "b": [1], "c": [2], "a and b": [0, 1]}
    got = permutation_importance(estimator.fit(rows), rows, groups, "y", "i", "features", "p").collect()
    assert [r.group for r in got] == ["a and b", "a", "b", "c"]
    assert got[3].rmse_increase == pytest.approx(0, abs=1e-9) and got[1].r2_drop > 1


def test_ablation_marks_what_the_model_depends_on(fitted):
    df, _, estimator = fitted
    got = {r.without: r for r in ablation(df, df, ["a", "b", "c"], {"a": ["a"], "c": ["c"]}, estimator, "y").collect()}
    assert got[""].r2 == pytest.approx(1) and got["a"].depends and not got["c"].depends and not got[""].depends
    with pytest.raises(ValueError):
        ablation(df, df, ["a"], {"all": ["a"]}, estimator, "y")
