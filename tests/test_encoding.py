"""Encoders and the lookup join, on small frames with rare and hot keys."""

import pytest
from pyspark.sql import functions as F

from filmlens.operators import encoding as E
from filmlens.operators import leakage as L
from filmlens.operators import lookup


@pytest.fixture
def train(spark):
    data = [("a", 8.0), ("a", 6.0), ("b", 2.0), (None, 4.0)]
    return spark.createDataFrame(data, "director string, avg_vote double")


def test_target_encoding(spark, train):
    fitted = E.target_encode_fit(train, "director", "avg_vote")
    found = {r.director: r.encoding for r in fitted.mapping.collect()}
    assert fitted.default == 5.0 and fitted.n_entries == 4
    assert found == pytest.approx({"a": (14 + 50) / 12, "b": (2 + 50) / 11, None: (4 + 50) / 11})
    test = spark.createDataFrame([(1, "a"), (2, "new"), (3, None)], "id int, director string")
    applied = E.encode_apply(test, fitted)
    assert applied.columns == ["id", "director_encoded"]
    assert {r.id: r.director_encoded for r in applied.collect()} == pytest.approx({1: found["a"], 2: 5.0, 3: found[None]})


def test_frequency_encoding(spark, train):
    fitted = E.frequency_encode_fit(train, "director")
    test = spark.createDataFrame([(1, "a"), (2, "new")], "id int, director string")
    assert {r.id: r.director_freq for r in E.encode_apply(test, fitted).collect()} == {1: 0.5, 2: 0.25}


def test_top_categories(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("c",), ("b",), ("d",), (None,)], "genre string")
    top = E.top_categories_fit(df, "genre", 2)
    assert {r.genre for r in top.table.collect()} == {"a", "b"}
    assert sorted(r.genre for r in E.top_categories_apply(df, top).collect()) == ["Other"] * 3 + ["a"] * 3 + ["b"]
    with pytest.raises(ValueError):
        E.top_categories_fit(df, "genre", 0)


def test_test_rows_cannot_change_a_mapping(spark):
    data = [(i, f"d{i % 7}", float(i % 10)) for i in range(400)]
    df = spark.createDataFrame(data, "id int, director string, avg_vote double")
    from filmlens.operators.relational import hash_percent, split_by_key

    changed = df.withColumn("avg_vote", F.when(hash_percent(["id"]) >= 80, F.lit(999.0)).otherwise(F.col("avg_vote")))
    mappings = []
    for frame in (df, changed):
        fitted = E.target_encode_fit(split_by_key(frame, ["id"])[0], "director", "avg_vote")
        mappings.append(sorted((r.director, round(r.encoding, 9)) for r in fitted.mapping.collect()))
    assert mappings[0] == mappings[1]


def test_large_lookup_equals_the_broadcast_one(spark, monkeypatch):
    """A third of the rows share a key and a third have none; sizes are set so that all paths are taken."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50))
    df = spark.range(3000).select("id", key.alias("k"), (F.col("id") % 11).cast("double").alias("y"))
    fitted = E.target_encode_fit(df, "k", "y")
    probe = df.select("id", "k").union(spark.createDataFrame([(-1, "unseen")], "id long, k string"))
    small = {r.id: r.k_encoded for r in E.encode_apply(probe, fitted).collect()}
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    for parts in (1000, 10, 2):
        monkeypatch.setattr(lookup, "HOT_PARTS", parts)
        large = E.encode_apply(probe, fitted, ["id"])
        assert {r.id: r.k_encoded for r in large.collect()} == small
    assert len(small) == 3001


@pytest.mark.parametrize("narrow,wide", [("int", "bigint"), ("float", "double"), ("smallint", "int")])
def test_both_ways_agree_on_keys_of_different_types(spark, narrow, wide):
    """Hot, rare, missing and unseen keys, fitted in one type and looked up in the other."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50 + 100)
    df = spark.range(600).select("id", key.alias("k"), (F.col("id") % 11).cast("double").alias("y"))
    probe = df.select("id", "k").union(spark.createDataFrame([(-1, 9999)], "id long, k long"))
    for fit_type, use_type in ((narrow, wide), (wide, narrow), (wide, wide)):
        fitted = E.target_encode_fit(df.withColumn("k", F.col("k").cast(fit_type)), "k", "y")
        asked = probe.withColumn("k", F.col("k").cast(use_type))
        small = {r.id: r.k_encoded for r in E.encode_apply(asked, fitted).collect()}
        large = {r.id: r.k_encoded for r in E.encode_apply(asked, fitted, ["id"], broadcast_bytes=0).collect()}
        assert small == large and len(set(small.values())) > 10
        assert small[-1] == fitted.default != small[0]


def test_a_lossy_lookup_is_refused(spark):
    fitted = E.frequency_encode_fit(spark.createDataFrame([("1",), ("2",)], "k string"), "k")
    with pytest.raises(TypeError):
        E.encode_apply(spark.range(3).select(F.col("id").alias("k")), fitted)


@pytest.mark.parametrize("mean", [0.0, 1e6, 1e9])
def test_encoding_correlation_of_large_values(spark, mean):
    df = spark.range(4000).select((F.col("id") % 20).alias("c"), (F.lit(mean) + (F.col("id") % 20) / 10.0 + (F.col("id") * 37 % 101) / 25.0).alias("y"))
    joined = df.join(df.groupBy("c").agg(F.avg(F.col("y") - mean).alias("m")), "c").withColumn("d", F.col("y") - mean)
    assert L.encoding_target_corr(df, "c", "y").first()["corr"] == pytest.approx(joined.stat.corr("d", "m"), abs=1e-5)


def test_hot_rows_spread_over_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(8000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"))
        fitted = E.frequency_encode_fit(df, "k")
        joined = E.encode_apply(df, fitted, ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = [r["count"] for r in E.encode_apply(df, fitted, ["id"]).groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * 8000 / 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_correlation_bands_and_verdict(spark):
    data = [(float(i), i * 2.0, (i % 3) * 1.0, 5.0) for i in range(30)]
    df = spark.createDataFrame(data, "y double, votes double, duration double, review_constant double")
    corrs = L.correlations(df, "y", ["votes", "duration", "review_constant"])
    found = {r.column: r.band for r in L.target_correlations(df, "y", ["votes", "duration", "review_constant"]).collect()}
    assert found == {"votes": "strong", "duration": "acceptable", "review_constant": "acceptable"}
    assert {r.column: r.status for r in L.leakage_ranking(corrs).collect()}["votes"] == "LEAKAGE"
    verdict = L.leakage_verdict(corrs).first()
    assert (verdict.n_flagged, verdict.flagged, verdict.verdict) == (1, "votes", "detected")
    assert L.leakage_verdict(corrs.filter("column = 'duration'")).first().verdict == "not detected"


def test_encoding_correlation_equals_the_join(spark):
    data = [(f"c{i % 5}", float((i * 37) % 23)) for i in range(200)] + [(None, 9.0), ("c1", None)]
    df = spark.createDataFrame(data, "c string, y double")
    clean = df.na.drop()
    joined = clean.join(clean.groupBy("c").agg(F.avg("y").alias("m")), "c")
    assert L.encoding_target_corr(df, "c", "y").first()["corr"] == pytest.approx(joined.stat.corr("y", "m"))
    means = E.group_mean_join(clean, "c", "y", "m")
    assert means.stat.corr("y", "m") == pytest.approx(joined.stat.corr("y", "m"))


def test_large_lookup_sorts_no_rows_while_a_task_can_hold_its_keys(spark):
    from dataclasses import replace

    rows = spark.range(3000).select("id", F.when(F.col("id") % 10 < 5, "hot").when(F.col("id") % 10 < 9, F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), (F.col("id") % 7).cast("double").alias("y"))
    fitted = E.target_encode_fit(rows.filter("id % 3 > 0"), "k", "y")
    sized = lambda n: replace(fitted, lookup=replace(fitted.lookup, n_bytes=n))
    few = E.encode_apply(rows, sized(lookup.BROADCAST_BYTES + 1), ["id"])
    many = E.encode_apply(rows, sized(1 << 60), ["id"])
    plan, sorted_plan = (df._jdf.queryExecution().executedPlan().toString() for df in (few, many))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "Sort " not in plan
    assert "SortMergeJoin" in sorted_plan
    expected = {r.id: r.k_encoded for r in E.encode_apply(rows, fitted, ["id"]).collect()}
    for df in (few, many):
        found = df.select("id", "k_encoded").collect()
        assert len(found) == 3000 and {r.id: r.k_encoded for r in found} == expected
