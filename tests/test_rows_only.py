"""Registered queries without a SQL counterpart: what must hold for their rows."""

import pytest
from pyspark.sql import functions as F

from filmlens import registry

SF_DIR = "/root/testdata/sf0.001"


def run(spark, name):
    return registry.queries()[name](spark, SF_DIR)


def test_sample(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    sample = run(spark, "sample_fraction")
    assert 0.05 < sample.count() / orders.count() < 0.2
    assert sample.join(orders, "o_orderkey", "left_anti").count() == 0
    assert sample.count() == run(spark, "sample_fraction").count()


def test_hashed_genre_is_one_entry(spark):
    found = run(spark, "feature_hasher")
    parts = spark.read.parquet(f"{SF_DIR}/part.parquet")
    assert found.count() == found.select("p_partkey").distinct().count() == parts.count()
    assert {r.value for r in found.select("value").distinct().collect()} == {1.0}
    assert found.select("bucket").distinct().count() <= parts.select("p_type").distinct().count()


def test_hashed_counts_add_up_to_the_tokens(spark):
    hashed = run(spark, "hashing_tf").groupBy("doc_id").agg(F.sum("tf").alias("n"))
    counted = run(spark, "text_tokens_filtered").filter("n_tokens > 0")
    assert hashed.count() == counted.count()
    assert hashed.join(counted, "doc_id").filter("n != n_tokens").count() == 0


def test_hashed_weights_scale_with_the_counts(spark):
    joined = run(spark, "hashed_tfidf").join(run(spark, "hashing_tf"), ["doc_id", "bucket"])
    spread = joined.groupBy("bucket").agg((F.max(F.col("tfidf") / F.col("tf")) - F.min(F.col("tfidf") / F.col("tf"))).alias("d"))
    assert spread.agg(F.max("d")).first()[0] == pytest.approx(0.0, abs=1e-9)


def test_feature_rows(spark):
    found = run(spark, "feature_stages")
    assert {r.width for r in found.select("width").distinct().collect()} == {124}
    assert run(spark, "feature_index_map").count() == 124
    assert found.count() == spark.read.parquet(f"{SF_DIR}/labels.parquet").join(
        spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id"
    ).count()


def test_ridge_scores_the_test_side(spark):
    scored = run(spark, "model_ridge")
    test_side = run(spark, "feature_stages").filter("side = 'test'")
    assert scored.count() == test_side.count() and scored.filter("prediction is null").count() == 0


def test_importances(spark):
    found = run(spark, "feature_importance").collect()
    assert {r.model for r in found} == {"forest", "gbt"} and all(r.rank <= 10 for r in found)
    shares = run(spark, "importance_share").collect()
    assert abs(sum(r.share for r in shares) - 1) < 1e-9


def test_whole_reports(spark):
    report = run(spark, "report_with_popularity").collect()
    assert {r.model for r in report} == {"ridge", "forest", "gbt", "ensemble"} and [r.rank for r in report] == [1, 2, 3, 4]
    worst = run(spark, "worst_intrinsic_frequency").groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count("prediction").alias("p")).collect()
    assert {(r.model, r.n, r.p) for r in worst} == {(m, 20, 20) for m in ("ridge", "forest", "gbt")}
