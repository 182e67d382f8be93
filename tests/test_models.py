"""Text and vector features, models and reports: invariants and small brute-force checks."""

import math
import re
import threading
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from filmlens.functions.stopwords import ENGLISH
from filmlens.functions.text import content_tokens, term_tfidf
from filmlens.operators.leakage import importance_share
from filmlens.operators.cleaning import clean_required
from filmlens.operators.relational import hash_percent, split_by_key
from filmlens.plans import evaluation as V
from filmlens.plans.features import feature_index_map, feature_stages, feature_summary, text_stages
from filmlens.plans.models import ENSEMBLE_WEIGHTS, fit_models, regressors, train_variant, train_variants
from filmlens.plans.variants import INTRINSIC_FREQUENCY, INTRINSIC_TARGET, VARIANTS, WITH_POPULARITY

TEXTS = [
    (0, "The Cat sat on THE mat, the cat's mat!"),
    (1, "A réaile café; cats don't"),
    (2, ""),
    (3, "dog dog dog cat whose under over"),
    (4, "cat dog bird"),
]


def py_tokens(text):
    return [w for w in re.split(r"[^A-Za-z0-9_]+", text.lower()) if len(w) >= 3 and w not in ENGLISH]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "id int, text string")


def test_stop_words_are_the_default_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert ENGLISH == [w for w in ENGLISH if w in set(StopWordsRemover.loadDefaultStopWords("english"))]
    assert set(ENGLISH) == set(StopWordsRemover.loadDefaultStopWords("english"))


def test_tokens(docs):
    found = {r.id: r.words for r in docs.select("id", content_tokens("text").alias("words")).collect()}
    assert found == {i: py_tokens(t) for i, t in TEXTS}
    from pyspark.ml import Pipeline

    stages = Pipeline(stages=text_stages("text")[:2]).fit(docs).transform(docs)
    assert {r.id: r.desc_filtered for r in stages.collect()} == found


def test_tfidf_brute_force(docs):
    is_train = hash_percent(["id"]) < 80
    train = {r.id for r in docs.filter(is_train).collect()}
    df = Counter(w for i, t in TEXTS if i in train for w in set(py_tokens(t)))
    expected = {
        (i, w): n * math.log((len(train) + 1) / (df[w] + 1)) for i, t in TEXTS for w, n in Counter(py_tokens(t)).items()
    }
    found = {(r.id, r.term): r.tfidf for r in term_tfidf(docs, "id", "text", is_train).collect()}
    assert found == pytest.approx(expected)


def test_hashed_weights_sum_to_the_token_count(spark, docs):
    from pyspark.ml import Pipeline

    hashed = Pipeline(stages=text_stages("text")[:3]).fit(docs).transform(docs)
    sums = {r.id: r.n for r in hashed.select("id", F.aggregate(vector_to_array("desc_tf"), F.lit(0.0), lambda a, b: a + b).alias("n")).collect()}
    assert sums == {i: len(py_tokens(t)) for i, t in TEXTS}


def film_rows(n=240):
    rows = []
    for i in range(n):
        director, actors = f"d{i % 6}", f"a{i % 40}"
        score = 4.0 + (i % 6) * 0.5 + ((i * 7) % 10) / 10
        year = f"TV Movie {1970 + i % 50}" if i % 9 == 0 else str(1970 + i % 50)
        text = None if i == 5 else f"film number {i % 13} about {'cats' if i % 2 else 'dogs'}"
        rows.append((f"t{i}", text, f"g{i % 4}", director, actors, 70 + i % 80, year, score, 100 + i, float(i % 30), float(i % 12)))
    return rows


@pytest.fixture(scope="module")
def films(spark):
    schema = (
        "title_id string, description string, genre string, director string, actors string, duration int, year string, "
        "avg_vote double, votes int, reviews_from_users double, reviews_from_critics double"
    )
    return spark.createDataFrame(film_rows(), schema)


SIZES = {"gbt_iterations": 3, "forest_trees": 5}


@pytest.fixture(scope="module")
def trained(films):
    return {name: train_variant(films, v, sizes=SIZES) for name, v in VARIANTS.items()}


@pytest.mark.parametrize("variant,width", [(WITH_POPULARITY, 130), (INTRINSIC_TARGET, 124), (INTRINSIC_FREQUENCY, 124)])
def test_width_and_rows(trained, variant, width):
    run = trained[variant.name]
    assert variant.width == width
    both = run.tables.train.unionByName(run.tables.test)
    assert {r.n for r in both.select(F.size(vector_to_array("features")).alias("n")).collect()} == {width}
    assert both.count() == 239 and both.select("title_id").distinct().count() == 239
    assert run.scored.count() == run.tables.test.count()


def test_scaled_features_have_unit_deviation(trained):
    values = np.array([r.v for r in trained["intrinsic_target"].tables.train.select(vector_to_array("scaled_features").alias("v")).collect()])
    deviation = values.std(axis=0, ddof=1)
    assert np.allclose(deviation[deviation > 0], 1.0)


def test_stages_fitted_apart_equal_the_whole(films, trained):
    run = trained["intrinsic_target"]
    train = run.frame.apply(split_by_key(clean_required(films, INTRINSIC_TARGET.required), ["title_id"])[0])
    whole = feature_stages(INTRINSIC_TARGET).fit(train).transform(train)
    assert {r.title_id for r in whole.collect()} == {r.title_id for r in run.tables.train.collect()}
    ours = {r.title_id: r.v for r in run.tables.train.select("title_id", vector_to_array("scaled_features").alias("v")).collect()}
    for same in (whole, run.tables.stages.transform(train)):
        for r in same.select("title_id", vector_to_array("scaled_features").alias("v")).collect():
            assert ours[r.title_id] == pytest.approx(r.v)


def test_ensemble_is_the_weighted_sum(trained):
    run = trained["intrinsic_target"]
    assert sum(ENSEMBLE_WEIGHTS.values()) == pytest.approx(1.0)
    for r in run.scored.collect():
        assert r.pred_ensemble == pytest.approx(0.2 * r.pred_ridge + 0.3 * r.pred_forest + 0.5 * r.pred_gbt, abs=1e-12)
    assert "pred_ensemble" not in trained["intrinsic_frequency"].scored.columns


def test_boosting_reads_varying_positions_for_the_same_trees(trained):
    run = trained["intrinsic_target"]
    fitted = run.models["gbt"]
    vectors = np.array([r.v for r in run.tables.train.select(vector_to_array("scaled_features").alias("v")).collect()])
    assert list(fitted.positions) == [i for i in range(124) if len(set(vectors[:, i])) > 1]
    assert fitted.model.numFeatures == len(fitted.positions) < 124
    whole = regressors("avg_vote", gbt_iterations=3)["gbt"].fit(run.tables.train)
    assert fitted.importances(124).tolist() == whole.featureImportances.toArray().tolist()
    expected = {r.title_id: r.pred_gbt for r in whole.transform(run.tables.test).collect()}
    assert {r.title_id: r.pred_gbt for r in run.scored.collect()} == expected


def test_both_compared_variants_boost_on_varying_positions(trained):
    for variant in (WITH_POPULARITY, INTRINSIC_TARGET):
        run = trained[variant.name]
        fitted = run.models["gbt"]
        assert fitted.model.numFeatures == len(run.tables.varying) < variant.width
        named = V.feature_importance(fitted, run.scored, variant, None).collect()
        assert len(named) == variant.width and sum(r.importance for r in named) == pytest.approx(1.0)
        assert {r["index"] for r in named if r.importance > 0} <= set(fitted.positions)


def test_variants_trained_at_the_same_time_are_those_trained_alone(films, trained):
    runs = train_variants(films, (WITH_POPULARITY, INTRINSIC_TARGET, INTRINSIC_FREQUENCY), sizes=SIZES)
    assert [r.variant.name for r in runs] == ["with_popularity", "intrinsic_target", "intrinsic_frequency"]
    for run in runs:
        alone = trained[run.variant.name]
        assert run.predictions.keys() == alone.predictions.keys()
        columns = ["title_id", "avg_vote", *sorted(alone.predictions.values())]
        assert sorted(run.scored.select(columns).collect()) == sorted(alone.scored.select(columns).collect())


def test_the_comparison_trains_its_variants_at_the_same_time(spark, trained, monkeypatch):
    """Each training waits here until the other has begun too; both see the caller's job description, each for itself."""
    from filmlens.plans import models
    from filmlens.registry import models as registered

    met, context, seen = threading.Barrier(2, timeout=60), spark.sparkContext, {}

    def stub(df, variant, *args, **kwargs):
        inherited = context.getLocalProperty("spark.job.description")
        met.wait()
        context.setLocalProperty("spark.job.description", variant.name)
        met.wait()
        seen[variant.name] = (inherited, context.getLocalProperty("spark.job.description"))
        return trained[variant.name]

    for module in (models, registered):
        monkeypatch.setattr(module, "train_variant", stub)
    context.setJobDescription("comparison")
    try:
        found = {r.model: r for r in registered.variant_comparison(spark, "/root/testdata/sf0.001").collect()}
    finally:
        context.setLocalProperty("spark.job.description", None)
    assert seen == {v.name: ("comparison", v.name) for v in (WITH_POPULARITY, INTRINSIC_TARGET)}
    first, second = ({r.model: r.rmse for r in V.variant_metrics(trained[v.name]).collect()} for v in (WITH_POPULARITY, INTRINSIC_TARGET))
    assert {m: (r.rmse_first, r.rmse_second) for m, r in found.items()} == {m: pytest.approx((first[m], second[m])) for m in first}


def test_a_failing_variant_fails_the_whole(films, monkeypatch):
    from filmlens.plans import models

    def stub(df, variant, *args, **kwargs):
        if variant is INTRINSIC_TARGET:
            raise ValueError("no rows")

    monkeypatch.setattr(models, "train_variant", stub)
    with pytest.raises(ValueError, match="no rows"):
        train_variants(films, (WITH_POPULARITY, INTRINSIC_TARGET))


def test_boosting_without_varying_positions_reads_all(spark):
    rows = spark.createDataFrame([(float(i % 3), Vectors.dense([0.0, 0.0])) for i in range(30)], ["avg_vote", "scaled_features"])
    fitted = fit_models(rows, "avg_vote", ["gbt"], varying=[], gbt_iterations=2)["gbt"]
    assert fitted.positions is None and fitted.transform(rows).filter("pred_gbt IS NULL").count() == 0


def test_metrics_match_the_evaluator(trained):
    from pyspark.ml.evaluation import RegressionEvaluator

    run = trained["intrinsic_target"]
    for row in V.variant_metrics(run).collect():
        evaluator = RegressionEvaluator(labelCol="avg_vote", predictionCol=f"pred_{row.model}")
        for metric in ("rmse", "mae", "r2", "mse"):
            assert row[metric] == pytest.approx(evaluator.setMetricName(metric).evaluate(run.scored))
        assert row.mse == pytest.approx(row.rmse**2)


def test_report_and_ranking(spark, trained):
    report = V.model_report(trained["intrinsic_target"]).collect()
    assert [r.rmse for r in report] == sorted(r.rmse for r in report)
    assert {r.model: r.fit_seconds is None for r in report} == {"ridge": False, "forest": False, "gbt": False, "ensemble": True}
    metrics = spark.createDataFrame(
        [("ridge", 2.0, 1.5, 0.4, 4.0), ("gbt", 1.5, 1.0, 0.6, 2.25)], "model string, rmse double, mae double, r2 double, mse double"
    )
    best = V.model_ranking(metrics).first()
    assert (best.rank, best.model, best.is_best) == (1, "gbt", True)
    assert (best.rmse_gain_pct, best.r2_gain_pct) == pytest.approx((25.0, 50.0))
    compared = V.variant_comparison(metrics, metrics.withColumn("r2", F.col("r2") - 0.2)).collect()
    assert [(r.model, r.r2_drop, r.first_suspect, r.second_realistic) for r in compared] == [
        ("gbt", pytest.approx(0.2), False, True),
        ("ridge", pytest.approx(0.2), False, True),
    ]


def test_importance_names_and_shares(trained):
    run = trained["intrinsic_target"]
    everything = V.feature_importance(run.models["forest"], run.scored, INTRINSIC_TARGET, None)
    assert everything.count() == 124
    assert everything.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert V.feature_importance(run.models["gbt"], run.scored, INTRINSIC_TARGET, 10).count() == 10
    shares = importance_share(everything).collect()
    assert sum(r.share for r in shares) == pytest.approx(1.0)
    assert {r.group for r in shares} == {"text", "genre", "target_encoding", "numeric"}


def test_index_map(spark, trained):
    names = {r["index"]: r["name"] for r in feature_index_map(spark, INTRINSIC_TARGET).collect()}
    assert names[0] == "description[0]" and names[100] == "genre[0]" and names[115] == "genre[15]"
    assert [names[i] for i in range(116, 124)] == [
        "director_encoded", "actors_encoded", "duration", "duration_indexed", "year_clean", "decade", "is_recent", "is_old_classic",
    ]
    assert feature_summary(trained["intrinsic_target"].tables.train, INTRINSIC_TARGET).count() == 124


def test_worst_errors_break_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1.0, 3.0), ("a", 1.0, 3.0), ("c", 1.0, 9.0)], "k string, y double, p double")
    assert [r.k for r in V.worst_errors(df, "y", "p", "k", 2).collect()] == ["c", "a"]


def test_ridge_brute_force(spark):
    """Ridge with standardised features against the closed form."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) * [1.0, 5.0, 0.2]
    y = x @ [1.0, -0.3, 4.0] + 2.0 + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x, y)], ["avg_vote", "scaled_features"])
    model = fit_models(df, "avg_vote", ["ridge"])["ridge"].model
    sx, sy = x.std(axis=0, ddof=1), y.std(ddof=1)
    z, t = (x - x.mean(axis=0)) / sx, (y - y.mean()) / sy
    # The penalty applies to the standardised coefficients; lambda is given on the target's own scale.
    beta = np.linalg.solve(z.T @ z / len(y) + 0.1 / sy * np.eye(3), z.T @ t / len(y)) * sy / sx
    assert model.coefficients.toArray() == pytest.approx(beta, rel=2e-2)


def test_a_read_of_one_side_leaves_out_the_other(spark):
    from filmlens.plans.features import one_side, split_table

    rows = split_table(spark.range(500).withColumnRenamed("id", "k"), ["k"], "sides")
    train, test = one_side(rows, "train"), one_side(rows, "test")
    assert "PartitionFilters: [isnotnull(side" in train._jdf.queryExecution().executedPlan().toString()
    assert train.count() + test.count() == 500 and train.join(test, "k").count() == 0 and train.columns == ["k"]


def test_rows_that_are_not_dealt_are_written_where_they_are(spark):
    from filmlens.plans.features import split_table

    rows = spark.range(500).withColumnRenamed("id", "k").repartition(3)
    kept, dealt = split_table(rows, ["k"], "kept", dealt=False), split_table(rows, ["k"], "dealt")
    assert {r.k: r.side for r in kept.collect()} == {r.k: r.side for r in dealt.collect()}
    assert len(kept.inputFiles()) == 3 and not any("side=" in f for f in kept.inputFiles())


def test_texts_stay_below_every_shuffle(spark):
    """Profiles and features read texts on their scan; what is shuffled or joined no longer has them."""
    from filmlens.operators import profiling as P
    from filmlens.registry.tables import documents_film, labelled_documents

    for df in (P.null_profile(labelled_documents(spark, "/root/testdata/sf0.001", P.blank_marks)), documents_film(spark, "/root/testdata/sf0.001")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joined = next(line for line in plan.splitlines() if "Join" in line)
        below = plan.split(joined)[1].splitlines()
        project = next(line for line in below if "Project" in line)
        assert " text#" not in project.replace("AS text#", "") and "[text#" not in project
