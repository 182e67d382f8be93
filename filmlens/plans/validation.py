"""Cross-validation in which everything fitted, encoders included, sees the training folds only."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlens.operators.cleaning import clean_required
from filmlens.operators.encoding import FOLD_SEED, fold_number
from filmlens.operators.lookup import BROADCAST_BYTES
from filmlens.plans.evaluation import regression_metrics
from filmlens.plans.features import feature_frame, fit_features, hash_text
from filmlens.plans.variants import Variant
from filmlens.sources.staging import materialize

FitAndScore = Callable[[DataFrame], DataFrame]


def fold_table(df: DataFrame, keys: Sequence[str], folds: int = 5, name: str = "folds", seed: int = FOLD_SEED) -> DataFrame:
    """Write ``df`` once with its ``fold`` as the folder of each row; a round that leaves a fold out does not open its files to train."""
    if folds < 2:
        raise ValueError("folds must be at least 2")
    return materialize(df.withColumn("fold", fold_number(keys, folds, seed)), name, list(keys), ["fold"])


def sides_of_fold(rows: DataFrame, fold: int) -> DataFrame:
    """The rows of one round: ``side`` is test for the fold's own rows, train for all others."""
    return rows.withColumn("side", F.when(F.col("fold") == fold, "test").otherwise("train")).drop("fold")


def fold_counts(rows: DataFrame, folds: int) -> DataFrame:
    """Rows for training and testing of every round, in one pass over the fold folders."""
    sizes = [F.count_if(F.col("fold") == k).alias(f"n_{k}") for k in range(folds)]
    entries = [F.struct(F.lit(k).alias("fold"), (F.col("n") - F.col(f"n_{k}")).alias("n_train"), F.col(f"n_{k}").alias("n_test")) for k in range(folds)]
    return rows.agg(F.count(F.lit(1)).alias("n"), *sizes).select(F.inline(F.array(*entries)))


def broadcast_share(rounds: int) -> int:
    """Largest key table that one of several rounds sends to every executor: all rounds together send no more than one lookup may."""
    return BROADCAST_BYTES // rounds


def cross_validate(rows: DataFrame, folds: int, fit_and_score: FitAndScore, label: str, predictions: Mapping[str, str]) -> DataFrame:
    """Metrics of every round and model: ``fold, model, rmse, mae, r2, mse``.

    ``rows`` is a fold table. ``fit_and_score`` gets the rows of one round with
    their ``side`` and returns the test rows with the label and all prediction
    columns: it must fit on the training side alone. The scores of a round are
    written once, so a round's fits do not stay in the plans of the next.
    """
    found = None
    for k in range(folds):
        scored = fit_and_score(sides_of_fold(rows, k)).select(label, *predictions.values())
        metrics = regression_metrics(materialize(scored, f"scores-{k}"), label, predictions).select(F.lit(k).alias("fold"), "*")
        found = metrics if found is None else found.unionByName(metrics)
    return found


def cross_validation_summary(metrics: DataFrame) -> DataFrame:
    """Mean and spread over the folds of each model, best mean RMSE first. The input has one row per fold and model."""
    spread: Callable[[str], Column] = lambda c: F.coalesce(F.stddev_samp(c), F.lit(0.0))
    summary = metrics.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_folds"),
        F.avg("rmse").alias("rmse_mean"),
        spread("rmse").alias("rmse_spread"),
        F.avg("r2").alias("r2_mean"),
        spread("r2").alias("r2_spread"),
    )
    best = F.min_by(F.col("model"), F.struct("rmse_mean", "model"))
    return summary.crossJoin(F.broadcast(summary.agg(best.alias("best")))).select(
        *summary.columns, (F.col("model") == F.col("best")).alias("is_best")
    ).orderBy("rmse_mean", "model")


def cross_validate_variant(
    df: DataFrame, variant: Variant, grid: Mapping[str, Estimator], folds: int = 5, year: str = "year", **temporal: float
) -> DataFrame:
    """Cross-validate a model variant: metrics of every fold and grid point.

    In each round the encoders, the genre list, the term weights, the duration
    index and the scaler are fitted anew on the training folds, once for all grid
    points. ``grid`` names estimators on ``scaled_features``; their prediction
    column must be ``pred_`` and the name.
    """
    wanted = [variant.key, "desc_tf", variant.genre, *variant.categories, "duration", variant.target, "year_clean"]
    if variant.popularity:
        wanted += ["votes", "reviews_from_users", "reviews_from_critics"]
    clean = clean_required(df, variant.required, year)
    hashed = clean if "desc_tf" in df.columns else hash_text(clean, variant.text, variant.text_width)
    rows = fold_table(hashed.select(*wanted), [variant.key], folds)

    def fit_and_score(sides: DataFrame) -> DataFrame:
        tables = fit_features(feature_frame(sides, variant, broadcast_bytes=broadcast_share(folds), **temporal))
        scored = tables.test
        for estimator in grid.values():
            scored = estimator.fit(tables.train).transform(scored)
        return scored

    return cross_validate(rows, folds, fit_and_score, variant.target, {name: f"pred_{name}" for name in grid})
