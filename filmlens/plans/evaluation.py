"""Metrics, worst errors, rankings and comparison reports as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmlens.functions.bands import r2_band, r2_band_intrinsic
from filmlens.plans.features import feature_index_map
from filmlens.plans.models import FittedModel, TrainedVariant
from filmlens.plans.variants import Variant


def regression_metrics(df: DataFrame, label: str, predictions: Mapping[str, str]) -> DataFrame:
    """RMSE, MAE, R2 and MSE of every prediction column, in one aggregate."""
    columns = [F.count(F.lit(1)).alias("n"), F.var_pop(label).alias("spread")]
    for i, column in enumerate(predictions.values()):
        error = F.col(label) - F.col(column)
        columns += [F.avg(error * error).alias(f"mse_{i}"), F.avg(F.abs(error)).alias(f"mae_{i}")]
    entries = [
        F.struct(
            F.lit(name).alias("model"),
            F.sqrt(f"mse_{i}").alias("rmse"),
            F.col(f"mae_{i}").alias("mae"),
            (F.lit(1.0) - F.try_divide(F.col(f"mse_{i}"), F.col("spread"))).alias("r2"),
            F.col(f"mse_{i}").alias("mse"),
        )
        for i, name in enumerate(predictions)
    ]
    return df.agg(*columns).select(F.inline(F.array(*entries)))


def worst_errors(df: DataFrame, label: str, prediction: str, key: str, n: int = 20) -> DataFrame:
    """The ``n`` rows with the largest absolute error; ties go to the smaller key."""
    error = F.abs(F.col(label) - F.col(prediction))
    return (
        df.select(key, F.col(label).alias("real"), F.col(prediction).alias("prediction"), error.alias("error"))
        .orderBy(F.desc("error"), F.asc(key))
        .limit(n)
    )


def _gain(baseline: Column, value: Column) -> Column:
    return F.try_divide((baseline - value) * 100.0, baseline)


def model_ranking(metrics: DataFrame, baseline: str = "ridge") -> DataFrame:
    """Models by RMSE with their gain over the baseline.

    The window spans the metrics table, which has one row per model.
    """
    everything = Window.partitionBy()
    base_rmse = F.max(F.when(F.col("model") == baseline, F.col("rmse"))).over(everything)
    base_r2 = F.max(F.when(F.col("model") == baseline, F.col("r2"))).over(everything)
    rank = F.row_number().over(everything.orderBy("rmse", "model"))
    return metrics.select(
        rank.alias("rank"),
        "model",
        "rmse",
        "mae",
        "r2",
        (rank == 1).alias("is_best"),
        _gain(base_rmse, F.col("rmse")).alias("rmse_gain_pct"),
        (-_gain(base_r2, F.col("r2"))).alias("r2_gain_pct"),
    ).orderBy("rank")


def r2_bands(metrics: DataFrame) -> DataFrame:
    """Plausibility of every model's R2 in both scales."""
    return metrics.select("model", "r2", r2_band(F.col("r2")).alias("band"), r2_band_intrinsic(F.col("r2")).alias("band_intrinsic"))


def feature_importance(fitted: FittedModel, scored: DataFrame, variant: Variant, n: int | None = 10) -> DataFrame:
    """Importances of a tree model with the names behind the vector positions.

    The vector has one entry per feature, so its length is the variant's width.
    """
    values = fitted.importances(variant.width)
    spark = scored.sparkSession
    found = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "index int, importance double")
    rank = F.row_number().over(Window.partitionBy().orderBy(F.desc("importance"), "index"))
    ranked = found.join(F.broadcast(feature_index_map(spark, variant)), "index").select(rank.alias("rank"), "index", "name", "group", "importance")
    return (ranked.filter(F.col("rank") <= n) if n else ranked).orderBy("rank")


def variant_metrics(trained: TrainedVariant) -> DataFrame:
    """Metrics of all predictions of a trained variant on its test rows."""
    return regression_metrics(trained.scored, trained.variant.target, trained.predictions)


def model_report(trained: TrainedVariant) -> DataFrame:
    """Metrics with the fit time, best model first."""
    seconds = F.create_map(*[part for f in trained.models.values() for part in (F.lit(f.name), F.lit(f.seconds))])
    return variant_metrics(trained).withColumn("fit_seconds", F.try_element_at(seconds, F.col("model"))).orderBy("rmse", "model")


def variant_comparison(first: DataFrame, second: DataFrame, suspect_above: float = 0.7, realistic_below: float = 0.5) -> DataFrame:
    """Two variants' metrics per model: ``first`` may leak, ``second`` is the corrected one."""
    left = first.select("model", F.col("rmse").alias("rmse_first"), F.col("r2").alias("r2_first"))
    right = second.select("model", F.col("rmse").alias("rmse_second"), F.col("r2").alias("r2_second"))
    return (
        left.join(right, "model")
        .select(
            "*",
            (F.col("r2_first") - F.col("r2_second")).alias("r2_drop"),
            (F.col("r2_first") > suspect_above).alias("first_suspect"),
            (F.col("r2_second") < realistic_below).alias("second_realistic"),
        )
        .orderBy("model")
    )
