"""Three regressors on one shared feature table, and their weighted ensemble."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from filmlens.operators.cleaning import clean_required
from filmlens.plans.features import FeatureFrame, FeatureTables, feature_frame, fit_features, hash_text, split_table
from filmlens.plans.variants import Variant
from filmlens.sources.staging import materialize, staging_root

# Ensemble weights, and the parameters of the estimators below.
ENSEMBLE_WEIGHTS = {"ridge": 0.2, "forest": 0.3, "gbt": 0.5}

VARYING = "varying_features"
"""The scaled vector without the positions that are the same in all training rows."""


def regressors(label: str, gbt_iterations: int = 50, forest_trees: int = 30) -> dict[str, object]:
    """The three estimators with their parameters.

    The memory limit of the tree learners is raised so that a whole tree level
    is searched in one pass over the data.
    """
    common = {"labelCol": label, "featuresCol": "scaled_features"}
    trees = {"subsamplingRate": 0.8, "seed": 42, "maxMemoryInMB": 1024}
    return {
        "ridge": LinearRegression(**common, predictionCol="pred_ridge", maxIter=100, regParam=0.1, elasticNetParam=0.0, tol=1e-6),
        "forest": RandomForestRegressor(
            **common, **trees, predictionCol="pred_forest", numTrees=forest_trees, maxDepth=8, minInstancesPerNode=10
        ),
        "gbt": GBTRegressor(**common, **trees, predictionCol="pred_gbt", maxIter=gbt_iterations, maxDepth=5, stepSize=0.1),
    }


@dataclass(frozen=True)
class FittedModel:
    """A fitted regressor and the seconds its fit took.

    With ``positions`` the model reads only those of the scaled vector, in their order.
    """

    name: str
    model: Model
    seconds: float
    positions: tuple[int, ...] | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the model's prediction."""
        if self.positions is None:
            return self.model.transform(df)
        return self.model.transform(at_positions(df, self.positions)).drop(VARYING)

    def importances(self, width: int) -> np.ndarray:
        """A tree model's importance of each of the ``width`` positions of the scaled vector."""
        found = self.model.featureImportances.toArray()
        if self.positions is None:
            return found
        values = np.zeros(width)
        values[list(self.positions)] = found
        return values


def at_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Add ``varying_features``: the scaled vector at ``positions``."""
    return VectorSlicer(inputCol="scaled_features", outputCol=VARYING, indices=list(positions)).transform(df)


def fit_models(
    train: DataFrame,
    label: str,
    names: Sequence[str] = ("ridge", "forest", "gbt"),
    varying: Sequence[int] | None = None,
    **sizes: int,
) -> dict[str, FittedModel]:
    """Fit the named regressors on one prepared training table.

    ``varying`` are the vector positions that differ between training rows
    (:attr:`filmlens.plans.features.FeatureTables.varying`). Boosting searches
    all positions at every node, where one without a split costs as much as any
    other and is never chosen: its fit reads the varying ones alone, for the same
    trees. The forest draws a third of all positions at a node and gets them all.
    """
    estimators = regressors(label, **sizes)
    fitted = {}
    for name in names:
        started = time.monotonic()
        if name == "gbt" and varying:
            model = estimators[name].setFeaturesCol(VARYING).fit(at_positions(train, varying).select(label, VARYING))
            fitted[name] = FittedModel(name, model, time.monotonic() - started, tuple(varying))
        else:
            model = estimators[name].fit(train)
            fitted[name] = FittedModel(name, model, time.monotonic() - started)
    return fitted


def weighted_sum(weights: Mapping[str, float], prefix: str = "pred_") -> Column:
    """Weighted sum of prediction columns."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.col(f"{prefix}{name}") * weight
    return total


def score_all(fitted: Mapping[str, FittedModel], df: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Every model's prediction on the same row, and the ensemble if weights are given.

    The models are chained on one frame, so no join on generated row numbers
    is needed.
    """
    for entry in fitted.values():
        df = entry.transform(df)
    return df.withColumn("pred_ensemble", weighted_sum(weights)) if weights else df


@dataclass(frozen=True)
class TrainedVariant:
    """Everything one run of a variant produces; all frames are lazy or written tables."""

    variant: Variant
    frame: FeatureFrame
    tables: FeatureTables
    models: dict[str, FittedModel]
    scored: DataFrame

    @property
    def predictions(self) -> dict[str, str]:
        names = [*self.models, *(["ensemble"] if "pred_ensemble" in self.scored.columns else [])]
        return {name: f"pred_{name}" for name in names}


def prepare(df: DataFrame, variant: Variant, year: str = "year", **temporal: float) -> tuple[FeatureFrame, FeatureTables]:
    """Clean, split, engineer and assemble.

    The cleaned rows are written to the staging folder, with the hashed terms
    in place of the text: the encoders and the feature stages all read them
    again, and a lost executor must not bring back the joins behind them. The
    text is hashed here unless the caller has done so on its scan, before the
    joins behind ``df`` (:func:`filmlens.plans.features.hash_text`).
    """
    wanted = [variant.key, "desc_tf", variant.genre, *variant.categories, "duration", variant.target, "year_clean"]
    if variant.popularity:
        wanted += ["votes", "reviews_from_users", "reviews_from_critics"]
    clean = clean_required(df, variant.required, year)
    hashed = clean if "desc_tf" in df.columns else hash_text(clean, variant.text, variant.text_width)
    frame = feature_frame(split_table(hashed.select(*wanted), [variant.key], "clean"), variant, **temporal)
    return frame, fit_features(frame)


def train_variant(
    df: DataFrame,
    variant: Variant,
    names: Sequence[str] = ("ridge", "forest", "gbt"),
    year: str = "year",
    sizes: Mapping[str, int] | None = None,
    **temporal: float,
) -> TrainedVariant:
    """Run a variant from raw rows to scored test rows.

    The predictions are written once, without the vectors: metrics, worst
    errors and saved predictions all read that narrow table.
    """
    frame, tables = prepare(df, variant, year, **temporal)
    models = fit_models(tables.train, variant.target, names, tables.varying, **(sizes or {}))
    weights = ENSEMBLE_WEIGHTS if variant.ensemble and set(ENSEMBLE_WEIGHTS) <= set(models) else None
    scored = score_all(models, tables.test, weights).drop("features", "scaled_features")
    return TrainedVariant(variant, frame, tables, models, materialize(scored, "scored"))


def train_variants(
    df: DataFrame,
    variants: Sequence[Variant],
    names: Sequence[str] = ("ridge", "forest", "gbt"),
    year: str = "year",
    sizes: Mapping[str, int] | None = None,
    parallelism: int = 2,
    **temporal: float,
) -> list[TrainedVariant]:
    """Run several variants on the same raw rows, ``parallelism`` of them at a time.

    Boosting is a chain of some hundred short jobs, each of which waits for the
    one before and leaves cores idle; another variant's jobs fill them. Every
    second variant fits its models in the opposite order, so that one's forest
    meets the other's boosting, and two forests' rows are seldom cached at once.
    Each variant reads and writes what ``train_variant`` does, for the same
    models; only ``seconds`` of the fits include the time in which others had
    the cores.
    """
    spark = df.sparkSession
    staging_root(spark)  # Where this makes a temporary folder, it is made once, before the threads ask for it.

    def run(variant: Variant, order: Sequence[str]) -> Callable[[], TrainedVariant]:
        # Every thread gets local properties of its own, as in pyspark.ml.tuning.
        return inheritable_thread_target(spark)(lambda: train_variant(df, variant, order, year, sizes, **temporal))

    with ThreadPoolExecutor(parallelism) as pool:
        started = [pool.submit(run(v, names[::-1] if i % 2 else names)) for i, v in enumerate(variants)]
        return [s.result() for s in started]
