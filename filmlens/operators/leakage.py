"""Diagnostics for predictors that already contain the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlens.functions.bands import correlation_band, encoding_band
from filmlens.operators.cleaning import require


def pearson(x: str, y: str) -> Column:
    """Pearson correlation over the rows that have both values; null if either is constant.

    The built-in ``corr`` raises a division error on a constant column in ANSI mode.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Correlation of every column with the target, in one aggregate."""
    stats = df.agg(*[F.struct(F.lit(c).alias("column"), pearson(target, c).alias("corr")).alias(f"c_{i}") for i, c in enumerate(columns)])
    return stats.select(F.inline(F.array(*[F.col(f"c_{i}") for i in range(len(columns))])))


def target_correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Correlations with their band, highest signed value first."""
    found = correlations(df, target, columns).withColumn("band", correlation_band(F.col("corr")))
    return found.orderBy(F.desc("corr"), "column")


def _suspect(threshold: float, name_tokens: Sequence[str]) -> Column:
    named = F.lit(False)
    for token in name_tokens:
        named = named | F.col("column").contains(token)
    return F.coalesce((F.abs("corr") > threshold) & named, F.lit(False))


def leakage_ranking(corrs: DataFrame, threshold: float = 0.5, name_tokens: Sequence[str] = ("vote", "review")) -> DataFrame:
    """Columns by absolute correlation, flagged when strong and named after the outcome."""
    return corrs.select(
        "column",
        F.abs("corr").alias("importance"),
        F.when(_suspect(threshold, name_tokens), "LEAKAGE").otherwise("OK").alias("status"),
    ).orderBy(F.desc("importance"), "column")


def leakage_verdict(corrs: DataFrame, threshold: float = 0.5, name_tokens: Sequence[str] = ("vote", "review")) -> DataFrame:
    """One row: the flagged columns and whether there are any.

    The input has one row per examined column, so the list is as short as the
    list of columns.
    """
    suspects = F.array_sort(F.collect_list(F.when(_suspect(threshold, name_tokens), F.col("column"))))
    return corrs.agg(suspects.alias("found")).select(
        F.size("found").cast("bigint").alias("n_flagged"),
        F.array_join("found", ",").alias("flagged"),
        F.when(F.size("found") > 0, "detected").otherwise("not detected").alias("verdict"),
    )


def encoding_target_corr(df: DataFrame, column: str, target: str) -> DataFrame:
    """Correlation between the target and the mean target of the row's own category.

    The covariance of a value with its group mean is the variance of the group
    mean, so the correlation is the root of the between-group share of the
    total sum of squares. It follows from one row per category; the means are
    never joined back to the rows. Values are centred on the global mean first:
    sums of squares of large values would cancel.
    """
    present = require(df.select(F.col(column).alias("category"), F.col(target).cast("double").alias("target")), ["category", "target"])
    centre = present.select(F.coalesce(F.avg("target"), F.lit(0.0))).scalar()
    per_category = present.select("category", (F.col("target") - centre).alias("target")).groupBy("category").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg("target").alias("mean"),
        F.var_pop("target").alias("within"),
    )
    sums = per_category.agg(
        F.count(F.lit(1)).alias("n_categories"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("between"),
        F.sum(F.col("n") * F.col("within")).alias("within"),
    )
    corr = F.sqrt(F.try_divide(F.col("between"), F.col("between") + F.col("within")))
    return sums.select("n_categories", F.col("n").cast("bigint").alias("n_rows"), corr.alias("corr")).withColumn(
        "band", encoding_band(F.col("corr"))
    )


def importance_share(importance: DataFrame, alarm: float = 0.7) -> DataFrame:
    """Share of the total importance per feature group; one group above ``alarm`` dominates.

    The input has one row per model feature.
    """
    total = importance.select(F.sum("importance")).scalar()
    shares = importance.groupBy("group").agg(F.sum("importance").alias("importance"), F.count(F.lit(1)).alias("n_features"))
    share = F.try_divide(F.col("importance"), total)
    return shares.select("group", "n_features", "importance", share.alias("share"), (share > alarm).alias("dominates")).orderBy(
        F.desc("share"), "group"
    )
