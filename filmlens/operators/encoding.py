"""Category encoders: fitted on the training rows, applied to any rows.

A fit is one grouped aggregate written as a small table with one row per
category. Applying it is a lookup join; nothing per category reaches the
driver and no Python function runs per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlens.operators.lookup import Lookup, build_lookup, lookup_join
from filmlens.operators.relational import hash_number


@dataclass(frozen=True)
class Encoding:
    """A fitted encoder: the mapping per category and the value for unseen ones."""

    column: str
    suffix: str
    lookup: Lookup
    default: float | None

    @property
    def mapping(self) -> DataFrame:
        """One row per category of the training rows (null is a category)."""
        return self.lookup.table

    @property
    def n_entries(self) -> int:
        """Categories plus the entry for unseen ones."""
        return self.lookup.n_keys + 1

    @property
    def output(self) -> str:
        return f"{self.column}_{self.suffix}"


def category_means(df: DataFrame, column: str, target: str) -> DataFrame:
    """Mean target and row count per category."""
    return df.groupBy(column).agg(F.avg(target).alias("category_mean"), F.count(F.lit(1)).alias("category_count"))


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Row count per category."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("category_count"))


def _smoothed(mean: Column, n: Column, overall: float | None, smoothing: float) -> Column:
    return (mean * n + F.lit(overall) * F.lit(smoothing)) / (n + F.lit(smoothing))


def target_encode_fit(train: DataFrame, column: str, target: str, smoothing: float = 10.0) -> Encoding:
    """Smoothed category means ``(mean * n + global * smoothing) / (n + smoothing)``.

    Unseen categories get the global training mean. A training row's own
    target is part of its category's mean: that is the leakage the diagnostics
    in ``operators.leakage`` make visible.
    """
    stats = train.groupBy(column).agg(
        F.avg(target).alias("category_mean"),
        F.count(F.lit(1)).alias("category_count"),
        F.count(target).alias("target_count"),
    )
    weighted = F.sum(F.col("category_mean") * F.col("target_count"))
    mean = F.try_divide(weighted, F.sum("target_count")).alias("global_mean")
    lookup, measured = build_lookup(stats, column, "category_mean", "category_count", f"means-{column}", mean)
    smoothed = _smoothed(F.col("category_mean"), F.col("category_count"), measured.global_mean, smoothing)
    return Encoding(column, "encoded", lookup.derive("encoding", smoothed), measured.global_mean)


def frequency_encode_fit(train: DataFrame, column: str) -> Encoding:
    """Category shares ``n / total``; unseen categories get ``1 / total``."""
    lookup, _ = build_lookup(category_counts(train, column), column, "category_count", "category_count", f"counts-{column}")
    share = F.col("category_count") / F.lit(float(lookup.n_rows))
    return Encoding(column, "freq", lookup.derive("encoding", share), 1.0 / lookup.n_rows if lookup.n_rows else None)


def encode_apply(df: DataFrame, encoding: Encoding, spread: list[str] | None = None, broadcast_bytes: int | None = None) -> DataFrame:
    """Replace the category column by its encoding, named by ``encoding.output``."""
    joined = lookup_join(df, encoding.column, encoding.lookup, encoding.output, spread, broadcast_bytes)
    value = F.coalesce(F.col(encoding.output), F.lit(encoding.default).cast("double"))
    return joined.withColumn(encoding.output, value).drop(encoding.column)


def encode_apply_grid(
    df: DataFrame, encoding: Encoding, smoothings: Mapping[str, float], spread: list[str] | None = None, broadcast_bytes: int | None = None
) -> DataFrame:
    """Replace the category by one target encoding for each smoothing strength, under the strengths' names.

    The strengths share one fit and one join: only the weight of its global mean differs.
    """
    parts = encoding.lookup.derive("__means", F.struct(F.col("category_mean").alias("mean"), F.col("category_count").alias("n")))
    joined = lookup_join(df, encoding.column, parts, "__means", spread, broadcast_bytes)
    overall = F.lit(encoding.default).cast("double")
    values = {c: F.coalesce(_smoothed(F.col("__means.mean"), F.col("__means.n"), encoding.default, s), overall) for c, s in smoothings.items()}
    return joined.withColumns(values).drop(encoding.column, "__means")


@dataclass(frozen=True)
class FoldedEncoding:
    """A target encoder with one value per category and fold, each fitted on the rows of all other folds.

    The mapping has an array ``encodings`` of ``folds + 1`` values: the one at a
    fold's number leaves that fold out, the last leaves nothing out. ``defaults``
    are the values for unseen categories, in the same order.
    """

    column: str
    lookup: Lookup
    defaults: tuple[float | None, ...]
    keys: tuple[str, ...]
    seed: int

    @property
    def folds(self) -> int:
        return len(self.defaults) - 1

    @property
    def mapping(self) -> DataFrame:
        return self.lookup.table

    @property
    def output(self) -> str:
        return f"{self.column}_encoded"

    def fold(self) -> Column:
        """The fold of a training row."""
        return fold_number(self.keys, self.folds, self.seed)


FOLD_SEED = 43


def fold_number(keys: Sequence[str], folds: int, seed: int = FOLD_SEED) -> Column:
    """A fold, 0 to ``folds - 1``, that depends only on the key values and the seed."""
    return F.pmod(hash_number(keys, seed), F.lit(folds)).cast("int")


def kfold_encode_fit(
    train: DataFrame, column: str, target: str, keys: Sequence[str], folds: int = 5, smoothing: float = 10.0, seed: int = FOLD_SEED
) -> FoldedEncoding:
    """Smoothed category means for each fold, from the rows of the other folds only.

    A training row's own target, and those of its whole fold, are not part of its
    encoding. One grouped aggregate keeps the sums without each fold side by side;
    sums are never subtracted from each other. Null is a category.
    """
    if folds < 2:
        raise ValueError("folds must be at least 2")
    rows = train.select(F.col(column), F.col(target).cast("double").alias("__y"), fold_number(keys, folds, seed).alias("__fold"))
    outside = [F.col("__fold") != k for k in range(folds)] + [F.lit(True)]
    stats = rows.groupBy(column).agg(
        F.count(F.lit(1)).alias("category_count"),
        *[F.coalesce(F.sum(F.when(o, F.col("__y"))), F.lit(0.0)).alias(f"sum_{k}") for k, o in enumerate(outside)],
        *[F.count_if(o).alias(f"rows_{k}") for k, o in enumerate(outside)],
        *[F.count_if(o & F.col("__y").isNotNull()).alias(f"known_{k}") for k, o in enumerate(outside)],
    )
    n = range(folds + 1)
    means = [F.try_divide(F.sum(f"sum_{k}"), F.sum(f"known_{k}")).alias(f"mean_{k}") for k in n]
    lookup, measured = build_lookup(stats, column, "category_count", "category_count", f"folded-means-{column}", *means)
    defaults = tuple(measured[f"mean_{k}"] for k in n)

    def smoothed(k: int) -> Column:
        # The mean over the rows with a target, weighted by all rows, as in the plain encoder.
        mean = F.try_divide(F.col(f"sum_{k}"), F.col(f"known_{k}"))
        value = (mean * F.col(f"rows_{k}") + F.lit(defaults[k]) * F.lit(smoothing)) / (F.col(f"rows_{k}") + F.lit(smoothing))
        return F.when(F.col(f"known_{k}") > 0, value).otherwise(F.lit(defaults[k]))

    return FoldedEncoding(column, lookup.derive("encodings", F.array(*[smoothed(k) for k in n])), defaults, tuple(keys), seed)


def kfold_encode_apply(
    df: DataFrame, encoding: FoldedEncoding, training: Column, spread: list[str] | None = None, broadcast_bytes: int | None = None
) -> DataFrame:
    """Replace the category by its encoding: without the row's own fold where ``training`` holds, of all folds elsewhere."""
    place = F.when(training, encoding.fold()).otherwise(encoding.folds)
    placed = df.withColumn("__place_of_fold", place)
    joined = lookup_join(placed, encoding.column, encoding.lookup, encoding.output, spread, broadcast_bytes)
    defaults = F.array(*[F.lit(d).cast("double") for d in encoding.defaults])
    value = F.coalesce(F.get(encoding.output, F.col("__place_of_fold")), F.get(defaults, F.col("__place_of_fold")))
    return joined.withColumn(encoding.output, value).drop(encoding.column, "__place_of_fold")


def encoding_sizes(encodings: list[Encoding]) -> DataFrame:
    """Number of categories behind each fitted encoder."""
    sizes = [
        e.mapping.agg(F.lit(e.column).alias("column"), F.count(F.lit(1)).alias("n_categories"), F.sum("category_count").alias("n_rows"))
        for e in encodings
    ]
    result = sizes[0]
    for size in sizes[1:]:
        result = result.unionByName(size)
    return result


@dataclass(frozen=True)
class TopCategories:
    """The categories that are kept; all others become one."""

    column: str
    lookup: Lookup
    n: int

    @property
    def table(self) -> DataFrame:
        """One row per kept category with its row count."""
        return self.lookup.table


def top_categories_fit(train: DataFrame, column: str, n: int = 30) -> TopCategories:
    """The ``n`` most frequent categories; ties go to the smaller value."""
    if n <= 0:
        raise ValueError("n must be positive")
    ranked = category_counts(train, column).orderBy(F.desc("category_count"), F.asc_nulls_last(column)).limit(n)
    lookup, _ = build_lookup(ranked, column, "category_count", "category_count", f"top-{column}")
    return TopCategories(column, lookup, n)


def top_categories_apply(df: DataFrame, top: TopCategories, other: str = "Other", spread: list[str] | None = None) -> DataFrame:
    """Replace every category outside the kept list by ``other``.

    Null is a category like any other: it becomes ``other`` unless it is
    itself among the most frequent.
    """
    joined = lookup_join(df, top.column, top.lookup, "__kept", spread)
    value = F.when(F.col("__kept").isNotNull(), F.col(top.column)).otherwise(F.lit(other))
    return joined.withColumn(top.column, value).select(*df.columns)


def group_mean_join(df: DataFrame, column: str, value: str, out: str, spread: list[str] | None = None) -> DataFrame:
    """Each row with the mean ``value`` of its group."""
    lookup, _ = build_lookup(category_means(df, column, value), column, "category_mean", "category_count", f"group-{column}")
    return lookup_join(df, column, lookup, out, spread)
