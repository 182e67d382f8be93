"""Profiles. Each one is a single aggregate over the data, whatever the width."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmlens.operators.relational import all_present, is_blank
from filmlens.sources.staging import materialize


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def _long_form(entries: list[Column]) -> Column:
    return F.inline(F.array(*entries))


def dimensions(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null-or-blank count and share of every column."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(is_blank(df, c)).alias(f"blank_{i}") for i, c in enumerate(columns)],
    )
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"blank_{i}").alias("n_null")) for i, c in enumerate(columns)]
    return counts.select("total", _long_form(entries)).select(
        "column", "n_null", _percent(F.col("n_null"), F.col("total")).alias("pct")
    )


def blank_marks(df: DataFrame) -> DataFrame:
    """The frame with every text column replaced by a short one that is blank, or null, where it was.

    Taken before a join whose rows are only profiled, it keeps the texts out of
    the join's shuffle.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(c) == "", "").when(F.col(c).isNotNull(), "x") for c in texts}) if texts else df


def schema_catalog(df: DataFrame) -> DataFrame:
    """Numbered columns with their type and null-or-blank count."""
    fields = [
        F.struct(
            F.lit(i + 1).alias("ordinal"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"blank_{i}").alias("n_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    counts = df.agg(*[F.count_if(is_blank(df, f.name)).alias(f"blank_{i}") for i, f in enumerate(df.schema.fields)])
    return counts.select(_long_form(fields))


def frame_profile(df: DataFrame) -> dict[str, DataFrame]:
    """Dimensions, column catalog and null profile of a frame, all from one aggregate over it."""
    fields = df.schema.fields
    blanks = [F.count_if(is_blank(df, f.name)).alias(f"blank_{i}") for i, f in enumerate(fields)]
    row = materialize(df.agg(F.count(F.lit(1)).alias("total"), *blanks), "frame-profile")
    nulls = [F.struct(F.lit(f.name).alias("column"), F.col(f"blank_{i}").alias("n_null")) for i, f in enumerate(fields)]
    catalog = [
        F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"blank_{i}").alias("n_null"))
        for i, f in enumerate(fields)
    ]
    return {
        "dimensions": row.select(F.col("total").alias("n_rows"), F.lit(len(fields)).alias("n_columns")),
        "columns": row.select(_long_form(catalog)),
        "nulls": row.select("total", _long_form(nulls)).select("column", "n_null", _percent(F.col("n_null"), F.col("total")).alias("pct")),
    }


def describe_typed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of numeric columns."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("n"),
                F.avg(c).cast("double").alias("mean"),
                F.stddev(c).alias("sd"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(f"stats_{i}")
            for i, c in enumerate(columns)
        ]
    )
    return stats.select(_long_form([F.col(f"stats_{i}") for i in range(len(columns))]))


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Describe of text columns: least and greatest text, mean and deviation of the values that are numbers."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("n"),
                F.avg(F.col(c).try_cast("double")).alias("mean"),
                F.stddev(F.col(c).try_cast("double")).alias("sd"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(f"stats_{i}")
            for i, c in enumerate(columns)
        ]
    )
    return stats.select(_long_form([F.col(f"stats_{i}") for i in range(len(columns))]))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values per column; null counts as a value."""
    counts = df.agg(
        *[
            (F.count_distinct(F.col(c)) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(f"n_{i}")
            for i, c in enumerate(columns)
        ]
    )
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"n_{i}").alias("n_distinct")) for i, c in enumerate(columns)]
    return counts.select(_long_form(entries))


def top_groups(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values; ties go to the smaller value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(column)).limit(n)


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any missing value and rows with at least one."""
    keep = all_present(df, list(columns or df.columns))
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(keep).alias("n_complete"))
    incomplete = F.col("n_rows") - F.col("n_complete")
    return counts.select(
        "n_rows",
        "n_complete",
        incomplete.alias("n_incomplete"),
        _percent(F.col("n_complete"), F.col("n_rows")).alias("pct_complete"),
        _percent(incomplete, F.col("n_rows")).alias("pct_incomplete"),
    )


def histogram(df: DataFrame, column: str, per_unit: int = 10) -> DataFrame:
    """Counts per bin of width ``1 / per_unit``; values are cut toward zero."""
    bin_ = (F.col(column) * per_unit).cast("bigint") / F.lit(float(per_unit))
    return df.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("count")).orderBy("bin")


def binned_means(df: DataFrame, bin_column: str, means: dict[str, str], order: str) -> DataFrame:
    """Mean of several columns and the row count per bin, highest ``order`` first."""
    return (
        df.groupBy(bin_column)
        .agg(*[F.avg(c).alias(name) for name, c in means.items()], F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc(order), bin_column)
    )
