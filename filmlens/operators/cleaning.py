"""Cleaning of dirty numeric text and the reports on what it costs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmlens.operators.relational import all_present, drop_blank


def digits_number(column: str | Column, dtype: str = "int") -> Column:
    """The number made of a text's digits, or null when it has none."""
    return F.regexp_replace(column, "[^0-9]", "").try_cast(dtype)


def clean_year(df: DataFrame, source: str = "year", target: str = "year_clean", mode: str = "digits", dtype: str = "int") -> DataFrame:
    """Add the parsed year: ``digits`` reads "TV Movie 2019" as 2019, ``strict`` as null."""
    if mode not in ("digits", "strict"):
        raise ValueError("mode must be 'digits' or 'strict'")
    text = F.col(source).cast("string")
    return df.withColumn(target, digits_number(text, dtype) if mode == "digits" else text.try_cast(dtype))


def year_number(df: DataFrame, column: str) -> Column:
    """The year as a number; text that is no number becomes null."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column).try_cast("int")
    return F.col(column)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where a listed column is null or NaN.

    The same rows as ``na.drop(subset=columns)``, written as one condition per
    column: those reach the file scan and turn an outer join into an inner one.
    """
    return df.filter(all_present(df, columns))


def clean_required(df: DataFrame, required: Sequence[str], source: str = "year") -> DataFrame:
    """Digits-only year, then drop the rows that miss a required value."""
    return require(clean_year(df, source), required)


def clean_validation(df: DataFrame, required: Sequence[str], text: Sequence[str], source: str = "year") -> DataFrame:
    """Strict year replaces ``source``; rows with a missing value or a blank text go."""
    parsed = clean_year(df, source, mode="strict").drop(source)
    return drop_blank(require(parsed, required), text)


def retention(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before and after a cleaning rule, and the share it drops, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(keep).alias("rows_after"))
    lost = F.col("rows_before") - F.col("rows_after")
    return counts.select(
        "rows_before",
        "rows_after",
        lost.alias("rows_lost"),
        F.try_divide(lost * 100.0, F.col("rows_before")).alias("pct_lost"),
    )


def data_sufficiency(df: DataFrame, keep: Column, ample: int = 10000, limited: int = 5000) -> DataFrame:
    """Whether the rows that survive cleaning are enough to train on."""
    counts = df.agg(F.count(F.lit(1)).alias("rows_total"), F.count_if(keep).alias("rows_usable"))
    usable = F.col("rows_usable")
    return counts.select(
        "rows_total",
        "rows_usable",
        F.try_divide(usable * 100.0, F.col("rows_total")).alias("pct_usable"),
        F.when(usable > ample, "sufficient").when(usable > limited, "limited").otherwise("insufficient").alias("verdict"),
    )
