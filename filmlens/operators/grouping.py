"""Profiles over several groupings in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouping_profile(df: DataFrame, dimensions: Sequence[str], sets: Sequence[Sequence[str]], **aggregates: Column) -> DataFrame:
    """Aggregates for every listed set of dimensions, from one expanded scan and one shuffle.

    ``level`` tells the sets apart: bit i from the right is set where the i-th
    dimension from the end is summed over, so a null dimension there is no value
    of the data. An empty set is the whole table.
    """
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *dimensions)
    return grouped.agg(F.grouping_id().cast("bigint").alias("level"), *[a.alias(n) for n, a in aggregates.items()]).select(
        "level", *dimensions, *aggregates
    )


def rollup_profile(df: DataFrame, dimensions: Sequence[str], **aggregates: Column) -> DataFrame:
    """Aggregates by all dimensions, by all but the last, and so on to the whole table."""
    sets = [list(dimensions[:n]) for n in range(len(dimensions), -1, -1)]
    return grouping_profile(df, dimensions, sets, **aggregates)


def cube_profile(df: DataFrame, dimensions: Sequence[str], **aggregates: Column) -> DataFrame:
    """Aggregates by every subset of the dimensions."""
    sets: list[list[str]] = [[]]
    for c in dimensions:
        sets = [s + more for s in sets for more in ([c], [])]
    return grouping_profile(df, dimensions, sets, **aggregates)


def pivot_counts(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Row counts as a table of ``rows`` by the listed ``values`` of ``columns``, and of all other values under ``other``.

    The values are listed, so that the columns are known before any data is read
    and one aggregate serves all of them.
    """
    listed = [F.count_if(F.col(columns) == v).alias(str(v)) for v in values]
    other = F.count_if(~F.coalesce(F.col(columns).isin(list(values)), F.lit(False))).alias("other")
    return df.groupBy(rows).agg(*listed, other)
