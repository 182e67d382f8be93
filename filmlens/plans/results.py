"""A query's total and a preview of its rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from filmlens.sources.staging import materialize


@dataclass(frozen=True)
class QueryResult:
    """Number of rows found and the first of them."""

    total: int
    preview: list[Row]

    @property
    def message(self) -> str:
        return f"{self.total} rows found" if self.total else "no results"


def run(df: DataFrame, order: Sequence[Column], n: int = 10) -> QueryResult:
    """Run the query once: the rows are counted while the first ``n`` are picked."""
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("total")).orderBy(*order).limit(n).collect()
    return QueryResult(counted.get["total"], rows)


def summary(df: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    """The first ``n`` rows, each with the total number found; the query itself runs once."""
    hits = materialize(df, "hits")
    total = hits.select(F.count(F.lit(1))).scalar()
    return hits.orderBy(*order).limit(n).withColumn("total", total)
