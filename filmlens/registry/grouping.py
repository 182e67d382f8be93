"""Grouping sets, rollup, cube and pivot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.operators import grouping as G
from filmlens.registry.core import query
from filmlens.registry.tables import orders, orders_catalog, rounded, table

_FIGURES = "count(*) AS n, round(sum(o_totalprice) / 1000000, 4) AS total_millions, max(o_totalprice) AS highest, count(DISTINCT o_custkey) AS n_customers"


def _profile(df: DataFrame, how, dimensions: list[str], *more) -> DataFrame:
    """Count, total, maximum and distinct customers of every group."""
    found = how(
        df, dimensions, *more,
        n=F.count(F.lit(1)), total=F.sum("o_totalprice"), highest=F.max("o_totalprice"), n_customers=F.count_distinct("o_custkey"),
    )
    return found.select("level", *dimensions, "n", rounded(F.col("total") / 1000000, 4).alias("total_millions"), "highest", "n_customers")


_YEARLY = "(SELECT *, CAST(year(o_orderdate) AS INT) AS o_year FROM orders)"


@query(
    "grouping_sets_catalog",
    f"""SELECT CAST(grouping(o_year, o_orderpriority) AS BIGINT) AS level, o_year, o_orderpriority, {_FIGURES}
        FROM {_YEARLY} GROUP BY GROUPING SETS ((o_year), (o_orderpriority), ())""",
)
def grouping_sets_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog by year, by genre and as a whole, in one pass."""
    return _profile(orders(spark, sf), G.grouping_profile, ["o_year", "o_orderpriority"], [["o_year"], ["o_orderpriority"], []])


@query(
    "rollup_catalog",
    f"""SELECT CAST(grouping(o_year, o_orderpriority, o_orderstatus) AS BIGINT) AS level, o_year, o_orderpriority, o_orderstatus, {_FIGURES}
        FROM {_YEARLY} GROUP BY ROLLUP (o_year, o_orderpriority, o_orderstatus)""",
)
def rollup_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(orders(spark, sf), G.rollup_profile, ["o_year", "o_orderpriority", "o_orderstatus"])


@query(
    "cube_catalog",
    f"""SELECT CAST(grouping(o_orderpriority, c_mktsegment, o_orderstatus) AS BIGINT) AS level, o_orderpriority, c_mktsegment, o_orderstatus, {_FIGURES}
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY CUBE (o_orderpriority, c_mktsegment, o_orderstatus)""",
)
def cube_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Genre, country and language of the catalog view, in all combinations."""
    return _profile(orders_catalog(spark, sf, "c_mktsegment"), G.cube_profile, ["o_orderpriority", "c_mktsegment", "o_orderstatus"])


@query(
    "cube_missing_labels",
    """SELECT CAST(grouping(lang, quality) AS BIGINT) AS level, lang, quality, count(*) AS n
       FROM documents LEFT JOIN labels USING (doc_id) GROUP BY CUBE (lang, quality)""",
)
def cube_missing_labels(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension with nulls of its own, which the level tells from the sums over it."""
    joined = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return G.cube_profile(joined, ["lang", "quality"], n=F.count(F.lit(1)))


@query(
    "pivot_year_priority",
    f"""SELECT o_year, count(*) FILTER (o_orderpriority = '1-URGENT') AS "1-URGENT", count(*) FILTER (o_orderpriority = '2-HIGH') AS "2-HIGH",
               count(*) FILTER (coalesce(o_orderpriority NOT IN ('1-URGENT', '2-HIGH'), true)) AS other FROM {_YEARLY} GROUP BY o_year""",
)
def pivot_year_priority(spark: SparkSession, sf: str) -> DataFrame:
    return G.pivot_counts(orders(spark, sf), "o_year", "o_orderpriority", ["1-URGENT", "2-HIGH"])
