"""Profiles, cleaning and the reports on both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.functions.bands import rating_bin
from filmlens.operators import cleaning as C
from filmlens.operators import profiling as P
from filmlens.operators.relational import all_present
from filmlens.registry.core import query
from filmlens.registry.tables import (
    DIRTY_YEAR_SQL,
    LABELLED_SQL,
    PARTS_FILM_SQL,
    USER_COUNTS_SQL,
    dirty_orders,
    documents_film,
    labelled_documents,
    orders,
    parts_film,
    popular_orders,
    rounded,
    table,
)

# --- profiles ------------------------------------------------------------


def _blank_sql(relation: str, columns: list[str], text: set[str]) -> str:
    """One SELECT per column, as an independent count of nulls and blanks."""
    parts = []
    for column in columns:
        blank = f'"{column}" IS NULL' + (f""" OR "{column}" = ''""" if column in text else "")
        n = f"count(*) FILTER (WHERE {blank})"
        parts.append(f"""SELECT '{column}' AS "column", {n} AS n_null, round({n} * 100.0::DOUBLE / count(*), 6) AS pct FROM t""")
    return f"WITH t AS ({relation}) " + " UNION ALL ".join(parts)


_TEXT_COLUMNS = {"text", "lang", "source", "verdict"}
_LABELLED_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic", "verdict"]


@query("profile_dimensions", "SELECT count(*) AS n_rows, CAST(11 AS INT) AS n_columns FROM lineitem")
def profile_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    return P.dimensions(table(spark, sf, "lineitem"))


@query(
    "schema_catalog",
    """SELECT 1 AS ordinal, 'c_custkey' AS "column", 'bigint' AS "type", count(*) FILTER (WHERE c_custkey IS NULL) AS n_null FROM customer
       UNION ALL SELECT 2, 'c_name', 'string', count(*) FILTER (WHERE c_name IS NULL OR c_name = '') FROM customer
       UNION ALL SELECT 3, 'c_nationkey', 'int', count(*) FILTER (WHERE c_nationkey IS NULL) FROM customer
       UNION ALL SELECT 4, 'c_acctbal', 'double', count(*) FILTER (WHERE c_acctbal IS NULL) FROM customer
       UNION ALL SELECT 5, 'c_mktsegment', 'string', count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment = '') FROM customer""",
)
def schema_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return P.schema_catalog(table(spark, sf, "customer"))


@query("null_profile", _blank_sql(LABELLED_SQL, _LABELLED_COLUMNS, _TEXT_COLUMNS))
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    found = labelled_documents(spark, sf, P.blank_marks).select(*_LABELLED_COLUMNS)
    return P.null_profile(found).withColumn("pct", rounded("pct"))


_MODEL_COLUMNS = [
    "avg_vote", "genre", "director", "actors", "description", "duration",
    "votes", "reviews_from_users", "reviews_from_critics", "year", "writer", "production_company",
]


@query(
    "null_profile_subset",
    _blank_sql(PARTS_FILM_SQL, _MODEL_COLUMNS, {"genre", "director", "actors", "description", "year", "writer", "production_company"}),
)
def null_profile_subset(spark: SparkSession, sf: str) -> DataFrame:
    return P.null_profile(parts_film(spark, sf), _MODEL_COLUMNS).withColumn("pct", rounded("pct"))


def _describe_sql(relation: str, columns: list[str], digits: int) -> str:
    return f"WITH t AS ({relation}) " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count("{c}") AS n, round(avg("{c}"), {digits}) AS mean,
                   round(stddev_samp("{c}"), {digits}) AS sd, CAST(min("{c}") AS DOUBLE) AS "min", CAST(max("{c}") AS DOUBLE) AS "max" FROM t"""
        for c in columns
    )


def _describe_rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.withColumns({"mean": rounded("mean", digits), "sd": rounded("sd", digits)})


@query(
    "describe_numeric",
    _describe_sql("SELECT * FROM lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"], 4),
)
def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
    return _describe_rounded(P.describe_typed(table(spark, sf, "lineitem"), columns), 4)


@query("describe_target", _describe_sql(f"SELECT CAST(quality AS DOUBLE) AS label FROM ({LABELLED_SQL})", ["label"], 6))
def describe_target(spark: SparkSession, sf: str) -> DataFrame:
    return _describe_rounded(P.describe_typed(documents_film(spark, sf).withColumnRenamed("avg_vote", "label"), ["label"]), 6)


@query(
    "describe_dirty_string",
    f"""WITH t AS (SELECT {DIRTY_YEAR_SQL} AS "year" FROM orders)
        SELECT 'year' AS "column", count("year") AS n, round(avg(TRY_CAST("year" AS DOUBLE)), 6) AS mean,
               round(stddev_samp(TRY_CAST("year" AS DOUBLE)), 6) AS sd, min("year") AS "min", max("year") AS "max" FROM t""",
)
def describe_dirty_string(spark: SparkSession, sf: str) -> DataFrame:
    return _describe_rounded(P.describe_text(dirty_orders(spark, sf), ["year"]), 6)


@query(
    "distinct_counts",
    f"WITH t AS ({LABELLED_SQL}) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_distinct FROM (SELECT DISTINCT "{c}" FROM t)"""
        for c in ("doc_id", "lang", "source", "quality")
    ),
)
def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return P.distinct_counts(labelled_documents(spark, sf), ["doc_id", "lang", "source", "quality"])


@query(
    "top_years",
    """SELECT CAST(year(o_orderdate) AS INT) AS o_year, count(*) AS "count" FROM orders
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_years(spark: SparkSession, sf: str) -> DataFrame:
    return P.top_groups(orders(spark, sf), "o_year", 10)


@query(
    "completeness",
    f"""WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE quality IS NOT NULL AND toxic IS NOT NULL AND verdict IS NOT NULL) AS k
                   FROM ({LABELLED_SQL}))
        SELECT n AS n_rows, k AS n_complete, n - k AS n_incomplete, round(k * 100.0::DOUBLE / n, 6) AS pct_complete,
               round((n - k) * 100.0::DOUBLE / n, 6) AS pct_incomplete FROM c""",
)
def completeness(spark: SparkSession, sf: str) -> DataFrame:
    found = P.completeness(labelled_documents(spark, sf))
    return found.withColumns({c: rounded(c) for c in ("pct_complete", "pct_incomplete")})


@query("histogram_tenths", "SELECT trunc(value * 10) / 10.0::DOUBLE AS bin, count(*) AS \"count\" FROM events GROUP BY 1")
def histogram_tenths(spark: SparkSession, sf: str) -> DataFrame:
    return P.histogram(table(spark, sf, "events"), "value")


_PRICE_EDGES = (100000.0, 200000.0, 300000.0, 400000.0)
_BIN_SQL = """CASE WHEN {c} < {e[0]} THEN 'very low (<5)' WHEN {c} < {e[1]} THEN 'low (5-6)' WHEN {c} < {e[2]} THEN 'medium (6-7)'
              WHEN {c} < {e[3]} THEN 'good (7-8)' ELSE 'excellent (8+)' END"""


@query("rating_bins", f"SELECT o_orderkey, {_BIN_SQL.format(c='o_totalprice', e=_PRICE_EDGES)} AS rating_bin FROM orders")
def rating_bins(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", rating_bin(F.col("o_totalprice"), _PRICE_EDGES).alias("rating_bin"))


_SCORE_EDGES = (4.0, 4.8, 5.6, 6.4)


def _binned_parts(spark: SparkSession, sf: str) -> DataFrame:
    return parts_film(spark, sf).withColumn("rating_bin", rating_bin(F.col("avg_vote"), _SCORE_EDGES))


_BINNED_SQL = f"SELECT *, {_BIN_SQL.format(c='avg_vote', e=_SCORE_EDGES)} AS rating_bin FROM ({PARTS_FILM_SQL})"


@query(
    "bin_mean_count",
    f"""SELECT rating_bin, round(avg(votes), 6) AS avg_votes, count(*) AS "count" FROM ({_BINNED_SQL}) GROUP BY 1""",
)
def bin_mean_count(spark: SparkSession, sf: str) -> DataFrame:
    found = P.binned_means(_binned_parts(spark, sf), "rating_bin", {"avg_votes": "votes"}, "avg_votes")
    return found.withColumn("avg_votes", rounded("avg_votes"))


@query(
    "bin_two_means",
    f"""SELECT rating_bin, round(avg(reviews_from_users), 6) AS avg_user_reviews,
               round(avg(reviews_from_critics), 6) AS avg_critic_reviews, count(*) AS "count" FROM ({_BINNED_SQL}) GROUP BY 1""",
)
def bin_two_means(spark: SparkSession, sf: str) -> DataFrame:
    means = {"avg_user_reviews": "reviews_from_users", "avg_critic_reviews": "reviews_from_critics"}
    found = P.binned_means(_binned_parts(spark, sf), "rating_bin", means, "avg_user_reviews")
    return found.withColumns({c: rounded(c) for c in means})


# --- cleaning ------------------------------------------------------------

_DIGITS = "regexp_replace({c}, '[^0-9]', '', 'g')"


@query("clean_year_digits", f"SELECT p_partkey, p_brand, TRY_CAST({_DIGITS.format(c='p_brand')} AS INT) AS year_clean FROM part")
def clean_year_digits(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_year(table(spark, sf, "part"), "p_brand").select("p_partkey", "p_brand", "year_clean")


@query("clean_year_double", f"SELECT doc_id, TRY_CAST({_DIGITS.format(c='source')} AS DOUBLE) AS year_clean FROM documents")
def clean_year_double(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_year(table(spark, sf, "documents"), "source", dtype="double").select("doc_id", "year_clean")


@query(
    "clean_year_strict",
    f"""WITH t AS (SELECT o_orderkey, TRY_CAST({DIRTY_YEAR_SQL} AS INT) AS year_clean FROM orders)
        SELECT o_orderkey, year_clean, (SELECT count(*) FROM t WHERE year_clean IS NULL) AS n_failed FROM t""",
)
def clean_year_strict(spark: SparkSession, sf: str) -> DataFrame:
    parsed = C.clean_year(dirty_orders(spark, sf), mode="strict").select("o_orderkey", "year_clean")
    failed = parsed.select(F.count_if(F.col("year_clean").isNull())).scalar()
    return parsed.withColumn("n_failed", failed)


@query(
    "retention_report",
    f"""WITH c AS (SELECT count(*) AS b, count(quality) AS a FROM ({LABELLED_SQL}))
        SELECT b AS rows_before, a AS rows_after, b - a AS rows_lost, round((b - a) * 100.0::DOUBLE / b, 6) AS pct_lost FROM c""",
)
def retention_report(spark: SparkSession, sf: str) -> DataFrame:
    joined = labelled_documents(spark, sf)
    return C.retention(joined, all_present(joined, ["quality"])).withColumn("pct_lost", rounded("pct_lost"))


@query(
    "clean_intrinsic",
    f"""SELECT doc_id AS title_id, lang AS genre, TRY_CAST({_DIGITS.format(c='source')} AS INT) AS year_clean,
               CAST(quality AS DOUBLE) AS avg_vote FROM ({LABELLED_SQL}) WHERE quality IS NOT NULL""",
)
def clean_intrinsic(spark: SparkSession, sf: str) -> DataFrame:
    required = ["description", "genre", "director", "actors", "duration", "avg_vote", "year_clean"]
    return C.clean_required(documents_film(spark, sf), required).select("title_id", "genre", "year_clean", "avg_vote")


@query(
    "clean_with_popularity",
    f"""SELECT o.o_orderkey, CAST(year(o.o_orderdate) AS INT) AS year_clean, u.votes, u.reviews_from_users, u.reviews_from_critics
        FROM orders o JOIN ({USER_COUNTS_SQL}) u ON o.o_custkey = u.o_custkey""",
)
def clean_with_popularity(spark: SparkSession, sf: str) -> DataFrame:
    required = ["o_totalprice", "o_orderpriority", "votes", "reviews_from_users", "reviews_from_critics", "year_clean"]
    found = C.clean_required(popular_orders(spark, sf), required)
    return found.select("o_orderkey", "year_clean", "votes", "reviews_from_users", "reviews_from_critics")


@query(
    "clean_validation",
    """SELECT page_id, url, TRY_CAST(regexp_extract(url, '[^/]*$') AS INT) AS year_clean FROM pages
       WHERE TRY_CAST(regexp_extract(url, '[^/]*$') AS INT) IS NOT NULL AND page_id IS NOT NULL AND url <> '' AND html <> ''""",
)
def clean_validation(spark: SparkSession, sf: str) -> DataFrame:
    """The last part of an address is a number on some pages and text on others."""
    dirty = table(spark, sf, "pages").withColumn("year", F.substring_index("url", "/", -1))
    found = C.clean_validation(dirty, ["page_id", "year_clean"], ["url", "html"])
    return found.select("page_id", "url", "year_clean")


@query(
    "data_sufficiency",
    f"""WITH c AS (SELECT count(*) AS n, count(TRY_CAST({DIRTY_YEAR_SQL} AS INT)) AS k FROM orders)
        SELECT n AS rows_total, k AS rows_usable, round(k * 100.0::DOUBLE / n, 6) AS pct_usable,
               CASE WHEN k > 10000 THEN 'sufficient' WHEN k > 5000 THEN 'limited' ELSE 'insufficient' END AS verdict FROM c""",
)
def data_sufficiency(spark: SparkSession, sf: str) -> DataFrame:
    parsed = C.clean_year(dirty_orders(spark, sf), mode="strict")
    return C.data_sufficiency(parsed, F.col("year_clean").isNotNull()).withColumn("pct_usable", rounded("pct_usable"))
