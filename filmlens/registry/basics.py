"""Projections, filters, joins, grouped aggregates, sorts, deduplication, nulls and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.operators import relational as R
from filmlens.registry.core import query
from filmlens.registry.tables import (
    LABELLED_SQL,
    PARTS_FILM_SQL,
    draw_sql,
    labelled_documents,
    orders,
    parts_film,
    rounded,
    table,
)

# --- projections ---------------------------------------------------------


@query("project_select", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def project_select(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("project_alias", "SELECT p_name, p_retailprice AS rating FROM part")
def project_alias(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_name", F.col("p_retailprice").alias("rating"))


@query("project_drop", "SELECT p_partkey, p_name, p_type, p_size, p_retailprice FROM part")
def project_drop(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").drop("p_brand")


@query("project_select_expr", "SELECT p_name AS name, p_size + 1 AS next_size FROM part")
def project_select_expr(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr("p_name AS name", "p_size + 1 AS next_size")


@query(
    "derive_decade_mod",
    "SELECT o_orderkey, CAST(year(o_orderdate) - year(o_orderdate) % 10 AS INT) AS decade FROM orders",
)
def derive_decade_mod(spark: SparkSession, sf: str) -> DataFrame:
    return orders(spark, sf).withColumn("decade", F.col("o_year") - F.col("o_year") % 10).select("o_orderkey", "decade")


@query("derive_flag_bool", "SELECT o_orderkey, year(o_orderdate) >= 1999 AS is_recent FROM orders")
def derive_flag_bool(spark: SparkSession, sf: str) -> DataFrame:
    return orders(spark, sf).withColumn("is_recent", F.col("o_year") >= 1999).select("o_orderkey", "is_recent")


@query("project_rename", "SELECT c_custkey, c_name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer")
def project_rename(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").withColumnRenamed("c_acctbal", "balance")


@query(
    "project_model_columns",
    f"""SELECT title_id, title, "year", genre, duration, director, writer, production_company, actors, description,
               round(total_votes, 2) AS label, votes, reviews_from_users, reviews_from_critics FROM ({PARTS_FILM_SQL})""",
)
def project_model_columns(spark: SparkSession, sf: str) -> DataFrame:
    return parts_film(spark, sf).select(
        "title_id", "title", "year", "genre", "duration", "director", "writer", "production_company", "actors",
        "description", rounded("total_votes", 2).alias("label"), "votes", "reviews_from_users", "reviews_from_critics",
    )


# --- filters -------------------------------------------------------------

_PRICED = ("o_orderkey", "o_totalprice")


def _order_filter(name: str, condition, where: str) -> None:
    query(name, f"SELECT o_orderkey, o_totalprice FROM orders WHERE {where}")(
        lambda spark, sf: orders(spark, sf).filter(condition()).select(*_PRICED)
    )


_order_filter("filter_gt", lambda: F.col("o_totalprice") > 400000, "o_totalprice > 400000")
_order_filter("filter_ge", lambda: F.col("o_totalprice") >= 400000, "o_totalprice >= 400000")
_order_filter("filter_lt", lambda: F.col("o_totalprice") < 50000, "o_totalprice < 50000")
_order_filter("filter_le", lambda: F.col("o_totalprice") <= 50000, "o_totalprice <= 50000")
_order_filter("filter_eq", lambda: F.col("o_orderstatus") == "F", "o_orderstatus = 'F'")
_order_filter("filter_ne", lambda: F.col("o_orderstatus") != "F", "o_orderstatus <> 'F'")
_order_filter("filter_between", lambda: F.col("o_totalprice").between(100000, 200000), "o_totalprice BETWEEN 100000 AND 200000")
_order_filter("filter_in", lambda: F.col("o_orderstatus").isin("F", "P"), "o_orderstatus IN ('F', 'P')")
_order_filter("filter_not", lambda: ~(F.col("o_orderpriority") == "5-LOW"), "NOT (o_orderpriority = '5-LOW')")
_order_filter(
    "filter_compound",
    lambda: (F.col("o_year") > 1997)
    & (F.col("o_totalprice") > 300000)
    & (F.col("o_orderpriority").contains("HIGH") | F.col("o_orderpriority").contains("URGENT")),
    "year(o_orderdate) > 1997 AND o_totalprice > 300000 AND (o_orderpriority LIKE '%HIGH%' OR o_orderpriority LIKE '%URGENT%')",
)


def _part_filter(name: str, condition, where: str) -> None:
    query(name, f"SELECT p_partkey, p_name FROM part WHERE {where}")(
        lambda spark, sf: table(spark, sf, "part").filter(condition()).select("p_partkey", "p_name")
    )


_part_filter("filter_contains", lambda: F.col("p_name").contains("red"), "p_name LIKE '%red%'")
_part_filter("filter_starts_with", lambda: F.col("p_name").startswith("blue"), "p_name LIKE 'blue%'")
_part_filter("filter_ends_with", lambda: F.col("p_name").endswith("rod"), "p_name LIKE '%rod'")
_part_filter("filter_rlike", lambda: F.col("p_name").rlike("(?i)BLUE.*"), "regexp_matches(p_name, '(?i)BLUE.*')")
_part_filter("filter_lower_contains", lambda: F.lower("p_type").contains("eco"), "lower(p_type) LIKE '%eco%'")


@query("filter_not_null", f"SELECT doc_id, quality FROM ({LABELLED_SQL}) WHERE quality IS NOT NULL")
def filter_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_documents(spark, sf).filter(F.col("quality").isNotNull()).select("doc_id", "quality")


@query("filter_is_null", f"SELECT doc_id, lang FROM ({LABELLED_SQL}) WHERE quality IS NULL")
def filter_is_null(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_documents(spark, sf).filter(F.col("quality").isNull()).select("doc_id", "lang")


@query("filter_blank", f"SELECT doc_id, quality FROM ({LABELLED_SQL}) WHERE verdict IS NULL OR verdict = ''")
def filter_blank(spark: SparkSession, sf: str) -> DataFrame:
    joined = labelled_documents(spark, sf)
    return joined.filter(R.is_blank(joined, "verdict")).select("doc_id", "quality")


# --- joins ---------------------------------------------------------------


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "lang", "n_chars")


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels")


_JOINED_COLUMNS = "doc_id, lang, n_chars, quality, toxic"


@query("join_inner", f"SELECT {_JOINED_COLUMNS} FROM documents JOIN labels USING (doc_id)")
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).join(_labels(spark, sf), "doc_id", "inner")


@query("join_left", f"SELECT {_JOINED_COLUMNS} FROM documents LEFT JOIN labels USING (doc_id)")
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).join(_labels(spark, sf), "doc_id", "left")


@query("join_right", f"SELECT {_JOINED_COLUMNS} FROM labels RIGHT JOIN documents USING (doc_id)")
def join_right(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf).join(_docs(spark, sf), "doc_id", "right").select(*_JOINED_COLUMNS.split(", "))


@query(
    "join_full_outer",
    """SELECT coalesce(l.doc_id, e.vec_id) AS id, l.quality, l.toxic, e."label"
       FROM labels l FULL OUTER JOIN embeddings e ON l.doc_id = e.vec_id""",
)
def join_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    left = _labels(spark, sf).withColumnRenamed("doc_id", "id")
    right = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label")
    return left.join(right, "id", "outer")


@query("join_left_semi", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def join_left_semi(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).join(_labels(spark, sf), "doc_id", "left_semi")


@query("join_left_anti", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def join_left_anti(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).join(_labels(spark, sf), "doc_id", "left_anti")


@query(
    "join_loss",
    """WITH c AS (SELECT (SELECT count(*) FROM documents) AS b,
                         (SELECT count(*) FROM documents JOIN labels USING (doc_id)) AS a)
       SELECT b AS rows_before, a AS rows_after, b - a AS rows_lost, round((b - a) * 100.0::DOUBLE / b, 6) AS pct_lost FROM c""",
)
def join_loss(spark: SparkSession, sf: str) -> DataFrame:
    found = R.join_loss(_docs(spark, sf), _labels(spark, sf), "doc_id", "inner")
    return found.withColumn("pct_lost", rounded("pct_lost"))


# --- grouped aggregates --------------------------------------------------


@query("agg_group_count", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def agg_group_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_group_avg",
    "SELECT CAST(year(o_orderdate) AS INT) AS o_year, round(avg(o_totalprice), 4) AS avg_price FROM orders GROUP BY 1",
)
def agg_group_avg(spark: SparkSession, sf: str) -> DataFrame:
    return orders(spark, sf).groupBy("o_year").agg(rounded(F.avg("o_totalprice"), 4).alias("avg_price"))


@query(
    "agg_group_multi",
    """SELECT o_orderpriority, round(avg(o_totalprice), 4) AS avg_price, count(*) AS n, max(o_totalprice) AS max_price
       FROM orders GROUP BY 1""",
)
def agg_group_multi(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        rounded(F.avg("o_totalprice"), 4).alias("avg_price"),
        F.count(F.lit(1)).alias("n"),
        F.max("o_totalprice").alias("max_price"),
    )


@query(
    "agg_sum_min_max",
    """SELECT l_returnflag, round(sum(l_quantity), 2) AS sum_qty, min(l_extendedprice) AS min_price,
              max(l_extendedprice) AS max_price FROM lineitem GROUP BY 1""",
)
def agg_sum_min_max(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        rounded(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"),
    )


@query(
    "agg_first_last",
    """SELECT o_custkey, first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS first_value,
              last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS last_value FROM orders GROUP BY 1""",
)
def agg_first_last(spark: SparkSession, sf: str) -> DataFrame:
    return R.first_last(table(spark, sf, "orders"), ["o_custkey"], "o_totalprice", ["o_orderdate", "o_orderkey"])


# --- sorts, limits, samples ----------------------------------------------


@query("sort_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_desc(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(*_PRICED).orderBy(F.desc("o_totalprice"), F.asc("o_orderkey"))


@query(
    "sort_multi",
    """SELECT CAST(year(o_orderdate) AS INT) AS o_year, o_totalprice, o_orderkey FROM orders
       ORDER BY o_year, o_totalprice DESC, o_orderkey""",
)
def sort_multi(spark: SparkSession, sf: str) -> DataFrame:
    found = orders(spark, sf).select("o_year", "o_totalprice", "o_orderkey")
    return found.orderBy(F.asc("o_year"), F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("sort_alias", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def sort_alias(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", "c_acctbal").sort(F.col("c_acctbal").desc(), "c_custkey")


@query("limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def limit_n(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(*_PRICED).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("head_n", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_partkey LIMIT 5")
def head_n(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice").orderBy("p_partkey").limit(5)


@query("sample_fraction")
def sample_fraction(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(*_PRICED).sample(fraction=0.1, seed=42)


@query("sample_hash", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {draw_sql('o_orderkey')} < 10")
def sample_hash(spark: SparkSession, sf: str) -> DataFrame:
    return R.sample_by_key(table(spark, sf, "orders").select(*_PRICED), ["o_orderkey"], 10)


# --- duplicates and nulls ------------------------------------------------


@query("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "dedupe_by_key",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) = 1""",
)
def dedupe_by_key(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return R.dedupe_by_key(found, ["o_custkey"], ["o_totalprice", "o_orderkey"])


@query(
    "drop_any_null",
    f"SELECT doc_id, lang, quality, toxic FROM ({LABELLED_SQL}) WHERE quality IS NOT NULL AND toxic IS NOT NULL",
)
def drop_any_null(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_documents(spark, sf).select("doc_id", "lang", "quality", "toxic").na.drop()


@query("drop_null_subset", f"SELECT doc_id, lang, verdict FROM ({LABELLED_SQL}) WHERE verdict IS NOT NULL")
def drop_null_subset(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_documents(spark, sf).select("doc_id", "lang", "verdict").na.drop(subset=["verdict"])


@query(
    "fill_null",
    f"SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM ({LABELLED_SQL})",
)
def fill_null(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_documents(spark, sf).select("doc_id", "quality", "toxic").na.fill(0, ["quality", "toxic"])


@query(
    "drop_blank",
    f"SELECT doc_id, lang, source, verdict FROM ({LABELLED_SQL}) WHERE verdict <> '' AND lang <> '' AND source <> ''",
)
def drop_blank(spark: SparkSession, sf: str) -> DataFrame:
    found = labelled_documents(spark, sf).select("doc_id", "lang", "source", "verdict")
    return R.drop_blank(found, ["verdict", "lang", "source"])


# --- scalar functions ----------------------------------------------------


@query("fn_upper", "SELECT p_partkey, upper(p_name) AS name_upper FROM part")
def fn_upper(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("name_upper"))


@query("fn_lower", "SELECT doc_id, lower(text) AS text_lower FROM documents")
def fn_lower(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.lower("text").alias("text_lower"))


@query("fn_length", "SELECT doc_id, CAST(length(text) AS INT) AS text_length FROM documents")
def fn_length(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.length("text").alias("text_length"))
