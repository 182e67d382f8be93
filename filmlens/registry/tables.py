"""The given tables, and catalog-shaped frames that Spark derives from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.plans.features import hash_text
from filmlens.plans.roles import Roles
from filmlens.sources.catalog import catalog

ORDERS = Roles(
    key="o_orderkey",
    title="o_orderkey",
    original_title="o_orderkey",
    year="o_year",
    date="o_orderdate",
    score="o_totalprice",
    votes="c_acctbal",
    genre="o_orderpriority",
    person="c_name",
    language="o_orderstatus",
    country="c_mktsegment",
)
PARTS = Roles(
    key="p_partkey",
    title="p_name",
    original_title="p_name",
    year="p_size",
    score="p_retailprice",
    genre="p_type",
)

# The same year text in SQL: one priority class carries a prefix.
DIRTY_YEAR_SQL = (
    "CASE WHEN o_orderpriority = '5-LOW' THEN 'TV Order ' || CAST(year(o_orderdate) AS VARCHAR) "
    "ELSE CAST(year(o_orderdate) AS VARCHAR) END"
)


def draw_sql(*keys: str) -> str:
    """SQL form of ``hash_percent`` with seed 42."""
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST('0x' || substr(md5(concat_ws('|', {text}, '42')), 1, 8) AS BIGINT) % 100"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(column: str | Column, digits: int = 6) -> Column:
    """Rounded, because parallel sums of doubles differ in their last bits."""
    return F.round(column, digits)


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their year."""
    return table(spark, sf, "orders").withColumn("o_year", F.year("o_orderdate"))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers under the orders' key name."""
    return table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")


def orders_catalog(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """Orders left join customers, with only the customer columns asked for."""
    movies = orders(spark, sf)
    return catalog(movies, customers(spark, sf), "o_custkey", [*movies.columns, *extra])


def dirty_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose year is text, with a prefix on one priority class."""
    year = F.year("o_orderdate").cast("string")
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("TV Order "), year)).otherwise(year)
    return table(spark, sf, "orders").withColumn("year", text)


def user_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Event counts per user in the parts of votes and reviews."""
    kind = F.col("event_type")
    return (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("o_custkey"))
        .agg(
            F.count_if(kind == "view").alias("votes"),
            F.count_if(kind == "click").alias("reviews_from_users"),
            F.count_if(kind == "purchase").alias("reviews_from_critics"),
        )
    )


USER_COUNTS_SQL = """
    SELECT user_id AS o_custkey,
           count(*) FILTER (WHERE event_type = 'view') AS votes,
           count(*) FILTER (WHERE event_type = 'click') AS reviews_from_users,
           count(*) FILTER (WHERE event_type = 'purchase') AS reviews_from_critics
    FROM events GROUP BY user_id
"""


def popular_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the event counts of their customer; customers without events have nulls."""
    return dirty_orders(spark, sf).join(user_counts(spark, sf), "o_custkey", "left")


def labelled_documents(spark: SparkSession, sf: str, prepared: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Documents (``prepared`` on their scan) left join labels; the verdict text is blank for low quality and null without a label."""
    joined = prepared(table(spark, sf, "documents")).join(table(spark, sf, "labels"), "doc_id", "left")
    return joined.withColumn("verdict", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, ""))


LABELLED_SQL = """
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic,
           CASE WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN '' END AS verdict
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def part_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Sales figures per part, in the part of the ratings."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("title_id"))
        .agg(
            (F.avg("l_extendedprice") / 10000).alias("avg_vote"),
            F.sum("l_extendedprice").alias("total_votes"),
            F.count(F.lit(1)).alias("votes"),
            F.sum("l_quantity").alias("reviews_from_users"),
            F.count_if(F.col("l_returnflag") == "R").alias("reviews_from_critics"),
        )
    )


def parts_film(spark: SparkSession, sf: str) -> DataFrame:
    """Parts left join their sales, under the film files' column names."""
    films = table(spark, sf, "part").select(
        F.col("p_partkey").alias("title_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("year"),
        F.col("p_type").alias("genre"),
        F.col("p_size").alias("duration"),
        F.col("p_brand").alias("director"),
        F.col("p_type").alias("writer"),
        F.col("p_brand").alias("production_company"),
        F.col("p_name").alias("actors"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("description"),
    )
    return films.join(part_sales(spark, sf), "title_id", "left")


PARTS_FILM_SQL = """
    SELECT p.p_partkey AS title_id, p.p_name AS title, p.p_brand AS "year", p.p_type AS genre,
           p.p_size AS duration, p.p_brand AS director, p.p_type AS writer,
           p.p_brand AS production_company, p.p_name AS actors,
           concat_ws(' ', p.p_name, p.p_type, p.p_brand) AS description,
           s.avg_vote, s.total_votes, s.votes, s.reviews_from_users, s.reviews_from_critics
    FROM part p LEFT JOIN (
        SELECT l_partkey, avg(l_extendedprice) / 10000 AS avg_vote, sum(l_extendedprice) AS total_votes,
               count(*) AS votes, sum(l_quantity) AS reviews_from_users,
               count(*) FILTER (WHERE l_returnflag = 'R') AS reviews_from_critics
        FROM lineitem GROUP BY l_partkey
    ) s ON s.l_partkey = p.p_partkey
"""

# Year and duration limits that suit the parts' brand numbers and sizes.
PARTS_LIMITS = {"recent_from": 20, "classic_to": 8, "short": 15, "medium": 35}


def documents_film(spark: SparkSession, sf: str) -> DataFrame:
    """Documents left join labels under the film files' column names; unlabelled rows have no target.

    The texts are hashed on their scan, so only their term counts go through the join.
    """
    hashed = hash_text(table(spark, sf, "documents").withColumnRenamed("text", "description"), "description")
    return hashed.join(table(spark, sf, "labels"), "doc_id", "left").select(
        F.col("doc_id").alias("title_id"),
        "description",
        "desc_tf",
        F.col("lang").alias("genre"),
        F.col("source").alias("director"),
        F.concat_ws("-", "lang", "source").alias("actors"),
        F.col("n_chars").alias("duration"),
        F.col("source").alias("year"),
        F.col("quality").cast("double").alias("avg_vote"),
    )


# Year and duration limits that suit the documents' source numbers and lengths.
DOCUMENT_LIMITS = {"recent_from": 15, "classic_to": 5, "short": 500, "medium": 2000}


def sales_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their part, under the film files' column names; the key is the order."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(
        F.col("l_orderkey").alias("title_id"),
        F.col("l_suppkey").cast("string").alias("director"),
        F.col("l_partkey").cast("string").alias("actors"),
        F.col("p_name").alias("genre"),
        F.col("p_size").alias("duration"),
        F.year("l_shipdate").alias("year_clean"),
        F.col("l_extendedprice").alias("avg_vote"),
    )


SALES_LINES_SQL = f"""
    SELECT l.l_orderkey AS title_id, CAST(l.l_suppkey AS VARCHAR) AS director,
           CAST(l.l_partkey AS VARCHAR) AS actors, p.p_name AS genre, p.p_size AS duration,
           CAST(year(l.l_shipdate) AS INT) AS year_clean, l.l_extendedprice AS avg_vote,
           {draw_sql("l.l_orderkey")} AS draw
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

SALES_LIMITS = {"recent_from": 2000, "classic_to": 1996, "short": 15, "medium": 35}


def orders_film(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with customer and nation under the film files' column names, for model timing."""
    joined = (
        dirty_orders(spark, sf)
        .join(customers(spark, sf), "o_custkey")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(
        F.col("o_orderkey").alias("title_id"),
        F.concat_ws(" ", "o_orderpriority", "c_mktsegment", "n_name", "c_name", "year").alias("description"),
        F.col("o_orderpriority").alias("genre"),
        F.col("c_name").alias("director"),
        F.concat_ws(" ", "c_mktsegment", "n_name").alias("actors"),
        F.dayofyear("o_orderdate").alias("duration"),
        F.col("year"),
        (F.col("o_totalprice") / 50000).alias("avg_vote"),
    )


ORDERS_LIMITS = {"recent_from": 2000, "classic_to": 1996, "short": 90, "medium": 120}
