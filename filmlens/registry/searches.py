"""Catalog searches, in DataFrame and SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.plans import catalog_queries as Q
from filmlens.plans.results import summary
from filmlens.registry.core import query
from filmlens.registry.tables import ORDERS, PARTS, PARTS_FILM_SQL, customers, orders, orders_catalog, parts_film, rounded, table
from filmlens.sources.catalog import register_catalog

_ORDER_COLUMNS = "o_orderkey, CAST(year(o_orderdate) AS INT) AS o_year, o_totalprice"
_JOINED = "orders LEFT JOIN customer ON o_custkey = c_custkey"


def _both_forms(name: str, named: Q.NamedQuery, oracle: str, frame) -> None:
    """Register the DataFrame form under ``name`` and the SQL form under ``sql_<name>``."""
    query(name, oracle)(lambda spark, sf: named.dataframe(frame(spark, sf)))
    query(f"sql_{name}", oracle)(lambda spark, sf: named.sql(spark, frame(spark, sf)))


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part")


def _with_person(spark: SparkSession, sf: str) -> DataFrame:
    return orders_catalog(spark, sf, "c_name")


_both_forms(
    "catalog_year_range",
    Q.by_year_range(1996, 1998, ORDERS),
    f"SELECT {_ORDER_COLUMNS} FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998",
    orders,
)
_both_forms(
    "catalog_min_score",
    Q.by_min_score(480000.0, ORDERS),
    f"SELECT {_ORDER_COLUMNS}, c_acctbal FROM {_JOINED} WHERE o_totalprice >= 480000",
    lambda spark, sf: orders_catalog(spark, sf, "c_acctbal"),
)
_both_forms(
    "catalog_genre",
    Q.by_genre("HIGH", roles=ORDERS),
    f"SELECT {_ORDER_COLUMNS} FROM orders WHERE o_orderpriority LIKE '%HIGH%'",
    orders,
)
_both_forms(
    "catalog_two_genres",
    Q.by_two_genres("HIGH", "URGENT", ORDERS),
    f"SELECT {_ORDER_COLUMNS} FROM orders WHERE o_orderpriority LIKE '%HIGH%' OR o_orderpriority LIKE '%URGENT%'",
    orders,
)
_both_forms(
    "catalog_title_prefix",
    Q.by_title_prefix("blue", PARTS),
    "SELECT p_name, p_size, p_retailprice FROM part WHERE p_name LIKE 'blue%'",
    _parts,
)
_both_forms(
    "catalog_year_genre_score",
    Q.by_year_genre_score(1996, 2000, "HIGH", 380000.0, ORDERS),
    f"""SELECT {_ORDER_COLUMNS} FROM orders
        WHERE year(o_orderdate) BETWEEN 1996 AND 2000 AND o_orderpriority LIKE '%HIGH%' AND o_totalprice >= 380000""",
    orders,
)
_both_forms(
    "catalog_person",
    Q.by_person("00000004", roles=ORDERS),
    f"SELECT {_ORDER_COLUMNS} FROM {_JOINED} WHERE c_name LIKE '%00000004%'",
    _with_person,
)
_both_forms(
    "catalog_person_year",
    Q.by_person("00000004", 1996, 2000, roles=ORDERS),
    f"SELECT {_ORDER_COLUMNS} FROM {_JOINED} WHERE c_name LIKE '%00000004%' AND year(o_orderdate) BETWEEN 1996 AND 2000",
    _with_person,
)
_both_forms(
    "catalog_person_year_genre",
    Q.by_person("00000004", 1995, 2001, "HIGH", roles=ORDERS),
    f"""SELECT {_ORDER_COLUMNS} FROM {_JOINED}
        WHERE c_name LIKE '%00000004%' AND year(o_orderdate) BETWEEN 1995 AND 2001 AND o_orderpriority LIKE '%HIGH%'""",
    _with_person,
)


@query(
    "sql_genre_year_lang_country",
    f"""SELECT o_orderkey, o_totalprice FROM {_JOINED}
        WHERE o_orderpriority LIKE '%HIGH%' AND year(o_orderdate) BETWEEN 1996 AND 2000
          AND o_orderstatus LIKE '%F%' AND c_mktsegment LIKE '%BUILD%'""",
)
def sql_genre_year_lang_country(spark: SparkSession, sf: str) -> DataFrame:
    named = Q.by_genre_years_language_country("HIGH", 1996, 2000, "F", "BUILD", ORDERS)
    return named.sql(spark, orders_catalog(spark, sf, "c_mktsegment"))


@query("sql_title_lookup", "SELECT p_name, p_type, p_retailprice FROM part WHERE p_name LIKE '%red widget%'")
def sql_title_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return Q.title_lookup("red widget", PARTS).sql(spark, _parts(spark, sf))


@query(
    "sql_any_genre_filters",
    f"""SELECT o_orderkey, o_orderpriority, o_totalprice FROM {_JOINED}
        WHERE (o_orderpriority LIKE '%HIGH%' OR o_orderpriority LIKE '%URGENT%' OR o_orderpriority LIKE '%LOW%')
          AND year(o_orderdate) BETWEEN 1995 AND 1998 AND o_totalprice >= 350000 AND c_mktsegment LIKE '%MACHINERY%'""",
)
def sql_any_genre_filters(spark: SparkSession, sf: str) -> DataFrame:
    named = Q.any_genre_filters(("HIGH", "URGENT", "LOW"), 1995, 1998, 350000.0, "MACHINERY", ORDERS)
    return named.sql(spark, orders_catalog(spark, sf, "c_mktsegment"))


@query("sql_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%red%' AND p_type LIKE 'ECO%'")
def sql_like(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("SELECT p_partkey, p_name FROM {part} WHERE p_name LIKE '%red%' AND p_type LIKE 'ECO%'", part=_parts(spark, sf))


@query(
    "global_avg",
    f"SELECT round(avg(avg_vote), 6) AS avg_vote_total, round(avg(total_votes), 4) AS avg_total_votes FROM ({PARTS_FILM_SQL})",
)
def global_avg(spark: SparkSession, sf: str) -> DataFrame:
    means = parts_film(spark, sf).agg(F.avg("avg_vote").alias("score"), F.avg("total_votes").alias("votes"))
    return means.select(rounded("score").alias("avg_vote_total"), rounded("votes", 4).alias("avg_total_votes"))


@query("global_stddev", f"SELECT round(stddev_samp(total_votes), 4) AS stddev_total_votes FROM ({PARTS_FILM_SQL})")
def global_stddev(spark: SparkSession, sf: str) -> DataFrame:
    found = Q.global_stddev(parts_film(spark, sf), "total_votes", "stddev_total_votes")
    return found.select(rounded("stddev_total_votes", 4).alias("stddev_total_votes"))


_OUTLIERS = "SELECT event_id, value FROM events WHERE value > (SELECT avg(value) + 3 * stddev_samp(value) FROM events)"


@query("outliers_3sigma", _OUTLIERS)
def outliers_3sigma(spark: SparkSession, sf: str) -> DataFrame:
    return Q.outliers(table(spark, sf, "events"), "value", ["event_id", "value"], "event_id")


@query("sql_outliers_3sigma", _OUTLIERS)
def sql_outliers_3sigma(spark: SparkSession, sf: str) -> DataFrame:
    return Q.outliers_sql(spark, table(spark, sf, "events"), "value", ["event_id", "value"], "event_id")


@query(
    "catalog_view",
    """SELECT o.o_custkey, o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
              o.o_orderdate, CAST(year(o.o_orderdate) AS INT) AS o_year, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
       FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def catalog_view(spark: SparkSession, sf: str) -> DataFrame:
    register_catalog(spark, orders(spark, sf), customers(spark, sf), "o_custkey")
    return spark.sql("SELECT * FROM full_movies")


@query(
    "result_summary",
    """WITH hit AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority LIKE '%HIGH%')
       SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM hit) AS total
       FROM hit ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def result_summary(spark: SparkSession, sf: str) -> DataFrame:
    hits = Q.matches(orders(spark, sf), Q.Criteria(genres=("HIGH",)), ORDERS).select("o_orderkey", "o_totalprice")
    return summary(hits, [F.desc("o_totalprice"), F.asc("o_orderkey")])
