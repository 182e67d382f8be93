"""Split, encoders, derived predictors and whole feature frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.functions.derive import derive_popularity, derive_temporal, duration_category
from filmlens.operators import encoding as E
from filmlens.operators.relational import hash_percent, split_by_key
from filmlens.plans.features import feature_frame, split_table
from filmlens.plans.variants import INTRINSIC_FREQUENCY, INTRINSIC_TARGET
from filmlens.registry.core import query
from filmlens.registry.tables import (
    PARTS_FILM_SQL,
    SALES_LIMITS,
    SALES_LINES_SQL,
    draw_sql,
    orders,
    parts_film,
    rounded,
    sales_lines,
    table,
)

_ORDERS_SQL = f"SELECT *, {draw_sql('o_orderkey')} AS draw FROM orders"
_MEANS_SQL = """
    SELECT {c}, avg(o_totalprice) AS category_mean, count(*) AS category_count,
           (avg(o_totalprice) * count(*) + (SELECT m FROM g) * 10) / (count(*) + 10) AS encoding
    FROM tr GROUP BY {c}
"""
_SPLIT_SQL = f"""
    WITH o AS ({_ORDERS_SQL}), tr AS (SELECT * FROM o WHERE draw < 80), g AS (SELECT avg(o_totalprice) AS m FROM tr),
         cust AS ({_MEANS_SQL.format(c="o_custkey")}), prio AS ({_MEANS_SQL.format(c="o_orderpriority")})
"""


def train_orders(spark: SparkSession, sf: str) -> DataFrame:
    return split_by_key(table(spark, sf, "orders"), ["o_orderkey"])[0]


@query("train_test_split", f"SELECT o_orderkey, draw < 80 AS is_train FROM ({_ORDERS_SQL})")
def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", (hash_percent(["o_orderkey"]) < 80).alias("is_train"))


@query(
    "category_mean_count",
    "SELECT o_custkey, round(avg(o_totalprice), 6) AS category_mean, count(*) AS category_count FROM orders GROUP BY 1",
)
def category_mean_count(spark: SparkSession, sf: str) -> DataFrame:
    found = E.category_means(table(spark, sf, "orders"), "o_custkey", "o_totalprice")
    return found.withColumn("category_mean", rounded("category_mean", 6))


@query("category_count", "SELECT o_custkey, count(*) AS category_count FROM orders GROUP BY 1")
def category_count(spark: SparkSession, sf: str) -> DataFrame:
    return E.category_counts(table(spark, sf, "orders"), "o_custkey")


@query(
    "join_group_mean",
    """SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS customer_mean FROM orders""",
)
def join_group_mean(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    joined = E.group_mean_join(found, "o_custkey", "o_totalprice", "customer_mean", ["o_orderkey"])
    return joined.select("o_orderkey", rounded("customer_mean", 6).alias("customer_mean"))


@query(
    "target_encode_fit",
    f"""{_SPLIT_SQL} SELECT o_custkey, category_count, round(encoding, 4) AS encoding,
        round((SELECT m FROM g), 4) AS default_encoding FROM cust""",
)
def target_encode_fit(spark: SparkSession, sf: str) -> DataFrame:
    fitted = E.target_encode_fit(train_orders(spark, sf), "o_custkey", "o_totalprice")
    return fitted.mapping.select(
        "o_custkey",
        "category_count",
        rounded("encoding", 4).alias("encoding"),
        rounded(F.lit(fitted.default), 4).alias("default_encoding"),
    )


_TARGET_APPLY_SQL = f"""{_SPLIT_SQL} SELECT o_orderkey, round(coalesce(encoding, (SELECT m FROM g)), 4) AS o_custkey_encoded
        FROM o LEFT JOIN cust USING (o_custkey)"""


@query("target_encode_apply", _TARGET_APPLY_SQL)
def target_encode_apply(spark: SparkSession, sf: str) -> DataFrame:
    fitted = E.target_encode_fit(train_orders(spark, sf), "o_custkey", "o_totalprice")
    found = E.encode_apply(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), fitted, ["o_orderkey"])
    return found.withColumn("o_custkey_encoded", rounded("o_custkey_encoded", 4))


@query("target_encode_apply_shuffled", _TARGET_APPLY_SQL)
def target_encode_apply_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The way of large mappings, fitted on keys of a narrower type than those looked up."""
    train = train_orders(spark, sf).withColumn("o_custkey", F.col("o_custkey").cast("int"))
    fitted = E.target_encode_fit(train, "o_custkey", "o_totalprice")
    found = E.encode_apply(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), fitted, ["o_orderkey"], broadcast_bytes=0)
    return found.withColumn("o_custkey_encoded", rounded("o_custkey_encoded", 4))


@query(
    "target_encode_two",
    f"""{_SPLIT_SQL} SELECT o_orderkey, round(coalesce(cust.encoding, (SELECT m FROM g)), 4) AS o_custkey_encoded,
               round(coalesce(prio.encoding, (SELECT m FROM g)), 4) AS o_orderpriority_encoded
        FROM o LEFT JOIN cust USING (o_custkey) LEFT JOIN prio USING (o_orderpriority)""",
)
def target_encode_two(spark: SparkSession, sf: str) -> DataFrame:
    train = train_orders(spark, sf)
    found = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    for column in ("o_custkey", "o_orderpriority"):
        found = E.encode_apply(found, E.target_encode_fit(train, column, "o_totalprice"), ["o_orderkey"])
    return found.withColumns({c: rounded(c, 4) for c in ("o_custkey_encoded", "o_orderpriority_encoded")})


_FREQUENCY_SQL = f"""
    WITH o AS ({_ORDERS_SQL}), tr AS (SELECT * FROM o WHERE draw < 80), t AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM tr),
         freq AS (SELECT o_custkey, count(*) AS category_count, count(*) / (SELECT n FROM t) AS encoding FROM tr GROUP BY 1)
"""


@query(
    "frequency_encode_fit",
    f"""{_FREQUENCY_SQL} SELECT o_custkey, category_count, round(encoding, 9) AS encoding,
        round(1.0 / (SELECT n FROM t), 9) AS default_encoding FROM freq""",
)
def frequency_encode_fit(spark: SparkSession, sf: str) -> DataFrame:
    fitted = E.frequency_encode_fit(train_orders(spark, sf), "o_custkey")
    return fitted.mapping.select(
        "o_custkey",
        "category_count",
        rounded("encoding", 9).alias("encoding"),
        rounded(F.lit(fitted.default), 9).alias("default_encoding"),
    )


_FREQUENCY_APPLY_SQL = f"""{_FREQUENCY_SQL} SELECT o_orderkey, round(coalesce(encoding, 1.0 / (SELECT n FROM t)), 9) AS o_custkey_freq
        FROM o LEFT JOIN freq USING (o_custkey)"""


def _frequency_encoded(spark: SparkSession, sf: str, broadcast_bytes: int | None = None) -> DataFrame:
    fitted = E.frequency_encode_fit(train_orders(spark, sf), "o_custkey")
    found = E.encode_apply(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), fitted, ["o_orderkey"], broadcast_bytes)
    return found.withColumn("o_custkey_freq", rounded("o_custkey_freq", 9))


@query("frequency_encode_apply", _FREQUENCY_APPLY_SQL)
def frequency_encode_apply(spark: SparkSession, sf: str) -> DataFrame:
    return _frequency_encoded(spark, sf)


@query("frequency_encode_apply_shuffled", _FREQUENCY_APPLY_SQL)
def frequency_encode_apply_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    return _frequency_encoded(spark, sf, broadcast_bytes=0)


_TOP_SQL = "SELECT p_name, count(*) AS category_count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30"


@query("topk_categories", _TOP_SQL)
def topk_categories(spark: SparkSession, sf: str) -> DataFrame:
    return E.top_categories_fit(table(spark, sf, "part"), "p_name", 30).table


@query(
    "reduce_cardinality_apply",
    f"""SELECT p_partkey, CASE WHEN p_name IN (SELECT p_name FROM ({_TOP_SQL})) THEN p_name ELSE 'Other' END AS p_name FROM part""",
)
def reduce_cardinality_apply(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    return E.top_categories_apply(parts.select("p_partkey", "p_name"), E.top_categories_fit(parts, "p_name", 30))


@query(
    "encoding_sizes",
    f"""{_SPLIT_SQL} SELECT 'o_custkey' AS "column", count(*) AS n_categories, CAST(sum(category_count) AS BIGINT) AS n_rows FROM cust
        UNION ALL SELECT 'o_orderpriority', count(*), CAST(sum(category_count) AS BIGINT) FROM prio""",
)
def encoding_sizes(spark: SparkSession, sf: str) -> DataFrame:
    train = train_orders(spark, sf)
    return E.encoding_sizes([E.target_encode_fit(train, c, "o_totalprice") for c in ("o_custkey", "o_orderpriority")])


_DERIVED_SQL = """CAST(trunc({y} / 10.0::DOUBLE) AS INT) * 10 AS decade, CASE WHEN {y} >= {r} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_recent,
    CASE WHEN {y} <= {k} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_old_classic,
    CASE WHEN {d} <= {s} THEN 'short' WHEN {d} <= {m} THEN 'medium' ELSE 'long' END AS duration_category"""


@query(
    "derive_temporal",
    f"""SELECT o_orderkey, {_DERIVED_SQL.format(y="year(o_orderdate)", r=2000, k=1996, d="dayofyear(o_orderdate)", s=90, m=120)} FROM orders""",
)
def derive_temporal_query(spark: SparkSession, sf: str) -> DataFrame:
    dated = orders(spark, sf).withColumn("duration", F.dayofyear("o_orderdate"))
    found = derive_temporal(dated, "o_year", recent_from=2000, classic_to=1996)
    return found.select("o_orderkey", "decade", "is_recent", "is_old_classic", "duration_category")


@query(
    "duration_category",
    "SELECT doc_id, CASE WHEN n_chars <= 90 THEN 'short' WHEN n_chars <= 120 THEN 'medium' ELSE 'long' END AS duration_category FROM documents",
)
def duration_category_query(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", duration_category("n_chars").alias("duration_category"))


@query(
    "derive_popularity",
    f"""SELECT title_id, round(votes / (reviews_from_users + reviews_from_critics + 1), 6) AS votes_per_review,
               round(reviews_from_users / (reviews_from_critics + 1), 6) AS review_ratio,
               round(ln(1 + votes), 6) AS log_votes FROM ({PARTS_FILM_SQL})""",
)
def derive_popularity_query(spark: SparkSession, sf: str) -> DataFrame:
    derived = ("votes_per_review", "review_ratio", "log_votes")
    return derive_popularity(parts_film(spark, sf)).select("title_id", *[rounded(c).alias(c) for c in derived])


_FRAME_COLUMNS = ("title_id", "genre", "duration", "decade", "is_recent", "is_old_classic", "duration_category")
_FRAME_DERIVED = _DERIVED_SQL.format(y="s.year_clean", r=2000, k=1996, d="s.duration", s=15, m=35)
_FRAME_BASE = f"""
    WITH s AS ({SALES_LINES_SQL}), tr AS (SELECT * FROM s WHERE draw < 80),
         top AS (SELECT genre, count(*) AS n FROM tr GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30),
"""
_FRAME_TAIL = f"""s.title_id, CASE WHEN s.genre IN (SELECT genre FROM top) THEN s.genre ELSE 'Other' END AS genre, s.duration,
    {_FRAME_DERIVED}, CASE WHEN s.draw < 80 THEN 'train' ELSE 'test' END AS side
    FROM s LEFT JOIN d ON s.director = d.director LEFT JOIN a ON s.actors = a.actors"""


def _frame(spark: SparkSession, sf: str, variant, encoded: tuple[str, str], digits: int) -> DataFrame:
    rows = split_table(sales_lines(spark, sf), ["title_id"], "sales-lines", dealt=False)
    frame = feature_frame(rows, variant, **SALES_LIMITS)
    columns = [*_FRAME_COLUMNS, *[rounded(c, digits).alias(c) for c in encoded]]
    return frame.both.select(*columns, "side")


def _smoothed(column: str) -> str:
    return f"""SELECT {column}, (avg(avg_vote) * count(*) + (SELECT m FROM g) * 10) / (count(*) + 10) AS e FROM tr GROUP BY 1"""


@query(
    "feature_frame_target",
    f"""{_FRAME_BASE} g AS (SELECT avg(avg_vote) AS m FROM tr), d AS ({_smoothed("director")}), a AS ({_smoothed("actors")})
        SELECT round(coalesce(d.e, (SELECT m FROM g)), 3) AS director_encoded,
               round(coalesce(a.e, (SELECT m FROM g)), 3) AS actors_encoded, {_FRAME_TAIL}""",
)
def feature_frame_target(spark: SparkSession, sf: str) -> DataFrame:
    return _frame(spark, sf, INTRINSIC_TARGET, ("director_encoded", "actors_encoded"), 3)


@query(
    "feature_frame_frequency",
    f"""{_FRAME_BASE} t AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM tr),
        d AS (SELECT director, count(*) / (SELECT n FROM t) AS e FROM tr GROUP BY 1),
        a AS (SELECT actors, count(*) / (SELECT n FROM t) AS e FROM tr GROUP BY 1)
        SELECT round(coalesce(d.e, 1.0 / (SELECT n FROM t)), 9) AS director_freq,
               round(coalesce(a.e, 1.0 / (SELECT n FROM t)), 9) AS actors_freq, {_FRAME_TAIL}""",
)
def feature_frame_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return _frame(spark, sf, INTRINSIC_FREQUENCY, ("director_freq", "actors_freq"), 9)
