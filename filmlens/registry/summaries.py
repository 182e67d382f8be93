"""Mergeable sketches, nested types, importance by permutation and ablation."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.operators import nested as N
from filmlens.operators import sketches as K
from filmlens.plans import evaluation as V
from filmlens.plans.importance import ablation, permutation_importance, permuted_rows
from filmlens.plans.models import FittedModel, regressors
from filmlens.plans.variants import Variant
from filmlens.registry.core import query
from filmlens.registry.tables import PARTS_FILM_SQL, parts_film, rounded, table

# --- sketches ----------------------------------------------------------------

DISTINCT_BOUND = 0.06
RANK_BOUND = 0.03
"""Four times the standard error of the distinct sketches, and over twice the rank error of the quantile sketches."""


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return K.sketch_parts(events, ["day", "event_type"], ["user_id", "event_id"], ["value"])


@query(
    "sketch_distinct_by_type",
    """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users, count(DISTINCT event_id) AS n_events, true AS users_within, true AS events_within
       FROM events GROUP BY event_type""",
)
def sketch_distinct_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sketches merged by type, held against exact counts within the stated bound."""
    merged = K.merge_parts(_daily(spark, sf), ["event_type"])
    estimated = merged.select("event_type", "n", K.distinct_estimate("user_id").alias("users"), K.distinct_estimate("event_id").alias("events"))
    exact = table(spark, sf, "events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("n_users"), F.count_distinct("event_id").alias("n_events")
    )
    within = lambda a, b: F.abs(F.col(a) - F.col(b)) <= DISTINCT_BOUND * F.col(b)
    return estimated.join(exact, "event_type").select(
        "event_type", "n", "n_users", "n_events", within("users", "n_users").alias("users_within"), within("events", "n_events").alias("events_within")
    )


@query(
    "sketch_quantiles_by_type",
    """SELECT event_type, q AS share, count(value) AS n, true AS within FROM events, (VALUES (0.1::DOUBLE), (0.5), (0.9)) s(q) GROUP BY event_type, q""",
)
def sketch_quantiles_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """The true share of values up to each merged quantile, held against the share asked for."""
    merged = K.merge_parts(K.merge_parts(_daily(spark, sf), ["event_type", "day"]), ["event_type"])
    shares = F.array(*[F.struct(F.lit(q).alias("share"), K.quantile_estimate("value", q).alias("estimate")) for q in (0.1, 0.5, 0.9)])
    estimates = merged.select("event_type", F.explode(shares).alias("s")).select("event_type", "s.*")
    values = table(spark, sf, "events").filter("value IS NOT NULL")
    ranked = values.join(F.broadcast(estimates), "event_type").groupBy("event_type", "share").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < F.col("estimate")).alias("below"), F.count_if(F.col("value") <= F.col("estimate")).alias("upto")
    )
    within = (F.col("below") / F.col("n") <= F.col("share") + RANK_BOUND) & (F.col("upto") / F.col("n") >= F.col("share") - RANK_BOUND)
    return ranked.select("event_type", "share", "n", within.alias("within"))


@query("sketch_merge_order", "SELECT count(*) AS n, true AS same_however_merged FROM events")
def sketch_merge_order(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches merged at once and by way of days and of types give one estimate."""
    daily = _daily(spark, sf)
    ways = [daily, K.merge_parts(daily, ["day"]), K.merge_parts(daily, ["event_type"])]
    found = None
    for way in ways:
        one = K.merge_parts(way, []).select("n", K.distinct_estimate("user_id").alias("users"))
        found = one if found is None else found.unionByName(one)
    return found.agg(F.max("n").alias("n"), (F.count_distinct("n", "users") == 1).alias("same_however_merged"))


# --- nested types ------------------------------------------------------------

_TOKENS_SQL = "list_distinct(list_filter(list_transform(string_split_regex(p_name || ' ' || p_type, '[ ]'), lambda x: trim(x)), lambda x: x <> ''))"


def _tokens():
    return N.token_list(F.concat_ws(" ", "p_name", "p_type"), " ")


@query(
    "nested_token_search",
    f"""SELECT p_partkey, CAST(len({_TOKENS_SQL}) AS INT) AS n_tokens, list_has_any({_TOKENS_SQL}, ['ring', 'red']) AS by_token,
               contains(p_name, 'ring') OR contains(p_name, 'red') AS by_substring,
               len(list_intersect({_TOKENS_SQL}, ['ring', 'SMALL'])) = 2 AS both FROM part""",
)
def nested_token_search(spark: SparkSession, sf: str) -> DataFrame:
    """Whole tokens of a list next to the substring form, which also finds parts of longer words."""
    return table(spark, sf, "part").select(
        "p_partkey",
        F.size(_tokens()).alias("n_tokens"),
        N.has_any(_tokens(), ["ring", "red"]).alias("by_token"),
        (F.contains("p_name", F.lit("ring")) | F.contains("p_name", F.lit("red"))).alias("by_substring"),
        N.has_all(_tokens(), ["ring", "SMALL"]).alias("both"),
    )


_INDEX_SQL = f"SELECT DISTINCT unnest({_TOKENS_SQL}) AS token, p_partkey AS key FROM part"


def _index(spark: SparkSession, sf: str) -> DataFrame:
    return N.inverted_index(table(spark, sf, "part"), "p_partkey", _tokens())


@query("nested_index_summary", f"SELECT token, count(*) AS n_rows, min(key) AS first_key FROM ({_INDEX_SQL}) GROUP BY token")
def nested_index_summary(spark: SparkSession, sf: str) -> DataFrame:
    return N.index_summary(_index(spark, sf))


@query(
    "nested_index_search",
    f"SELECT key, count(*) AS n_found FROM ({_INDEX_SQL}) WHERE token IN ('ring', 'red', 'SMALL') GROUP BY key HAVING count(*) >= 2",
)
def nested_index_search(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with two or more of three tokens, by the inverted index."""
    return N.search_index(_index(spark, sf), ["ring", "red", "SMALL"], 2)


@query(
    "nested_props",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS prop_k, json_extract(props, '$.missing') IS NOT NULL AS has_missing, json_valid(props) AS props_valid
       FROM events""",
)
def nested_props(spark: SparkSession, sf: str) -> DataFrame:
    found = N.parse_record(table(spark, sf, "events").select("event_id", "props"), "props", "k bigint, missing string", "prop_")
    return found.select("event_id", "prop_k", F.col("prop_missing").isNotNull().alias("has_missing"), "props_valid")


@query(
    "nested_order_lines",
    """SELECT l_orderkey, CAST(count(*) AS INT) AS n_lines, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INT) AS n_returned,
              round(sum(l_quantity), 2) AS quantity, max(l_quantity) >= 40 AS any_large, min({'n': l_linenumber, 'p': l_partkey}).p AS first_part
       FROM lineitem GROUP BY l_orderkey""",
)
def nested_order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their lines as a list of records, asked by functions on lists."""
    packed = N.packed_details(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", ["l_partkey", "l_quantity", "l_returnflag"])
    return packed.select(
        "l_orderkey",
        F.size("details").alias("n_lines"),
        F.size(F.filter("details", lambda d: d["l_returnflag"] == "R")).alias("n_returned"),
        rounded(F.aggregate("details", F.lit(0.0), lambda acc, d: acc + d["l_quantity"]), 2).alias("quantity"),
        F.exists("details", lambda d: d["l_quantity"] >= 40).alias("any_large"),
        F.get("details", F.lit(0))["l_partkey"].alias("first_part"),
    )


# --- importance --------------------------------------------------------------

_HASH_SQL = "CAST('0x' || substr(md5(concat_ws('|', CAST({k} AS VARCHAR), '42')), 1, 8) AS BIGINT)"
_STUMP_SQL = f"""
    WITH r AS (SELECT title_id, avg_vote AS y, duration > 25 AS flag, {_HASH_SQL.format(k="title_id")} AS h FROM ({PARTS_FILM_SQL}) WHERE avg_vote IS NOT NULL),
    s AS (SELECT *, coalesce(lag(flag) OVER (ORDER BY h, title_id), first_value(flag) OVER (ORDER BY h DESC, title_id DESC)) AS other FROM r),
    m AS (SELECT flag, avg(y) AS mean FROM r GROUP BY flag),
    e AS (SELECT avg((y - own.mean) ** 2) AS base, avg((y - moved.mean) ** 2) AS moved, var_pop(y) AS spread
          FROM s JOIN m own ON own.flag = s.flag JOIN m moved ON moved.flag = s.other)
"""


def _stump(spark: SparkSession, sf: str, name: str = "forest"):
    """A tree with one split on a flag, next to a constant it cannot use."""
    flag = (F.col("duration") > 25).cast("double").alias("flag")
    rows = parts_film(spark, sf).filter("avg_vote IS NOT NULL").select("title_id", "avg_vote", flag, F.lit(1.0).alias("constant"))
    assembled = VectorAssembler(inputCols=["constant", "flag"], outputCol="scaled_features").transform(rows)
    estimator = regressors("avg_vote", gbt_iterations=1, forest_trees=1)[name]
    if name == "forest":
        estimator.setBootstrap(False)
    return estimator.setMaxDepth(1).setSubsamplingRate(1.0).fit(assembled), assembled


@query("permutation_order", f"{_STUMP_SQL} SELECT title_id, CAST(other AS DOUBLE) AS other FROM s")
def permutation_order(spark: SparkSession, sf: str) -> DataFrame:
    """The permuted flag of every part."""
    _, rows = _stump(spark, sf)
    return permuted_rows(rows.select("title_id", "flag"), "title_id", "flag", "other").select("title_id", "other")


@query(
    "permutation_importance",
    f"""{_STUMP_SQL} SELECT 'flag' AS "group", round(sqrt(moved), 6) AS rmse, round(sqrt(moved) - sqrt(base), 6) AS rmse_increase, round((moved - base) / spread, 6) AS r2_drop FROM e
        UNION ALL SELECT 'constant', round(sqrt(base), 6), 0.0::DOUBLE, 0.0::DOUBLE FROM e""",
)
def permutation_importance_query(spark: SparkSession, sf: str) -> DataFrame:
    """A model of one split, whose permuted error SQL can state."""
    model, rows = _stump(spark, sf)
    found = permutation_importance(model, rows, {"constant": [0], "flag": [1]}, "avg_vote", "title_id", "scaled_features", "pred_forest")
    # Without the sign of a zero.
    return found.withColumns({c: rounded(c) + 0.0 for c in ("rmse", "rmse_increase", "r2_drop")})


_ABLATION_SQL = f"""
    WITH r AS (SELECT avg_vote AS y, CAST(duration AS DOUBLE) AS a, reviews_from_users AS b FROM ({PARTS_FILM_SQL}) WHERE avg_vote IS NOT NULL),
    m AS (SELECT avg(y) AS my, avg(a) AS ma, avg(b) AS mb, stddev_pop(y) AS sy, stddev_pop(a) AS sa, stddev_pop(b) AS sb,
                 corr(a, b) AS ab, corr(a, y) AS ay, corr(b, y) AS byy, 1 + 0.1::DOUBLE / stddev_pop(y) AS d FROM r),
    w AS (SELECT *, (d * ay - ab * byy) / (d * d - ab * ab) * sy / sa AS wa, (d * byy - ab * ay) / (d * d - ab * ab) * sy / sb AS wb FROM m),
    p AS (SELECT y, my + wa * (a - ma) + wb * (b - mb) AS p0, my + byy / d * sy / sb * (b - mb) AS p1, my + ay / d * sy / sa * (a - ma) AS p2 FROM r CROSS JOIN w),
    e AS (SELECT unnest(['', 'duration', 'reviews']) AS without, unnest([avg((y - p0) ** 2), avg((y - p1) ** 2), avg((y - p2) ** 2)]) AS mse, var_pop(y) AS spread FROM p)
    SELECT without, round(sqrt(mse), 5) AS rmse, round(1 - mse / spread, 5) AS r2,
           round((mse - min(mse) FILTER (without = '') OVER ()) / spread, 5) AS r2_drop, (mse - min(mse) FILTER (without = '') OVER ()) / spread > 0.2 AS depends FROM e
"""


@query("ablation", _ABLATION_SQL)
def ablation_query(spark: SparkSession, sf: str) -> DataFrame:
    """The ridge estimator without each of its two inputs."""
    rows = parts_film(spark, sf).filter("avg_vote IS NOT NULL").select(
        "title_id", "avg_vote", F.col("duration").cast("double").alias("duration"), F.col("reviews_from_users").cast("double").alias("reviews")
    )
    estimator = regressors("avg_vote")["ridge"].setFeaturesCol("features")
    found = ablation(rows, rows, ["duration", "reviews"], {"duration": ["duration"], "reviews": ["reviews"]}, estimator, "avg_vote")
    return found.withColumns({c: rounded(c, 5) + 0.0 for c in ("rmse", "r2", "r2_drop")})


_TWO_INPUTS = Variant(name="two_inputs", encoder="target", required=(), numeric=("constant", "flag"), text_width=0, genre_width=0)


@query(
    "feature_importance_one_split",
    """SELECT m AS model, CAST(r AS INT) AS "rank", CAST(i AS INT) AS "index", n AS name, 'numeric' AS "group", v AS importance
       FROM (VALUES (1, 1, 'flag', 1.0::DOUBLE), (2, 0, 'constant', 0.0)) t(r, i, n, v), (VALUES ('forest'), ('gbt')) u(m),
            (SELECT count(*) AS parts FROM part) WHERE parts > 0""",
)
def feature_importance_one_split(spark: SparkSession, sf: str) -> DataFrame:
    """Importances by name of trees that can split on one input only."""
    found = None
    for name in ("forest", "gbt"):
        model, rows = _stump(spark, sf, name)
        one = V.feature_importance(FittedModel(name, model, 0.0), rows, _TWO_INPUTS, None).select(F.lit(name).alias("model"), "*")
        found = one if found is None else found.unionByName(one)
    return found


_PRICE_PREDICTIONS = {"ridge": "pred_ridge", "forest": "pred_forest", "gbt": "pred_gbt"}
_PRICES_SQL = """
    WITH s AS (SELECT p_retailprice AS y, p_retailprice + p_size AS pred_ridge, p_retailprice + p_size / 2.0::DOUBLE AS pred_forest,
                      p_retailprice - p_size / 4.0::DOUBLE AS pred_gbt FROM part),
    m AS (SELECT unnest(['ridge', 'forest', 'gbt']) AS model, unnest([avg((y - pred_ridge) ** 2), avg((y - pred_forest) ** 2), avg((y - pred_gbt) ** 2)]) AS mse, var_pop(y) AS spread FROM s),
    f AS (SELECT model, sqrt(mse) AS rmse, 1 - mse / spread AS r2 FROM m), b AS (SELECT rmse AS b, r2 AS q FROM f WHERE model = 'ridge')
"""


@query(
    "model_ranking_gains",
    f"""{_PRICES_SQL} SELECT CAST(row_number() OVER (ORDER BY rmse, model) AS INT) AS "rank", model, round(rmse, 4) AS rmse, round(r2, 6) AS r2,
        round((b - rmse) / b * 100, 4) + 0.0::DOUBLE AS rmse_gain_pct, round((r2 - q) / q * 100, 4) + 0.0::DOUBLE AS r2_gain_pct FROM f CROSS JOIN b""",
)
def model_ranking_gains(spark: SparkSession, sf: str) -> DataFrame:
    """The ranking with both gains, on part prices and three predictions that are off by shares of the part's size."""
    y, size = F.col("p_retailprice"), F.col("p_size")
    scored = table(spark, sf, "part").select(
        y.alias("y"), (y + size).alias("pred_ridge"), (y + size / 2.0).alias("pred_forest"), (y - size / 4.0).alias("pred_gbt")
    )
    found = V.model_ranking(V.regression_metrics(scored, "y", _PRICE_PREDICTIONS))
    return found.select(
        "rank", "model", rounded("rmse", 4).alias("rmse"), rounded("r2").alias("r2"),
        (rounded("rmse_gain_pct", 4) + 0.0).alias("rmse_gain_pct"), (rounded("r2_gain_pct", 4) + 0.0).alias("r2_gain_pct"),
    )
