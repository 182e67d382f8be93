"""Out-of-fold encoding, nested cross-validation and collaboration features."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.operators import collaboration as C
from filmlens.operators import encoding as E
from filmlens.operators.leakage import pearson
from filmlens.operators.relational import hash_percent
from filmlens.plans import validation as X
from filmlens.plans.features import one_side
from filmlens.plans.variants import INTRINSIC_KFOLD, INTRINSIC_TARGET
from filmlens.registry.core import query
from filmlens.registry.encoding import train_orders
from filmlens.registry.tables import DOCUMENT_LIMITS, PARTS_LIMITS, documents_film, draw_sql, parts_film, rounded, table

FOLDS = 5


def fold_sql(key: str, folds: int = FOLDS) -> str:
    """SQL form of ``fold_number`` with its default seed."""
    return f"CAST(CAST('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), '{E.FOLD_SEED}')), 1, 8) AS BIGINT) % {folds} AS INT)"


# --- out-of-fold encoding --------------------------------------------------

_FOLDED_SQL = f"""
    WITH o AS (SELECT *, {draw_sql("o_orderkey")} AS draw, {fold_sql("o_orderkey")} AS fold FROM orders),
         tr AS (SELECT * FROM o WHERE draw < 80), k AS (SELECT unnest(range({FOLDS} + 1)) AS k),
         g AS (SELECT k, avg(o_totalprice) AS m FROM tr, k WHERE fold <> k GROUP BY k),
         c AS (SELECT k, o_custkey, count(*) AS n, (avg(o_totalprice) * count(*) + any_value(m) * 10) / (count(*) + 10) AS e
               FROM tr JOIN g ON fold <> k GROUP BY k, o_custkey),
         enc AS (SELECT o_orderkey, o.o_custkey, o.o_totalprice, draw < 80 AS is_train, coalesce(e, m) AS e
                 FROM o JOIN g ON g.k = CASE WHEN draw < 80 THEN fold ELSE {FOLDS} END
                 LEFT JOIN c ON c.k = g.k AND c.o_custkey = o.o_custkey)
"""


def _folded(spark: SparkSession, sf: str, broadcast_bytes: int | None = None) -> DataFrame:
    fitted = E.kfold_encode_fit(train_orders(spark, sf), "o_custkey", "o_totalprice", ["o_orderkey"], FOLDS)
    found = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return E.kfold_encode_apply(found, fitted, hash_percent(["o_orderkey"]) < 80, ["o_orderkey"], broadcast_bytes)


_KFOLD_APPLY_SQL = f"{_FOLDED_SQL} SELECT o_orderkey, round(e, 4) AS o_custkey_encoded FROM enc"


@query("kfold_target_encode", _KFOLD_APPLY_SQL)
def kfold_target_encode(spark: SparkSession, sf: str) -> DataFrame:
    return _folded(spark, sf).select("o_orderkey", rounded("o_custkey_encoded", 4).alias("o_custkey_encoded"))


@query("kfold_target_encode_shuffled", _KFOLD_APPLY_SQL)
def kfold_target_encode_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The way of large mappings."""
    return _folded(spark, sf, broadcast_bytes=0).select("o_orderkey", rounded("o_custkey_encoded", 4).alias("o_custkey_encoded"))


@query(
    "kfold_encode_fit",
    f"""{_FOLDED_SQL} SELECT g.k AS fold, o_custkey, round(coalesce(e, m), 4) AS encoding
        FROM (SELECT DISTINCT o_custkey FROM tr) CROSS JOIN g LEFT JOIN c USING (k, o_custkey)""",
)
def kfold_encode_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Every fitted value; the last number stands for all folds."""
    fitted = E.kfold_encode_fit(train_orders(spark, sf), "o_custkey", "o_totalprice", ["o_orderkey"], FOLDS)
    found = fitted.mapping.select("o_custkey", F.posexplode("encodings").alias("fold", "encoding"))
    return found.select(F.col("fold").cast("bigint").alias("fold"), "o_custkey", rounded("encoding", 4).alias("encoding"))


@query(
    "kfold_leakage",
    f"""{_FOLDED_SQL}, plain AS (SELECT o_custkey, e FROM c WHERE k = {FOLDS}),
        r AS (SELECT corr(plain.e, o_totalprice) AS with_own_row, corr(enc.e, o_totalprice) AS out_of_fold
              FROM enc JOIN plain USING (o_custkey) WHERE is_train)
        SELECT round(with_own_row, 6) AS with_own_row, round(out_of_fold, 6) AS out_of_fold, with_own_row > out_of_fold + 0.1 AS leaks FROM r""",
)
def kfold_leakage(spark: SparkSession, sf: str) -> DataFrame:
    """Correlation of the training rows' target with the encoding that contains it and with the one that does not."""
    train = train_orders(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice")
    plain = E.target_encode_fit(train, "o_custkey", "o_totalprice")
    folded = E.kfold_encode_fit(train, "o_custkey", "o_totalprice", ["o_orderkey"], FOLDS)
    both = E.encode_apply(train.withColumn("c", F.col("o_custkey")), plain, ["o_orderkey"]).withColumnsRenamed(
        {"o_custkey_encoded": "plain", "c": "o_custkey"}
    )
    both = E.kfold_encode_apply(both, folded, F.lit(True), ["o_orderkey"])
    found = both.agg(pearson("plain", "o_totalprice").alias("with_own_row"), pearson("o_custkey_encoded", "o_totalprice").alias("out_of_fold"))
    leaks = (F.col("with_own_row") > F.col("out_of_fold") + 0.1).alias("leaks")
    return found.select(rounded("with_own_row").alias("with_own_row"), rounded("out_of_fold").alias("out_of_fold"), leaks)


# --- cross-validation --------------------------------------------------------

_SMOOTHINGS = {"s1": 1.0, "s10": 10.0, "s100": 100.0}
_ROUNDS_SQL = f"""
    WITH o AS (SELECT *, {fold_sql("o_orderkey")} AS fold FROM orders), k AS (SELECT CAST(unnest(range({FOLDS})) AS INT) AS k),
         g AS (SELECT k, avg(o_totalprice) AS m FROM o JOIN k ON fold <> k GROUP BY k),
         c AS (SELECT k, o_custkey, count(*) AS n, avg(o_totalprice) AS mean FROM o JOIN k ON fold <> k GROUP BY k, o_custkey)
"""


def _order_folds(spark: SparkSession, sf: str) -> DataFrame:
    return X.fold_table(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], FOLDS)


@query("cv_fold_counts", f"{_ROUNDS_SQL} SELECT k AS fold, count(*) FILTER (fold <> k) AS n_train, count(*) FILTER (fold = k) AS n_test FROM o, k GROUP BY k")
def cv_fold_counts(spark: SparkSession, sf: str) -> DataFrame:
    return X.fold_counts(_order_folds(spark, sf), FOLDS)


@query(
    "cv_encodings",
    f"""{_ROUNDS_SQL} SELECT fold, o_orderkey, round(coalesce((mean * n + m * 10) / (n + 10), m), 4) AS o_custkey_encoded
        FROM o JOIN g ON g.k = o.fold LEFT JOIN c ON c.k = o.fold AND c.o_custkey = o.o_custkey""",
)
def cv_encodings(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a test row: its customer encoded by a fit on the other folds."""
    folds = _order_folds(spark, sf)
    found = None
    for k in range(FOLDS):
        sides = X.sides_of_fold(folds, k)
        fitted = E.target_encode_fit(one_side(sides, "train"), "o_custkey", "o_totalprice")
        one = E.encode_apply(one_side(sides, "test"), fitted, ["o_orderkey"], X.broadcast_share(FOLDS)).select(
            F.lit(k).alias("fold"), "o_orderkey", rounded("o_custkey_encoded", 4).alias("o_custkey_encoded")
        )
        found = one if found is None else found.unionByName(one)
    return found


def _smoothing_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The grid of smoothing strengths: the encoding itself is the prediction."""

    def fit_and_score(sides: DataFrame) -> DataFrame:
        fitted = E.target_encode_fit(one_side(sides, "train"), "o_custkey", "o_totalprice")
        strengths = {f"pred_{name}": strength for name, strength in _SMOOTHINGS.items()}
        return E.encode_apply_grid(one_side(sides, "test"), fitted, strengths, ["o_orderkey"], X.broadcast_share(FOLDS))

    return X.cross_validate(_order_folds(spark, sf), FOLDS, fit_and_score, "o_totalprice", {n: f"pred_{n}" for n in _SMOOTHINGS})


def _smoothing_sql(name: str, strength: float) -> str:
    p = f"(o_totalprice - coalesce((mean * n + m * {strength}) / (n + {strength}), m))"
    return f"""SELECT fold, '{name}' AS model, sqrt(avg({p} * {p})) AS rmse, avg(abs({p})) AS mae,
                      1 - avg({p} * {p}) / var_pop(o_totalprice) AS r2 FROM scored GROUP BY fold"""


_SMOOTHING_SQL = (
    f"""{_ROUNDS_SQL}, scored AS (SELECT fold, o_totalprice, mean, n, m FROM o JOIN g ON g.k = o.fold
            LEFT JOIN c ON c.k = o.fold AND c.o_custkey = o.o_custkey), metrics AS ("""
    + " UNION ALL ".join(_smoothing_sql(n, s) for n, s in _SMOOTHINGS.items())
    + ")"
)


@query("cv_metrics", f"{_SMOOTHING_SQL} SELECT fold, model, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 6) AS r2 FROM metrics")
def cv_metrics(spark: SparkSession, sf: str) -> DataFrame:
    found = _smoothing_metrics(spark, sf)
    return found.select("fold", "model", rounded("rmse", 4).alias("rmse"), rounded("mae", 4).alias("mae"), rounded("r2").alias("r2"))


@query(
    "cv_summary",
    f"""{_SMOOTHING_SQL}, s AS (SELECT model, count(*) AS n_folds, avg(rmse) AS a, stddev_samp(rmse) AS b, avg(r2) AS c, stddev_samp(r2) AS d FROM metrics GROUP BY 1)
        SELECT model, n_folds, round(a, 4) AS rmse_mean, round(b, 4) AS rmse_spread, round(c, 6) AS r2_mean, round(d, 6) AS r2_spread,
               row_number() OVER (ORDER BY a, model) = 1 AS is_best FROM s""",
)
def cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    found = X.cross_validation_summary(_smoothing_metrics(spark, sf))
    return found.withColumns({c: rounded(c, 4 if c.startswith("rmse") else 6) for c in ("rmse_mean", "rmse_spread", "r2_mean", "r2_spread")})


_REGULARISATIONS = {"weak": 0.01, "middle": 0.1, "strong": 1.0}
_CV_RIDGE_SQL = f"""
    WITH p AS (SELECT p_partkey, p_brand, CAST(p_size AS DOUBLE) AS b, p_retailprice / 100 AS y, {fold_sql("p_partkey", 3)} AS fold FROM part),
         k AS (SELECT CAST(unnest(range(3)) AS INT) AS k),
         g AS (SELECT k, avg(y) AS m FROM p JOIN k ON fold <> k GROUP BY k),
         c AS (SELECT k, p_brand, (avg(y) * count(*) + any_value(m) * 10) / (count(*) + 10) AS e FROM p JOIN g ON fold <> k GROUP BY k, p_brand),
         x AS (SELECT g.k, fold, y, b, coalesce(e, m) AS a FROM p CROSS JOIN g LEFT JOIN c ON c.k = g.k AND c.p_brand = p.p_brand),
         r AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {v}::DOUBLE)" for n, v in _REGULARISATIONS.items())}) t(model, reg)),
         t AS (SELECT k, model, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, stddev_samp(y) AS sy, stddev_samp(a) AS sa, stddev_samp(b) AS sb,
                      corr(a, b) AS ab, corr(a, y) AS ay, corr(b, y) AS byy, any_value(reg) AS reg, count(*) AS n
               FROM x, r WHERE fold <> k GROUP BY k, model),
         d AS (SELECT *, 1 + reg / stddev AS d FROM (SELECT *, sy * sqrt((n - 1) / n) AS stddev FROM t)),
         w AS (SELECT *, (d * ay - ab * byy) / (d * d - ab * ab) * sy / sa AS wa, (d * byy - ab * ay) / (d * d - ab * ab) * sy / sb AS wb FROM d),
         e AS (SELECT x.k, model, y, y - (my + wa * (a - ma) + wb * (b - mb)) AS err FROM x JOIN w ON w.k = x.k WHERE fold = x.k)
    SELECT k AS fold, model, round(sqrt(avg(err * err)), 5) AS rmse, round(1 - avg(err * err) / var_pop(y), 5) AS r2 FROM e GROUP BY k, model
"""


@query("cv_ridge_grid", _CV_RIDGE_SQL)
def cv_ridge_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The ridge estimator over a grid of penalties, on an encoding fitted anew in each round and one plain feature."""
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", F.col("p_size").cast("double").alias("b"), (F.col("p_retailprice") / 100).alias("y"))
    common = {"labelCol": "y", "featuresCol": "features", "maxIter": 100, "tol": 1e-6, "elasticNetParam": 0.0}
    grid = {n: LinearRegression(**common, regParam=v, predictionCol=f"pred_{n}") for n, v in _REGULARISATIONS.items()}

    def fit_and_score(sides: DataFrame) -> DataFrame:
        fitted = E.target_encode_fit(one_side(sides, "train"), "p_brand", "y")
        assembled = VectorAssembler(inputCols=["p_brand_encoded", "b"], outputCol="features").transform(E.encode_apply(sides, fitted, ["p_partkey"]))
        train, scored = one_side(assembled, "train"), one_side(assembled, "test")
        for estimator in grid.values():
            scored = estimator.fit(train).transform(scored)
        return scored

    found = X.cross_validate(X.fold_table(parts, ["p_partkey"], 3), 3, fit_and_score, "y", {n: f"pred_{n}" for n in grid})
    return found.select("fold", "model", rounded("rmse", 5).alias("rmse"), rounded("r2", 5).alias("r2"))


@query("cv_variant_parts")
def cv_variant_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The whole intrinsic variant cross-validated: all feature stages fitted in each of three rounds, two models on each."""
    common = {"labelCol": "avg_vote", "featuresCol": "scaled_features"}
    grid = {
        "ridge": LinearRegression(**common, predictionCol="pred_ridge", maxIter=100, regParam=0.1, elasticNetParam=0.0, tol=1e-6),
        "gbt": GBTRegressor(**common, predictionCol="pred_gbt", maxIter=10, maxDepth=3, stepSize=0.1, subsamplingRate=0.8, seed=42),
    }
    return X.cross_validate_variant(parts_film(spark, sf), INTRINSIC_TARGET, grid, 3, **PARTS_LIMITS)


@query("cv_variant_kfold")
def cv_variant_kfold(spark: SparkSession, sf: str) -> DataFrame:
    """The variant with out-of-fold encodings on documents, with the summary over its folds."""
    ridge = LinearRegression(
        labelCol="avg_vote", featuresCol="scaled_features", predictionCol="pred_ridge", maxIter=100, regParam=0.1, elasticNetParam=0.0, tol=1e-6
    )
    return X.cross_validation_summary(X.cross_validate_variant(documents_film(spark, sf), INTRINSIC_KFOLD, {"ridge": ridge}, 3, **DOCUMENT_LIMITS))


# --- collaboration -----------------------------------------------------------

_GRAPH_SQL = "SELECT l_suppkey AS l, l_partkey AS r, count(*) AS w FROM lineitem WHERE l_suppkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY 1, 2"


@query(
    "collaboration_degrees",
    f"""WITH e AS ({_GRAPH_SQL}) SELECT 'left' AS side, l AS node, count(*) AS degree, CAST(sum(w) AS BIGINT) AS strength FROM e GROUP BY l
        UNION ALL SELECT 'right', r, count(*), CAST(sum(w) AS BIGINT) FROM e GROUP BY r""",
)
def collaboration_degrees(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers and parts in the place of directors and actors."""
    graph = C.edges(table(spark, sf, "lineitem"), "l_suppkey", "l_partkey")
    sides = [C.degrees(graph, side).select(F.lit(side).alias("side"), "*") for side in ("left", "right")]
    return sides[0].unionByName(sides[1])


def _rank_sql(rounds: int, tail: str) -> str:
    steps = []
    for i in range(1, rounds + 1):
        steps.append(
            f"""r{i} AS (SELECT e.r AS node, 0.15 / (SELECT count(*) FROM sr) + 0.85 * sum(v.rank / sl.s * e.w) AS rank
                FROM e JOIN l{i - 1} v ON v.node = e.l JOIN sl ON sl.node = e.l GROUP BY e.r),
            l{i} AS (SELECT e.l AS node, 0.15 / (SELECT count(*) FROM sl) + 0.85 * sum(v.rank / sr.s * e.w) AS rank
                FROM e JOIN r{i} v ON v.node = e.r JOIN sr ON sr.node = e.r GROUP BY e.l)"""
        )
    return f"""
    WITH e AS ({_GRAPH_SQL}), sl AS (SELECT l AS node, sum(w)::DOUBLE AS s, count(*) AS d FROM e GROUP BY l),
         sr AS (SELECT r AS node, sum(w)::DOUBLE AS s, count(*) AS d FROM e GROUP BY r),
         l0 AS (SELECT node, 1.0::DOUBLE / (SELECT count(*) FROM sl) AS rank FROM sl), {", ".join(steps)} {tail}"""


_RANKS = "SELECT 'left' AS side, node, round(rank, 10) AS rank FROM l{n} UNION ALL SELECT 'right', node, round(rank, 10) FROM r{n}"


def _ranks(spark: SparkSession, sf: str, rounds: int, broadcast_bytes: int | None) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey")
    found = C.collaboration_rank(lines, "l_suppkey", "l_partkey", rounds, broadcast_bytes=broadcast_bytes)
    sides = [r.select(F.lit(side).alias("side"), "node", rounded("rank", 10).alias("rank")) for side, r in zip(("left", "right"), found, strict=True)]
    return sides[0].unionByName(sides[1])


@query("collaboration_rank", _rank_sql(C.ROUNDS, _RANKS.format(n=C.ROUNDS)))
def collaboration_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _ranks(spark, sf, C.ROUNDS, None)


@query("collaboration_rank_shuffled", _rank_sql(3, _RANKS.format(n=3)))
def collaboration_rank_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The way of node tables too large to broadcast."""
    return _ranks(spark, sf, 3, 0)


@query(
    "collaboration_features",
    _rank_sql(
        2,
        """SELECT l_orderkey, l_linenumber, sl.d AS l_suppkey_degree, round(l2.rank, 10) AS l_suppkey_rank, sr.d AS l_partkey_degree,
                  round(r2.rank, 10) AS l_partkey_rank, e.w AS pair_count
           FROM lineitem JOIN sl ON sl.node = l_suppkey JOIN l2 ON l2.node = l_suppkey JOIN sr ON sr.node = l_partkey
           JOIN r2 ON r2.node = l_partkey JOIN e ON e.l = l_suppkey AND e.r = l_partkey""",
    ),
)
def collaboration_features(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    found = C.collaboration_features(lines, "l_suppkey", "l_partkey", 2, spread=["l_orderkey", "l_linenumber"]).drop("l_suppkey", "l_partkey")
    return found.withColumns({c: rounded(c, 10) for c in ("l_suppkey_rank", "l_partkey_rank")})
