"""Diagnostics that look for the target among the predictors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filmlens.operators import leakage as L
from filmlens.operators.cleaning import clean_year, require
from filmlens.plans import film
from filmlens.registry.core import query
from filmlens.registry.tables import PARTS_FILM_SQL, parts_film, rounded, table

_COLUMNS = ["votes", "reviews_from_users", "reviews_from_critics", "duration", "year_clean"]
_CORR_SQL = f"""
    WITH t AS (SELECT *, CAST(regexp_replace("year", '[^0-9]', '', 'g') AS DOUBLE) AS year_clean FROM ({PARTS_FILM_SQL})
               WHERE total_votes IS NOT NULL),
         corrs AS (""" + " UNION ALL ".join(f"""SELECT '{c}' AS "column", corr(total_votes, {c}) AS corr FROM t""" for c in _COLUMNS) + ")"
_FLAG_SQL = """abs(corr) > 0.5 AND ("column" LIKE '%vote%' OR "column" LIKE '%review%')"""


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    parsed = clean_year(parts_film(spark, sf), dtype="double")
    return require(parsed, ["total_votes", *_COLUMNS])


@query(
    "target_correlations",
    f"""{_CORR_SQL} SELECT "column", round(corr, 6) AS corr,
        CASE WHEN abs(corr) > 0.7 THEN 'strong' WHEN abs(corr) > 0.5 THEN 'moderate' WHEN abs(corr) > 0.3 THEN 'suspicious'
             ELSE 'acceptable' END AS band FROM corrs""",
)
def target_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return L.target_correlations(_cleaned(spark, sf), "total_votes", _COLUMNS).withColumn("corr", rounded("corr"))


@query(
    "leakage_ranking",
    f"""{_CORR_SQL} SELECT "column", round(abs(corr), 6) AS importance, CASE WHEN {_FLAG_SQL} THEN 'LEAKAGE' ELSE 'OK' END AS status FROM corrs""",
)
def leakage_ranking(spark: SparkSession, sf: str) -> DataFrame:
    found = L.leakage_ranking(L.correlations(_cleaned(spark, sf), "total_votes", _COLUMNS))
    return found.withColumn("importance", rounded("importance"))


@query(
    "leakage_verdict",
    f"""{_CORR_SQL} SELECT count(*) AS n_flagged, coalesce(string_agg("column", ',' ORDER BY "column"), '') AS flagged,
        CASE WHEN count(*) > 0 THEN 'detected' ELSE 'not detected' END AS verdict FROM corrs WHERE {_FLAG_SQL}""",
)
def leakage_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return L.leakage_verdict(L.correlations(_cleaned(spark, sf), "total_votes", _COLUMNS))


@query(
    "encoding_target_corr",
    """WITH m AS (SELECT o_totalprice, avg(o_totalprice) OVER (PARTITION BY o_custkey) AS a FROM orders),
            c AS (SELECT corr(o_totalprice, a) AS r, count(*) AS n FROM m)
       SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS n_categories, n AS n_rows, round(r, 6) AS corr,
              CASE WHEN r > 0.9 THEN 'leakage' WHEN r > 0.7 THEN 'moderate' ELSE 'acceptable' END AS band FROM c""",
)
def encoding_target_corr(spark: SparkSession, sf: str) -> DataFrame:
    return L.encoding_target_corr(table(spark, sf, "orders"), "o_custkey", "o_totalprice").withColumn("corr", rounded("corr"))


_DIAGNOSIS_SQL = _CORR_SQL.replace("total_votes IS NOT NULL", "avg_vote IS NOT NULL").replace("corr(total_votes,", "corr(avg_vote,")


@query(
    "film_diagnosis_correlations",
    f"""{_DIAGNOSIS_SQL} SELECT "column", round(corr, 6) AS corr,
        CASE WHEN abs(corr) > 0.7 THEN 'strong' WHEN abs(corr) > 0.5 THEN 'moderate' WHEN abs(corr) > 0.3 THEN 'suspicious'
             ELSE 'acceptable' END AS band FROM corrs""",
)
def film_diagnosis_correlations(spark: SparkSession, sf: str) -> DataFrame:
    """From the whole diagnosis job."""
    return film.diagnosis(parts_film(spark, sf))["correlations"].withColumn("corr", rounded("corr"))


@query(
    "film_diagnosis_verdict",
    f"""{_DIAGNOSIS_SQL} SELECT count(*) AS n_flagged, coalesce(string_agg("column", ',' ORDER BY "column"), '') AS flagged,
        CASE WHEN count(*) > 0 THEN 'detected' ELSE 'not detected' END AS verdict FROM corrs WHERE {_FLAG_SQL}""",
)
def film_diagnosis_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """From the whole diagnosis job."""
    return film.diagnosis(parts_film(spark, sf))["verdict"]
