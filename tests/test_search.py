"""Catalog searches on film-shaped rows, in both forms."""

import pytest
from pyspark.sql import functions as F

from filmlens.plans import catalog_queries as Q
from filmlens.plans.results import run, summary
from filmlens.sources.catalog import catalog, register_catalog

FILMS = [
    ("t1", "The Dark Hour", "The Dark Hour", "2012", "Action, Drama", "Ann Poe, Tom Hanks", "English", "USA", 8.6, 100),
    ("t2", "The Darkest", "Misery Road", "TV Movie 2019", "Horror", "Bob Ray", "English, French", "USA, France", 8.6, 300),
    ("t3", "Light", "Misery", "2015", "Melodrama", "Tom Hanks", "French", "France", 7.5, 50),
    ("t4", "Dark 100%", "Dark_100%", "1987", "Thriller, Horror", None, "English", "USA", 7.9, 20),
    ("t5", "the dark", "Goonies", "1985", "Adventure, Family", "Leonardo DiCaprio", "English", "USA", 7.8, 10),
    ("t6", "Blank", "Blank", None, None, "", "None", "USA", None, None),
]
COLUMNS = "title_id title original_title year genre actors language country avg_vote votes".split()


@pytest.fixture(scope="module")
def films(spark):
    return spark.createDataFrame(FILMS, ", ".join(f"{c} string" for c in COLUMNS[:8]) + ", avg_vote double, votes int")


CASES = {
    "year range skips text years": (Q.by_year_range(2010, 2020), ["The Dark Hour", "Light"]),
    "min score then votes": (Q.by_min_score(8.5), ["The Darkest", "The Dark Hour"]),
    "genre is a substring with case": (Q.by_genre("drama"), ["Light"]),
    "genre": (Q.by_genre("Drama"), ["The Dark Hour"]),
    "either genre": (Q.by_two_genres(), ["The Darkest", "Dark 100%"]),
    "prefix with case": (Q.by_title_prefix(), ["The Dark Hour", "The Darkest"]),
    "prefix with a wildcard character": (Q.by_title_prefix("Dark 100%"), ["Dark 100%"]),
    "year, genre, score": (Q.by_year_genre_score(), ["The Dark Hour"]),
    "person": (Q.by_person("Tom Hanks"), ["The Dark Hour", "Light"]),
    "person and years": (Q.by_person("Tom Hanks", 2013, 2020), ["Light"]),
    "person, years, genre": (Q.by_person("Tom Hanks", 2010, 2020, "Action"), ["The Dark Hour"]),
    "four conditions": (Q.by_genre_years_language_country(), ["Dark_100%"]),
    "lookup": (Q.title_lookup(), ["Misery Road", "Misery"]),
    "lookup escapes underscore": (Q.title_lookup("k_1"), ["Dark_100%"]),
    "any of three": (Q.any_genre_filters(), ["Goonies"]),
}


@pytest.mark.parametrize("case", CASES)
def test_both_forms_agree(spark, films, case):
    named, expected = CASES[case]
    frame = [tuple(r) for r in named.dataframe(films).collect()]
    text = [tuple(r) for r in named.sql(spark, films).collect()]
    assert frame == text
    titles = [r[0] for r in frame]
    assert titles == expected if named.order else sorted(titles) == sorted(expected)


def test_equal_scores_keep_key_order(films):
    assert [r.title for r in Q.by_genre("Action", "Horror").dataframe(films).collect()][:2] == ["The Dark Hour", "The Darkest"]


def test_outliers_both_forms(spark):
    rows = [(i, 1.0 + i % 2) for i in range(50)] + [(99, 100.0)]
    df = spark.createDataFrame(rows, "id int, v double")
    assert [r.id for r in Q.outliers(df, "v", ["id"], "id").collect()] == [99]
    assert [r.id for r in Q.outliers_sql(spark, df, "v", ["id"], "id").collect()] == [99]


def test_year_range_on_a_date_reaches_the_scan(spark):
    from filmlens.registry.tables import ORDERS, orders

    found = Q.by_year_range(1996, 1998, ORDERS).dataframe(orders(spark, "/root/testdata/sf0.001"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = found._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in plan and "LessThan(o_orderdate,1999-01-01" in plan
    assert "o_orderpriority" not in plan.split("ReadSchema")[1]


def test_join_is_left_out_when_no_rating_column_is_asked(spark):
    movies = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    ratings = spark.createDataFrame([("a", 5.0)], "k string, r double")
    assert "Join" not in catalog(movies, ratings, "k", ["k", "x"])._jdf.queryExecution().toString()
    assert {tuple(r) for r in catalog(movies, ratings, "k", ["x", "r"]).collect()} == {(1, 5.0), (2, None)}
    assert catalog(movies, ratings, "k").columns == ["k", "x", "r"]


def test_views(spark):
    movies = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    ratings = spark.createDataFrame([("a", 5.0)], "k string, r double")
    register_catalog(spark, movies, ratings, "k", "m_view", "r_view", "full_view")
    assert {tuple(r) for r in spark.sql("SELECT x, r FROM full_view").collect()} == {(1, 5.0), (2, None)}
    assert spark.table("m_view").count() == 2 and spark.table("r_view").count() == 1


def test_result_counts_and_previews_in_one_run(films):
    result = run(films, [F.desc("votes"), F.asc("title_id")], 2)
    assert result.total == 6 and [r.title_id for r in result.preview] == ["t2", "t1"]
    empty = run(films.filter("votes > 1000"), [F.asc("title_id")])
    assert empty.total == 0 and empty.message == "no results"
    assert {r.total for r in summary(films, [F.asc("title_id")], 3).collect()} == {6}
