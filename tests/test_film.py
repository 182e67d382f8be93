"""The whole jobs on film-shaped rows."""

import pytest

from filmlens.plans import film
from filmlens.plans.models import train_variant
from filmlens.plans.variants import INTRINSIC_FREQUENCY
from filmlens.sources.csv_files import movie_schema, rating_schema


@pytest.fixture(scope="module")
def files(spark):
    movies, ratings = [], []
    for i in range(300):
        row = dict.fromkeys(movie_schema().names)
        row.update(
            title_id=f"t{i:03d}", title=f"Film {i}", original_title=f"Film {i}", genre="Drama" if i % 3 else "",
            year="TV Movie 2019" if i % 50 == 0 else str(1990 + i % 30), duration=60 + i % 90, country="USA", language="English",
            director=f"d{i % 9}", writer="w", production_company="p", actors=f"a{i % 20}", description=f"story of {i % 17} cats",
            avg_vote=3.0 + (i % 60) / 10, votes=100 + (i % 60) * 20, reviews_from_users=float(i % 60), reviews_from_critics=float(i % 7),
        )
        movies.append(tuple(row.values()))
        if i % 10:
            rated = dict.fromkeys(rating_schema().names)
            rated.update(title_id=f"t{i:03d}", weighted_average_vote=5.0, total_votes=i, mean_vote=5.0, median_vote=5.0)
            ratings.append(tuple(rated.values()))
    return spark.createDataFrame(movies, movie_schema()), spark.createDataFrame(ratings, rating_schema())


def test_exploration(files):
    found = film.exploration(*files)
    assert {k: v.first().n_columns for k, v in found.items() if k.endswith("dimensions")} == {
        "movies_dimensions": 22, "ratings_dimensions": 49, "joined_dimensions": 70,
    }
    nulls = {r.column: r.n_null for r in found["joined_nulls"].collect()}
    assert nulls["genre"] == 100 and nulls["total_votes"] == 30 and nulls["budget"] == 300
    assert found["joined_columns"].count() == 70
    assert found["join_loss"].first().rows_lost == 0
    assert found["completeness"].first().n_complete == 0
    assert found["movies_year"].first()["max"] == "TV Movie 2019"
    assert {r.column: r.n_distinct for r in found["distinct"].collect()} == {"title_id": 300, "year": 31, "country": 1, "language": 1}
    assert found["top_years"].count() == 10


def test_validation(files):
    found = film.validation(files[0].join(files[1], "title_id", "left"))
    usable = [i for i in range(300) if i % 3 and i % 50]
    assert found["bad_years"].first().n_failed == 6
    assert found["retention"].first().rows_after == len(usable)
    assert (found["sufficiency"].first().verdict, found["sufficiency"].first().rows_usable) == ("insufficient", len(usable))
    assert found["label_stats"].first().n == len(usable)
    assert sum(r["count"] for r in found["label_histogram"].collect()) == len(usable)
    assert found["nulls"].count() == 12 and found["sample"].count() == 5


def test_diagnosis(files):
    found = film.diagnosis(files[0].join(files[1], "title_id", "inner"))
    assert found["verdict"].first().flagged == "reviews_from_users,votes"
    assert found["correlations"].first().band == "strong"
    assert sum(r["count"] for r in found["votes_by_rating"].collect()) == files[1].count()
    assert found["reviews_by_rating"].count() == 5
    # Ratings exist for every film but each tenth, which leaves 18 of the 20 actor lists.
    assert found["actors_encoding"].first().n_categories == 18


def test_model_on_the_joined_files(files):
    joined = files[0].join(files[1], "title_id", "inner")
    trained = train_variant(joined, INTRINSIC_FREQUENCY, ["ridge"])
    assert trained.scored.filter("pred_ridge is null").count() == 0
    assert trained.tables.train.count() + trained.tables.test.count() == files[1].count()


def test_skewed_join_is_split(spark):
    """A key with a third of the rows is split by adaptive execution where both sides are too large to broadcast."""
    from pyspark.sql import functions as F

    from filmlens.sources.catalog import catalog

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
        movies = spark.range(0, 60000, 1, 8).select("id", key.alias("k"), F.md5(F.col("id").cast("string")).alias("t"))
        ratings = spark.range(1000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("r"))
        joined = catalog(movies, ratings, "k", ["id", "r"])
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
