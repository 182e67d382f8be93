"""The catalog: a movies frame left-joined to its 1:1 ratings frame."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def catalog(movies: DataFrame, ratings: DataFrame, key: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Movies left join ratings on ``key``.

    ``ratings`` holds at most one row per key, so when ``columns`` are all
    movie columns the join cannot change the result and is left out; otherwise
    only the requested rating columns travel through the join.
    """
    if columns is None:
        return movies.join(ratings, key, "left")
    columns = list(columns)
    from_ratings = [c for c in columns if c not in movies.columns]
    if not from_ratings:
        return movies.select(*columns)
    return movies.join(ratings.select(key, *from_ratings), key, "left").select(*columns)


def full_catalog_sql(movies_view: str, ratings_view: str, key: str, rating_columns: Iterable[str]) -> str:
    """SQL text of the full catalog view: all movie columns and the named rating columns."""
    picked = ", ".join(f"r.`{c}`" for c in rating_columns)
    return f"SELECT m.*, {picked} FROM {movies_view} m LEFT JOIN {ratings_view} r ON m.`{key}` = r.`{key}`"


def register_catalog(
    spark: SparkSession,
    movies: DataFrame,
    ratings: DataFrame,
    key: str,
    movies_view: str = "movies",
    ratings_view: str = "ratings",
    full_view: str = "full_movies",
) -> DataFrame:
    """Register both frames and the full catalog as temporary views."""
    movies.createOrReplaceTempView(movies_view)
    ratings.createOrReplaceTempView(ratings_view)
    full = spark.sql(full_catalog_sql(movies_view, ratings_view, key, [c for c in ratings.columns if c != key]))
    full.createOrReplaceTempView(full_view)
    return full


def full_movies(spark: SparkSession, movies_path: str, ratings_path: str, key: str = "title_id", how: str = "left", multi_line: bool = False) -> DataFrame:
    """Read both film files and join them on ``key``."""
    from filmlens.sources.csv_files import read_movies, read_ratings

    return read_movies(spark, movies_path, key, multi_line).join(read_ratings(spark, ratings_path, key), key, how)
