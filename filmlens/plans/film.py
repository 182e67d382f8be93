"""The whole jobs on the film files: exploration, validation, diagnosis.

Each returns its results as named DataFrames. What several of them read (the
join, the cleaned columns) is written once to the staging folder first.
Predictions come from ``plans.models.train_variant`` on the joined files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlens.functions.bands import rating_bin
from filmlens.operators import cleaning as C
from filmlens.operators import leakage as L
from filmlens.operators import profiling as P
from filmlens.operators.relational import all_present, is_blank, join_loss
from filmlens.sources.staging import materialize

# The columns each job looks at.
MODEL_COLUMNS = (
    "title", "year", "genre", "duration", "director", "writer", "production_company",
    "actors", "description", "votes", "reviews_from_users", "reviews_from_critics",
)
CRITICAL_COLUMNS = (
    "label", "genre", "director", "actors", "description", "duration",
    "votes", "reviews_from_users", "reviews_from_critics", "year_clean",
)
CRITICAL_TEXTS = ("genre", "director", "actors", "description")
SUSPECT_COLUMNS = ("votes", "reviews_from_users", "reviews_from_critics", "duration", "year_clean")


def exploration(movies: DataFrame, ratings: DataFrame, key: str = "title_id") -> dict[str, DataFrame]:
    """Sizes, columns, nulls, statistics, distinct values, top years and completeness.

    The files are parsed once and kept as Parquet; sizes, columns and nulls of
    a frame come from one aggregate.
    """
    movies, ratings = materialize(movies, "movies"), materialize(ratings, "ratings")
    full = materialize(movies.join(ratings, key, "left"), "joined")
    found = {}
    for name, df in (("movies", movies), ("ratings", ratings), ("joined", full)):
        found |= {f"{name}_{what}": part for what, part in P.frame_profile(df).items()}
    found["movies_year"] = P.describe_text(movies, ["year"])
    found["movies_stats"] = P.describe_typed(movies, ["duration"])
    found["ratings_stats"] = P.describe_typed(ratings, ["weighted_average_vote", "total_votes", "mean_vote", "median_vote"])
    found["joined_stats"] = P.describe_typed(full, ["duration", "avg_vote", "votes", "weighted_average_vote", "total_votes"])
    found["join_loss"] = join_loss(movies, ratings, key, "left")
    found["distinct"] = P.distinct_counts(full, [key, "year", "country", "language"])
    found["top_years"] = P.top_groups(full, "year", 10)
    found["completeness"] = P.completeness(full)
    return found


def validation(full: DataFrame, key: str = "title_id") -> dict[str, DataFrame]:
    """Whether the joined files can train a model, and what cleaning costs."""
    selected = materialize(full.select(key, *MODEL_COLUMNS, F.col("avg_vote").alias("label")), "selected")
    parsed = C.clean_year(selected, mode="strict").drop("year")
    keep = all_present(parsed, CRITICAL_COLUMNS)
    for column in CRITICAL_TEXTS:
        keep = keep & ~is_blank(parsed, column)
    clean = C.clean_validation(selected, CRITICAL_COLUMNS, CRITICAL_TEXTS)
    return {
        "nulls": P.null_profile(selected, ["label", *[c for c in MODEL_COLUMNS if c != "title"]]),
        "bad_years": parsed.agg(F.count_if(F.col("year_clean").isNull()).alias("n_failed")),
        "retention": C.retention(parsed, keep),
        "sufficiency": C.data_sufficiency(parsed, keep),
        "label_stats": P.describe_typed(clean, ["label"]),
        "label_histogram": P.histogram(clean, "label"),
        "sample": clean.select(key, "title", "year_clean", "genre", "label", "votes").orderBy(key).limit(5),
    }


def diagnosis(joined: DataFrame, target: str = "avg_vote") -> dict[str, DataFrame]:
    """Where the target shows among the predictors."""
    cleaned = C.require(C.clean_year(joined, dtype="double"), [target, *SUSPECT_COLUMNS])
    df = materialize(cleaned.select(target, *SUSPECT_COLUMNS), "diagnosis")
    corrs = materialize(L.target_correlations(df, target, SUSPECT_COLUMNS), "correlations")
    binned = df.withColumn("rating_bin", rating_bin(F.col(target)))
    reviews = {"avg_user_reviews": "reviews_from_users", "avg_critic_reviews": "reviews_from_critics"}
    return {
        "correlations": corrs.orderBy(F.desc("corr"), "column"),
        "votes_by_rating": P.binned_means(binned, "rating_bin", {"avg_votes": "votes"}, "avg_votes"),
        "reviews_by_rating": P.binned_means(binned, "rating_bin", reviews, "avg_user_reviews"),
        "ranking": L.leakage_ranking(corrs),
        "verdict": L.leakage_verdict(corrs),
        "actors_encoding": L.encoding_target_corr(joined, "actors", target),
    }
