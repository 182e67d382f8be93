"""Derived predictors that read only their own row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decade(year: str) -> Column:
    """First year of the decade."""
    return (F.col(year) / 10).cast("int") * 10


def flag(condition: Column) -> Column:
    """1.0 where the condition holds, else 0.0 (also for null)."""
    return F.when(condition, 1.0).otherwise(0.0)


def duration_category(duration: str, short: float = 90, medium: float = 120) -> Column:
    """``short``, ``medium`` or ``long``; a null duration counts as long."""
    return F.when(F.col(duration) <= short, "short").when(F.col(duration) <= medium, "medium").otherwise("long")


def derive_temporal(
    df: DataFrame,
    year: str = "year_clean",
    duration: str = "duration",
    recent_from: int = 2015,
    classic_to: int = 1980,
    short: float = 90,
    medium: float = 120,
) -> DataFrame:
    """Decade, recent and classic flags, duration category."""
    return df.withColumns(
        {
            "decade": decade(year),
            "is_recent": flag(F.col(year) >= recent_from),
            "is_old_classic": flag(F.col(year) <= classic_to),
            "duration_category": duration_category(duration, short, medium),
        }
    )


def derive_popularity(df: DataFrame, votes: str = "votes", users: str = "reviews_from_users", critics: str = "reviews_from_critics") -> DataFrame:
    """Votes per review, user-to-critic ratio and log votes."""
    return df.withColumns(
        {
            "votes_per_review": F.col(votes) / (F.col(users) + F.col(critics) + 1),
            "review_ratio": F.col(users) / (F.col(critics) + 1),
            "log_votes": F.log1p(votes),
        }
    )
