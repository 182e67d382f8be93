"""The model variants: what is required, how categories are encoded, what is assembled."""

from __future__ import annotations

from dataclasses import dataclass

INTRINSIC_REQUIRED = ("description", "genre", "director", "actors", "duration", "avg_vote", "year_clean")
POPULARITY_REQUIRED = ("votes", "reviews_from_users", "reviews_from_critics")


@dataclass(frozen=True)
class Variant:
    """Columns and steps of one model variant; the column names are those of the film files.

    ``numeric`` lists the assembled inputs that follow the text and genre
    vectors, in order.
    """

    name: str
    encoder: str
    required: tuple[str, ...]
    numeric: tuple[str, ...]
    ensemble: bool = True
    popularity: bool = False
    target: str = "avg_vote"
    categories: tuple[str, ...] = ("director", "actors")
    genre: str = "genre"
    text: str = "description"
    key: str = "title_id"
    indexed: str = "duration_category"
    text_width: int = 100
    genre_width: int = 16
    top_genres: int = 30
    smoothing: float = 10.0
    folds: int = 5

    @property
    def width(self) -> int:
        """Length of the assembled vector."""
        return self.text_width + self.genre_width + len(self.numeric)


_YEAR_INPUTS = ("year_clean", "decade")
_FLAGS = ("is_recent", "is_old_classic")

WITH_POPULARITY = Variant(
    name="with_popularity",
    encoder="target",
    required=INTRINSIC_REQUIRED + POPULARITY_REQUIRED,
    numeric=(
        "director_encoded",
        "actors_encoded",
        "duration",
        "duration_indexed",
        "votes",
        "log_votes",
        "reviews_from_users",
        "reviews_from_critics",
        *_YEAR_INPUTS,
        "votes_per_review",
        "review_ratio",
        *_FLAGS,
    ),
    popularity=True,
)

INTRINSIC_TARGET = Variant(
    name="intrinsic_target",
    encoder="target",
    required=INTRINSIC_REQUIRED,
    numeric=("director_encoded", "actors_encoded", "duration", "duration_indexed", *_YEAR_INPUTS, *_FLAGS),
)

INTRINSIC_FREQUENCY = Variant(
    name="intrinsic_frequency",
    encoder="frequency",
    required=INTRINSIC_REQUIRED,
    numeric=("director_freq", "actors_freq", "duration", "duration_indexed", *_YEAR_INPUTS, *_FLAGS),
    ensemble=False,
)

INTRINSIC_KFOLD = Variant(
    name="intrinsic_kfold",
    encoder="kfold",
    required=INTRINSIC_REQUIRED,
    numeric=INTRINSIC_TARGET.numeric,
)

VARIANTS = {v.name: v for v in (WITH_POPULARITY, INTRINSIC_TARGET, INTRINSIC_FREQUENCY, INTRINSIC_KFOLD)}
