"""Which column plays which part in a catalog."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Column names of a catalog; the defaults are those of the film files.

    ``date`` names a date or timestamp column that ``year`` is taken from, if
    there is one: year ranges are then asked of the date, a predicate that
    reaches the file scan.
    """

    key: str = "title_id"
    title: str = "title"
    original_title: str = "original_title"
    year: str = "year"
    date: str | None = None
    score: str = "avg_vote"
    votes: str = "votes"
    genre: str = "genre"
    person: str = "actors"
    language: str = "language"
    country: str = "country"


FILM = Roles()
