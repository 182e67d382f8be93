"""Catalog searches in DataFrame and SQL form.

Both forms are built from one ``Criteria``. Results are ordered by score with
the unique key as the last sort key: the order is the same on every run, and
many equal scores still spread over all sort tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmlens.operators.cleaning import year_number
from filmlens.operators.relational import above_sigma
from filmlens.plans.roles import FILM, Roles


@dataclass(frozen=True)
class Criteria:
    """Conditions that must all hold; ``genres`` asks for any of its entries.

    Texts are matched as substrings, with case.
    """

    first_year: int | None = None
    last_year: int | None = None
    min_score: float | None = None
    genres: Sequence[str] = field(default_factory=tuple)
    title_prefix: str | None = None
    title_contains: str | None = None
    person: str | None = None
    language: str | None = None
    country: str | None = None


def _year_columns(df: DataFrame, c: Criteria, roles: Roles) -> list[Column]:
    conditions = []
    if roles.date is not None:
        kind = df.schema[roles.date].dataType
        if c.first_year is not None:
            conditions.append(F.col(roles.date) >= F.lit(f"{c.first_year:04d}-01-01").cast(kind))
        if c.last_year is not None:
            conditions.append(F.col(roles.date) < F.lit(f"{c.last_year + 1:04d}-01-01").cast(kind))
        return conditions
    year = year_number(df, roles.year)
    if c.first_year is not None:
        conditions.append(year >= c.first_year)
    if c.last_year is not None:
        conditions.append(year <= c.last_year)
    return conditions


def matches(df: DataFrame, c: Criteria, roles: Roles = FILM) -> DataFrame:
    """The rows of ``df`` that meet the criteria."""
    conditions = _year_columns(df, c, roles)
    if c.min_score is not None:
        conditions.append(F.col(roles.score) >= c.min_score)
    if c.genres:
        any_genre = F.lit(False)
        for genre in c.genres:
            any_genre = any_genre | F.col(roles.genre).contains(genre)
        conditions.append(any_genre)
    if c.title_prefix is not None:
        conditions.append(F.col(roles.title).startswith(c.title_prefix))
    for column, text in (
        (roles.original_title, c.title_contains),
        (roles.person, c.person),
        (roles.language, c.language),
        (roles.country, c.country),
    ):
        if text is not None:
            conditions.append(F.col(column).contains(text))
    for condition in conditions:
        df = df.filter(condition)
    return df


def _quoted(column: str) -> str:
    return f"`{column}`"


def _like(text: str) -> str:
    """LIKE treats three characters specially; they are escaped here."""
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def where_clause(df: DataFrame, c: Criteria, roles: Roles = FILM) -> tuple[str, dict[str, object]]:
    """SQL condition with named parameters, and the parameter values."""
    parts: list[str] = []
    args: dict[str, object] = {}
    if roles.date is not None:
        kind = df.schema[roles.date].dataType.simpleString()
        if c.first_year is not None:
            parts.append(f"{_quoted(roles.date)} >= CAST(:first_day AS {kind})")
            args["first_day"] = f"{c.first_year:04d}-01-01"
        if c.last_year is not None:
            parts.append(f"{_quoted(roles.date)} < CAST(:end_day AS {kind})")
            args["end_day"] = f"{c.last_year + 1:04d}-01-01"
    else:
        year = _quoted(roles.year)
        if (c.first_year, c.last_year) != (None, None) and isinstance(df.schema[roles.year].dataType, T.StringType):
            year = f"TRY_CAST({year} AS INT)"
        if c.first_year is not None:
            parts.append(f"{year} >= :first_year")
            args["first_year"] = c.first_year
        if c.last_year is not None:
            parts.append(f"{year} <= :last_year")
            args["last_year"] = c.last_year
    if c.min_score is not None:
        parts.append(f"{_quoted(roles.score)} >= :min_score")
        args["min_score"] = float(c.min_score)
    if c.genres:
        parts.append("(" + " OR ".join(f"{_quoted(roles.genre)} LIKE :genre_{i}" for i in range(len(c.genres))) + ")")
        args.update({f"genre_{i}": f"%{_like(genre)}%" for i, genre in enumerate(c.genres)})
    if c.title_prefix is not None:
        parts.append(f"{_quoted(roles.title)} LIKE :title_prefix")
        args["title_prefix"] = f"{_like(c.title_prefix)}%"
    for name, column, text in (
        ("title_contains", roles.original_title, c.title_contains),
        ("person", roles.person, c.person),
        ("language", roles.language, c.language),
        ("country", roles.country, c.country),
    ):
        if text is not None:
            parts.append(f"{_quoted(column)} LIKE :{name}")
            args[name] = f"%{_like(text)}%"
    return " AND ".join(parts) or "TRUE", args


def search(df: DataFrame, c: Criteria, columns: Sequence[str], order: Sequence[str] = (), roles: Roles = FILM) -> DataFrame:
    """DataFrame form: filter, order by ``order`` descending, project."""
    found = matches(df, c, roles)
    if order:
        found = found.orderBy(*[F.desc(o) for o in order], F.asc(roles.key))
    return found.select(*columns)


def search_sql(spark: SparkSession, df: DataFrame, c: Criteria, columns: Sequence[str], order: Sequence[str] = (), roles: Roles = FILM) -> DataFrame:
    """SQL form of :func:`search` over the same frame."""
    where, args = where_clause(df, c, roles)
    picked = ", ".join(_quoted(column) for column in columns)
    text = f"SELECT {picked} FROM {{catalog}} WHERE {where}"
    if order:
        text += " ORDER BY " + ", ".join(f"{_quoted(o)} DESC" for o in order) + f", {_quoted(roles.key)}"
    return spark.sql(text, args=args, catalog=df)


@dataclass(frozen=True)
class NamedQuery:
    """A search with its projection and order, runnable in both forms."""

    criteria: Criteria
    columns: tuple[str, ...]
    order: tuple[str, ...]
    roles: Roles

    def dataframe(self, df: DataFrame) -> DataFrame:
        return search(df, self.criteria, self.columns, self.order, self.roles)

    def sql(self, spark: SparkSession, df: DataFrame) -> DataFrame:
        return search_sql(spark, df, self.criteria, self.columns, self.order, self.roles)


def _by_score(criteria: Criteria, roles: Roles) -> NamedQuery:
    return NamedQuery(criteria, (roles.title, roles.year, roles.score), (roles.score,), roles)


def by_year_range(first: int = 2015, last: int = 2020, roles: Roles = FILM) -> NamedQuery:
    """Titles of a year range."""
    return _by_score(Criteria(first_year=first, last_year=last), roles)


def by_min_score(score: float = 8.5, roles: Roles = FILM) -> NamedQuery:
    """Titles with at least this score, by score and votes."""
    columns = (roles.title, roles.year, roles.score, roles.votes)
    return NamedQuery(Criteria(min_score=score), columns, (roles.score, roles.votes), roles)


def by_genre(*genres: str, roles: Roles = FILM) -> NamedQuery:
    """Titles whose genre text contains any of the given ones."""
    return _by_score(Criteria(genres=genres or ("Drama",)), roles)


def by_two_genres(first: str = "Horror", second: str = "Thriller", roles: Roles = FILM) -> NamedQuery:
    """Titles of either genre."""
    return by_genre(first, second, roles=roles)


def by_title_prefix(prefix: str = "The Dark", roles: Roles = FILM) -> NamedQuery:
    """Titles that start with the prefix."""
    return _by_score(Criteria(title_prefix=prefix), roles)


def by_year_genre_score(first: int = 2010, last: int = 2020, genre: str = "Action", score: float = 7.5, roles: Roles = FILM) -> NamedQuery:
    """Titles of a year range and genre with at least this score."""
    return _by_score(Criteria(first_year=first, last_year=last, genres=(genre,), min_score=score), roles)


def by_person(
    person: str = "Leonardo DiCaprio",
    first: int | None = None,
    last: int | None = None,
    genre: str | None = None,
    roles: Roles = FILM,
) -> NamedQuery:
    """Titles with a person, optionally within a year range and of a genre."""
    criteria = Criteria(person=person, first_year=first, last_year=last, genres=(genre,) if genre else ())
    return _by_score(criteria, roles)


def by_genre_years_language_country(
    genre: str = "Horror",
    first: int = 1987,
    last: int = 2020,
    language: str = "English",
    country: str = "USA",
    roles: Roles = FILM,
) -> NamedQuery:
    """Titles of a genre, year range, language and country."""
    criteria = Criteria(genres=(genre,), first_year=first, last_year=last, language=language, country=country)
    return NamedQuery(criteria, (roles.original_title, roles.score), (roles.score,), roles)


def title_lookup(text: str = "Misery", roles: Roles = FILM) -> NamedQuery:
    """Genre and score of the titles that contain the text."""
    return NamedQuery(Criteria(title_contains=text), (roles.original_title, roles.genre, roles.score), (), roles)


def any_genre_filters(
    genres: Sequence[str] = ("Adventure", "Comedy", "Family"),
    first: int = 1985,
    last: int = 1990,
    score: float = 7.8,
    country: str = "USA",
    roles: Roles = FILM,
) -> NamedQuery:
    """Titles of any given genre within years, score and country; unordered."""
    criteria = Criteria(genres=tuple(genres), first_year=first, last_year=last, min_score=score, country=country)
    return NamedQuery(criteria, (roles.original_title, roles.genre, roles.score), (), roles)


def global_mean(df: DataFrame, column: str, out: str) -> DataFrame:
    """Mean of a column over all rows."""
    return df.agg(F.avg(column).alias(out))


def global_stddev(df: DataFrame, column: str, out: str) -> DataFrame:
    """Sample standard deviation of a column over all rows."""
    return df.agg(F.stddev(column).alias(out))


def outliers(df: DataFrame, column: str, columns: Sequence[str], key: str, sigmas: float = 3.0) -> DataFrame:
    """Rows more than ``sigmas`` deviations above the mean, highest first."""
    return above_sigma(df, column, sigmas).orderBy(F.desc(column), F.asc(key)).select(*columns)


def outliers_sql(spark: SparkSession, df: DataFrame, column: str, columns: Sequence[str], key: str, sigmas: float = 3.0) -> DataFrame:
    """SQL form of :func:`outliers`."""
    picked = ", ".join(_quoted(c) for c in columns)
    c = _quoted(column)
    text = f"""
        SELECT {picked} FROM {{catalog}}
        WHERE {c} > (SELECT AVG({c}) + :sigmas * STDDEV({c}) FROM {{catalog}})
        ORDER BY {c} DESC, {_quoted(key)}
    """
    return spark.sql(text, args={"sigmas": float(sigmas)}, catalog=df)
