"""CSV readers and the film file schemas.

A schema given up front saves the extra pass that inference costs; inference
stays available for files whose columns are not known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column names and types of the film file, in file order.
_MOVIE_COLUMNS = [
    ("title", "string"),
    ("original_title", "string"),
    ("year", "string"),
    ("date_published", "string"),
    ("genre", "string"),
    ("duration", "int"),
    ("country", "string"),
    ("language", "string"),
    ("director", "string"),
    ("writer", "string"),
    ("production_company", "string"),
    ("actors", "string"),
    ("description", "string"),
    ("avg_vote", "double"),
    ("votes", "int"),
    ("budget", "string"),
    ("usa_gross_income", "string"),
    ("worlwide_gross_income", "string"),
    ("metascore", "double"),
    ("reviews_from_users", "double"),
    ("reviews_from_critics", "double"),
]


def _rating_columns() -> list[tuple[str, str]]:
    """The rating file's columns after the key, in file order."""
    columns = [("weighted_average_vote", "double"), ("total_votes", "int"), ("mean_vote", "double"), ("median_vote", "double")]
    columns += [(f"votes_{score}", "int") for score in range(10, 0, -1)]
    ages = ["0age", "18age", "30age", "45age"]
    for group, bands in (("allgenders", ages), ("males", ["allages", *ages]), ("females", ["allages", *ages])):
        for band in bands:
            columns += [(f"{group}_{band}_avg_vote", "double"), (f"{group}_{band}_votes", "double")]
    for voters in ("top1000_voters", "us_voters", "non_us_voters"):
        columns += [(f"{voters}_rating", "double"), (f"{voters}_votes", "double")]
    return columns


def _schema(id_column: str, columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in [(id_column, "string"), *columns]))


def movie_schema(id_column: str = "title_id") -> T.StructType:
    """22 columns of the film file; the key column takes the given name."""
    return _schema(id_column, _MOVIE_COLUMNS)


def rating_schema(id_column: str = "title_id") -> T.StructType:
    """49 columns of the rating file; the key column takes the given name."""
    return _schema(id_column, _rating_columns())


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    quote_escape: bool = True,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """Read CSV with a header row.

    ``quote_escape`` reads a doubled quote inside a quoted field as one quote.
    ``multi_line`` accepts line breaks inside quoted fields; such a file
    cannot be split, so large data should come as many files of bounded size
    (see ``sinks.write_csv``) and be stored as Parquet after the first read.
    Without ``schema`` the types are inferred, at the cost of a second pass.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).options(**options)
    if quote_escape:
        reader = reader.option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_movies(
    spark: SparkSession,
    path: str | list[str],
    id_column: str = "title_id",
    multi_line: bool = False,
    infer_schema: bool = False,
) -> DataFrame:
    """The film file, with doubled quotes read as quotes."""
    return read_csv(spark, path, None if infer_schema else movie_schema(id_column), multi_line=multi_line)


def read_ratings(
    spark: SparkSession,
    path: str | list[str],
    id_column: str = "title_id",
    infer_schema: bool = False,
) -> DataFrame:
    """The rating file: plain fields, no quote escape."""
    return read_csv(spark, path, None if infer_schema else rating_schema(id_column), quote_escape=False)
