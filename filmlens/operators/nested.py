"""Lists and records inside rows: token lists with an inverted index, parsed properties, packed detail rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlens.sources.staging import materialize


def token_list(column: Column, separator: str = ",") -> Column:
    """The different non-blank parts of a listed text, trimmed, in order; an empty list for a null text."""
    parts = F.transform(F.split(F.coalesce(column, F.lit("")), f"[{separator}]"), lambda p: F.trim(p))
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


def has_any(tokens: Column, wanted: Sequence[str]) -> Column:
    """Whether one of the wanted tokens is in the list, as a whole token."""
    return F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in wanted]))


def has_all(tokens: Column, wanted: Sequence[str]) -> Column:
    """Whether every wanted token is in the list."""
    return F.size(F.array_intersect(tokens, F.array(*[F.lit(w) for w in wanted]))) == len(set(wanted))


def inverted_index(df: DataFrame, key: str, tokens: Column, name: str = "inverted-index") -> DataFrame:
    """``token, key`` of every row and token, written in the order of tokens.

    Postings are rows and not lists, so a frequent token is many rows and no large
    one; files are ranges of tokens, and a search opens those of its tokens only.
    """
    pairs = df.select(F.explode(tokens).alias("token"), F.col(key).alias("key")).distinct()
    return materialize(pairs.repartitionByRange("token", "key").sortWithinPartitions("token", "key"), name)


def index_summary(index: DataFrame) -> DataFrame:
    """``token, n_rows, first_key`` of every token."""
    return index.groupBy("token").agg(F.count(F.lit(1)).alias("n_rows"), F.min("key").alias("first_key"))


def search_index(index: DataFrame, wanted: Sequence[str], at_least: int | None = None) -> DataFrame:
    """``key, n_found`` of the rows with ``at_least`` of the wanted tokens; all of them by default."""
    different = sorted(set(wanted))
    found = index.filter(F.col("token").isin(different)).groupBy("key").agg(F.count(F.lit(1)).alias("n_found"))
    return found.filter(F.col("n_found") >= (len(different) if at_least is None else at_least))


def parse_record(df: DataFrame, column: str, schema: str, prefix: str = "") -> DataFrame:
    """The fields of a JSON text as columns, and ``<column>_valid``; fields are null where the text is no such record."""
    with_fields = df.withColumn("__record", F.from_json(column, schema))
    names = with_fields.schema["__record"].dataType.fieldNames()
    valid = F.coalesce(F.get_json_object(column, "$").isNotNull(), F.lit(False)).alias(f"{column}_valid")
    return with_fields.select(*df.columns, *[F.col(f"__record.{n}").alias(f"{prefix}{n}") for n in names], valid)


def packed_details(details: DataFrame, key: str, order: str, fields: Sequence[str], name: str = "details") -> DataFrame:
    """One row per key with its detail rows as a list of records, ordered; for details whose number per key is small by nature."""
    return details.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *fields))).alias(name))
