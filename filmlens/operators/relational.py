"""Relational operators whose result is defined for any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_blank(df: DataFrame, column: str) -> Column:
    """Null, or the empty string where the column is text."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def is_present(df: DataFrame, column: str) -> Column:
    """Neither null nor NaN: what ``na.drop`` keeps."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def all_present(df: DataFrame, columns: Sequence[str]) -> Column:
    """True where ``na.drop(subset=columns)`` keeps the row."""
    keep = F.lit(True)
    for column in columns:
        keep = keep & is_present(df, column)
    return keep


def drop_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where a listed text column is empty (or null)."""
    for column in columns:
        df = df.filter(F.col(column) != "")
    return df


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``, which should be unique in a key.

    Minima are taken before and after the shuffle, so a key with very many rows
    sends one row per task. The minimum keeps a struct, which rules out hash
    aggregation: each side sorts by the key, as a window would, but the shuffle
    carries one row per key and task instead of all rows.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("row")
    return df.groupBy(*keys).agg(first).select(*keys, "row.*").select(*df.columns)


def first_last(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """First and last ``value`` per key in a stated order."""
    by = F.struct(*order)
    return df.groupBy(*keys).agg(
        F.min_by(value, by).alias("first_value"),
        F.max_by(value, by).alias("last_value"),
    )


def hash_number(keys: Sequence[str], seed: int = 42) -> Column:
    """32 bits that depend only on the key values and the seed.

    Unlike a random draw they do not change with the partitioning or when a
    lost task is run again, and unlike plain key arithmetic they do not
    inherit a pattern in the keys.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def hash_percent(keys: Sequence[str], seed: int = 42) -> Column:
    """A number 0-99 that depends only on the key values and the seed."""
    return F.pmod(hash_number(keys, seed), F.lit(100)).cast("int")


def sample_by_key(df: DataFrame, keys: Sequence[str], percent: int, seed: int = 42) -> DataFrame:
    """Repeatable Bernoulli sample of about ``percent`` percent of the keys."""
    return df.filter(hash_percent(keys, seed) < percent)


def split_by_key(df: DataFrame, keys: Sequence[str], train_percent: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Repeatable train/test split; rows that share a key stay on one side."""
    draw = hash_percent(keys, seed)
    return df.filter(draw < train_percent), df.filter(draw >= train_percent)


def above_sigma(df: DataFrame, column: str, sigmas: float = 3.0) -> DataFrame:
    """Rows above the mean plus ``sigmas`` sample standard deviations."""
    limit = df.select(F.avg(column) + F.lit(float(sigmas)) * F.stddev(column)).scalar()
    return df.filter(F.col(column) > limit)


def join_loss(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Rows before and after an inner or left join, without running the join.

    Both sides are counted per key first, so the join meets one row per key
    and a key that holds much of the data costs no more than any other.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    n_left = left.groupBy(key).agg(F.count(F.lit(1)).alias("n_left"))
    n_right = right.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_right"))
    unmatched = 1 if how == "left" else 0
    counted = n_left.join(n_right, key, "left").withColumn("n_out", F.col("n_left") * F.coalesce("n_right", F.lit(unmatched)))
    return counted.agg(
        F.coalesce(F.sum("n_left"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("n_out"), F.lit(0)).alias("rows_after"),
    ).select(
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_lost"),
        F.try_divide((F.col("rows_before") - F.col("rows_after")) * 100.0, F.col("rows_before")).alias("pct_lost"),
    )
