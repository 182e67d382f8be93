"""Left join of many rows to a table with one row per key.

The table carries the number of rows behind each key, so the frequent keys
are known before the join runs and can be kept out of its shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmlens.sources.staging import materialize

BROADCAST_BYTES = 32 * 1024 * 1024
"""Largest key table, by measured content, that is sent to every executor."""

HOT_PARTS = 1000
"""A key is hot when it holds at least one in this many rows: there are never more than this many."""


@dataclass(frozen=True)
class Lookup:
    """One row per ``key`` with its row count and a value, written to the staging folder."""

    table: DataFrame
    key: str
    value: str
    count: str
    n_keys: int
    n_rows: int
    n_bytes: int

    def derive(self, value: str, column: Column) -> Lookup:
        """The same keys with a value computed from the table's columns."""
        return replace(self, table=self.table.withColumn(value, column), value=value)


def build_lookup(table: DataFrame, key: str, value: str, count: str, name: str, *stats: Column) -> tuple[Lookup, Row]:
    """Write the table once and measure it; ``stats`` are further aggregates over it."""
    written = materialize(table, name)
    width = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + 32
    measured = written.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(count), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("n_bytes"),
        *stats,
    ).first()
    return Lookup(written, key, value, count, measured.n_keys, measured.n_rows, measured.n_bytes), measured


def _common_type(column: T.DataType, key: T.DataType) -> T.DataType:
    """The type both sides are compared and hashed in; a cast that could lose values is refused."""
    if column.simpleString() == key.simpleString():
        return key
    if isinstance(column, T.IntegralType) and isinstance(key, T.IntegralType):
        return T.LongType()
    if isinstance(column, T.FractionalType) and isinstance(key, T.FractionalType) and not T.DecimalType in (type(column), type(key)):
        return T.DoubleType()
    raise TypeError(f"cannot look up {column.simpleString()} values among {key.simpleString()} keys")


def lookup_join(
    df: DataFrame, column: str, lookup: Lookup, out: str, spread: list[str] | None = None, broadcast_bytes: int | None = None
) -> DataFrame:
    """Add ``out``: the value found for ``column``, null where the key is unknown.

    Null is a key like any other. Integers of different widths, and floats and
    doubles, are compared in the wider type; other differing types are an
    error. ``broadcast_bytes`` replaces ``BROADCAST_BYTES``; the result does not
    depend on it. A table of checked size is broadcast. Beyond
    that size only the hot keys are broadcast (at most ``HOT_PARTS`` by
    arithmetic); the rows they serve pass the shuffle join under a key spread
    over ``spread`` (all columns by default), so no task receives a hot key
    whole. The spread is a hash of the row, so a repeated task sends every row
    to the same place again.
    """
    kind = _common_type(df.schema[column].dataType, lookup.table.schema[lookup.key].dataType)
    wanted, key = F.col(column).cast(kind), F.col(lookup.key).cast(kind)
    found = lookup.table.select(key.alias("__key"), F.col(lookup.value).alias(out))
    if lookup.n_bytes <= (BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes):
        return df.join(F.broadcast(found), wanted.eqNullSafe(F.col("__key")), "left").drop("__key")

    hot = F.col(lookup.count) >= F.lit(max(1.0, lookup.n_rows / HOT_PARTS))
    hot_table = lookup.table.filter(hot).select(
        key.alias("__hot_key"), F.col(lookup.value).alias("__hot_value"), F.lit(True).alias("__hit")
    )
    cold_table = lookup.table.filter(~hot).select(
        key.alias("__key"), F.col(lookup.value).alias("__cold_value")
    )
    # The planner's own estimate must not send out what was measured as too large. A task's share of
    # the keys that could be sent out is held in its memory, so that the rows need no sort; a caller's
    # own bound is kept to by a merge.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    how = "shuffle_hash" if broadcast_bytes is None and lookup.n_bytes <= partitions * BROADCAST_BYTES else "merge"
    cold_table = cold_table.withColumn("__cold_place", F.xxhash64("__key")).hint(how)
    hit = F.coalesce("__hit", F.lit(False))
    served = df.join(F.broadcast(hot_table), wanted.eqNullSafe(F.col("__hot_key")), "left").select(
        *df.columns,
        "__hot_value",
        hit.alias("__served"),
        F.when(hit, F.xxhash64(*(spread or df.columns))).otherwise(F.xxhash64(wanted)).alias("__place"),
    )
    matched = served.join(
        cold_table,
        (F.col("__place") == F.col("__cold_place")) & wanted.eqNullSafe(F.col("__key")) & ~F.col("__served"),
        "left",
    )
    value = F.when(F.col("__served"), F.col("__hot_value")).otherwise(F.col("__cold_value"))
    return matched.select(*df.columns, value.alias(out))
