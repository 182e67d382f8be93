"""Joins and window frames along an order, for keys of any size.

A key's rows are cut into buckets of the order, so that a task meets one bucket
of a key and not the whole key. What a bucket needs from the ones before it (a
last row, a total) is one row per bucket and is carried over by a window over
those. The result does not depend on the bucket's width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND = 1_000_000
HOUR = 3600 * SECOND
DAY = 24 * HOUR
"""Ticks of timestamps and dates; numbers are their own ticks."""


def ticks(df: DataFrame, column: str) -> Column:
    """The place of a row in the order as a number: microseconds for timestamps and dates."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return F.col(column)
    raise TypeError(f"{column} is neither a time nor a number")


def _bucket(t: str, width: float) -> Column:
    return F.floor(F.col(t) / F.lit(width)).cast("bigint")


def _same(a: str, b: str, columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    width: float,
    tolerance: float | None = None,
) -> DataFrame:
    """Every left row with the last right row of its keys at or before its time.

    Adds ``right_time`` and ``values``; null where there is no such row, or where
    it is more than ``tolerance`` ticks earlier. Of right rows at one time the
    one with the largest values counts. Null keys and times match nothing. Both
    sides are one stream of rows in each bucket of ``width`` ticks; only the last
    right row of a bucket is carried on.
    """
    clash = set(left.columns) & {right_time, *values}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    named = [F.col(k) for k in keys]
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    found = F.struct(ticks(right, right_time).alias("t"), F.struct(right_time, *values).alias("values"))
    rights = right.filter(present & F.col(right_time).isNotNull()).select(*named, found.alias("found"))
    rights = rights.select(*keys, F.col("found.t").alias("t"), F.lit(0).alias("kind"), "found")
    lefts = left.select(*named, ticks(left, left_time).alias("t"), F.lit(1).alias("kind"), F.struct(*left.columns).alias("row"))
    both = rights.unionByName(lefts, allowMissingColumns=True).withColumn("bucket", _bucket("t", width))

    before = Window.partitionBy(*keys, "bucket").orderBy("t", "kind", "found").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = both.withColumn("near", F.last("found", ignorenulls=True).over(before)).filter("kind = 1")
    # One row per bucket; a bucket with left rows only has no last right row of its own.
    ends = both.groupBy(*keys, "bucket").agg(F.max("found").alias("end"))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("far", F.last("end", ignorenulls=True).over(earlier)).filter("far IS NOT NULL").select(*keys, "bucket", "far")
    joined = within.alias("a").join(carried.alias("b"), _same("a", "b", [*keys, "bucket"]), "left")
    best = F.coalesce("a.near", "b.far")
    if tolerance is not None:
        best = F.when(F.col("a.t") - best["t"] <= tolerance, best)
    return joined.select("a.row", best["values"].alias("found")).select("row.*", "found.*")


def range_join(points: DataFrame, intervals: DataFrame, value: str, low: str, high: str, width: float) -> DataFrame:
    """Pairs of a point and an interval with ``low <= value < high``, without a cross join.

    An interval belongs to the level whose cells, ``width`` doubled as often as it
    takes, are at least as long as it is, so it lies in two cells at most. A point
    lies in one cell of each level that has intervals (their number is the log of
    the longest length). Pairs meet in a cell; a cell with very many points is
    split by adaptive execution. Nulls and empty intervals match nothing.
    """
    clash = set(points.columns) & set(intervals.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    length = F.col(high) - F.col(low)
    kept = intervals.filter(length > 0).withColumn("__level", F.greatest(F.ceil(F.log2(length / F.lit(float(width)))), F.lit(0)).cast("int"))
    levels = [r[0] for r in kept.select("__level").distinct().collect()]  # at most some two thousand: exponents of a double

    def cell(x: Column, level: Column) -> Column:
        return F.floor(x / (F.lit(float(width)) * F.pow(F.lit(2.0), level))).cast("bigint")

    covered = kept.withColumn("__cell", F.explode(F.array_distinct(F.array(cell(F.col(low), F.col("__level")), cell(F.col(high), F.col("__level"))))))
    wanted = points.filter(F.col(value).isNotNull()).withColumn("__level", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")))
    placed = wanted.withColumn("__cell", cell(F.col(value), F.col("__level")))
    met = placed.join(covered, ["__level", "__cell"]).filter((F.col(value) >= F.col(low)) & (F.col(value) < F.col(high)))
    return met.select(*points.columns, *intervals.columns)


def _carry(df: DataFrame, keys: Sequence[str], per_bucket: Column, over: str) -> DataFrame:
    """Per key and bucket, what the buckets before it come to: their sum, or the last one's value."""
    ends = df.groupBy(*keys, "__bucket").agg(per_bucket.alias("__end"))
    by = Window.partitionBy(*keys).orderBy("__bucket")
    found = F.sum("__end").over(by.rowsBetween(Window.unboundedPreceding, -1)) if over == "sum" else F.lag("__end").over(by)
    return ends.select(*keys, "__bucket", found.alias("__carried"))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, width: float) -> DataFrame:
    """``out``: the sum of ``value`` over the key's rows up to this one.

    ``order`` is a time or number and then columns that make it unique in a key.
    Null values add nothing; the sum is null until there is one.
    """
    placed = df.withColumn("__t", ticks(df, order[0])).withColumn("__bucket", _bucket("__t", width))
    upto = Window.partitionBy(*keys, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = placed.withColumn("__within", F.sum(value).over(upto))
    joined = within.alias("a").join(_carry(placed, keys, F.sum(value), "sum").alias("b"), _same("a", "b", [*keys, "__bucket"]), "left")
    a, b = F.col("a.__within"), F.col("b.__carried")
    total = F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    return joined.select(*[f"a.{c}" for c in df.columns], total.alias(out))


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, width: float) -> DataFrame:
    """``out``: ``value`` of the key's row before this one; null for its first row."""
    placed = df.withColumn("__t", ticks(df, order[0])).withColumn("__bucket", _bucket("__t", width))
    packed = F.struct(F.col(value).alias("v"))
    within = placed.withColumn("__within", F.lag(packed).over(Window.partitionBy(*keys, "__bucket").orderBy(*order)))
    ends = _carry(placed, keys, F.max_by(packed, F.struct(*order)), "last")
    joined = within.alias("a").join(ends.alias("b"), _same("a", "b", [*keys, "__bucket"]), "left")
    return joined.select(*[f"a.{c}" for c in df.columns], F.coalesce("a.__within", "b.__carried")["v"].alias(out))


def rolling(df: DataFrame, keys: Sequence[str], time: str, span: int, **aggregates: Column) -> DataFrame:
    """Aggregates over the key's rows of the last ``span`` ticks, this row's time included on both ends.

    Buckets are as long as the span, so a frame lies in a row's bucket and the
    one before: each row is sent to its own bucket and, as context, to the next.
    Rows without a time get nulls.
    """
    placed = df.withColumn("__t", ticks(df, time)).withColumn("__bucket", _bucket("__t", span))
    own, context = placed.withColumn("__own", F.lit(True)), placed.withColumns({"__own": F.lit(False), "__bucket": F.col("__bucket") + 1})
    frame = Window.partitionBy(*keys, "__bucket").orderBy("__t").rangeBetween(-span, Window.currentRow)
    both = own.unionByName(context.filter("__t IS NOT NULL"))
    found = both.withColumns({name: F.when(F.col("__t").isNotNull(), a.over(frame)) for name, a in aggregates.items()})
    return found.filter("__own").select(*df.columns, *aggregates)
