"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
"""A word: a run of characters other than the six ASCII white-space characters."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), 1)


RUN = 256
BLOCK_CHARS = 2000


def running(values: Column, zero: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For each element of a bound array of ints, what the associative ``op`` makes of ``zero`` and all elements before it.

    A list that grows by one in every step is copied in every step, so it is kept
    to runs of ``RUN`` elements, and to one element a run above those.
    """
    none = F.array().cast("array<int>")
    starts = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1, F.lit(RUN))).otherwise(none)
    part = lambda s: F.slice(values, s + 1, F.lit(RUN))

    def scan(some: Column, first: Column) -> Column:
        step = lambda acc, x: F.struct(op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(some, F.struct(first.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    totals = lambda ss: F.transform(ss, lambda s: F.aggregate(part(s), zero, op))
    return let(starts, lambda ss: F.flatten(F.zip_with(ss, scan(totals(ss), zero), lambda s, first: scan(part(s), first))))


def blocks(text: Column) -> Column:
    """The text in parts of ``BLOCK_CHARS`` code points: places in a long text are far from its start, and reached from there."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))


def piece(parts: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text in ``blocks``."""
    block = lambda at: F.floor(at / BLOCK_CHARS).cast("int")
    first, last = block(start), block(end - 1)
    head = F.substring(F.get(parts, first), start - first * BLOCK_CHARS + 1, F.least(end - start, F.lit(BLOCK_CHARS)))
    tail = F.substring(F.get(parts, last), F.lit(1), end - last * BLOCK_CHARS)
    between = F.array_join(F.slice(parts, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    return F.when(end <= start, F.lit("")).when(first == last, head).otherwise(F.concat(head, between, tail))
