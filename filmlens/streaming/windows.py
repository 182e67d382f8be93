"""Windowed aggregates of an event stream, kept up over restarts and closed at its end.

A stream is a folder to which Parquet files are added. Windows are appended to
the result folder once the watermark has passed their end: each window is
written once, by the transactions of Spark's file sink, and a run that is started
again with the same checkpoint goes on where the last one stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Build = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class EventStream:
    """A folder of event files, the schema they have, their time column, and how late an event may come."""

    folder: str
    schema: T.StructType
    time: str
    delay: str = "1 hour"

    def read(self, spark: SparkSession) -> DataFrame:
        """The stream with its watermark. A time without zone is read in the session's."""
        rows = spark.readStream.schema(self.schema).parquet(self.folder)
        return rows.withColumn(self.time, F.col(self.time).cast("timestamp")).withWatermark(self.time, self.delay)

    def append(self, rows: DataFrame) -> None:
        """Add files with these events."""
        rows.select(*self.schema.names).write.mode("append").parquet(self.folder)

    def close(self, spark: SparkSession, at: Column) -> None:
        """Add one event that lets the watermark pass every open window; its own window stays open and is never written."""
        empty = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != self.time else at.cast(f.dataType).alias(f.name) for f in self.schema]
        self.append(spark.range(1).select(*empty))


def tumbling(time: str, length: str) -> Column:
    return F.window(time, length)


def sliding(time: str, length: str, step: str) -> Column:
    return F.window(time, length, step)


def session(time: str, gap: str) -> Column:
    return F.session_window(time, gap)


def windowed(rows: DataFrame, window: Column, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """``window_start, window_end``, keys and aggregates; the same expression serves streams and tables."""
    counted = rows.groupBy(window.alias("window"), *keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *aggregates)


def deduplicated(rows: DataFrame, key: str) -> DataFrame:
    """The first event of every key, where events with one key come within the watermark's delay of each other."""
    return rows.dropDuplicatesWithinWatermark([key])


def run_available(spark: SparkSession, stream: EventStream, build: Build, out: str, checkpoint: str, files_per_batch: int | None = None) -> None:
    """Process what the folder holds and has not been processed with this checkpoint, then stop."""
    rows = stream.read(spark)
    if files_per_batch:
        rows = (
            spark.readStream.schema(stream.schema).option("maxFilesPerTrigger", files_per_batch).parquet(stream.folder)
            .withColumn(stream.time, F.col(stream.time).cast("timestamp")).withWatermark(stream.time, stream.delay)
        )
    writer = build(rows).writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(out).awaitTermination()
