"""Importance resampling towards a target distribution of hashed word features.

1. Runs of words fall into ``BUCKETS`` buckets by CRC-32. Tasks count them for
   the documents and for the target texts; the two histograms give one array of
   gains, 1000 times the smoothed log ratio, rounded down.
2. A document's weight is the sum of the gains of its features, read from that
   array; with Gumbel noise from a hash of its id it becomes a score. The
   documents with the highest scores are a draw without replacement in
   proportion to the importance weights.
3. The cutoff is found without sorting all scores: a quantile sketch brackets
   it, exact counts outside the bracket confirm that it lies inside or widen
   the bracket, and only what is inside is sorted.

Texts are read twice and never shuffled; what is sorted has five numbers a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm.alnum_words import crc32, find_words, runs
from filmlens.llm.common import table
from filmlens.llm.tokens import slices
from filmlens.sources.staging import materialize

BUCKETS = 10_000
MAX_RUN = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
ACCURACY = 1_000
"""Inverse of the rank error that the quantile sketch allows, as a share of the rows."""


@dataclass(frozen=True)
class Settings:
    """Features are runs of 1 to ``max_run`` words; ``percent`` of the documents of ``min_words`` or more are drawn."""

    max_run: int = MAX_RUN
    buckets: int = BUCKETS
    min_words: int = MIN_WORDS
    percent: int = PERCENT
    seed: int = SEED


def _features(texts: list[bytes | None], max_run: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of runs of each length: buckets, and for each text (and past the last) the index of its first one."""
    found = find_words(texts)
    for n in range(1, max_run + 1):
        data, start, end, first = runs(found, n)
        yield (crc32(data, start, end) % np.uint32(buckets)).astype(np.int64), first


def count_buckets(texts: DataFrame, text_column: str = "text", settings: Settings = Settings()) -> np.ndarray:
    """Features of all rows in each bucket. One row a bucket leaves a task, and only their sums reach the driver."""
    max_run, buckets = settings.max_run, settings.buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, part in slices(batches):
            for found, _ in _features(part, max_run, buckets):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counted = texts.select(F.col(f"`{text_column}`").alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row a bucket
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares of each bucket, rounded down."""
    s, t, all_s, all_t = (x.astype(np.float64) for x in (source, target, source.sum(), target.sum()))
    return np.floor(1000 * np.log((t + 1) * (all_s + len(s)) / ((s + 1) * (all_t + len(t))))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_column: str = "doc_id", text_column: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    max_run, buckets = settings.max_run, settings.buckets

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            weight = n_features = np.zeros(len(texts), np.int64)
            n_words = None
            for found, first in _features(texts, max_run, buckets):
                sums = np.concatenate(([0], np.cumsum(gain[found])))
                weight = weight + sums[first[1:]] - sums[first[:-1]]
                n_features = n_features + np.diff(first)
                n_words = np.diff(first) if n_words is None else n_words
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (n_words, n_features, weight))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    read = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return read.mapInArrow(score, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel value from the first 32 bits of a hash of seed and id, rounded down; a null id counts as empty."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _in_order(scored: DataFrame, name: str) -> DataFrame:
    """The rows with ``rank``, 1 for the highest score, ties by id: a range sort whose partitions are counted."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]
    placed = scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = materialize(placed, name)
    # The upper bits of a place are its partition, the lower 33 its row there.
    sizes = sorted(tuple(r) for r in placed.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n")).collect())
    before, start = [], 0
    for part, n in sizes:
        before.append((part, start))
        start += n
    offsets = F.lit(0).cast("bigint")
    if before:
        spark = scored.sparkSession
        offset_table = spark.createDataFrame(before, "part bigint, before bigint")
        placed = placed.withColumn("part", F.shiftright("place", 33)).join(F.broadcast(offset_table), "part").drop("part")
        offsets = F.col("before")
    rank = offsets + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("rank", rank.cast("bigint")).drop("place", "before")


def bracket(scored: DataFrame, wanted: int, total: int) -> tuple[int | None, int | None, int]:
    """Bounds of the score of row ``wanted`` from above (null: none), and how many rows are above the upper one.

    The sketch proposes; exact counts decide. While the row is not inside, the
    margin doubles, up to no bounds at all.
    """
    margin = 2.0 / ACCURACY
    while margin < 1:
        at = 1 - wanted / total
        asked = [max(at - margin, 0.0), min(at + margin, 1.0)]
        low, high = scored.agg(F.percentile_approx("score", asked, 10 * ACCURACY).alias("q")).first().q
        counts = scored.agg(F.count_if(F.col("score") > high).alias("above"), F.count_if(F.col("score") >= low).alias("upto")).first()
        if counts.above < wanted <= counts.upto:
            return low, high, counts.above
        margin *= 2
    return None, None, 0


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Of a written table of scores, the rows with ``drawn``."""
    enough = scored.filter(F.col("n_words") >= min_words)
    total = enough.count()
    wanted = percent * total // 100
    if not wanted:
        return scored.withColumn("drawn", F.lit(False))
    low, high, above = bracket(enough, wanted, total)
    inside = enough if low is None else enough.filter(F.col("score").between(low, high))
    last = _in_order(inside.select("score", "doc_id", "n_features"), "bracket").filter(F.col("rank") == wanted - above).first()
    # Equal in all three means equal rows; as many of them as fit are drawn by their rank below.
    later_id = F.coalesce(F.col("doc_id") < F.lit(last.doc_id), F.lit(last.doc_id is None) & F.col("doc_id").isNotNull())
    same_id = F.col("doc_id").eqNullSafe(F.lit(last.doc_id))
    before = (F.col("score") > last.score) | (
        (F.col("score") == last.score) & (later_id | (same_id & (F.col("n_features") <= last.n_features)))
    )
    return scored.withColumn("drawn", (F.col("n_words") >= min_words) & before)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text_column: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs``; the undrawn have no rank.

    Null and empty texts have no features, weight 0 and are never drawn (unless
    ``min_words`` is 0). Very long texts are counted whole. Rows that repeat an id
    are rows of their own with the same noise; equal scores are ranked by id
    (null last), then by features, and rows that agree in all of it are alike in
    every column but the rank. An empty ``docs`` gives no rows; an empty
    ``target`` gives every bucket the gain of an unseen one. Other columns are not
    read, so their names do not matter.
    """
    gain = gains(count_buckets(docs, text_column, settings), count_buckets(target, target_text_column, settings))
    weighed = weigh(docs, gain, id_column, text_column, settings)
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), settings.seed)), "scores")
    marked = draw(scored, settings.percent, settings.min_words)
    n = scored.filter(F.col("n_words") >= settings.min_words).count() * settings.percent // 100
    ranked = _in_order(marked.filter("drawn").drop("drawn"), "drawn")
    # Rows equal to the last one may be more than are wanted.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    return marked.filter("NOT drawn").drop("drawn").withColumn("rank", F.lit(None).cast("bigint")).unionByName(ranked)


NAME = "op13_resample"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Features, weight, score and rank of every document, towards the benchmark's words."""
    found = resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE_SQL = r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) r(i))
), texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark
), lists AS (
  SELECT side, r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM texts
), words AS (
  SELECT side, r, w, count(*) AS n FROM (SELECT side, r, unnest(ws) AS w FROM lists) GROUP BY ALL
), vocabulary AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(strlen(w)), lambda k: ('0x' || substr(hex(encode(w)), CAST(2 * k + 1 AS BIGINT), 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM words), crc
), counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
  FROM words JOIN vocabulary USING (w) GROUP BY bucket
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM counts, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts)
), weights AS (
  SELECT r, CAST(sum(n * gain) AS BIGINT) AS weight FROM words JOIN vocabulary USING (w) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY r
), scored AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM lists LEFT JOIN weights USING (r) WHERE side = 'd'
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY n_features < 20, score DESC, doc_id NULLS LAST, n_features) AS place,
         count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS wanted
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN place END AS rank FROM ranked
"""
