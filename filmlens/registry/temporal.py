"""As-of and range joins, window frames, event-time streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.operators import temporal as O
from filmlens.registry.core import query
from filmlens.registry.tables import rounded, table
from filmlens.sources.staging import staging_path
from filmlens.streaming import windows as S

# --- joins along an order ------------------------------------------------


@query(
    "as_of_last_click",
    """WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
            c AS (SELECT user_id, ts AS click_ts, event_id AS click_id FROM events WHERE event_type = 'click')
       SELECT p.event_id, p.user_id, p.ts, c.click_ts, c.click_id FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts >= c.click_ts""",
)
def as_of_last_click(spark: SparkSession, sf: str) -> DataFrame:
    """The user's last click before each purchase."""
    events = table(spark, sf, "events")
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"))
    return O.as_of_join(purchases, clicks, ["user_id"], "ts", "click_ts", ["click_id"], O.DAY)


@query(
    "as_of_click_within_day",
    """WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
            c AS (SELECT user_id, ts AS click_ts, event_id AS click_id FROM events WHERE event_type = 'click'),
            j AS (SELECT p.event_id, c.click_ts, c.click_id, p.ts - c.click_ts <= INTERVAL 1 DAY AS near
                  FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts >= c.click_ts)
       SELECT event_id, CASE WHEN near THEN click_ts END AS click_ts, CASE WHEN near THEN click_id END AS click_id FROM j""",
)
def as_of_click_within_day(spark: SparkSession, sf: str) -> DataFrame:
    """The same, if it is not more than a day old."""
    events = table(spark, sf, "events")
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"))
    found = O.as_of_join(purchases, clicks, ["user_id"], "ts", "click_ts", ["click_id"], 6 * O.HOUR, O.DAY)
    return found.select("event_id", "click_ts", "click_id")


@query(
    "as_of_latest_order",
    """WITH l AS (SELECT l_orderkey, l_linenumber, o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
            o AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS last_order FROM orders GROUP BY 1, 2)
       SELECT l_orderkey, l_linenumber, last_order FROM l ASOF LEFT JOIN o ON l.o_custkey = o.o_custkey AND l.l_shipdate >= o.o_orderdate""",
)
def as_of_latest_order(spark: SparkSession, sf: str) -> DataFrame:
    """The customer's latest order on the day each line was shipped."""
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.select("l_orderkey", "l_linenumber", "o_custkey", "l_shipdate")
    latest = orders.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("last_order"))
    found = O.as_of_join(lines, latest, ["o_custkey"], "l_shipdate", "o_orderdate", ["last_order"], 90 * O.DAY)
    return found.select("l_orderkey", "l_linenumber", "last_order")


_BANDS_SQL = "SELECT p_brand AS band, p_type AS kind, min(p_retailprice) AS low, max(p_retailprice) AS high FROM part GROUP BY 1, 2"


@query(
    "range_join_price_bands",
    f"""WITH b AS ({_BANDS_SQL}) SELECT p_partkey, band, kind FROM part JOIN b ON p_retailprice >= low AND p_retailprice < high WHERE p_size = 7""",
)
def range_join_price_bands(spark: SparkSession, sf: str) -> DataFrame:
    """The price bands, of a brand and a type each, that parts of one size lie in; bands are wide and overlap."""
    parts = table(spark, sf, "part")
    bands = parts.groupBy(F.col("p_brand").alias("band"), F.col("p_type").alias("kind")).agg(
        F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high")
    )
    points = parts.filter("p_size = 7").select("p_partkey", "p_retailprice")
    return O.range_join(points, bands, "p_retailprice", "low", "high", 10.0).select("p_partkey", "band", "kind")


@query(
    "range_join_band_counts",
    f"""WITH b AS ({_BANDS_SQL}) SELECT band, kind, count(*) AS n, round(sum(l_extendedprice) / 1000000, 4) AS total_millions
        FROM lineitem JOIN b ON l_extendedprice >= low * 10 AND l_extendedprice < high * 10 GROUP BY 1, 2""",
)
def range_join_band_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines whose price lies in ten times a band, counted by band."""
    bands = table(spark, sf, "part").groupBy(F.col("p_brand").alias("band"), F.col("p_type").alias("kind")).agg(
        (F.min("p_retailprice") * 10).alias("low"), (F.max("p_retailprice") * 10).alias("high")
    )
    found = O.range_join(table(spark, sf, "lineitem").select("l_extendedprice"), bands, "l_extendedprice", "low", "high", 100.0)
    counted = found.groupBy("band", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("s"))
    return counted.select("band", "kind", "n", rounded(F.col("s") / 1000000, 4).alias("total_millions"))


# --- window frames ---------------------------------------------------------

_BY_USER = "OVER (PARTITION BY user_id ORDER BY ts, event_id"


@query("window_running_total", f"SELECT event_id, round(sum(value) {_BY_USER} ROWS UNBOUNDED PRECEDING), 4) AS total FROM events")
def window_running_total(spark: SparkSession, sf: str) -> DataFrame:
    """What each user has come to with every event, in two levels: days, and rows of a day."""
    found = O.running_sum(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "value", "total", O.DAY)
    return found.select("event_id", rounded("total", 4).alias("total"))


@query("window_running_total_all", "SELECT event_id, round(sum(value) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 3) AS total FROM events")
def window_running_total_all(spark: SparkSession, sf: str) -> DataFrame:
    """The same over all events as one key, the extreme of a hot one: no task meets more than an hour of it."""
    one = table(spark, sf, "events").withColumn("all", F.lit(1))
    return O.running_sum(one, ["all"], ["ts", "event_id"], "value", "total", O.HOUR).select("event_id", rounded("total", 3).alias("total"))


@query("window_previous_event", f"SELECT event_id, lag(event_type) {_BY_USER}) AS before, lag(event_id) {_BY_USER}) AS before_id FROM events")
def window_previous_event(spark: SparkSession, sf: str) -> DataFrame:
    """Type and id of the user's event before each one."""
    events = table(spark, sf, "events").withColumn("both", F.struct("event_type", "event_id"))
    found = O.previous_row(events, ["user_id"], ["ts", "event_id"], "both", "previous", O.DAY)
    return found.select("event_id", F.col("previous.event_type").alias("before"), F.col("previous.event_id").alias("before_id"))


@query(
    "window_last_three_days",
    """SELECT event_id, count(*) OVER w AS n, round(sum(value) OVER w, 4) AS total, max(value) OVER w AS highest FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND CURRENT ROW)""",
)
def window_last_three_days(spark: SparkSession, sf: str) -> DataFrame:
    found = O.rolling(
        table(spark, sf, "events"), ["user_id"], "ts", 3 * O.DAY, n=F.count(F.lit(1)), total=F.sum("value"), highest=F.max("value")
    )
    return found.select("event_id", "n", rounded("total", 4).alias("total"), "highest")


# --- streams ---------------------------------------------------------------

_FIGURES: dict[str, Column | str] = {"n": "count(*)", "total": "sum(value)", "highest": "max(value)"}


def _streamed(spark: SparkSession, sf: str, build: S.Build, delay: str = "1 hour", again: bool = False) -> DataFrame:
    """All events as a stream in two runs with one checkpoint, then closed; ``again`` sends part of the first half twice."""
    events = table(spark, sf, "events")
    stream = S.EventStream(staging_path(spark, "events"), events.schema, "ts", delay)
    bounds = events.agg(F.min("ts").cast("timestamp").cast("double").alias("a"), F.max("ts").cast("timestamp").cast("double").alias("b")).first()
    early = F.col("ts").cast("timestamp").cast("double") < (bounds.a + bounds.b) / 2
    out, checkpoint = staging_path(spark, "windows"), staging_path(spark, "stream-checkpoint")
    for part in (events.filter(early), events.filter(~early).unionByName(events.filter(early & (F.col("event_id") % 3 == 0))) if again else events.filter(~early)):
        stream.append(part)
        S.run_available(spark, stream, build, out, checkpoint)
    stream.close(spark, F.timestamp_seconds(F.lit(bounds.b + 365.0 * 86400)))
    S.run_available(spark, stream, build, out, checkpoint)
    return spark.read.parquet(out)


def _figures(rows: DataFrame, window: Column, *keys: str) -> DataFrame:
    return S.windowed(rows, window, keys, n=F.count(F.lit(1)), total=F.sum("value"), highest=F.max("value"))


def _shown(found: DataFrame, *keys: str) -> DataFrame:
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    return found.select(*times, *keys, "n", rounded("total", 4).alias("total"), "highest")


@query(
    "stream_tumbling",
    """SELECT time_bucket(INTERVAL 6 HOURS, ts) AS window_start, time_bucket(INTERVAL 6 HOURS, ts) + INTERVAL 6 HOURS AS window_end, event_type,
              count(*) AS n, round(sum(value), 4) AS total, max(value) AS highest FROM events GROUP BY ALL""",
)
def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    """Events by type in windows of six hours."""
    return _shown(_streamed(spark, sf, lambda rows: _figures(rows, S.tumbling("ts", "6 hours"), "event_type")), "event_type")


@query(
    "stream_sliding",
    """WITH w AS (SELECT time_bucket(INTERVAL 12 HOURS, ts) - to_hours(12 * unnest([0, 1])) AS window_start, value FROM events)
       SELECT window_start, window_start + INTERVAL 24 HOURS AS window_end, count(*) AS n, round(sum(value), 4) AS total, max(value) AS highest FROM w GROUP BY ALL""",
)
def stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """All events in windows of a day that start every twelve hours."""
    return _shown(_streamed(spark, sf, lambda rows: _figures(rows, S.sliding("ts", "24 hours", "12 hours"))))


@query(
    "stream_sessions",
    """WITH s AS (SELECT *, coalesce(ts - lag(ts) OVER w >= INTERVAL 8 HOURS, true) AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
            g AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM s)
       SELECT min(ts) AS window_start, max(ts) + INTERVAL 8 HOURS AS window_end, user_id, count(*) AS n, round(sum(value), 4) AS total, max(value) AS highest
       FROM g GROUP BY user_id, session""",
)
def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of a user: events less than eight hours apart; a session goes on over the restart."""
    return _shown(_streamed(spark, sf, lambda rows: _figures(rows, S.session("ts", "8 hours"), "user_id")), "user_id")


@query("stream_deduplicated", "SELECT event_id, user_id, value FROM events")
def stream_deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    """Each event once, though a third of the first half is sent again after the restart."""
    found = _streamed(spark, sf, lambda rows: S.deduplicated(rows, "event_id"), "40 days", again=True)
    return found.filter("event_id IS NOT NULL").select("event_id", "user_id", "value")
