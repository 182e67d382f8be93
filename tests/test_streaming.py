from datetime import datetime, timedelta

from pyspark.sql import functions as F

from filmlens.streaming import windows as S

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, value double"
START = datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame([(i, START + timedelta(minutes=m), u, 1.0) for i, m, u in rows], SCHEMA)


def stream(spark, tmp_path, delay="10 minutes"):
    empty = events(spark, [])
    return S.EventStream(str(tmp_path / "in"), empty.schema, "ts", delay), str(tmp_path / "out"), str(tmp_path / "check")


def shown(spark, out):
    found = spark.read.parquet(out).orderBy("window_start", "user_id").collect()
    minutes = lambda t: int((t.replace(tzinfo=None) - START).total_seconds() // 60)
    return [(minutes(r.window_start), minutes(r.window_end), r.user_id, r.n) for r in found]


def counted(window):
    return lambda rows: S.windowed(rows, window(), ["user_id"], n=F.count(F.lit(1)))


def end(spark, source):
    source.close(spark, F.lit(START + timedelta(days=9)).cast("timestamp"))


def test_a_window_is_written_once_its_end_is_past_and_late_events_are_dropped(spark, tmp_path):
    source, out, check = stream(spark, tmp_path)
    build = counted(lambda: S.tumbling("ts", "30 minutes"))
    source.append(events(spark, [(1, 1, 7), (2, 29, 7), (3, 35, 7)]))
    S.run_available(spark, source, build, out, check)
    assert shown(spark, out) == []  # the watermark stands at minute 25
    source.append(events(spark, [(4, 5, 7), (5, 45, 7)]))
    S.run_available(spark, source, build, out, check)
    assert shown(spark, out) == [(0, 30, 7, 3)]
    source.append(events(spark, [(6, 6, 7)]))  # too late: its window is closed
    end(spark, source)
    S.run_available(spark, source, build, out, check)
    assert shown(spark, out) == [(0, 30, 7, 3), (30, 60, 7, 2)]


def test_a_second_run_without_new_files_adds_nothing(spark, tmp_path):
    source, out, check = stream(spark, tmp_path)
    build = counted(lambda: S.sliding("ts", "20 minutes", "10 minutes"))
    source.append(events(spark, [(1, 12, 7), (2, 15, None)]))
    end(spark, source)
    for _ in range(2):
        S.run_available(spark, source, build, out, check)
        assert shown(spark, out) == [(0, 20, None, 1), (0, 20, 7, 1), (10, 30, None, 1), (10, 30, 7, 1)]


def test_sessions_go_on_over_a_restart_and_batches(spark, tmp_path):
    source, out, check = stream(spark, tmp_path)
    build = counted(lambda: S.session("ts", "20 minutes"))
    for rows in ([(1, 0, 7), (2, 15, 7)], [(3, 30, 7), (4, 31, 8)], [(5, 80, 7)]):
        source.append(events(spark, rows))
        S.run_available(spark, source, build, out, check, files_per_batch=1)
    end(spark, source)
    S.run_available(spark, source, build, out, check)
    assert shown(spark, out) == [(0, 50, 7, 3), (31, 51, 8, 1), (80, 100, 7, 1)]


def test_a_key_is_kept_once(spark, tmp_path):
    source, out, check = stream(spark, tmp_path, "1 hour")
    for rows in ([(1, 0, 7), (1, 5, 7)], [(1, 20, 7), (2, 20, 7)]):
        source.append(events(spark, rows))
        S.run_available(spark, source, lambda rows: S.deduplicated(rows, "event_id"), out, check)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2]
