from pyspark.sql import functions as F

import __spark_entry__ as entries
from tallylake.streaming.landing import (
    dedup_stream,
    read_available,
    run_available,
    session_revenue,
    stream_raw,
    upsert_available,
    windowed_revenue,
)
from tests.frames import rows, ts

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def write_events(spark, path, events):
    spark.createDataFrame([(i, ts(t), 1, kind, v, None) for i, t, kind, v in events], EVENTS).coalesce(1).write.mode(
        "append"
    ).parquet(path)


def test_windows_close_behind_the_watermark_and_repeats_drop(spark, tmp_path):
    path = str(tmp_path / "events")
    write_events(spark, path, [
        (1, "2024-01-01 00:10:00", "view", 1.0), (1, "2024-01-01 00:10:00", "view", 1.0),
        (2, "2024-01-01 00:59:59", "view", 2.5), (3, "2024-01-01 01:00:00", "buy", 4.0),
        (4, "2024-01-01 05:00:00", "view", 9.0),
    ])
    events = spark.readStream.schema(EVENTS).parquet(path)
    got = read_available(windowed_revenue(events), "test")
    assert rows(got, "window_start", "event_type", "events", "revenue") == sorted([
        (ts("2024-01-01 00:00:00"), "view", 2, 3.5), (ts("2024-01-01 01:00:00"), "buy", 1, 4.0),
    ], key=repr)


def test_a_frequent_key_is_dropped_to_one_across_files_and_runs(spark, tmp_path):
    path, out, progress = (str(tmp_path / name) for name in ("events", "out", "progress"))

    def run():
        events = spark.readStream.schema(EVENTS).parquet(path)
        timed = events.withColumn("time", F.col("ts").cast("timestamp"))
        run_available(dedup_stream(timed, ["event_id"], "time", "1 hour", 4).select("event_id"), out, progress)
        return rows(spark.read.parquet(out), "event_id")

    for _ in range(3):
        write_events(spark, path, [(7, "2024-01-01 00:10:00", "view", 1.0)] * 50 + [(8, "2024-01-01 00:11:00", "buy", 1.0)])
    assert run() == [(7,), (8,)]
    write_events(spark, path, [(7, "2024-01-01 00:20:00", "view", 1.0), (9, "2024-01-01 00:21:00", "buy", 1.0)])
    assert run() == [(7,), (8,), (9,)]


def test_raw_files_stream_typed(spark, tmp_path):
    folder = tmp_path / "orders"
    folder.mkdir()
    header = ("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
              "order_delivered_customer_date,order_estimated_delivery_date")
    (folder / "a.csv").write_text(f"{header}\no1,c1,shipped,2025-01-02 03:04:05,bad,,,\n")
    got = read_available(stream_raw(spark, str(folder), "orders"), "raw")
    assert rows(got, "order_id", "order_purchase_timestamp", "order_approved_at") == [("o1", ts("2025-01-02 03:04:05"), None)]


def test_sessions_with_copies_late_events_and_a_restart(spark, tmp_path):
    path, out, progress = (str(tmp_path / name) for name in ("events", "out", "progress"))

    def run():
        events = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(path)
        return rows(upsert_available(session_revenue(events), out, progress), "session_start", "session_end", "events", "revenue")

    write_events(spark, path, [(1, "2024-01-01 00:10:00", "view", 1.0)] * 3 + [(2, "2024-01-01 00:30:00.25", "buy", 2.0)])
    write_events(spark, path, [(1, "2024-01-01 00:10:00", "view", 1.0), (3, "2024-01-01 00:45:00", "buy", 4.0)])  # late, joins
    write_events(spark, path, [(4, "2024-01-01 02:00:00", "buy", 8.0)])
    assert run() == []  # the first session may still grow: its end is 01:15, the watermark stands at 01:00
    write_events(spark, path, [(5, "2024-01-01 05:00:00", "buy", 16.0)])
    first = (ts("2024-01-01 00:10:00"), ts("2024-01-01 01:15:00"), 3, 7.0)
    second = (ts("2024-01-01 02:00:00"), ts("2024-01-01 02:30:00"), 1, 8.0)
    assert run() == [first, second]
    # A batch that failed after it had written runs again under its number: its rows are there once.
    commits = sorted((tmp_path / "progress" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert run() == [first, second]
    write_events(spark, path, [(6, "2024-01-01 02:10:00", "buy", 99.0), (7, "2024-01-01 09:00:00", "buy", 1.0)])  # too late
    assert run() == [first, second, (ts("2024-01-01 05:00:00"), ts("2024-01-01 05:30:00"), 1, 16.0)]


def test_a_folder_of_event_parts_is_read_whole(spark, tmp_path):
    write_events(spark, str(tmp_path / "events.parquet"), [(1, "2024-01-01 00:10:00", "view", 1.0)])
    write_events(spark, str(tmp_path / "events.parquet"), [(2, "2024-01-01 00:20:00", "view", 2.0), (3, "2024-01-02 00:00:00", "buy", 1.0)])
    got = entries.queries()["stream_dedup_revenue"](spark, str(tmp_path))
    assert rows(got, "event_type", "events", "revenue") == [("view", 2, 3.0)]
