import json
import time

import pytest
from pyspark.sql import functions as F

from clicklake.operators.rebuild import refine
from clicklake.operators.slices import history_and_live
from clicklake.schemas import CLICK_TABLE, CLICKS
from clicklake.sources.lake import Lake, read_bronze, read_silver
from clicklake.streaming.jobs import stream_to_bronze, stream_to_files, stream_to_silver
from clicklake.streaming.operators import LateRows, first_versions, windowed_counts, windowed_users
from clicklake.streaming.sources import changed_since, decode_messages, stream_files, topic_options
from conftest import click, day_of_clicks, rows_of

PLAIN = ["click_id", "user_id", "event_type", "event_timestamp", "updated_at", "domain", "event_date"]


@pytest.fixture
def feed(clicks, tmp_path):
    """Write a file of clicks into a folder that a stream reads; files arrive in the order written."""
    folder = tmp_path / "feed"

    def add(*rows):
        clicks(*rows).coalesce(1).write.mode("append").parquet(str(folder))
        return str(folder)

    return add


def drain(query):
    query.awaitTermination()
    return query


def test_stream_lands_raw_rows_once_across_restarts(spark, clicks, feed, tmp_path):
    data, log = str(tmp_path / "data"), str(tmp_path / "log")
    day1, day2 = day_of_clicks("2024-01-05", 20, 0), day_of_clicks("2024-01-06", 20, 100)
    for rows in (day1, day2):
        path = feed(*rows)
        drain(stream_to_bronze(stream_files(spark, path, 1), data, log, drain=True))
    drain(stream_to_bronze(stream_files(spark, path, 1), data, log, drain=True))
    stored = spark.read.schema(CLICK_TABLE.bronze).parquet(data)
    assert rows_of(stored.drop("batch_id", "extract_date")) == rows_of(clicks(*day1, *day2))
    assert stored.filter("extract_date = '2024-01-06'").count() == 20


def test_windows_close_behind_the_watermark_and_late_rows_are_counted(spark, feed, tmp_path):
    late_rows = LateRows()
    spark.streams.addListener(late_rows)
    timely = [click(i, f"2024-01-05 1{i}:05:00", user=i % 2) for i in range(4)]
    late = click(50, "2024-01-05 10:30:00", user=5)
    for rows in ([*timely, click(9, "2024-01-05 10:06:00", user=7)], [late, click(51, "2024-01-05 13:10:00")]):
        counts = windowed_counts(stream_files(spark, feed(*rows)))
        query = drain(stream_to_files(counts, str(tmp_path / "out"), str(tmp_path / "log"), drain=True))
    out = spark.read.schema(counts.schema).parquet(str(tmp_path / "out"))
    found = rows_of(out, F.hour("window_start"), "event_type", "event_count", "approx_users")
    assert found == [(10, "page_view", 2, 2), (11, "page_view", 1, 1), (12, "page_view", 1, 1)]
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    assert wait_for(lambda: late_rows.dropped(query)) == 1
    spark.streams.removeListener(late_rows)


def wait_for(value, seconds=20):
    """Listeners are told of a batch a moment after it."""
    end = time.monotonic() + seconds
    while not value() and time.monotonic() < end:
        time.sleep(0.1)
    return value()


def test_late_rows_are_counted_over_more_batches_than_are_kept(spark, feed, tmp_path):
    late_rows, key = LateRows(), "spark.sql.streaming.numRecentProgressUpdates"
    spark.streams.addListener(late_rows)
    kept = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        feed(click(1, "2024-01-05 12:00:00"))
        for i in range(5):
            path = feed(click(10 + i, "2024-01-05 10:00:00"), click(20 + i, f"2024-01-05 12:0{i}:30"))
        counts = windowed_counts(stream_files(spark, path, 1))
        query = drain(stream_to_files(counts, str(tmp_path / "out"), str(tmp_path / "log"), drain=True))
        assert len(query.recentProgress) <= 3
        out = spark.read.schema(counts.schema).parquet(str(tmp_path / "out"))
        # rows are late by the watermark of the batch before theirs, so the second batch's still counts
        assert rows_of(out, F.hour("window_start"), "event_count") == [(10, 1)]
        wait_for(lambda: late_rows.dropped(query) >= 4)
        assert late_rows.dropped(query) == 4 > sum(
            op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
        )
    finally:
        spark.conf.set(key, kept)
        spark.streams.removeListener(late_rows)


def test_exact_users_per_window(spark, feed, tmp_path):
    path = feed(
        *[click(i, f"2024-01-05 10:0{i}:00", user=i % 2) for i in range(5)], click(8, "2024-01-05 15:00:00", user=3)
    )
    users = windowed_users(stream_files(spark, path))
    drain(stream_to_files(users, str(tmp_path / "out"), str(tmp_path / "log"), drain=True))
    out = spark.read.schema(users.schema).parquet(str(tmp_path / "out"))
    assert rows_of(out, "event_count", "unique_users") == [(5, 2)]


@pytest.mark.parametrize("salts", [1, 8])
def test_stream_dedup_across_batches(spark, feed, tmp_path, salts):
    feed(click(1, "2024-01-05 10:00:00"), click(2, "2024-01-05 10:01:00"))
    path = feed(click(1, "2024-01-05 10:00:00", updated="2024-01-05 10:30:00"), click(3, "2024-01-05 10:02:00"))
    rows = first_versions(stream_files(spark, path, 1), salts=salts)
    drain(stream_to_files(rows, str(tmp_path / "out"), str(tmp_path / "log"), drain=True))
    out = spark.read.schema(CLICKS).parquet(str(tmp_path / "out"))
    assert rows_of(out, "click_id") == [(1,), (2,), (3,)]


def test_stream_to_silver_equals_batch_also_after_restart_and_replay(spark, clicks, feed, tmp_path):
    lake, log = Lake(str(tmp_path / "lake")), str(tmp_path / "log")
    batches = [
        day_of_clicks("2024-01-05", 30, 0),
        [click(3, "2024-01-06 10:00:00", "click", updated="2024-01-06 11:00:00"), *day_of_clicks("2024-01-06", 20, 100)],
        [click(4, "2024-01-05 01:00:00", "error", updated="2024-01-06 12:00:00"), click(500, "2024-01-05 02:00:00")],
    ]
    for rows in batches[:2]:
        path = feed(*rows)
    drain(stream_to_silver(stream_files(spark, path, 1), lake, log, drain=True))
    feed(*batches[2])
    drain(stream_to_silver(stream_files(spark, path, 1), lake, log, drain=True))
    expected = rows_of(refine(clicks(*[r for b in batches for r in b])), *PLAIN)
    assert rows_of(read_silver(spark, lake), *PLAIN) == expected
    assert read_bronze(spark, lake).count() == 53

    drain(stream_to_silver(stream_files(spark, path), lake, str(tmp_path / "replay"), drain=True))
    assert rows_of(read_silver(spark, lake), *PLAIN) == expected

    tail = changed_since(stream_files(spark, path), "2024-01-05 02:00:00")
    drain(stream_to_silver(tail, lake, str(tmp_path / "part"), drain=True))
    assert rows_of(read_silver(spark, lake), *PLAIN) == expected


def test_history_then_live_equals_batch(spark, clicks, feed, tmp_path):
    rows = [*day_of_clicks("2024-01-05", 20, 0), *day_of_clicks("2024-01-06", 20, 10)]
    path, data = feed(*rows), str(tmp_path / "data")
    live = changed_since(stream_files(spark, path), "2024-01-06")
    drain(stream_to_bronze(live, data, str(tmp_path / "log"), drain=True))
    streamed = spark.read.schema(CLICKS).parquet(data).select(*CLICKS.fieldNames())
    assert 0 < streamed.count() < 40
    both = history_and_live(clicks(*rows), streamed, "2024-01-06")
    assert rows_of(refine(both)) == rows_of(refine(history_and_live(clicks(*rows), clicks(*rows), "2024-01-06")))


def test_messages_decode_to_clicks(spark):
    message = {"click_id": 7, "user_id": 2, "event_type": "click", "event_timestamp": "2024-01-05T10:00:00Z"}
    df = spark.createDataFrame([(bytearray(json.dumps(message), "utf8"),)], "value binary")
    row = decode_messages(df).select("click_id", "event_type", F.hour("event_timestamp"), "page_url").first()
    assert tuple(row) == (7, "click", 10, None)


def test_replay_positions_of_a_topic():
    assert topic_options("h:1")["startingOffsets"] == "earliest"
    assert topic_options("h:1", start="latest")["startingOffsets"] == "latest"
    assert topic_options("h:1", start="2024-01-01")["startingTimestamp"] == "1704067200000"
    assert topic_options("h:1")["subscribe"] == "clicks"


def test_malformed_messages_are_kept_apart(spark, tmp_path):
    good = json.dumps({"click_id": 7, "user_id": 2, "event_type": "click", "event_timestamp": "2024-01-05T10:00:00Z", "updated_at": "2024-01-05T10:00:00Z"})
    texts = [good, "{broken", '{"click_id": "x"}', "[]", None]
    spark.createDataFrame([(t,) for t in texts], "value string").write.parquet(str(tmp_path / "topic"))
    messages = spark.readStream.schema("value string").parquet(str(tmp_path / "topic"))
    lake = Lake(str(tmp_path / "lake"))
    drain(stream_to_silver(decode_messages(messages), lake, str(tmp_path / "log"), drain=True))
    assert rows_of(read_silver(spark, lake), "click_id") == [(7,)]
    rejected = spark.read.parquet(f"{lake.root}/rejected/clicks")
    assert rejected.count() == 4 and ("{broken",) in rows_of(rejected, "malformed")


def test_exact_copies_of_a_hot_key_are_spread_and_left_once(spark, feed, tmp_path):
    path = feed(*[click(1, "2024-01-05 10:00:00")] * 400)
    rows = first_versions(stream_files(spark, path))
    query = drain(stream_to_files(rows, str(tmp_path / "out"), str(tmp_path / "log"), drain=True))
    assert spark.read.schema(CLICKS).parquet(str(tmp_path / "out")).count() == 1
    states = [op for p in query.recentProgress for op in p["stateOperators"]]
    assert max(op["numRowsTotal"] for op in states) == 8
    assert any("rocksdb" in name for op in states for name in op["customMetrics"])
