"""Streams over several files: merged commits, late rows, hand-over from history, replays, sessions closed by a gap."""

from datetime import date, datetime, timezone

import pytest
from clicklake.operators.rebuild import refine
from clicklake.plans import silver as silver_plan
from clicklake.schemas import CLICK_TABLE
from clicklake.sources.derived import SLICES, as_feed, feed_files, write_feed
from clicklake.sources.lake import Lake, read_bronze, read_silver
from clicklake.sources.snapshots import current, names_in
from clicklake.streaming import jobs
from clicklake.streaming.jobs import hybrid_run, late_rows, repair_late, replay, stream_to_bronze, stream_to_files, stream_to_silver
from clicklake.streaming.operators import live_sessions
from clicklake.streaming.positions import batch_at, batches, files_by_batch, stored_state, watermark_of
from clicklake.streaming.sources import stream_files
from conftest import click, rows_of
from pyspark.sql import functions as F

PLAIN = ["click_id", "user_id", "event_type", "event_timestamp", "updated_at", "domain", "event_date"]


@pytest.fixture
def feed(clicks, tmp_path):
    folder = tmp_path / "feed"

    def add(*rows):
        clicks(*rows).coalesce(1).write.mode("append").parquet(str(folder))
        return str(folder)

    return add


def test_listing_stays_constant_over_many_batches(spark, clicks, tmp_path, monkeypatch):
    """Eighty micro-batches of two days; refining is left to the end."""
    monkeypatch.setattr(jobs, "rebuild_silver", lambda *a: None)
    lake, rows, most = Lake(str(tmp_path / "lake")), [], 0
    for number in range(80):
        batch = [click(number, f"2024-01-0{5 + number % 2} 10:00:00"), click(number // 2, "2024-01-05 09:00:00", updated="2024-01-06 12:00:00")]
        rows += batch
        jobs.land_batch(clicks(*batch).coalesce(1), lake, "run", number, most=4)
        if number % 25 == 24:
            held = current(spark, lake.bronze())
            most = max(most, len(held.entries), len(current(spark, lake.keys()).entries))
            assert len(names_in(spark, lake.bronze())) < 60
    assert most <= 2 * 5 + 9
    jobs.land_batch(clicks(*batch), lake, "run", 79)  # the last batch again: it landed, and was merged since
    assert read_bronze(spark, lake).count() == len(rows)
    monkeypatch.undo()
    silver_plan.rebuild_silver(spark, lake, [])
    assert rows_of(read_silver(spark, lake), *PLAIN) == rows_of(refine(clicks(*rows)), *PLAIN)


def late_feed(feed):
    first = [click(i, f"2024-01-05 1{i}:00:00") for i in range(5)]
    feed(*first)
    feed(click(10, "2024-01-06 10:00:00"), click(11, "2024-01-06 11:00:00"))
    late = [click(1, "2024-01-05 11:00:00", "purchase", updated="2024-01-06 12:00:00"), click(20, "2024-01-05 09:00:00", updated="2024-01-06 12:30:00")]
    return feed(*late, click(12, "2024-01-06 12:00:00"))


def test_late_rows_are_set_aside_counted_and_repaired(spark, clicks, feed, tmp_path, monkeypatch):
    lake, log, path = Lake(str(tmp_path / "lake")), str(tmp_path / "log"), late_feed(feed)
    stream_to_silver(stream_files(spark, path, 1), lake, log, drain=True, delay="10 minutes").awaitTermination()
    assert late_rows(spark, lake) == 2
    assert read_bronze(spark, lake).count() == 8 and read_silver(spark, lake).filter("click_id = 20").count() == 0
    feed(click(21, "2024-01-05 08:00:00", updated="2024-01-06 13:00:00"))
    stream_to_silver(stream_files(spark, path, 1), lake, log, drain=True, delay="10 minutes").awaitTermination()
    assert late_rows(spark, lake) == 3  # counted on after a restart
    assert watermark_of(spark, log, batches(spark, log)[-1]) == datetime(2024, 1, 6, 11, 50, tzinfo=timezone.utc).timestamp() * 1000

    def die(*args, **options):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(jobs, "rebuild_silver", die)
        repair_late(spark, lake)
    assert repair_late(spark, lake) == 3 and repair_late(spark, lake) == 0
    assert read_bronze(spark, lake).count() == 11
    assert rows_of(read_silver(spark, lake), *PLAIN) == rows_of(refine(spark.read.schema(CLICK_TABLE.schema).parquet(path)), *PLAIN)


def test_history_is_handed_over_without_a_gap(spark, clicks, feed, tmp_path):
    lake, log, path = Lake(str(tmp_path / "lake")), str(tmp_path / "log"), late_feed(feed)
    history = spark.read.schema(CLICK_TABLE.schema).parquet(path).filter("click_id <> 20")
    hybrid_run(spark, lake, history, stream_files(spark, path, 1), "2024-01-06 12:30:00", log, drain=True).awaitTermination()
    full = spark.read.schema(CLICK_TABLE.schema).parquet(path)
    assert rows_of(read_silver(spark, lake), *PLAIN) == rows_of(refine(full), *PLAIN)
    assert rows_of(read_bronze(spark, lake).select("click_id")) == rows_of(full.select("click_id"))
    feed(click(1, "2024-01-05 11:00:00", "scroll", updated="2024-01-07 01:00:00"), click(30, "2024-01-04 11:00:00", updated="2024-01-05 11:00:00"))
    hybrid_run(spark, lake, history, stream_files(spark, path, 1), "2024-01-06 12:30:00", log, drain=True).awaitTermination()
    assert rows_of(read_silver(spark, lake), *PLAIN) == rows_of(refine(spark.read.schema(CLICK_TABLE.schema).parquet(path)), *PLAIN)
    with pytest.raises(ValueError, match="handed over"):
        hybrid_run(spark, lake, history, stream_files(spark, path, 1), "2024-01-07", log, drain=True)


def test_replay_from_a_recorded_position(spark, clicks, feed, tmp_path):
    path, log = late_feed(feed), str(tmp_path / "log")
    stream_to_bronze(stream_files(spark, path, 1), str(tmp_path / "data"), log, drain=True).awaitTermination()
    assert list(files_by_batch(spark, log)) == batches(spark, log) == [0, 1, 2]
    assert batch_at(spark, log, "2020-01-01") == 0 and batch_at(spark, log, date(2200, 1, 1)) is None
    lake = Lake(str(tmp_path / "lake"))
    assert replay(spark, lake, log, 1) == 2
    assert rows_of(read_silver(spark, lake), "click_id") == [(1,), (10,), (11,), (12,), (20,)]
    assert replay(spark, lake, log, 0) == 3 and replay(spark, lake, log, 9) == 0
    assert rows_of(read_silver(spark, lake), *PLAIN) == rows_of(refine(spark.read.schema(CLICK_TABLE.schema).parquet(path)), *PLAIN)


def test_sessions_close_by_a_gap_across_batches(spark, feed, tmp_path):
    feed(click(1, "2024-01-05 10:00:00"), click(2, "2024-01-05 10:20:00", "click"), click(3, "2024-01-05 10:25:00", user=2))
    path = feed(click(4, "2024-01-05 10:45:00"), click(5, "2024-01-05 12:00:00", user=None), click(6, "2024-01-05 11:50:00"))
    log = str(tmp_path / "log")
    sessions = live_sessions(stream_files(spark, path, 1))
    stream_to_files(sessions, str(tmp_path / "out"), log, drain=True).awaitTermination()
    out = spark.read.schema(sessions.schema).parquet(str(tmp_path / "out"))
    at = lambda text: datetime.fromisoformat(f"2024-01-05 {text}")
    want = [(1, at("10:00"), at("10:45"), 3, 2), (2, at("10:25"), at("10:25"), 1, 1)]
    assert rows_of(out, "user_id", "started_at", "ended_at", "event_count", "page_views_count") == want
    assert stored_state(spark, log).count() >= 1  # the session that is still open


def test_a_large_feed_has_more_files_and_each_slice_is_one_batch(spark, clicks, tmp_path):
    """Slices with fewer rows than files, and one without rows, still fill a batch each."""
    assert feed_files(100_000) == 2 and feed_files(36_000_000) == 24
    rows = clicks(*[click(i, f"2024-01-{day:02d} 10:00:00") for i, day in enumerate((1, 2, 7, 17, 18, 22, 28, 29, 30))])
    write_feed(rows, str(tmp_path / "feed"), 3)
    log = str(tmp_path / "log")
    stream_to_bronze(stream_files(spark, str(tmp_path / "feed"), 3), str(tmp_path / "raw"), log, drain=True).awaitTermination()
    taken = files_by_batch(spark, log)
    assert [len(files) for files in taken.values()] == [3] * SLICES
    columns = ["click_id", "event_timestamp", "updated_at"]
    for number, files in taken.items():
        wanted = as_feed(rows).filter(f"arrival = {number}")
        assert rows_of(spark.read.schema(CLICK_TABLE.schema).parquet(*files), *columns) == rows_of(wanted, *columns)
        assert rows_of(as_feed(rows, [number]), *columns, "arrival") == rows_of(wanted, *columns, "arrival")


def test_a_replay_rebuilds_the_refined_dates_once(spark, feed, tmp_path, monkeypatch):
    lake, log, path = Lake(str(tmp_path / "lake")), str(tmp_path / "log"), late_feed(feed)
    stream_to_bronze(stream_files(spark, path, 1), str(tmp_path / "raw"), log, drain=True).awaitTermination()
    rebuild, calls = jobs.rebuild_silver, []
    monkeypatch.setattr(jobs, "rebuild_silver", lambda *a: calls.append(a) or rebuild(*a))
    assert replay(spark, lake, log, 0) == 3 and len(calls) == 1
    assert rows_of(read_silver(spark, lake), *PLAIN) == rows_of(refine(spark.read.schema(CLICK_TABLE.schema).parquet(path)), *PLAIN)


def test_slices_of_a_feed_have_their_days(spark, clicks):
    """Rows without an event time belong to the first slice, days outside all slices to the outer ones."""
    stamps = ["2023-12-01 00:00:00", "2024-01-05 23:59:59.999999", "2024-01-06 00:00:00", "2024-01-25 23:59:59", "2024-01-26 00:00:00", "2024-03-01 00:00:00"]
    rows = clicks(*[click(77 * 31 * i, at) for i, at in enumerate(stamps)])
    undated = rows.limit(1).selectExpr("* EXCEPT (event_timestamp)", "CAST(NULL AS TIMESTAMP) AS event_timestamp").withColumn("click_id", F.lit(-77 * 31))
    found = as_feed(undated.unionByName(rows)).groupBy("click_id").agg(F.min("arrival"))
    assert [n for _, n in sorted(map(tuple, found.collect()))] == [0] * 3 + [1, 4, 5, 5]


def test_a_feed_is_dealt_to_its_files_by_hash(spark, clicks, tmp_path):
    """Exact copies share a file: rows dealt in turn would part them, and be sorted before to be dealt alike by each attempt."""
    write_feed(clicks(*[click(11 * i + 2, "2024-01-08 10:00:00") for i in range(60)]), str(tmp_path / "feed"), 3)
    held = spark.read.schema(CLICK_TABLE.schema).parquet(str(tmp_path / "feed")).filter("updated_at < '2024-01-09'")
    per_file = held.groupBy("click_id", F.input_file_name()).count()
    assert held.count() == 120 and rows_of(per_file.select("count")) == [(2,)] * 60
    assert per_file.select("input_file_name()").distinct().count() == 3
