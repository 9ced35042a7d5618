"""What a feed with late rows costs: steps that ran one after the other, or twice, in every batch and in the repair."""

import threading
from datetime import date, datetime, timezone

import pytest
from clicklake.operators import rebuild
from clicklake.operators.cleaning import valid_row
from clicklake.operators.rebuild import competing_rows, key_blocks, refine, refine_dates, rows_on
from clicklake.plans import bronze as bronze_plan
from clicklake.plans.bronze import land, with_metadata
from clicklake.plans.silver import rebuild_silver
from clicklake.schemas import BATCH_LOG, CLICK_TABLE
from clicklake.sources.derived import SECONDS, feed_files
from clicklake.sources.lake import Lake, log_batch, read_batch_log, read_bronze, read_silver
from clicklake.streaming import jobs
from clicklake.streaming.jobs import late_rows, repair_late, stream_to_silver
from clicklake.streaming.sources import stream_files
from conftest import click, rows_of
from pyspark.sql import functions as F

D5, D6, D7 = date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7)
PLAIN = ["click_id", "user_id", "event_type", "event_timestamp", "updated_at", "domain", "event_date"]


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def test_a_middling_feed_is_written_by_more_than_a_few_tasks():
    assert [feed_files(n) for n in (0, 600_000, 6_000_000, 7_200_000, 36_000_000, 72_000_000)] == [2, 2, 20, 24, 24, 48]


def test_seconds_of_odd_properties_are_those_of_the_parser(spark):
    texts = ['{"k": 5}', '{"k": 0}', '{"k": 024}', '{"k": 5}\n', '{"k":5}', '{"k": "7"}', '{"k": 1.5}', '{"k": 123456789}', '{"k": 1234567890}',
             '{"k": -3}', "", "{}", '{"k": null}', "x", '{"k": 5}}', '[{"k": 5}]', '{"a": 1, "k": 5}', '{"k": 5, "k": 6}', ' {"k": 5}', None]
    rows = spark.createDataFrame([(t,) for t in texts], "props string")
    assert rows.where(f"NOT ({SECONDS} <=> get_json_object(props, '$.k'))").count() == 0
    assert rows.selectExpr(SECONDS).distinct().count() > 5


def test_an_entry_of_the_batch_log_is_made_without_python_rows(spark, lake, monkeypatch):
    def unasked(*args, **options):
        raise AssertionError("rows made in Python")

    began = datetime(2024, 1, 5, 10, 0, 0, 123456, tzinfo=timezone.utc)
    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "createDataFrame", unasked)
        log_batch(spark, lake, "b1", "bronze.clicks", 2**40, began)
        log_batch(spark, lake, "b2", "gold.x", 0, success=False)
    logged = spark.read.parquet(lake.batch_log)
    assert [(f.name, f.dataType) for f in logged.schema] == [(f.name, f.dataType) for f in BATCH_LOG]
    micros = F.unix_micros("started_at") == F.lit(int(began.timestamp()) * 10**6 + 123456)
    assert rows_of(read_batch_log(spark, lake), "batch_id", "table", "rows", micros, "success")[0] == ("b1", "bronze.clicks", 2**40, True, True)
    assert rows_of(read_batch_log(spark, lake), "batch_id", "success", F.expr("started_at = finished_at"))[1] == ("b2", False, True)


def test_a_rebuild_looks_at_the_rows_on_its_dates_once(spark, clicks, lake, monkeypatch):
    rows = [click(i << 20, f"2024-01-0{5 + i % 3} 10:00:00", updated=f"2024-01-0{6 + i % 3} 10:00:00") for i in range(40)]
    rows += [click(None, "2024-01-05 11:00:00"), click(3 << 20, "2024-01-05 12:00:00", "unknown"), click(5 << 20, "2024-01-06 12:00:00", user=None)]
    raw = with_metadata(clicks(*rows, rows[0]), "b")
    undated = raw.withColumn("extract_date", F.when(F.col("click_id") != 1 << 20, F.col("extract_date")))
    for held in (raw, undated, raw.limit(0), raw.where("click_id IS NULL"), raw.where("click_id = 7")):
        for dates in ([D6], [D5, D7], [date(2024, 2, 1)]):
            found = rows_on(held, dates)
            on_dates = valid_row(CLICK_TABLE) & F.to_date("event_timestamp").isin(dates)
            assert sorted(found.blocks) == sorted(key_blocks(held.where(on_dates).select("click_id"), CLICK_TABLE))
            competing = competing_rows(held, dates, found=found)
            assert rows_of(competing) == rows_of(competing_rows(held, dates))
            assert rows_of(refine_dates(competing, dates, found=found)) == rows_of(refine(held).where(F.col("event_date").isin(dates)))
    landed = land(spark, lake, clicks(*rows), D5, date(2024, 1, 10))

    def again(*args, **options):
        raise AssertionError("a second scan")

    monkeypatch.setattr(rebuild, "key_blocks", again)
    rebuild_silver(spark, lake, landed.event_dates)
    assert rows_of(read_silver(spark, lake), *PLAIN) == rows_of(refine(clicks(*rows)), *PLAIN)


def test_the_index_is_asked_while_new_keys_are_added(spark, clicks, lake, monkeypatch):
    land(spark, lake, clicks(click(1, "2024-01-05 10:00:00"), click(2, "2024-01-05 10:00:00")), D5, D6)
    adding, add, told = threading.Event(), bronze_plan.add_keys, bronze_plan.date_list

    def asked(dates):
        assert adding.wait(60)
        return told(dates)

    monkeypatch.setattr(bronze_plan, "date_list", asked)
    monkeypatch.setattr(bronze_plan, "add_keys", lambda *a: (adding.set(), add(*a)))
    later = [click(1, "2024-01-06 10:00:00"), click(3, "2024-01-06 10:00:00")]
    assert land(spark, lake, clicks(*later), D6, D7).event_dates == [D5, D6]

    def fail(dates):
        raise OSError("look-up")

    monkeypatch.setattr(bronze_plan, "date_list", fail)
    with pytest.raises(OSError, match="look-up"):  # nothing landed, and the next attempt finds the same dates
        land(spark, lake, clicks(click(2, "2024-01-07 10:00:00")), D7, date(2024, 1, 8))
    assert read_bronze(spark, lake).count() == 4
    monkeypatch.setattr(bronze_plan, "date_list", told)
    assert land(spark, lake, clicks(click(2, "2024-01-07 10:00:00")), D7, date(2024, 1, 8)).event_dates == [D5, D7]


def test_late_rows_are_staged_while_the_others_land(spark, clicks, lake, tmp_path, monkeypatch):
    path, landing, land_batch, stage = str(tmp_path / "feed"), threading.Event(), jobs.land_batch, jobs.stage
    batches = [[click(1, "2024-01-06 10:00:00")], [click(2, "2024-01-05 10:00:00"), click(3, "2024-01-06 11:00:00")]]
    for rows in batches:
        clicks(*rows).coalesce(1).write.mode("append").parquet(path)

    def staged(*args, **options):
        assert landing.wait(60)
        return stage(*args, **options)

    def landed(rows, lake, run, number, *rest):
        if number == 1:
            landing.set()
        return land_batch(rows, lake, run, number, *rest)

    monkeypatch.setattr(jobs, "stage", staged)
    monkeypatch.setattr(jobs, "land_batch", landed)
    stream_to_silver(stream_files(spark, path, 1), lake, str(tmp_path / "log"), drain=True, delay="10 minutes").awaitTermination()
    assert late_rows(spark, lake) == 1 and rows_of(read_bronze(spark, lake), "click_id") == [(1,), (3,)]
    assert repair_late(spark, lake) == 1
    assert rows_of(read_silver(spark, lake), *PLAIN) == rows_of(refine(clicks(*batches[0], *batches[1])), *PLAIN)
