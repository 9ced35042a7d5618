from datetime import date

import pytest
from pyspark.sql import functions as F

from clicklake.operators.cleaning import clean_clicks, cleaning_report, duplicate_report
from clicklake.operators.rebuild import refine
from clicklake.operators.slices import (
    changed_between,
    day_with_late,
    history_and_live,
    late_slice,
)
from clicklake.operators.versions import latest_versions, union_versions
from conftest import click, rows_of

AT = "2024-01-05 10:00:00"


def test_clean_drops_nulls_and_unknown_types(clicks):
    df = clicks(
        click(1, AT, "page_view"),
        click(None, AT),
        click(2, AT, user=None),
        click(3, AT, None),
        click(4, AT, "form_submit"),
        click(5, AT, "scroll"),
        click(6, AT, "purchase"),
        click(7, AT, "click"),
    )
    assert rows_of(clean_clicks(df), "click_id") == [(1,), (5,), (6,), (7,)]


def test_cleaning_report(clicks):
    df = clicks(click(1, AT), click(2, AT, url="nohost"), click(3, AT, None), click(4, AT, url=None))
    assert cleaning_report(df).first().asDict() == {
        "rows_before": 4, "rows_after": 3, "empty_domain": 1, "undated": 0, "kept_pct": 75.0,
    }
    assert cleaning_report(df.limit(0)).first().asDict() == {
        "rows_before": 0, "rows_after": 0, "empty_domain": 0, "undated": 0, "kept_pct": 0.0,
    }


def test_latest_version_wins_and_is_counted(clicks):
    df = clicks(
        click(1, AT, "click", updated="2024-01-05 11:00:00"),
        click(1, AT, "scroll", updated="2024-01-05 12:00:00"),
        click(2, AT),
    )
    assert rows_of(latest_versions(df), "click_id", "event_type") == [(1, "scroll"), (2, "page_view")]
    assert duplicate_report(df).first().asDict() == {"rows_before": 3, "rows_after": 2, "duplicates": 1}


def test_null_change_time_loses(clicks):
    old = click(1, AT, "click")
    df = clicks(click(1, AT, "scroll").__class__(*[*click(1, AT, "scroll")[:-1], None]), old)
    assert rows_of(latest_versions(df), "event_type") == [("click",)]


def test_ties_do_not_depend_on_partitioning(spark, clicks):
    rows = [click(1, AT, kind, url=f"https://h{i}/") for i, kind in enumerate(["click", "scroll", "page_view"] * 4)]
    df = clicks(*rows)
    winners = {
        tuple(latest_versions(frame).first())
        for frame in (df.coalesce(1), df.repartition(7), df.orderBy(F.desc("page_url")), clicks(*rows[::-1]))
    }
    assert len(winners) == 1


def test_invalid_newest_version_does_not_hide_a_valid_one(clicks):
    df = clicks(
        click(1, AT, "click", updated="2024-01-05 11:00:00"),
        click(1, AT, "video_play", updated="2024-01-05 12:00:00"),
    )
    assert rows_of(refine(df), "click_id", "event_type") == [(1, "click")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """Half of all rows share one key: each map task must send at most one row for it."""
    rows = spark.range(0, 20_000, 1, 4).select(
        F.when(F.col("id") % 2 == 0, F.lit(-7)).otherwise(F.col("id")).alias("click_id"),
        F.lit("x").alias("session_id"), F.lit("u").alias("page_url"), F.lit("click").alias("event_type"),
        F.timestamp_seconds("id").alias("event_timestamp"), F.lit("a").alias("user_agent"),
        F.lit(None).cast("string").alias("ip_address"), F.lit(None).cast("string").alias("referrer_url"),
        F.timestamp_seconds("id").alias("created_at"), F.timestamp_seconds("id").alias("updated_at"),
        F.lit(1).cast("long").alias("user_id"),
    )
    out = latest_versions(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(click_id")
    assert "row_number(), 1, Partial" in plan[exchange:]
    assert out.count() == 10_000 + 1
    assert out.filter("click_id = -7").select(F.unix_timestamp("updated_at")).first()[0] == 19_998


def test_extract_window_is_half_open(clicks):
    df = clicks(
        click(1, AT, updated="2024-01-04 23:59:59.999999"),
        click(2, AT, updated="2024-01-05 00:00:00"),
        click(3, AT, updated="2024-01-05 23:59:59.999999"),
        click(4, AT, updated="2024-01-06 00:00:00"),
    )
    assert rows_of(changed_between(df, date(2024, 1, 5), "2024-01-06"), "click_id") == [(2,), (3,)]
    assert changed_between(df, "2024-01-05", "2024-01-05").count() == 0


def test_late_slice_and_union(clicks):
    df = clicks(
        click(1, "2024-01-14 12:00:00", updated="2024-01-15 01:00:00"),
        click(2, "2024-01-08 00:00:00", updated="2024-01-15 01:00:00"),
        click(3, "2024-01-07 23:59:59", updated="2024-01-15 01:00:00"),
        click(4, "2024-01-15 00:00:00", updated="2024-01-15 01:00:00"),
        click(5, "2024-01-14 12:00:00", updated="2024-01-16 01:00:00"),
    )
    assert rows_of(late_slice(df, "2024-01-15"), "click_id") == [(1,), (2,)]
    assert rows_of(day_with_late(df, "2024-01-15"), "click_id") == [(1,), (2,), (3,), (4,)]


def test_union_fills_missing_columns(clicks):
    new = clicks(click(1, AT, updated="2024-01-06 00:00:00"))
    old = clicks(click(1, AT), click(2, AT)).withColumn("batch_id", F.lit("b"))
    assert rows_of(union_versions(new, old), "click_id", "batch_id") == [(1, None), (2, "b")]


@pytest.mark.parametrize("cutover", ["2024-01-05", "2024-01-06", "2024-01-09"])
def test_history_and_live_equal_full_batch(clicks, cutover):
    df = clicks(
        *[click(i % 5, AT, url=f"https://h{i}/", updated=f"2024-01-0{5 + i % 4} 0{i}:00:00") for i in range(10)]
    )
    assert rows_of(history_and_live(df, df, cutover)) == rows_of(latest_versions(df))
