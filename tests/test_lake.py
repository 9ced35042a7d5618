from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clicklake.operators.completeness import calendar, missing_dates, rows_per_date
from clicklake.plans.bronze import batch_name, days_between, land, with_metadata
from clicklake.plans.gate import validate_layer, warn_about_nulls
from clicklake.plans.gold import build_gold, build_sessions
from clicklake.plans.health import Layer, lake_health, layer_row_counts
from clicklake.plans.silver import rebuild_all_silver
from clicklake.schemas import CLICK_TABLE
from clicklake.sources.jdbc import jdbc_options
from clicklake.sources.lake import (
    Lake,
    VerificationError,
    clear_partitions,
    overwrite_partitions,
    read_batch_log,
    read_bronze,
    read_silver,
    read_table,
    read_with_evolution,
    preview,
    verify_rows,
    write_idempotent,
)
from conftest import click, day_of_clicks, rows_of

D5, D6, D7 = date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path))


def test_batch_name_and_days():
    assert batch_name(datetime(2024, 3, 2, 1, 2, 3)) == "batch_20240302_010203"
    assert days_between(D5, D7) == [D5, D6]
    assert days_between(D5, D5) == []


def test_metadata_by_given_day_or_by_row(clicks):
    df = clicks(click(1, "2024-01-05 23:00:00", updated="2024-01-06 00:10:00"))
    assert with_metadata(df, "b", D5).first().extract_date == D5
    row = with_metadata(df, "b").first()
    assert (row.extract_date, row.batch_id) == (D6, "b")


def test_second_day_keeps_the_first(spark, clicks, lake):
    source = clicks(click(1, "2024-01-05 10:00:00"), click(2, "2024-01-06 10:00:00"), click(3, "2024-01-06 11:00:00"))
    assert land(spark, lake, source, D5, D6, "b1").written.rows == 1
    assert land(spark, lake, source, D6, D7, "b2").written.rows == 2
    assert rows_of(read_bronze(spark, lake), "extract_date", "click_id", "batch_id") == [
        (D5, 1, "b1"), (D6, 2, "b2"), (D6, 3, "b2"),
    ]
    assert read_bronze(spark, lake, D6).count() == 2
    assert read_bronze(spark, lake, end=D6).count() == 1


def test_range_lands_each_row_on_its_own_day(spark, clicks, lake):
    source = clicks(*day_of_clicks("2024-01-05", 20, 0), *day_of_clicks("2024-01-06", 30, 100))
    land(spark, lake, source, D5, D7)
    assert rows_of(rows_per_date(read_bronze(spark, lake), "extract_date", "b"), "date", "rows") == [(D5, 20), (D6, 30)]


def test_empty_rerun_empties_the_partition(spark, clicks, lake):
    source = clicks(click(1, "2024-01-05 10:00:00"), click(2, "2024-01-06 10:00:00"))
    land(spark, lake, source, D5, D7)
    landed = land(spark, lake, source.filter("click_id = 2"), D5, D6)
    assert (landed.written.rows, landed.event_dates) == (0, [D5])
    assert rows_of(read_bronze(spark, lake), "click_id") == [(2,)]


def test_one_day_window_is_empty(spark, clicks, lake):
    assert land(spark, lake, clicks(click(1, "2024-01-05 10:00:00")), D5, D5).written.rows == 0


def test_verification_compares_with_what_was_written(spark, clicks, lake):
    land(spark, lake, clicks(click(1, "2024-01-05 10:00:00")), D5, D6)
    path, schema, where = lake.bronze(), CLICK_TABLE.bronze, F.col("extract_date") == F.lit(D5)
    assert verify_rows(spark, path, schema, where, 1) == 1
    with pytest.raises(VerificationError, match="1 rows stored, 2 written"):
        verify_rows(spark, path, schema, where, 2)


def test_same_batch_twice_leaves_the_same_rows(spark, clicks, lake):
    rows = with_metadata(clicks(*day_of_clicks("2024-01-05", 25, 0)), "b1")
    for _ in range(2):
        assert write_idempotent(spark, rows, lake, lake.bronze(), "extract_date", "b1", "bronze.clicks").rows == 25
    assert read_bronze(spark, lake).count() == 25
    log = read_batch_log(spark, lake).collect()
    assert [(r.batch_id, r.table, r.rows) for r in log] == [("b1", "bronze.clicks", 25)] * 2
    age = datetime.now(timezone.utc) - log[0].finished_at.astimezone(timezone.utc)
    assert abs(age.total_seconds()) < 86_400


def test_missing_table_reads_as_empty(spark, lake):
    assert read_bronze(spark, lake).count() == 0
    assert clear_partitions(spark, lake.bronze(), CLICK_TABLE.bronze, "extract_date", [D5]) == []


def test_partition_filter_prunes_and_columns_are_pruned(spark, clicks, lake):
    source = clicks(*day_of_clicks("2024-01-05", 20, 0), *day_of_clicks("2024-01-06", 30, 100))
    land(spark, lake, source, D5, D7)
    df = read_bronze(spark, lake, D6).select("click_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "extract_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "ReadSchema: struct<click_id:bigint>" in plan
    assert df.count() == 30


def test_new_columns_are_null_in_old_files(spark, clicks, lake):
    overwrite_partitions(with_metadata(clicks(click(1, "2024-01-05 10:00:00")), "a"), lake.bronze(), "extract_date")
    newer = with_metadata(clicks(click(2, "2024-01-06 10:00:00")), "b").withColumn("country", F.lit("pt"))
    overwrite_partitions(newer, lake.bronze(), "extract_date")
    assert rows_of(read_with_evolution(spark, lake.bronze()), "click_id", "country") == [(1, None), (2, "pt")]
    declared = CLICK_TABLE.bronze.add("country", "string")
    assert rows_of(read_table(spark, lake.bronze(), declared), "click_id", "country") == [(1, None), (2, "pt")]


def test_gold_has_its_date_in_the_path_only(spark, clicks, lake):
    land(spark, lake, clicks(*day_of_clicks("2024-01-05", 40, 0), *day_of_clicks("2024-01-06", 40, 100)), D5, D7)
    rebuild_all_silver(spark, lake)
    report = build_gold(spark, lake)
    assert not report.failures and set(report.written["daily_metrics"].dates) == {D5, D6}
    inside = spark.read.parquet(f"{lake.gold('daily_metrics')}/date=2024-01-05")
    assert "date" not in inside.columns
    before = rows_of(spark.read.parquet(lake.gold("user_summary")))
    build_gold(spark, lake, [D6])
    assert rows_of(spark.read.parquet(lake.gold("user_summary"))) == before
    assert build_sessions(spark, lake) == spark.read.parquet(lake.gold("user_sessions")).count() > 0


def test_stored_layers_validate(spark, clicks, lake):
    land(spark, lake, clicks(click(1, "2024-01-05 10:00:00"), click(None, "2024-01-05 11:00:00")), D5, D6)
    rebuild_all_silver(spark, lake)
    assert validate_layer(spark, lake.silver(), "silver").success
    assert not validate_layer(spark, lake.bronze(), "bronze").success
    assert warn_about_nulls(spark, lake, D5, D6) == {"total_rows": 2, "null_click_ids": 1}


def test_ranked_metric_files_keep_their_order(spark, clicks, lake):
    rows = [click(i, "2024-01-05 10:00:00", url=f"https://h{i * i % 7}/") for i in range(60)]
    land(spark, lake, clicks(*rows), D5, D6)
    rebuild_all_silver(spark, lake)
    build_gold(spark, lake, [D5], ["domain_metrics"])
    for file in Path(lake.gold("domain_metrics")).rglob("*.parquet"):
        views = [r.page_views for r in spark.read.parquet(str(file)).collect()]
        assert views == sorted(views, reverse=True)


def test_preview(spark, clicks):
    assert preview(clicks(*day_of_clicks("2024-01-05", 9, 0)), "click_id").count() == 5


def test_missing_dates(spark, clicks, lake):
    land(spark, lake, clicks(click(1, "2024-01-05 10:00:00"), click(2, "2024-01-07 10:00:00")), D5, date(2024, 1, 8))
    rebuild_all_silver(spark, lake)
    gaps = missing_dates(read_silver(spark, lake), "event_date", date(2024, 1, 4), date(2024, 1, 9))
    assert rows_of(gaps) == [(date(2024, 1, 4),), (D6,), (date(2024, 1, 8),)]
    assert calendar(spark, D5, D5).count() == 0


def test_health(spark, clicks, lake):
    land(spark, lake, clicks(click(1, "2024-01-05 10:00:00"), click(2, "2024-01-06 23:00:00", "error")), D5, D7)
    rebuild_all_silver(spark, lake)
    from clicklake.operators.quality import bronze_suite, silver_suite

    layers = [
        Layer("bronze", read_bronze(spark, lake), "extract_date", "updated_at", tuple(bronze_suite())),
        Layer("silver", read_silver(spark, lake), "event_date", "updated_at", tuple(silver_suite())),
        Layer("none", read_silver(spark, lake).limit(0), "event_date", "updated_at"),
    ]
    found = {r.layer: r for r in lake_health(layers, "2024-01-07 02:00:00", D5, D7).collect()}
    assert (found["bronze"].rows, found["bronze"].freshness_hours, found["bronze"].dates_missing) == (2, 3.0, 0)
    assert found["bronze"].pass_rate < 95 and found["bronze"].breached
    assert (found["silver"].dates_missing, found["silver"].freshness_hours, found["silver"].pass_rate) == (1, 40.0, 100)
    assert (found["none"].rows, found["none"].dates_missing, found["none"].breached) == (0, 2, True)
    assert rows_of(layer_row_counts(layers), "layer", "date", "rows") == [
        ("bronze", D5, 1), ("bronze", D6, 1), ("silver", D5, 1),
    ]


def test_jdbc_read_is_split_on_the_change_column():
    options = jdbc_options("jdbc:x", CLICK_TABLE, D5, D6, 8, user="u")
    assert options["partitionColumn"] == "updated_at" and options["numPartitions"] == "8"
    assert options["lowerBound"].startswith("2024-01-05 00:00:00") and options["user"] == "u"
