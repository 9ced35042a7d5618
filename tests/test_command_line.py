import logging

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clicklake.__main__ import main, parser
from clicklake.operators.quality import SchemaError
from clicklake.plans.health import lake_health, stored_layers
from clicklake.operators.sessions import conversion_funnel, session_summary
from clicklake.schemas import SESSION_TABLE
from clicklake.sources.lake import Lake, read_bronze, read_silver
from conftest import click, rows_of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cli")
    assert main(["--lake", str(root / "lake"), "sample", "--output", str(root), "--clicks", "2000", "--sessions", "2000"]) == 0
    return root


def test_backfill_verify_and_quality(spark, folder):
    lake, clicks = str(folder / "lake"), str(folder / "clicks")
    days = ["2024-01-01", "2024-01-04"]
    assert main(["--lake", lake, "backfill", *days, "--source", clicks, "--dry-run"]) == 0
    assert read_bronze(spark, Lake(lake)).count() == 0
    assert main(["--lake", lake, "backfill", *days, "--source", clicks, "--gate", "bronze"]) == 0
    rows = read_silver(spark, Lake(lake)).count()
    assert rows == read_bronze(spark, Lake(lake)).count() > 0
    assert main(["--lake", lake, "verify-backfill", *days]) == 0
    assert main(["--lake", lake, "verify-backfill", "2023-12-31", "2024-01-04"]) == 1
    assert main(["--lake", lake, "quality", "--input", f"{lake}/bronze/clicks"]) == 0
    assert main(["--lake", lake, "quality", "--input", f"{lake}/silver/clicks", "--layer", "silver"]) == 0
    assert main(["--lake", lake, "quality", "--input", clicks, "--layer", "silver"]) == 1
    assert main(["--lake", lake, "validate", "--date", "2024-01-02"]) == 0
    assert main(["--lake", lake, "run-day", "2024-01-04", "--source", clicks]) == 0
    assert read_silver(spark, Lake(lake)).count() > rows


def test_stages_one_by_one_equal_a_backfill(spark, folder):
    clicks, days = str(folder / "clicks"), ["2024-01-01", "2024-01-04"]
    one, two = str(folder / "one"), str(folder / "two")
    assert main(["--lake", one, "backfill", *days, "--source", clicks]) == 0
    assert main(["--lake", two, "bronze", *days, "--source", clicks]) == 0
    assert main(["--lake", two, "silver", *days]) == 0
    assert main(["--lake", two, "gold"]) == 0
    for metric in ("daily_metrics", "user_summary"):
        assert rows_of(spark.read.parquet(Lake(one).gold(metric))) == rows_of(spark.read.parquet(Lake(two).gold(metric)))
    before = rows_of(read_silver(spark, Lake(two)))
    assert main(["--lake", two, "silver", *days, "--full"]) == 0
    assert rows_of(read_silver(spark, Lake(two))) == before
    assert main(["--lake", two, "gold", "--date", "2024-01-02"]) == 0


def test_sessions_go_through_all_their_layers(spark, folder):
    lake, days = str(folder / "sessions_lake"), ["2024-01-01", "2024-01-05"]
    source = ["--source", str(folder / "sessions"), "--table", "sessions"]
    assert main(["--lake", lake, "bronze", *days, *source]) == 0
    assert main(["--lake", lake, "silver", *days, "--table", "sessions"]) == 0
    rows = rows_of(read_silver(spark, Lake(lake), spec=SESSION_TABLE).drop("batch_id"))
    other = str(folder / "sessions_other")
    assert main(["--lake", other, "backfill", *days, *source]) == 0
    assert rows_of(read_silver(spark, Lake(other), spec=SESSION_TABLE).drop("batch_id")) == rows != []
    assert main(["--lake", other, "run-day", "2024-01-05", *source]) == 0


def test_session_table_and_funnel(spark, folder):
    lake = str(folder / "summaries")
    assert main(["--lake", lake, "backfill", "2024-01-01", "2024-01-04", "--source", str(folder / "clicks")]) == 0
    for _ in range(2):
        assert main(["--lake", lake, "sessions"]) == 0
    silver = read_silver(spark, Lake(lake))
    for name, expected in (("user_sessions", session_summary(silver)), ("conversion_funnel", conversion_funnel(silver))):
        stored = spark.read.parquet(Lake(lake).gold(name))
        assert rows_of(stored, *expected.columns) == rows_of(expected, *expected.columns) != []


def test_a_missing_or_drifted_source_leaves_the_lake_as_it_is(spark, folder, caplog):
    lake, days = str(folder / "kept"), ["2024-01-01", "2024-01-03"]
    clicks = spark.read.parquet(str(folder / "clicks"))
    for name, changed in (
        ("lacking", clicks.drop("user_id")),
        ("retyped", clicks.withColumn("user_id", F.col("user_id").cast("string"))),
        ("wider", clicks.withColumn("campaign", F.lit("c"))),
    ):
        changed.write.parquet(str(folder / name))
    assert main(["--lake", lake, "backfill", *days, "--source", str(folder / "clicks")]) == 0
    before = rows_of(read_bronze(spark, Lake(lake)))
    for source in ("no-such-folder", "lacking", "retyped"):
        assert main(["--lake", lake, "backfill", *days, "--source", str(folder / source)]) == 1
        with pytest.raises((AnalysisException, SchemaError)):
            main(["--lake", lake, "bronze", *days, "--source", str(folder / source)])
        assert rows_of(read_bronze(spark, Lake(lake))) == before != []
    with caplog.at_level(logging.WARNING):
        assert main(["--lake", lake, "backfill", *days, "--source", str(folder / "wider")]) == 0
    assert "new column campaign" in caplog.text


def test_backfill_needs_a_source_or_a_skip(folder):
    assert main(["--lake", str(folder / "x"), "backfill", "2024-01-01", "2024-01-02"]) == 1
    args = parser().parse_args(["--lake", "x", "backfill", "a", "b", "--skip-bronze", "--skip-gold"])
    assert args.skip == ["bronze", "gold"]


def test_health_of_a_stored_lake(spark, folder):
    lake, days = str(folder / "health"), ["2024-01-01", "2024-01-03"]
    assert main(["--lake", lake, "health", *days]) == 1
    assert main(["--lake", lake, "backfill", *days, "--source", str(folder / "clicks")]) == 0
    assert main(["--lake", lake, "health", *days, "--now", "2024-01-03 01:00:00"]) == 0
    assert main(["--lake", lake, "health", *days, "--now", "2024-01-04 01:00:00"]) == 1
    assert main(["--lake", lake, "backfill", *days, "--source", str(folder / "missing")]) == 1
    assert main(["--lake", lake, "health", *days, "--now", "2024-01-03 01:00:00"]) == 1


def test_health_scans_each_layer_once(spark, folder):
    lake = Lake(str(folder / "health"))
    plan = lake_health(stored_layers(spark, lake), "2024-01-03", "2024-01-01", "2024-01-03")._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Relation [") == 3


def test_streams_late_rows_and_replays(spark, clicks, tmp_path):
    lake, feed, log = (str(tmp_path / n) for n in ("lake", "feed", "log"))
    for rows in (
        [click(1, "2024-01-05 10:00:00"), click(2, "2024-01-06 10:00:00")], [click(3, "2024-01-07 10:00:00")],
        [click(4, "2024-01-04 10:00:00", updated="2024-01-07 11:00:00"), click(5, "2024-01-07 12:00:00")],
    ):
        clicks(*rows).coalesce(1).write.mode("append").parquet(feed)
    stream = ["stream", "--source", feed, "--checkpoint", log, "--files", "1", "--drain", "--delay", "10 minutes"]
    assert main(["--lake", lake, *stream]) == 0
    held = lambda: rows_of(read_silver(spark, Lake(lake)), "click_id")
    assert held() == [(1,), (2,), (3,), (5,)]
    assert main(["--lake", lake, "repair-late"]) == 0
    assert held() == [(1,), (2,), (3,), (4,), (5,)]
    assert main(["--lake", lake, "compact", "--rebuild-keys"]) == 0
    assert main(["--lake", lake, "sketches"]) == 0
    assert held() == [(1,), (2,), (3,), (4,), (5,)]
    other = str(tmp_path / "other")
    assert main(["--lake", other, "replay", "--checkpoint", log, "--from-batch", "1"]) == 0
    assert rows_of(read_silver(spark, Lake(other)), "click_id") == [(3,), (4,), (5,)]
    assert main(["--lake", other, "replay", "--checkpoint", log, "--since", "2100-01-01"]) == 1
    third = str(tmp_path / "third")
    hybrid = ["hybrid", "--history", feed, "--source", feed, "--cutover", "2024-01-07", "--checkpoint", str(tmp_path / "log3"), "--drain"]
    assert main(["--lake", third, *hybrid]) == 0
    assert rows_of(read_silver(spark, Lake(third)), "click_id") == [(1,), (2,), (3,), (4,), (5,)]
