import os
from datetime import date, timedelta

import pytest
from clicklake.operators import rebuild
from clicklake.operators.rebuild import key_ranges, refine, refine_dates
from clicklake.plans import keys as keys_plan
from clicklake.plans.bronze import land
from clicklake.plans.gate import QualityError, require, validate_frame
from clicklake.plans.runs import run_day, run_range
from clicklake.plans.silver import rebuild_silver
from clicklake.schemas import CLICK_TABLE, SESSION_TABLE
from clicklake.sources.lake import Lake, pending_dates, read_bronze, read_silver
from clicklake.sources.samples import sample_sessions
from clicklake.sources.snapshots import current, read_snapshot
from conftest import click, rows_of
from pyspark.sql import functions as F

D5, D6, D7, D8 = (date(2024, 1, d) for d in (5, 6, 7, 8))
FAR = keys_plan.BLOCK * 900


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def files(root, *but):
    kept = [d for d in os.listdir(root) if d not in but]
    return {
        os.path.join(d, f): open(os.path.join(d, f), "rb").read()
        for top in kept for d, _, names in os.walk(os.path.join(root, top)) for f in names
    }


def test_lookup_reads_only_the_blocks_of_the_slice(spark, clicks, lake):
    """Keys at both ends of history: three blocks hold keys, the slice has keys in two of them."""
    rows = [click(k, "2024-01-05 10:00:00", updated="2024-01-05 11:00:00") for k in (1, 2, FAR // 2, FAR, FAR + 1)]
    land(spark, lake, clicks(*rows), D5, D6)
    later = [click(k, "2024-01-07 10:00:00") for k in (1, FAR)]
    assert land(spark, lake, clicks(*later), D7, D8).event_dates == [D5, D7]
    slice_keys = clicks(*later).select("click_id")
    found = keys_plan.dates_of_keys(spark, lake, slice_keys, {0, 900})
    assert rows_of(found) == [(D5,), (D7,)]
    read = {f.split("block=")[1].split("/")[0] for f in found.inputFiles() if "block=" in f}
    assert read == {"0", "900"} and set(current(spark, lake.keys()).partitions) == {"0", "450", "900"}


def test_an_old_key_does_not_open_all_of_history(spark, clicks):
    rows = clicks(*[click(k, "2024-01-05 10:00:00") for k in (7, 9, FAR // 2, FAR, FAR + 5)])
    plan = refine_dates(rows.where(f"click_id <> {FAR // 2}").unionByName(rows.limit(0)), [D5])
    assert plan.count() == 4
    inside = key_ranges(rows.where(f"click_id <> {FAR // 2}"), CLICK_TABLE)
    assert rows_of(rows.where(inside), "click_id") == [(FAR,), (FAR + 5,), (7,), (9,)]
    assert key_ranges(rows.limit(0), CLICK_TABLE) is None
    text = key_ranges(spark.createDataFrame([("b",), ("d",)], "session_id string"), SESSION_TABLE)
    assert rows_of(spark.createDataFrame([("a",), ("c",)], "session_id string").where(text)) == [("c",)]


def test_many_far_keys_are_joined_into_a_few_ranges(spark):
    keys = [k * keys_plan.BLOCK * (k % 5 + 2) for k in range(200)]
    rows = spark.createDataFrame([(k,) for k in keys], "click_id long")
    inside = key_ranges(rows, CLICK_TABLE)
    assert rows.where(inside).count() == len(keys)
    assert inside._jc.toString().count(">=") <= 64


def test_replaced_rows_and_blocks_merged_keep_every_date(spark, clicks, lake, monkeypatch):
    monkeypatch.setattr(keys_plan, "MOST", 2)
    rows = [click(k, f"2024-01-0{5 + k % 3} 10:00:00", updated=f"2024-01-0{5 + k % 3} 11:00:00") for k in range(9)]
    for turn in range(4):
        moved = [click(k, "2024-01-04 10:00:00", updated="2024-01-08 01:00:00") for k in range(turn)]
        for day in (D5, D6, D7, D8):
            rebuild_silver(spark, lake, land(spark, lake, clicks(*rows, *moved), day, day + timedelta(days=1)).event_dates)
    assert all(len(current(spark, lake.keys()).commits(p)) <= 3 for p in current(spark, lake.keys()).partitions)
    columns = ["click_id", "event_date", "updated_at"]
    assert rows_of(read_silver(spark, lake), *columns) == rows_of(refine(read_bronze(spark, lake)), *columns)
    pairs = rows_of(keys_plan.pairs(read_bronze(spark, lake)))
    keys_plan.rebuild_keys(spark, lake)
    index = keys_plan.read_snapshot(spark, lake.keys(), keys_plan.index_schema(CLICK_TABLE))
    assert rows_of(index) == pairs


def test_a_raw_layer_without_an_index_gets_one(spark, clicks, lake, monkeypatch):
    with monkeypatch.context() as patched:
        patched.setattr("clicklake.plans.bronze.add_keys", lambda *a: None)
        land(spark, lake, clicks(click(1, "2024-01-05 10:00:00")), D5, D6)
    assert land(spark, lake, clicks(click(1, "2024-01-06 10:00:00")), D6, D7).event_dates == [D5, D6]


def test_the_first_landing_reads_its_rows_once_and_no_index(spark, clicks, lake, monkeypatch):
    def unasked(*args, **options):
        raise AssertionError("nothing had landed")

    with monkeypatch.context() as patched:
        patched.setattr("clicklake.plans.bronze.dates_of_keys", unasked)
        patched.setattr(keys_plan, "read_bronze", unasked)
        assert land(spark, lake, clicks(click(1, "2024-01-05 10:00:00")), D5, D6).event_dates == [D5]
    later = clicks(click(1, "2024-01-04 10:00:00", updated="2024-01-06 10:00:00"), click(2, "2024-01-06 10:00:00"))
    assert land(spark, lake, later, D6, D7).event_dates == [D5 - timedelta(days=1), D5, D6]


def test_text_keys_are_dealt_to_blocks(spark, lake):
    sessions = sample_sessions(spark.range(50))
    landed = land(spark, lake, sessions, date(2024, 1, 1), date(2024, 4, 1), spec=SESSION_TABLE)
    index = current(spark, lake.keys(SESSION_TABLE))
    assert landed.written.rows > 0 and all(0 <= int(p) < keys_plan.HASHED for p in index.partitions)


@pytest.mark.parametrize("first", [True, False])
def test_a_failed_gate_leaves_the_lake_byte_for_byte(spark, clicks, lake, first):
    good = [click(1, "2024-01-05 10:00:00"), click(2, "2024-01-06 10:00:00")]
    if not first:
        assert run_range(spark, lake, lambda: clicks(*good), D5, D7, gate="bronze").success
    else:
        os.makedirs(lake.root)
    before = files(lake.root, "batch_log")
    bad = [*good, click(2, "2024-01-06 12:00:00"), click(3, "2024-01-05 12:00:00")]
    report = run_range(spark, lake, lambda: clicks(*bad), D5, D7, gate="bronze")
    assert list(report.failures) == ["gate"]
    assert files(lake.root, "batch_log") == before
    assert pending_dates(spark, lake) == []
    assert read_bronze(spark, lake).count() == (0 if first else 2)
    with pytest.raises(QualityError):
        land(spark, lake, clicks(*bad), D5, D7, audit=lambda rows: require(validate_frame(rows, "bronze")))
    assert files(lake.root, "batch_log") == before


def test_all_days_of_a_range_show_at_once(spark, clicks, lake, monkeypatch):
    """A run that dies before it publishes leaves all old days, one that dies after it all new ones."""
    old = clicks(click(1, "2024-01-05 10:00:00"), click(2, "2024-01-06 10:00:00"))
    new = clicks(click(3, "2024-01-05 10:00:00"), click(4, "2024-01-06 10:00:00"))
    run_range(spark, lake, lambda: old, D5, D7)

    def die(*args, **options):
        raise KeyboardInterrupt

    for name, left in (("publish", [(1,), (2,)]), ("log_batch", [(3,), (4,)])):
        with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
            patched.setattr(f"clicklake.plans.bronze.{name}", die)
            land(spark, lake, new, D5, D7)
        assert rows_of(read_bronze(spark, lake), "click_id") == left
    assert run_day(spark, lake, lambda: new, D8).success
    assert rows_of(read_silver(spark, lake), "click_id") == [(3,), (4,)]


def test_many_keys_are_not_joined_and_few_are_broadcast(spark, clicks, monkeypatch):
    """Both ways leave what a full rebuild has on the dates, with keys that moved away, moved in and never were there."""
    rows = [click(i, f"2024-01-0{1 + i % 4} 10:00:00") for i in range(40)]
    rows += [click(i, f"2024-01-0{1 + (i + 1) % 4} 11:00:00", updated="2024-01-09 00:00:00") for i in range(0, 40, 3)]
    rows += [click(3, "2024-01-02 12:00:00", "unknown", updated="2024-01-10 00:00:00"), click(1, "2024-01-02 10:00:00")]
    raw = clicks(*rows)
    dates = [date(2024, 1, 2), date(2024, 1, 4)]
    wanted = rows_of(refine(raw).where(F.col("event_date").isin(dates)))
    for few, join in ((rebuild.FEW_ROWS, "BroadcastHashJoin"), (1, None)):
        monkeypatch.setattr(rebuild, "FEW_ROWS", few)
        found = refine_dates(raw, dates)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert join in plan if join else "Join" not in plan
        assert rows_of(found) == wanted


def test_a_block_of_many_keys_is_indexed_by_several_tasks(spark, clicks, lake):
    rows = [click(i << 20, "2024-01-05 10:00:00") for i in range(12)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keys_plan.add_keys(spark, lake, clicks(*rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    index = read_snapshot(spark, lake.keys(), keys_plan.index_schema(CLICK_TABLE))
    assert sorted(r[0] for r in index.select("click_id").collect()) == [i << 20 for i in range(12)]
    assert len(index.inputFiles()) > 1 and index.select("block").distinct().count() == 1
