"""Refined layer: rebuild exactly the event dates a landed slice touched, or everything."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import SparkSession

from clicklake.operators.rebuild import competing_rows, date_list, refine, refine_dates, rows_on
from clicklake.plans.bronze import batch_name
from clicklake.schemas import CLICK_TABLE, TableSpec
from clicklake.sources.lake import (
    Lake,
    Written,
    add_pending,
    clear_pending,
    pending_dates,
    read_bronze,
    read_silver,
    write_idempotent,
)


def dates_to_rebuild(
    spark: SparkSession, lake: Lake, dates: Iterable[date], spec: TableSpec = CLICK_TABLE
) -> list[date]:
    """``dates`` and those pending from earlier runs, also from such as died after they landed."""
    return sorted(set(dates) | set(pending_dates(spark, lake, spec)))


def rebuild_silver(
    spark: SparkSession, lake: Lake, dates: Iterable[date], spec: TableSpec = CLICK_TABLE, batch_id: str | None = None
) -> Written:
    """Make the refined partitions of ``dates``, and of dates pending from an earlier run, what a full rebuild
    would leave. Reads the raw layer only.
    """
    dates = dates_to_rebuild(spark, lake, dates, spec)
    if not dates:
        return Written(0, ())
    bronze = read_bronze(spark, lake, spec=spec)
    found = rows_on(bronze, dates, spec)
    rows = refine_dates(competing_rows(bronze, dates, spec, found), dates, spec, found)
    return _store(spark, lake, rows, dates, dates, spec, batch_id)


def rebuild_all_silver(
    spark: SparkSession, lake: Lake, spec: TableSpec = CLICK_TABLE, batch_id: str | None = None
) -> Written:
    """One pass over the whole raw layer; dates that end up without rows are emptied."""
    waiting = pending_dates(spark, lake, spec)
    held = date_list(read_silver(spark, lake, spec=spec).select("event_date").distinct())
    rows = refine(read_bronze(spark, lake, spec=spec), spec)
    return _store(spark, lake, rows, sorted({*held, *waiting}), waiting, spec, batch_id)


def _store(spark, lake, rows, dates, waiting, spec, batch_id) -> Written:
    """Metrics and sessions have to follow on every date: noted before the write, and after it for dates that it added."""
    followers = ("gold", "sessions") if spec == CLICK_TABLE else ()
    for stage in followers:
        add_pending(spark, lake, dates, spec, stage)
    written = write_idempotent(
        spark, rows, lake, lake.silver(spec), "event_date", batch_id or batch_name(), f"silver.{spec.name}", dates
    )
    for stage in followers:
        add_pending(spark, lake, written.dates, spec, stage)
    clear_pending(spark, lake, waiting, spec)
    return written
