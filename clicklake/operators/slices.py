"""Slices of a source by change time and event time."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.operators.versions import latest_versions, union_versions
from clicklake.schemas import CLICK_TABLE, LATE_DAYS, TableSpec

Moment = date | datetime | str


def as_day(value: Moment) -> date:
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value.date() if isinstance(value, datetime) else value


def next_day(value: Moment) -> date:
    return as_day(value) + timedelta(days=1)


def as_moment(value: Moment) -> str:
    """ISO text of a bound; a day means its midnight."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, datetime) else f"{value} 00:00:00.000000"


def in_range(df: DataFrame, column: str, start: Moment, end: Moment) -> DataFrame:
    """Rows with ``start <= column < end``; both bounds are literals, so they reach the scan."""
    low, high = (F.lit(as_moment(m)).cast("timestamp") for m in (start, end))
    return df.filter((F.col(column) >= low) & (F.col(column) < high))


def changed_between(df: DataFrame, start: Moment, end: Moment, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    """The incremental extract: declared columns of rows changed in the half-open range."""
    return in_range(df, spec.change_column, start, end).select(*spec.columns)


def late_slice(df: DataFrame, day: Moment, days: int = LATE_DAYS, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    """Rows changed on ``day`` whose event happened in the ``days`` days before it."""
    day = as_day(day)
    changed = changed_between(df, day, next_day(day), spec)
    return in_range(changed, spec.event_column, day - timedelta(days=days), day)


def day_with_late(df: DataFrame, day: Moment, days: int = LATE_DAYS, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    """The day's extract and its late slice. They overlap, so the union keeps one version per key."""
    day = as_day(day)
    return union_versions(
        changed_between(df, day, next_day(day), spec), late_slice(df, day, days, spec), spec
    )


def history_and_live(history: DataFrame, live: DataFrame, cutover: Moment, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    """Batch rows changed before ``cutover`` and stream rows from it on, one version per key."""
    moment = F.lit(as_moment(cutover)).cast("timestamp")
    before = history.filter(F.col(spec.change_column) < moment)
    after = live.filter(F.col(spec.change_column) >= moment)
    return latest_versions(before.unionByName(after, allowMissingColumns=True), spec)
