"""Raw layer: stage an extract, audit it, and publish it for all its days at once, however often it is rerun."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.operators.quality import validate_schema
from clicklake.operators.rebuild import date_list, touched_dates
from clicklake.operators.slices import Moment, as_day, changed_between
from clicklake.plans.keys import add_keys, block_of, dates_of_keys
from clicklake.schemas import CLICK_TABLE, TableSpec
from clicklake.sources.lake import Lake, Written, add_pending, day_of, log_batch, read_bronze, verify_rows
from clicklake.sources.snapshots import NULL, Staged, current, discard, holds_rows, is_snapshot_table, publish, read_staged, stage

log = logging.getLogger(__name__)

# Fixed value: the format of a batch name.
BATCH_FORMAT = "batch_%Y%m%d_%H%M%S"


def batch_name(moment: datetime | None = None) -> str:
    return (moment or datetime.now()).strftime(BATCH_FORMAT)


def with_metadata(
    df: DataFrame, batch_id: str, extract_date: Moment | None = None, spec: TableSpec = CLICK_TABLE
) -> DataFrame:
    """Add ``batch_id`` and ``extract_date``: the given day, or else the day each row changed."""
    day = F.to_date(spec.change_column) if extract_date is None else F.lit(as_day(extract_date))
    return df.withColumns({"batch_id": F.lit(batch_id), "extract_date": day})


def days_between(start: Moment, end: Moment) -> list[date]:
    first, last = as_day(start), as_day(end)
    return [first + timedelta(days=i) for i in range((last - first).days)]


@dataclass(frozen=True)
class Landed:
    written: Written
    event_dates: list[date]


#: Looks at the staged rows of a landing and raises if they must not be published.
Audit = Callable[[DataFrame], object]


def stage_rows(rows: DataFrame, lake: Lake, spec: TableSpec = CLICK_TABLE, name: str | None = None) -> Staged:
    """Write raw rows, which have ``batch_id`` and ``extract_date``, where no reader sees them yet: one job, which also tells their
    event days, as numbers, and blocks of keys.
    """
    facts = {"event_days": F.collect_set(F.unix_date(F.to_date(spec.event_column))), "blocks": F.collect_set(block_of(spec))}
    return stage(rows, lake.bronze(spec), "extract_date", [F.col(spec.key)], name, facts)


def publish_rows(
    spark: SparkSession,
    lake: Lake,
    staged: Staged,
    days: Iterable[date] = (),
    spec: TableSpec = CLICK_TABLE,
    audit: Audit | None = None,
    series: tuple[str, int] | None = None,
) -> Landed:
    """Make staged rows the raw rows of ``days`` (and add them to those of other days), all at once.

    ``event_dates`` are the days of every version, old or new, of each key in the new rows or in the rows they replace: the index of
    keys, asked before the new ones are added, knows those of all that landed before. Before the raw layer changes, the new keys are indexed and the dates
    noted as pending for the refined layer, so a run that dies at any point is made good by the next one, whatever its own range; if
    it dies earlier, or the audit fails, the raw layer is as it was.
    """
    rows = read_staged(spark, staged, spec.bronze)
    if audit:
        try:
            audit(rows)
        except Exception:
            discard(spark, staged)
            raise
    names = {d.isoformat() for d in days}
    blocks, keys = set(staged.facts["blocks"]), rows.select(spec.key)
    if names & set(current(spark, lake.bronze(spec)).partitions):
        old = read_bronze(spark, lake, min(days), max(days) + timedelta(days=1), spec)
        old = old.where(F.col("extract_date").isin(list(days)))
        blocks |= {r[0] for r in old.select(block_of(spec)).distinct().collect() if r[0] is not None}
        keys = keys.unionByName(old.select(spec.key))
    dates = {day_of(number) for number in staged.facts["event_days"]}
    if blocks:
        # the dates of the new rows are known, so an index is asked as it was before them; one of older rows may have yet to be made
        indexed, older = is_snapshot_table(spark, lake.keys(spec)), holds_rows(spark, lake.bronze(spec))
        new = rows.select(spec.key, spec.event_column)
        if indexed:
            # the look-up holds the version from before the new keys, whose files stay, so that both run side by side
            asked = dates_of_keys(spark, lake, keys, blocks, spec)
            with ThreadPoolExecutor(1) as pool:
                told = pool.submit(inheritable_thread_target(spark)(date_list), asked)
                add_keys(spark, lake, new, spec)
            dates |= set(told.result())
        else:
            add_keys(spark, lake, new, spec)
            if older:
                dates |= set(date_list(dates_of_keys(spark, lake, keys, blocks, spec)))
    add_pending(spark, lake, dates, spec)
    publish(spark, staged, names, series=series)
    written = Written(staged.rows, tuple(sorted(date.fromisoformat(p) for p in staged.partitions if p != NULL)))
    return Landed(written, sorted(dates))


def land(
    spark: SparkSession,
    lake: Lake,
    source: DataFrame,
    start: Moment,
    end: Moment,
    batch_id: str | None = None,
    spec: TableSpec = CLICK_TABLE,
    audit: Audit | None = None,
) -> Landed:
    """Extract ``[start, end)`` by change time into one partition per day, and check what was stored.

    The source is read once; columns it has beyond the declared ones are logged and left out, and a missing or
    retyped one raises before anything is touched. The rows are written aside, audited, and then replace those of all days of the range at
    once (``publish_rows``).
    """
    start, end = as_day(start), as_day(end)
    batch_id, started = batch_id or batch_name(), datetime.now(timezone.utc)
    for warning in validate_schema(source, spec.schema):
        log.warning("%s: %s", spec.name, warning)
    rows = with_metadata(changed_between(source, start, end, spec), batch_id, spec=spec)
    days = days_between(start, end)
    landed = publish_rows(spark, lake, stage_rows(rows, lake, spec), days, spec, audit)
    log_batch(spark, lake, batch_id, f"bronze.{spec.name}", landed.written.rows, started)
    in_range = F.col("extract_date").between(F.lit(start), F.lit(end - timedelta(days=1)))
    verify_rows(spark, lake.bronze(spec), spec.bronze, in_range, landed.written.rows)
    return landed


def dates_touched_by(
    spark: SparkSession, lake: Lake, start: Moment, end: Moment, spec: TableSpec = CLICK_TABLE
) -> list[date]:
    """Event dates to rebuild for raw rows already stored for ``[start, end)``."""
    landed = (F.col("extract_date") >= F.lit(as_day(start))) & (F.col("extract_date") < F.lit(as_day(end)))
    return date_list(touched_dates(read_bronze(spark, lake, spec=spec), landed, spec))
