"""Daily runs and range backfills: raw, then refined, then aggregated."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from clicklake.operators.completeness import missing_dates
from clicklake.operators.metrics import METRICS
from clicklake.operators.rebuild import date_list
from clicklake.operators.slices import Moment, as_day, next_day
from clicklake.plans.bronze import batch_name, dates_touched_by, days_between, land
from clicklake.plans.gate import quality_gate, require, validate_frame
from clicklake.plans.gold import build_gold, update_sessions
from clicklake.plans.silver import dates_to_rebuild, rebuild_silver
from clicklake.schemas import BRONZE_ROW_RANGE, CLICK_TABLE, TableSpec
from clicklake.sources.lake import Lake, log_batch, pending_dates, read_bronze, read_silver

log = logging.getLogger(__name__)
STAGES = ("bronze", "silver", "gold")
Source = Callable[[], DataFrame]


@dataclass
class RunReport:
    """What a run did. ``failures`` names the stage, or the metric of the last stage, that failed."""

    planned: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    event_dates: list[date] = field(default_factory=list)
    failures: dict[str, str] = field(default_factory=dict)

    @property
    def success(self) -> bool:
        return not self.failures


def run_range(
    spark: SparkSession,
    lake: Lake,
    source: Source,
    start: Moment,
    end: Moment,
    skip: Iterable[str] = (),
    dry_run: bool = False,
    gate: str | None = None,
    batch_id: str | None = None,
    metrics: Iterable[str] = tuple(METRICS),
    spec: TableSpec = CLICK_TABLE,
    row_range: tuple[int, int] = BRONZE_ROW_RANGE,
) -> RunReport:
    """Backfill ``[start, end)``. A failing raw or refined stage stops the later ones; a failing metric
    does not stop the other metrics. ``gate`` names a suite the raw rows must pass, ``row_range`` how many rows
    it accepts: new rows pass it before they are published, so a failed gate leaves all layers as they were; where the raw stage is skipped, the
    stored ones do. Sessions follow where all metrics do. Only clicks are aggregated: other tables end with the refined layer.
    """
    if spec != CLICK_TABLE:
        skip = {*skip, "gold"}
        if gate:
            raise ValueError(f"there is no suite for {spec.name}")
    skip = set(skip)
    if unknown := skip - set(STAGES):
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    report = RunReport(planned=[f"{stage} {as_day(start)} {as_day(end)}" for stage in STAGES if stage not in skip])
    if dry_run:
        return report
    stage, touched, batch_id = "bronze", None, batch_id or batch_name()
    try:
        if "bronze" not in skip:
            rows = source()

            def audit(staged):
                nonlocal stage
                stage = "gate"
                require(validate_frame(staged, gate, row_range))
                stage = "bronze"

            landed = land(spark, lake, rows, start, end, batch_id, spec, audit if gate else None)
            touched, report.rows["bronze"] = landed.event_dates, landed.written.rows
        stage = "silver"
        if "silver" not in skip:
            if gate and touched is None:
                stage = "gate"
                quality_gate(spark, lake, start, end, gate, row_range)
                stage = "silver"
            touched = dates_touched_by(spark, lake, start, end, spec) if touched is None else touched
            touched = dates_to_rebuild(spark, lake, touched, spec)
            report.rows["silver"] = rebuild_silver(spark, lake, touched, spec, batch_id).rows
    except Exception as error:
        log.exception("%s failed", stage)
        report.failures[stage] = str(error)
        log_batch(spark, lake, batch_id, f"{stage}.{spec.name}", 0, success=False)
        return report
    rebuilt = [] if "silver" in skip else touched
    report.event_dates = sorted(set(rebuilt) | set(days_between(start, end)))
    if "gold" not in skip:
        dates = {*report.event_dates, *pending_dates(spark, lake, spec, "gold")}
        if set(metrics) >= set(METRICS):
            try:
                report.rows["session_buckets"] = update_sessions(spark, lake, dates)
            except Exception as error:
                log.exception("sessions failed")
                report.failures["session_buckets"] = str(error)
        gold = build_gold(spark, lake, dates, metrics, batch_id)
        report.rows.update({name: written.rows for name, written in gold.written.items()})
        report.failures.update(gold.failures)
        for name in gold.failures:
            log_batch(spark, lake, batch_id, f"gold.{name}", 0, success=False)
    return report


def run_day(spark: SparkSession, lake: Lake, source: Source, day: Moment, **options) -> RunReport:
    """The daily run: rows changed on ``day``, that is in ``[day, day + 1)``."""
    return run_range(spark, lake, source, day, next_day(day), **options)


def backfill_gaps(spark: SparkSession, lake: Lake, start: Moment, end: Moment) -> dict[str, list[date]]:
    """Dates in ``[start, end)`` without rows, per layer."""
    bronze = read_bronze(spark, lake, start, end)
    silver = read_silver(spark, lake)
    return {
        "bronze": date_list(missing_dates(bronze, "extract_date", start, end)),
        "silver": date_list(missing_dates(silver, "event_date", start, end)),
    }
