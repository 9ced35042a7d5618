"""Quality of stored layers, and the gate between raw and refined."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from clicklake.operators.quality import SUITES, Summary, bronze_suite, collect_summary, null_report, run_checks
from clicklake.operators.slices import Moment
from clicklake.schemas import BRONZE_ROW_RANGE, CLICK_TABLE
from clicklake.sources.lake import Lake, read_bronze
from clicklake.sources.snapshots import is_snapshot_table, read_snapshot

log = logging.getLogger(__name__)


class QualityError(RuntimeError):
    """A quality suite found failing checks."""


def validate_frame(df: DataFrame, suite: str, row_range: tuple[int, int] = BRONZE_ROW_RANGE) -> Summary:
    """Run a suite in one job and report it; ``row_range`` is what the raw suite accepts."""
    checks = bronze_suite(row_range) if suite == "bronze" else SUITES[suite]()
    summary = collect_summary(run_checks(df, checks, suite))
    for failure in summary.failures:
        log.error(failure)
    log.info("%s: %d of %d checks passed (%.1f%%)", suite, summary.passed, summary.total, summary.pass_rate)
    return summary


def validate_layer(
    spark: SparkSession, path: str, suite: str, row_range: tuple[int, int] = BRONZE_ROW_RANGE
) -> Summary:
    """Run a suite over the table stored at ``path``, of a table with versions over the latest."""
    stored = read_snapshot(spark, path) if is_snapshot_table(spark, path) else spark.read.parquet(path)
    return validate_frame(stored, suite, row_range)


def require(summary: Summary) -> Summary:
    if not summary.success:
        raise QualityError("; ".join(summary.failures))
    return summary


def quality_gate(
    spark: SparkSession,
    lake: Lake,
    start: Moment,
    end: Moment,
    suite: str = "bronze",
    row_range: tuple[int, int] = BRONZE_ROW_RANGE,
) -> Summary:
    """Stop the run unless the raw rows stored for ``[start, end)`` pass."""
    return require(validate_frame(read_bronze(spark, lake, start, end), suite, row_range))


def warn_about_nulls(spark: SparkSession, lake: Lake, start: Moment | None = None, end: Moment | None = None) -> dict:
    """Totals of the raw rows; null keys are only warned about."""
    counts = null_report(read_bronze(spark, lake, start, end), CLICK_TABLE.key).first().asDict()
    if counts["null_click_ids"]:
        log.warning("%d rows without a click id", counts["null_click_ids"])
    return counts
