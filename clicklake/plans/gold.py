"""Aggregated layer: every metric for any number of dates, one job per metric and no loop over dates."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from clicklake.operators.metrics import METRIC_COLUMNS, METRICS, aggregate_metric
from clicklake.operators.rebuild import date_list
from clicklake.operators.sessions import conversion_funnel, session_summary
from clicklake.operators.sketches import hourly_sketches
from clicklake.plans.bronze import batch_name
from clicklake.sources.lake import (
    Lake,
    Written,
    clear_pending,
    pending_dates,
    read_silver,
    read_table,
    replace_table,
    write_idempotent,
)
from clicklake.sources.snapshots import expire, publish, read_snapshot, stage


@dataclass
class GoldReport:
    written: dict[str, Written] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


def build_gold(
    spark: SparkSession,
    lake: Lake,
    dates: Iterable[date] | None = None,
    metrics: Iterable[str] = tuple(METRICS),
    batch_id: str | None = None,
) -> GoldReport:
    """Rebuild the metrics of ``dates`` (all when None); a metric that fails does not stop the others.

    Each metric scans the few columns it needs, which is cheaper than to keep those of all metrics. Dates noted as
    pending are done with when all metrics of them are rebuilt.
    """
    metrics = tuple(metrics)
    dates = None if dates is None else sorted(dates)
    waiting = pending_dates(spark, lake, stage="gold") if dates is None else dates
    silver = read_silver(spark, lake, dates).select(*METRIC_COLUMNS)
    report = GoldReport()
    for name in metrics:
        try:
            result, path = aggregate_metric(silver, name), lake.gold(name)
            stored = dates
            if stored is None:
                stored = date_list(read_table(spark, path, result.schema).select("date").distinct())
            ranked_by = METRICS[name].ranked_by
            order = [F.desc(ranked_by)] if ranked_by else []
            report.written[name] = write_idempotent(
                spark, result, lake, path, "date", batch_id or batch_name(), f"gold.{name}", stored, order=order
            )
        except Exception as error:
            report.failures[name] = str(error)
    if not report.failures and set(metrics) >= set(METRICS):
        clear_pending(spark, lake, waiting, stage="gold")
    return report


def build_sketches(spark: SparkSession, lake: Lake, dates: Iterable[date] | None = None, batch_id: str | None = None) -> Written:
    """Rebuild the hourly sketches of ``dates`` (all when None). Days and months are united from them when they are read."""
    dates = None if dates is None else sorted(dates)
    rows, path = hourly_sketches(read_silver(spark, lake, dates)), lake.gold("hourly_sketches")
    held = dates if dates is not None else date_list(read_table(spark, path, rows.schema).select("date").distinct())
    return write_idempotent(spark, rows, lake, path, "date", batch_id or batch_name(), "gold.hourly_sketches", held)


def read_sketches(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.parquet(lake.gold("hourly_sketches"))


#: The session table lies in so many buckets.
SESSION_BUCKETS = 64


def bucket_of(buckets: int = SESSION_BUCKETS) -> Column:
    return F.pmod(F.xxhash64("session_id"), F.lit(buckets)).cast("int")


def update_sessions(spark: SparkSession, lake: Lake, dates: Iterable[date] = (), buckets: int = SESSION_BUCKETS) -> int:
    """Rebuild the sessions that have or had an event on ``dates`` or on dates that the refined layer rebuilt since the last call, and leave
    all others. Returns how many were rebuilt.

    A session's other rows lie between the ends that are stored for it, so refined dates outside are not read. Only buckets
    that hold such a session are read and replaced, all at once.
    """
    dates, path = sorted({*dates, *pending_dates(spark, lake, stage="sessions")}), lake.gold("session_buckets")
    if not dates:
        return 0
    schema = StructType([*session_summary(read_silver(spark, lake, [])).schema.fields, StructField("bucket", IntegerType())])
    stored = read_snapshot(spark, path, schema)
    first, last = F.to_date("started_at"), F.to_date("ended_at")
    on_dates = F.exists(F.lit(dates), lambda day: (day >= first) & (day <= last))
    near = stored.filter((last >= F.lit(dates[0])) & (first <= F.lit(dates[-1])) & on_dates)
    now = read_silver(spark, lake, dates).select("session_id").distinct()
    changed = now.unionByName(near.select("session_id")).distinct()
    # one job tells the span and the buckets: each use of ``changed`` scans the refined dates
    spans = changed.join(stored.select("session_id", first.alias("first"), last.alias("last")), "session_id", "left")
    low, high, touched = spans.agg(F.min("first"), F.max("last"), F.collect_set(bucket_of(buckets))).first()
    start, end = min(dates[0], low or dates[0]), max(dates[-1], high or dates[-1])
    if not touched:
        clear_pending(spark, lake, dates, stage="sessions")
        return 0
    rows = read_silver(spark, lake).filter(F.col("event_date").between(F.lit(start), F.lit(end)))
    # a null session_id is a session too
    same = F.col("r.session_id").eqNullSafe(F.col("c.session_id"))
    rebuilt = session_summary(rows.alias("r").join(changed.alias("c"), same, "left_semi").select("r.*"))
    rebuilt = rebuilt.withColumn("bucket", bucket_of(buckets))
    held = read_snapshot(spark, path, schema, {str(b) for b in touched}.__contains__)
    same = F.col("h.session_id").eqNullSafe(F.col("c.session_id"))
    kept = held.alias("h").join(changed.alias("c"), same, "left_anti").select("h.*")
    staged = stage(kept.withColumn("_new", F.lit(0)).unionByName(rebuilt.withColumn("_new", F.lit(1))), path, "bucket", [F.col("user_id")],
                   facts={"rebuilt": F.sum("_new")})
    publish(spark, staged, map(str, touched))
    expire(spark, path)
    clear_pending(spark, lake, dates, stage="sessions")
    return staged.facts["rebuilt"] or 0


def read_sessions_table(spark: SparkSession, lake: Lake) -> DataFrame:
    schema = StructType([*session_summary(read_silver(spark, lake, [])).schema.fields, StructField("bucket", IntegerType())])
    return read_snapshot(spark, lake.gold("session_buckets"), schema).drop("bucket")


def build_sessions(spark: SparkSession, lake: Lake) -> int:
    """Rebuild the session table, laid out by user so that reading one user touches few files."""
    by_user = session_summary(read_silver(spark, lake)).hint("rebalance", "user_id").sortWithinPartitions("user_id")
    return replace_table(by_user, lake.gold("user_sessions"))


def build_funnel(spark: SparkSession, lake: Lake) -> int:
    """Rebuild the conversion funnel, a row for each day."""
    return replace_table(conversion_funnel(read_silver(spark, lake)).coalesce(1), lake.gold("conversion_funnel"))
