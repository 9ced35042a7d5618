"""Health of the lake: per layer its rows, freshness, completeness and quality against the targets."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.operators.completeness import rows_per_date
from clicklake.operators.quality import Check, bronze_suite, measure_checks, silver_suite
from clicklake.operators.slices import Moment, as_day, as_moment
from clicklake.schemas import MAX_BATCH_HOURS, MAX_FRESHNESS_HOURS, MAX_LAG_MINUTES, MIN_PASS_RATE
from clicklake.sources.lake import Lake, path_exists, read_batch_log, read_bronze, read_silver

DAILY = "date DATE, event_type STRING, event_count BIGINT, unique_users BIGINT, unique_sessions BIGINT, unique_domains BIGINT"


@dataclass(frozen=True)
class Layer:
    """A table to watch. ``changed`` is an expression for the moment a row is current as of."""

    name: str
    rows: DataFrame
    date_column: str
    changed: str
    checks: tuple[Check, ...] = ()


def layer_row_counts(layers: list[Layer]) -> DataFrame:
    counts = [rows_per_date(layer.rows, layer.date_column, layer.name) for layer in layers]
    return reduce(DataFrame.unionByName, counts)


def _layer_health(layer: Layer, now: Moment, first: date, last: date) -> DataFrame:
    """State and checks of a layer, by one aggregate over one scan."""
    day = F.col(layer.date_column)
    inside = F.when((day >= F.lit(first)) & (day < F.lit(last)), day)
    state = measure_checks(
        layer.rows,
        list(layer.checks),
        layer.name,
        dates_present=F.size(F.collect_set(inside)).cast("long"),
        last_change=F.max(F.expr(layer.changed)),
    )
    age = F.unix_micros(F.lit(as_moment(now)).cast("timestamp")) - F.unix_micros(F.col("last_change"))
    passed = F.lit(None).cast("double")
    if layer.checks:
        passed = F.size(F.filter("results", lambda r: r["passed"])).cast("double") * 100 / F.size("results")
    return state.select(
        F.lit(layer.name).alias("layer"),
        F.col("total").alias("rows"),
        "dates_present",
        (F.lit((last - first).days).cast("long") - F.col("dates_present")).alias("dates_missing"),
        "last_change",
        (age.cast("double") / 3_600_000_000).alias("freshness_hours"),
        passed.alias("pass_rate"),
    )


def lake_health(layers: list[Layer], now: Moment, start: Moment, end: Moment) -> DataFrame:
    """One row per layer. ``breached`` when it is stale, lacks a date of ``[start, end)`` or fails too many
    checks; a layer without rows or without checks has no freshness or pass rate to breach by, but an empty
    layer lacks all its dates.
    """
    first, last = as_day(start), as_day(end)
    state = reduce(DataFrame.unionByName, [_layer_health(layer, now, first, last) for layer in layers])
    return state.select(
        "*",
        (
            F.coalesce(F.col("freshness_hours") > MAX_FRESHNESS_HOURS, F.lit(False))
            | (F.col("dates_missing") > 0)
            | F.coalesce(F.col("pass_rate") < MIN_PASS_RATE, F.lit(False))
        ).alias("breached"),
    )


def stored_layers(spark: SparkSession, lake: Lake) -> list[Layer]:
    """The layers of a stored lake."""
    daily = spark.read.schema(DAILY).parquet(lake.gold("daily_metrics")) if path_exists(spark, lake.gold("daily_metrics")) else (
        spark.createDataFrame([], DAILY)
    )
    return [
        Layer("bronze", read_bronze(spark, lake), "extract_date", "updated_at", tuple(bronze_suite())),
        Layer("silver", read_silver(spark, lake), "event_date", "updated_at", tuple(silver_suite())),
        Layer("gold", daily, "date", "CAST(date_add(date, 1) AS TIMESTAMP)"),
    ]


def run_measures(spark: SparkSession, lake: Lake, now: Moment) -> DataFrame:
    """From the batch log: the longest batch in hours, how old the last stream batch is in minutes, and the share of batches
    without a failed stage. A measure without a batch is null and not breached.
    """
    batches = read_batch_log(spark, lake).groupBy("batch_id").agg(
        F.min("started_at").alias("started"), F.max("finished_at").alias("finished"), F.every("success").alias("success")
    )
    streamed = F.col("batch_id").startswith("stream_")
    micros = F.unix_micros("finished") - F.unix_micros("started")
    totals = batches.agg(
        (F.max(F.when(~streamed, micros)).cast("double") / 3_600_000_000).alias("batch_hours"),
        F.max(F.when(streamed, F.col("finished"))).alias("last_stream"),
        (F.avg(F.when(~streamed, F.col("success").cast("double"))) * 100).alias("success_pct"),
    )
    lag = F.unix_micros(F.lit(as_moment(now)).cast("timestamp")) - F.unix_micros("last_stream")
    lag = lag.cast("double") / 60_000_000
    rows = [
        ("batch_duration_hours", F.col("batch_hours"), F.col("batch_hours") > MAX_BATCH_HOURS),
        ("streaming_lag_minutes", lag, lag > MAX_LAG_MINUTES),
        ("backfill_success_pct", F.col("success_pct"), F.col("success_pct") < 100),
    ]
    structs = [
        F.struct(F.lit(name).alias("measure"), value.alias("value"), F.coalesce(breach, F.lit(False)).alias("breached"))
        for name, value, breach in rows
    ]
    return totals.select(F.inline(F.array(*structs)))
