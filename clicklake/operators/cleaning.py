"""Row filters of the refined layer and the counts they are judged by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.functions.web import url_domain
from clicklake.schemas import SILVER_EVENT_TYPES, TableSpec


def valid_click() -> Column:
    """Key, user and event time present and a known event type. A null type makes the test null, so it is dropped.

    The source declares the event time as never null; a row without one belongs to no date of the refined layer.
    """
    return (
        F.col("click_id").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("event_timestamp").isNotNull()
        & F.col("event_type").isin(SILVER_EVENT_TYPES)
    )


def valid_row(spec: TableSpec) -> Column:
    if spec.name == "clicks":
        return valid_click()
    return F.col(spec.key).isNotNull() & F.col("user_id").isNotNull() & F.col(spec.event_column).isNotNull()


def clean_clicks(clicks: DataFrame) -> DataFrame:
    return clicks.filter(valid_click())


def cleaning_report(clicks: DataFrame) -> DataFrame:
    """Rows before and after cleaning, percent kept, kept rows whose URL has no host, and rows without an event
    time: one aggregate.
    """
    kept = F.count_if(valid_click())
    return clicks.agg(
        F.count(F.lit(1)).alias("rows_before"),
        kept.alias("rows_after"),
        F.count_if(valid_click() & (url_domain(F.col("page_url")) == "")).alias("empty_domain"),
        F.count_if(F.col("event_timestamp").isNull()).alias("undated"),
    ).withColumn(
        "kept_pct",
        F.when(F.col("rows_before") > 0, F.col("rows_after").cast("double") * 100 / F.col("rows_before")).otherwise(
            F.lit(0.0)
        ),
    )


def duplicate_report(cleaned: DataFrame, key: str = "click_id") -> DataFrame:
    """How many rows the deduplication of ``cleaned`` removes; needs non-null keys."""
    return cleaned.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_distinct(key).alias("rows_after"),
    ).withColumn("duplicates", F.col("rows_before") - F.col("rows_after"))
