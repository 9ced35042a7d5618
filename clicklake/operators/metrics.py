"""The aggregated layer's five metrics, declared as keys and measures.

Exact distinct counts are aggregated first by key *and* value, with map-side combining, and only then by
key, so a key that holds a third of the rows is spread over its values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.functions.web import whole_seconds


@dataclass(frozen=True)
class Metric:
    keys: dict[str, str]
    measures: dict[str, str]
    ranked_by: str | None = None


METRICS = {
    "daily_metrics": Metric(
        {"date": "event_date", "event_type": "event_type"},
        {
            "event_count": "count(*)",
            "unique_users": "count(DISTINCT user_id)",
            "unique_sessions": "count(DISTINCT session_id)",
            "unique_domains": "count(DISTINCT domain)",
        },
    ),
    "hourly_metrics": Metric(
        {"date": "event_date", "hour": "hour(event_timestamp)", "event_type": "event_type"},
        {"event_count": "count(*)", "unique_users": "count(DISTINCT user_id)"},
    ),
    "domain_metrics": Metric(
        {"date": "event_date", "domain": "domain", "device_type": "device_type"},
        {
            "page_views": "count(*)",
            "unique_users": "count(DISTINCT user_id)",
            "sessions": "count(DISTINCT session_id)",
        },
        ranked_by="page_views",
    ),
    "user_summary": Metric(
        {"date": "event_date", "user_id": "user_id"},
        {
            "total_events": "count(*)",
            "sessions": "count(DISTINCT session_id)",
            "event_types": "count(DISTINCT event_type)",
            "domains_visited": "count(DISTINCT domain)",
            "avg_session_duration_sec": "avg(_seconds)",
        },
    ),
    "device_metrics": Metric(
        {"date": "event_date", "device_type": "device_type", "browser": "browser"},
        {"event_count": "count(*)", "unique_users": "count(DISTINCT user_id)"},
    ),
}

METRIC_COLUMNS = [
    "event_date", "event_timestamp", "created_at", "event_type", "user_id", "session_id", "domain", "device_type",
    "browser",
]


def aggregate_metric(silver: DataFrame, name: str) -> DataFrame:
    metric = METRICS[name]
    seconds = whole_seconds(F.col("event_timestamp"), F.col("created_at"))
    keys = [F.expr(sql).alias(alias) for alias, sql in metric.keys.items()]
    measures = [F.expr(sql).alias(alias) for alias, sql in metric.measures.items()]
    return silver.withColumn("_seconds", seconds).groupBy(*keys).agg(*measures)


def ranked_metric(silver: DataFrame, name: str) -> DataFrame:
    """The metric as a report, in its ranking order where it has one. Tables drop the order, so sinks skip it."""
    out, ranked_by = aggregate_metric(silver, name), METRICS[name].ranked_by
    return out.orderBy(F.desc(ranked_by)) if ranked_by else out
