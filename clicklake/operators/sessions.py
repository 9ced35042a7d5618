"""Session-level results: one row per session, and the ordered conversion funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.functions.web import whole_seconds


def session_summary(silver: DataFrame) -> DataFrame:
    """One row per session; user and device are those of its earliest event.

    A plain aggregate: the partial step leaves one row per session and task before the shuffle.
    """
    event = F.when(
        F.col("event_timestamp").isNotNull(), F.struct("event_timestamp", "click_id", "user_id", "device_type")
    )
    out = silver.groupBy("session_id").agg(
        F.min(event).alias("first"),
        F.max("event_timestamp").alias("ended_at"),
        F.count_if(F.col("event_type") == "page_view").alias("page_views_count"),
    )
    started_at = F.col("first.event_timestamp")
    seconds = whole_seconds(F.col("ended_at"), started_at)
    return out.select(
        "session_id",
        "first.user_id",
        started_at.alias("started_at"),
        "ended_at",
        F.nullif(seconds, F.lit(0).cast("long")).alias("duration_seconds"),
        "page_views_count",
        (F.col("page_views_count") == 1).alias("bounce"),
        "first.device_type",
    )


def funnel_times(silver: DataFrame) -> DataFrame:
    """When each session first viewed a page, then clicked, then bought; null where it stopped.

    Each step is an aggregate with map-side combining: rows of its kind are joined with the session's previous step
    and reduced to the first one not before it. A session with a third of all rows is one row per task after
    that, and adaptive execution splits the join.
    """
    steps = silver.select("session_id", "event_type", F.col("event_timestamp").alias("at"))
    reached = (
        steps.filter(F.col("event_type") == "page_view").groupBy("session_id").agg(F.min("at").alias("viewed_at"))
    ).filter("viewed_at IS NOT NULL")
    for kind, before, after in (("click", "viewed_at", "clicked_at"), ("purchase", "clicked_at", "bought_at")):
        of_kind = steps.filter(F.col("event_type") == kind).alias("s")
        same = F.col("s.session_id").eqNullSafe(F.col("r.session_id"))
        later = (
            of_kind.join(reached.filter(F.col(before).isNotNull()).alias("r"), same & (F.col("s.at") >= F.col(f"r.{before}")))
            .groupBy("r.session_id")
            .agg(F.min("s.at").alias(after))
        )
        same = F.col("r.session_id").eqNullSafe(F.col("l.session_id"))
        reached = reached.alias("r").join(later.alias("l"), same, "left").select("r.*", f"l.{after}")
    return reached


def conversion_funnel(silver: DataFrame) -> DataFrame:
    """Per day of the first page view: sessions that reached each step in order."""
    return (
        funnel_times(silver)
        .groupBy(F.to_date("viewed_at").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("viewed"),
            F.count("clicked_at").alias("clicked"),
            F.count("bought_at").alias("purchased"),
        )
    )
