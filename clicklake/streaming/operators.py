"""Operators over a click stream. State is bounded by the watermark; later rows are dropped and counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from clicklake.schemas import CLICK_TABLE, WATERMARK, TableSpec


def watermarked(stream: DataFrame, delay: str = WATERMARK, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    return stream.withWatermark(spec.event_column, delay)


def first_versions(
    stream: DataFrame, delay: str = WATERMARK, spec: TableSpec = CLICK_TABLE, salts: int = 8
) -> DataFrame:
    """One row per key among rows within the watermark of each other. It keeps the first version to
    arrive; the refined layer keeps the latest, so it is built by ``stream_to_silver`` instead.

    A first pass by key and a random salt leaves at most ``salts`` rows per key, so a hot key is spread over that
    many tasks, exact redeliveries too. It keeps every key twice in state: pass 1 where no key is hot. A batch that runs
    again may draw other salts, but starts from the state before it, so each key still comes out once.
    """
    rows = watermarked(stream, delay, spec)
    if salts > 1:
        salted = rows.withColumn("salt", F.floor(F.rand() * salts).cast("int"))
        rows = salted.dropDuplicatesWithinWatermark([spec.key, "salt"]).drop("salt")
    return rows.dropDuplicatesWithinWatermark([spec.key])


def windowed_counts(stream: DataFrame, width: str = "1 hour", delay: str = WATERMARK) -> DataFrame:
    """Events and roughly distinct users per tumbling window and type, emitted when a window closes."""
    return (
        watermarked(stream, delay)
        .groupBy(F.window("event_timestamp", width).alias("span"), "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"), F.approx_count_distinct("user_id").alias("approx_users"))
        .select(
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "event_type",
            "event_count",
            "approx_users",
        )
    )


def windowed_users(stream: DataFrame, width: str = "1 hour", delay: str = WATERMARK) -> DataFrame:
    """Events and exactly distinct users per window and type: streams allow it as two chained aggregates."""
    return (
        watermarked(stream, delay)
        .groupBy(F.window("event_timestamp", width).alias("span"), "event_type", "user_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("span", "event_type")
        .agg(F.sum("n").alias("event_count"), F.count("user_id").alias("unique_users"))
        .select(
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "event_type",
            "event_count",
            "unique_users",
        )
    )


#: A session ends when nothing happens for so long.
GAP = "30 minutes"


def live_sessions(stream: DataFrame, gap: str = GAP, delay: str = WATERMARK) -> DataFrame:
    """A row for each session of a user, closed by a gap: emitted once the watermark has passed the gap after its last event.

    Rows behind the watermark are left out, rows without a user or an event time too. State holds a row for each open session, not its events.
    """
    rows = watermarked(stream, delay).filter(F.col("user_id").isNotNull())
    session = F.session_window("event_timestamp", gap).alias("span")
    return (
        rows.groupBy(session, "user_id")
        .agg(
            F.max("event_timestamp").alias("ended_at"),
            F.count(F.lit(1)).alias("event_count"),
            F.count_if(F.col("event_type") == "page_view").alias("page_views_count"),
        )
        .select("user_id", F.col("span.start").alias("started_at"), "ended_at", "event_count", "page_views_count")
    )


class LateRows(StreamingQueryListener):
    """Counts, per query, the rows that came later than the watermark, since this process began.

    A query keeps reports of its last batches only; a listener is told of every one. Add it to ``spark.streams``
    before the query starts. ``late_rows`` of the jobs that set such rows aside counts across restarts.
    """

    def __init__(self) -> None:
        self._dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self._dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self._dropped[str(event.progress.id)] = self._dropped.get(str(event.progress.id), 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def dropped(self, query: StreamingQuery) -> int:
        return self._dropped.get(str(query.id), 0)
