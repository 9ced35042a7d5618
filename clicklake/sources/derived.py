"""Click and session source tables derived from the generic ``events`` and ``pages`` tables.

The raw events hold no nulls, duplicates or user agents, so those are derived from the event id: every
rule of the refined layer then has rows to act on. Works on a batch or a streaming ``events``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.schemas import DEVICE_TYPES, SESSIONS, TRAFFIC_SOURCES
from clicklake.sources.samples import pick
from clicklake.sources.snapshots import names_in

# The agent of an event by its id modulo 9; the last one is null.
AGENTS = [
    "Mozilla/5.0 (Windows) Chrome/100.0",
    "Mozilla/5.0 (macOS) Safari/99.0",
    "Mozilla/5.0 (Linux) Firefox/98.0",
    "Mozilla/5.0 (iOS) Edge/97.0",
    "Mozilla/5.0 (Android) Chrome/96.0",
    "Mozilla/5.0 (iPhone) Mobile Safari/95.0",
    "Mozilla/5.0 (Android) Tablet Firefox/94.0",
    "curl/8.0",
]

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
PAGE_TABLE = "page_id BIGINT, url STRING, html STRING"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PAGE_TABLE).parquet(f"{folder}/pages.parquet")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream. The glob makes the source accept one file as well as a folder of files."""
    return spark.readStream.schema(EVENTS).parquet(f"{folder}/event[s].parquet")


#: The text of ``k`` of an event's properties. Those that are nothing but a short whole number in the events' own form are cut, since a
#: parser for each row costs more than the rest of a click.
SECONDS = (
    "if(props RLIKE '^[{]\"k\": (0|[1-9][0-9]{0,8})[}]\\\\z', substring(props, 7, length(props) - 7), get_json_object(props, '$.k'))"
)


def as_clicks(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Clicks of ``events``: one scan, one join; the repeated versions are exploded, not unioned."""
    agents = ", ".join(f"'{agent}'" for agent in AGENTS)
    linked = events.withColumn("page_id", F.expr(f"event_id % {pages.count()}")).join(
        pages.select("page_id", "url"), "page_id", "left"
    )
    repeated = linked.withColumns(
        {
            "delay": F.expr("explode(if(event_id % 10 = 0, array(0, 5), array(0)))"),
            "at": F.expr("CAST(ts AS TIMESTAMP)"),
        }
    )
    return repeated.selectExpr(
        "event_id AS click_id",
        "if(event_id % 97 = 0, NULL, user_id) AS user_id",
        "concat_ws('_', 'sess', user_id, to_date(at)) AS session_id",
        "if(event_id % 53 = 0, 'nohost', url) AS page_url",
        "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'form_submit' ELSE event_type END"
        " AS event_type",
        "at AS event_timestamp",
        f"element_at(array({agents}, NULL), CAST(event_id % 9 + 1 AS INT)) AS user_agent",
        "CAST(NULL AS STRING) AS ip_address",
        "CAST(NULL AS STRING) AS referrer_url",
        f"at - make_dt_interval(0, 0, 0, CAST({SECONDS} AS INT)) AS created_at",
        "at + make_dt_interval(0, 0, 0, event_id % 3600 + delay) AS updated_at",
    )


#: A feed arrives in so many slices of ``SLICE_DAYS`` days from ``FEED_START`` on; earlier and later days belong to the outer ones.
SLICES, SLICE_DAYS, FEED_START = 6, 5, "2024-01-01"
#: Rows that arrive late come this many slices after their own.
LATE_SLICES = 3


def as_feed(clicks: DataFrame, arrivals: Iterable[int] = range(SLICES)) -> DataFrame:
    """Clicks as a feed delivers them, with the slice of their ``arrival``: some are repeated exactly, some of the first slices are
    redelivered late, changed 1 to 6 days after, and some are moved to the next day by a change 8 days after.

    Rows that arrive outside ``arrivals`` are left out before they are repeated, so that the scan drops events of other slices.
    """
    now, last = sorted({*arrivals}), SLICES - LATE_SLICES
    before = [number - LATE_SLICES for number in now if LATE_SLICES <= number < last + LATE_SLICES]
    # comparisons with fixed moments: every slice's scan tests every event
    ends = "".join(
        f" WHEN event_timestamp < TIMESTAMP '{FEED_START}' + INTERVAL {SLICE_DAYS * (number + 1)} DAYS THEN {number}" for number in range(SLICES - 1)
    )
    own = f"CASE WHEN event_timestamp IS NULL THEN 0{ends} ELSE {SLICES - 1} END"
    inside = lambda numbers: f"slice IN ({', '.join(map(str, numbers))})" if numbers else "false"
    # one array of plain values: lambda functions over structs would be interpreted row by row
    kinds = (
        f"array_remove(array(if({inside(now)}, 'first', ''), if({inside(now)} AND click_id % 11 = 2, 'copy', ''),"
        f" if({inside(before)} AND click_id % 7 = 3, 'late', ''), if({inside(before)} AND click_id % 31 = 5, 'moved', '')), '')"
    )
    late = f"{inside(before)} AND (click_id % 7 = 3 OR click_id % 31 = 5)"
    rows = clicks.withColumn("slice", F.expr(own)).filter(f"{inside(now)} OR {late}").withColumn("kind", F.explode(F.expr(kinds)))
    days = "CASE kind WHEN 'late' THEN 1 + click_id % 6 WHEN 'moved' THEN 8 ELSE 0 END"
    return rows.withColumns(
        {
            "updated_at": F.expr(f"updated_at + make_dt_interval(CAST({days} AS INT))"),
            "event_timestamp": F.expr("event_timestamp + make_dt_interval(CAST(if(kind = 'moved', 1, 0) AS INT))"),
            "arrival": F.expr(f"slice + if(kind IN ('late', 'moved'), {LATE_SLICES}, 0)"),
        }
    ).drop("slice", "kind")


def read_feed(spark: SparkSession, folder: str, arrivals: Iterable[int] = range(SLICES)) -> DataFrame:
    return as_feed(read_clicks(spark, folder), arrivals)


#: A file of a slice holds the clicks of about so many events.
FEED_FILE = 250_000
#: Up to so many files, one holds fewer: those of a middling feed would else be written by a few long tasks.
FEW_FILES, SMALL_FILE = 24, 50_000


def feed_files(events: int) -> int:
    """Files of each slice: two, and more of a large feed, so that neither its writers nor its readers are two tasks."""
    small = -(-events // (SLICES * SMALL_FILE))
    return max(2, min(FEW_FILES, small), -(-events // (SLICES * FEED_FILE)))


def write_feed(clicks: DataFrame, path: str, files: int = 2) -> None:
    """The feed of ``clicks`` as files, slice after slice, so that a stream that takes ``files`` at once sees a slice in each batch.

    A slice with fewer rows than files gets empty ones, else later slices would be cut between batches. Rows are dealt by their hash: dealt in
    turn they would be sorted first.
    """
    spark = clicks.sparkSession
    for number in range(SLICES):
        rows = as_feed(clicks, [number]).drop("arrival")
        rows.repartition(files, "click_id", "updated_at").write.mode("append").parquet(path)
        held = sum(name.startswith("part-") for name in names_in(spark, path))
        for _ in range(files * (number + 1) - held):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(path)


def read_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return as_clicks(read_events(spark, folder), read_pages(spark, folder))


def stream_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return as_clicks(stream_events(spark, folder), read_pages(spark, folder))


def read_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """A session source: a user's day of events, source and device by user number, no user for each 97th."""
    events = read_events(spark, folder)
    per_session = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min(F.col("ts").cast("timestamp")).alias("started_at"),
        F.max(F.col("ts").cast("timestamp")).alias("last_at"),
        F.count_if(F.col("event_type") == "view").alias("views"),
    )
    seconds = F.unix_timestamp("last_at") - F.unix_timestamp("started_at")
    length = F.when(seconds > 0, seconds)
    user = F.col("user_id")
    return per_session.select(
        F.concat_ws("_", F.lit("sess"), user, "day").alias("session_id"),
        F.when(user % 97 != 0, user).alias("user_id"),
        "started_at",
        F.when(seconds > 0, F.col("last_at")).alias("ended_at"),
        length.cast("int").alias("duration_seconds"),
        F.col("views").cast("int").alias("page_views_count"),
        (F.col("views") == 1).alias("bounce"),
        pick(TRAFFIC_SOURCES, user % 4).alias("traffic_source"),
        pick(DEVICE_TYPES, user % 3).alias("device_type"),
        F.col("started_at").alias("created_at"),
    ).select(*SESSIONS.fieldNames())
