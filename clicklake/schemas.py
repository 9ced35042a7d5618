"""Declared schemas, table specs and the value sets every layer shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

# The columns of the source tables.
CLICKS = (
    StructType()
    .add("click_id", LongType())
    .add("user_id", LongType())
    .add("session_id", StringType())
    .add("page_url", StringType())
    .add("event_type", StringType())
    .add("event_timestamp", TimestampType())
    .add("user_agent", StringType())
    .add("ip_address", StringType())
    .add("referrer_url", StringType())
    .add("created_at", TimestampType())
    .add("updated_at", TimestampType())
)

SESSIONS = (
    StructType()
    .add("session_id", StringType())
    .add("user_id", LongType())
    .add("started_at", TimestampType())
    .add("ended_at", TimestampType())
    .add("duration_seconds", IntegerType())
    .add("page_views_count", IntegerType())
    .add("bounce", BooleanType())
    .add("traffic_source", StringType())
    .add("device_type", StringType())
    .add("created_at", TimestampType())
)

BATCH_LOG = (
    StructType()
    .add("batch_id", StringType())
    .add("table", StringType())
    .add("rows", LongType())
    .add("started_at", TimestampType())
    .add("finished_at", TimestampType())
    .add("success", BooleanType())
)


QUALITY = (
    StructType()
    .add("layer", StringType())
    .add("check", StringType())
    .add("column", StringType())
    .add("passed", BooleanType())
    .add("failing_rows", LongType())
    .add("total_rows", LongType())
    .add("failing_pct", DoubleType())
)


def bronze_schema(source: StructType) -> StructType:
    return StructType(list(source.fields)).add("batch_id", StringType()).add("extract_date", DateType())


def silver_schema(source: StructType, derived: tuple[str, ...]) -> StructType:
    out = bronze_schema(source)
    for name in derived:
        out = out.add(name, StringType())
    return out.add("event_date", DateType())


@dataclass(frozen=True)
class TableSpec:
    """What the generic operators need to know about one source table."""

    name: str
    schema: StructType
    key: str
    change_column: str
    event_column: str
    derived: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def bronze(self) -> StructType:
        return bronze_schema(self.schema)

    @property
    def silver(self) -> StructType:
        return silver_schema(self.schema, self.derived)


CLICK_TABLE = TableSpec(
    "clicks", CLICKS, "click_id", "updated_at", "event_timestamp", ("domain", "device_type", "browser")
)
SESSION_TABLE = TableSpec("sessions", SESSIONS, "session_id", "created_at", "started_at")
TABLES = {spec.name: spec for spec in (CLICK_TABLE, SESSION_TABLE)}

# The domains the layers accept.
SILVER_EVENT_TYPES = ["page_view", "click", "scroll", "purchase"]
BRONZE_EVENT_TYPES = ["page_view", "click", "scroll", "purchase", "form_submit", "video_play"]
TRAFFIC_SOURCES = ["organic", "paid", "direct", "referral"]
DEVICE_TYPES = ["desktop", "mobile", "tablet"]
BROWSERS = ["Chrome", "Firefox", "Safari", "Edge", "Other"]
# Fixed value: the rows that the raw suite accepts where no other range is given.
BRONZE_ROW_RANGE = (1, 10_000_000)

# Words looked for in a user agent, in order of precedence.
DEVICE_WORDS = [("Mobile", "mobile"), ("Tablet", "tablet"), ("iPhone", "mobile"), ("Android", "mobile")]
BROWSER_WORDS = [("Chrome", "Chrome"), ("Firefox", "Firefox"), ("Safari", "Safari"), ("Edge", "Edge")]

# Operating targets of the lake.
MAX_FRESHNESS_HOURS = 4.0
MAX_BATCH_HOURS = 4.0
MAX_LAG_MINUTES = 5.0
MIN_PASS_RATE = 95.0
LATE_DAYS = 7
WATERMARK = "10 minutes"
CHECKPOINT_INTERVAL = "5 minutes"
