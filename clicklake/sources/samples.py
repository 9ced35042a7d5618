"""Sample sessions and clicks as a pure function of (id, seed): no shuffle, and any partitioning agrees.

A click takes a session by number and recomputes that session's start and length, so nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.schemas import CLICKS, DEVICE_TYPES, SESSIONS, SILVER_EVENT_TYPES, TRAFFIC_SOURCES

# What the sample data is drawn from.
SAMPLE_CLICKS = 100_000
SAMPLE_SESSIONS = 10_000
SAMPLE_USERS = 10_000
SAMPLE_START = "2024-01-01 00:00:00"
SAMPLE_END = "2024-03-21 00:00:00"
MAX_SECONDS = 3600
MAX_PAGE_VIEWS = 50
AGENT_BROWSERS = ["Chrome", "Firefox", "Safari", "Edge"]
AGENT_SYSTEMS = ["Windows", "macOS", "Linux", "iOS", "Android"]
AGENT_VERSIONS = (80, 120)
PAGES = [
    "https://shop.example.com/",
    "https://shop.example.com/products",
    "https://shop.example.com/products/electronics",
    "https://shop.example.com/products/clothing",
    "https://shop.example.com/cart",
    "https://shop.example.com/checkout",
    "https://shop.example.com/account",
    "https://shop.example.com/search",
    "https://shop.example.com/blog",
    "https://shop.example.com/contact",
]

PRIME = 2_147_483_647


def draw(key: Column, seed: int, field: int, choices: int) -> Column:
    """A number in ``[0, choices)`` from ``key``: the high bits of a squared linear congruence per field. The part of
    a key above the prime enters with a factor of its own, so that larger keys do not repeat smaller ones.
    """
    factor, shift = pow(48_271, field + 1, PRIME), pow(16_807, seed + field + 1, PRIME)
    low, high = F.pmod(key.cast("long"), F.lit(PRIME)), F.pmod(F.floor(key / PRIME), F.lit(PRIME))
    mixed = (low * factor % PRIME + high * pow(69_621, field + 1, PRIME) % PRIME + shift) % PRIME
    return F.shiftright(mixed * mixed % PRIME * choices, 31)


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _seconds(count: Column) -> Column:
    return F.make_dt_interval(secs=count.cast("decimal(18,6)"))


def _session_start(number: Column, seed: int) -> Column:
    span = F.unix_timestamp(F.lit(SAMPLE_END).cast("timestamp")) - F.unix_timestamp(
        F.lit(SAMPLE_START).cast("timestamp")
    )
    return F.lit(SAMPLE_START).cast("timestamp") + _seconds(draw(number, seed, 1, 1 << 30) % (span + 1))


def _session_seconds(number: Column, seed: int) -> Column:
    return draw(number, seed, 2, MAX_SECONDS + 1)


def _session_user(number: Column, seed: int) -> Column:
    return draw(number, seed, 3, SAMPLE_USERS) + 1


def _session_id(number: Column) -> Column:
    return F.concat(F.lit("sess_"), F.lpad(number.cast("string"), 8, "0"))


def sample_sessions(numbers: DataFrame, seed: int = 42) -> DataFrame:
    """One session per row of ``numbers`` (a bigint column ``id``)."""
    n = F.col("id")
    start, seconds, views = _session_start(n, seed), _session_seconds(n, seed), draw(n, seed, 4, MAX_PAGE_VIEWS) + 1
    length = F.when(seconds > 0, seconds)
    return numbers.select(
        _session_id(n).alias("session_id"),
        _session_user(n, seed).alias("user_id"),
        start.alias("started_at"),
        (start + _seconds(length)).alias("ended_at"),
        length.cast("int").alias("duration_seconds"),
        views.cast("int").alias("page_views_count"),
        (views == 1).alias("bounce"),
        pick(TRAFFIC_SOURCES, draw(n, seed, 5, 4)).alias("traffic_source"),
        pick(DEVICE_TYPES, draw(n, seed, 6, 3)).alias("device_type"),
        start.alias("created_at"),
    ).select(*SESSIONS.fieldNames())


def sample_clicks(
    numbers: DataFrame, sessions: int = SAMPLE_SESSIONS, seed: int = 42, session_user: bool = False
) -> DataFrame:
    """One click per row of ``numbers``. Its user is drawn independently of its session's, unless ``session_user``."""
    n = F.col("id")
    number = draw(n, seed, 11, sessions)
    at = _session_start(number, seed) + _seconds(draw(n, seed, 12, 1 << 30) % (_session_seconds(number, seed) + 1))
    version = draw(n, seed, 17, AGENT_VERSIONS[1] - AGENT_VERSIONS[0] + 1) + AGENT_VERSIONS[0]
    agent = F.format_string(
        "Mozilla/5.0 (%s) %s/%d.0",
        pick(AGENT_SYSTEMS, draw(n, seed, 16, 5)),
        pick(AGENT_BROWSERS, draw(n, seed, 15, 4)),
        version,
    )
    octets = [draw(n, seed, 18 + i, 256).cast("string") for i in range(4)]
    user = _session_user(number, seed) if session_user else draw(n, seed, 10, SAMPLE_USERS) + 1
    return numbers.select(
        (n + 1).alias("click_id"),
        user.alias("user_id"),
        _session_id(number).alias("session_id"),
        pick(PAGES, draw(n, seed, 13, 10)).alias("page_url"),
        pick(SILVER_EVENT_TYPES, draw(n, seed, 14, 4)).alias("event_type"),
        at.alias("event_timestamp"),
        agent.alias("user_agent"),
        F.concat_ws(".", *octets).alias("ip_address"),
        F.when(draw(n, seed, 22, 100) >= 30, pick(PAGES, draw(n, seed, 23, 10))).alias("referrer_url"),
        at.alias("created_at"),
        (at + _seconds(draw(n, seed, 24, MAX_SECONDS + 1))).alias("updated_at"),
    ).select(*CLICKS.fieldNames())


def generate(
    spark: SparkSession, clicks: int = SAMPLE_CLICKS, sessions: int = SAMPLE_SESSIONS, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """The sample source tables, (clicks, sessions)."""
    return sample_clicks(spark.range(clicks), sessions, seed), sample_sessions(spark.range(sessions), seed)
