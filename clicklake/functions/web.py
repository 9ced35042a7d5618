"""Column functions over click rows. All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.schemas import BROWSER_WORDS, DEVICE_WORDS

# Fixed value: the host part of a URL, with user info and port.
HOST_PATTERN = "://([^/]+)"


def url_domain(url: Column) -> Column:
    """Host of ``url``; ``''`` when it has none, null for null."""
    return F.regexp_extract(url, HOST_PATTERN, 1)


def label_by_words(text: Column, words: list[tuple[str, str]], default: str) -> Column:
    """Label of the first word found in ``text``; ``default`` when none is, or for null."""
    found = [F.when(F.contains(text, F.lit(word)), F.lit(label)) for word, label in words]
    return F.coalesce(*found, F.lit(default))


def device_type(user_agent: Column) -> Column:
    return label_by_words(user_agent, DEVICE_WORDS, "desktop")


def browser(user_agent: Column) -> Column:
    return label_by_words(user_agent, BROWSER_WORDS, "Other")


def whole_seconds(later: Column, earlier: Column) -> Column:
    """Difference in seconds; each side is floored to its own second first."""
    return later.cast("timestamp").cast("long") - earlier.cast("timestamp").cast("long")


def enrich_clicks(clicks: DataFrame) -> DataFrame:
    return clicks.withColumns(
        {
            "domain": url_domain(F.col("page_url")),
            "device_type": device_type(F.col("user_agent")),
            "browser": browser(F.col("user_agent")),
            "event_date": F.to_date("event_timestamp"),
        }
    )


def zone_free(df: DataFrame) -> DataFrame:
    """Turn zoned timestamps into plain ones (the session zone is UTC), keeping column order."""
    stamps = {f.name for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in stamps else F.col(c) for c in df.columns])
