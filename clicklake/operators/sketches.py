"""Distinct counts that can be added up: sketches of an hour, of a day, of a month, as stored state.

A sketch of ``2 ** PRECISION`` places takes a few kilobytes whatever it has seen, and sketches unite without loss: that of a month is made
of its hours' and equals the one of all its rows. The count that it tells is off by about ``1.04 / sqrt(2 ** PRECISION)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRECISION = 12
#: Three standard errors.
ERROR = 3 * 1.04 / 2 ** (PRECISION / 2)
COUNTED = {"users": "user_id", "sessions": "session_id"}


def hourly_sketches(silver: DataFrame, precision: int = PRECISION) -> DataFrame:
    """date, hour, event_type, event_count and a sketch of users and of sessions."""
    hour = F.hour("event_timestamp").alias("hour")
    sketches = [F.hll_sketch_agg(column, F.lit(precision)).alias(name) for name, column in COUNTED.items()]
    return silver.groupBy(F.col("event_date").alias("date"), hour, "event_type").agg(
        F.count(F.lit(1)).alias("event_count"), *sketches
    )


def united(sketches: DataFrame, *by) -> DataFrame:
    """Sketches rolled up to coarser groups."""
    unions = [F.hll_union_agg(name).alias(name) for name in COUNTED]
    return sketches.groupBy(*by).agg(F.sum("event_count").alias("event_count"), *unions)


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """Counts in place of sketches."""
    return sketches.withColumns({name: F.hll_sketch_estimate(name) for name in COUNTED})
