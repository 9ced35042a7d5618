"""Row counts per layer and date, and the dates a layer has no rows for."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.operators.slices import Moment, as_day


def rows_per_date(layer: DataFrame, date_column: str, name: str) -> DataFrame:
    return layer.groupBy(F.col(date_column).alias("date")).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("layer"), "date", "rows"
    )


def calendar(spark: SparkSession, start: Moment, end: Moment) -> DataFrame:
    """Every date in ``[start, end)``."""
    first, last = as_day(start), as_day(end) - timedelta(days=1)
    if last < first:
        return spark.createDataFrame([], "date date")
    days = F.sequence(F.lit(first), F.lit(last))
    return spark.range(1).select(F.explode(days).alias("date"))


def missing_dates(layer: DataFrame, date_column: str, start: Moment, end: Moment) -> DataFrame:
    """Dates in ``[start, end)`` without a row in ``layer``."""
    first, last = as_day(start), as_day(end)
    present = layer.select(F.col(date_column).alias("date")).filter(
        (F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(last))
    )
    return calendar(layer.sparkSession, start, end).join(present.distinct(), "date", "left_anti")
