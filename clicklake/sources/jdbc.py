"""Reading a source table from a relational database, split by change time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicklake.operators.slices import Moment, as_moment, changed_between
from clicklake.schemas import CLICK_TABLE, TableSpec


def jdbc_options(
    url: str, spec: TableSpec, start: Moment, end: Moment, partitions: int, **properties: str
) -> dict[str, str]:
    """Options of a parallel read: ``partitions`` stripes of the change column, so an index on it serves each."""
    return {
        "url": url,
        "dbtable": spec.name,
        "partitionColumn": spec.change_column,
        "lowerBound": as_moment(start),
        "upperBound": as_moment(end),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        **properties,
    }


def extract_jdbc(
    spark: SparkSession,
    url: str,
    start: Moment,
    end: Moment,
    spec: TableSpec = CLICK_TABLE,
    partitions: int = 32,
    **properties: str,
) -> DataFrame:
    """Rows changed in ``[start, end)``. Spark pushes both bounds and the column list into the database."""
    reader = spark.read.format("jdbc").options(**jdbc_options(url, spec, start, end, partitions, **properties))
    return changed_between(reader.load(), start, end, spec)
