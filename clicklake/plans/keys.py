"""Which event dates the versions of a key lie on: an index of the raw layer in blocks of keys.

The index has a row for each key and event date of any raw version that ever landed, in partitions by block of the key. Numbered keys
lie in blocks of ``BLOCK`` neighbours, so keys that arrive together share blocks and an old key among them adds one block, not all of
history; other keys are dealt to ``HASHED`` blocks. A landing adds its pairs as one commit, before its rows are published, and
blocks that many commits hold are merged. A row that was replaced leaves its pair behind: it can make a date be rebuilt for
nothing, but none is ever missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, NumericType, StructType

from clicklake.schemas import CLICK_TABLE, TableSpec
from clicklake.sources.lake import Lake, read_bronze
from clicklake.sources.snapshots import compact, current, expire, holds_rows, is_snapshot_table, publish, read_snapshot, stage

BLOCK = 1 << 24
HASHED = 256
#: Numbered keys of a block are written in parts of so many neighbours.
PART = 1 << 18
#: Commits of a block that are read side by side before they are merged.
MOST = 8


def index_schema(spec: TableSpec) -> StructType:
    return StructType([spec.schema[spec.key]]).add("event_date", DateType()).add("block", LongType())


def block_of(spec: TableSpec) -> Column:
    """The block of a key; null for a null key."""
    key = F.col(spec.key)
    if isinstance(spec.schema[spec.key].dataType, NumericType):
        return F.floor(key / F.lit(BLOCK)).cast("long")
    return F.when(key.isNotNull(), F.pmod(F.xxhash64(key), F.lit(HASHED).cast("long")))


def part_of(spec: TableSpec) -> Column | None:
    """What part of its block a numbered key lies in: a pair is a few bytes, so that a block of millions would be one task."""
    return F.floor(F.col(spec.key) / F.lit(PART)) if isinstance(spec.schema[spec.key].dataType, NumericType) else None


def pairs(rows: DataFrame, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    """The index rows of raw rows. Versions without an event time have no date."""
    dated = rows.select(spec.key, F.to_date(spec.event_column).alias("event_date"), block_of(spec).alias("block"))
    return dated.where("block IS NOT NULL AND event_date IS NOT NULL").distinct()


def add_keys(spark: SparkSession, lake: Lake, rows: DataFrame, spec: TableSpec = CLICK_TABLE) -> None:
    """Add the keys of rows that are about to be published. A raw layer without an index gets one of all it holds."""
    path = lake.keys(spec)
    if not is_snapshot_table(spark, path) and holds_rows(spark, lake.bronze(spec)):
        rows = rows.unionByName(read_bronze(spark, lake, spec=spec).select(*rows.columns))
    added = stage(pairs(rows, spec), path, "block", [F.col(spec.key)], near=part_of(spec))
    publish(spark, added)
    if compact(spark, path, index_schema(spec), [F.col(spec.key)], MOST, added.partitions, merge=DataFrame.distinct):
        expire(spark, path)


def rebuild_keys(spark: SparkSession, lake: Lake, spec: TableSpec = CLICK_TABLE) -> None:
    """The index anew from the raw layer, without the pairs of rows that were replaced."""
    path = lake.keys(spec)
    held = stage(pairs(read_bronze(spark, lake, spec=spec), spec), path, "block", [F.col(spec.key)], near=part_of(spec))
    publish(spark, held, current(spark, path).partitions)
    expire(spark, path)


def dates_of_keys(
    spark: SparkSession, lake: Lake, keys: DataFrame, blocks: set[int], spec: TableSpec = CLICK_TABLE
) -> DataFrame:
    """Event dates of all versions of the ``keys``, which lie in ``blocks``; other blocks are not listed."""
    names = {str(b) for b in blocks}
    index = read_snapshot(spark, lake.keys(spec), index_schema(spec), names.__contains__)
    found = index.join(keys.select(spec.key).distinct(), spec.key, "left_semi")
    return found.select("event_date").distinct()
