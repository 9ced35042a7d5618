"""Latest version per key.

``row_number() = 1`` makes Catalyst put a group limit below the exchange, so every map task sends at most
one row per key. A key that holds a third of the table costs one row per task, not one giant partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklake.schemas import CLICK_TABLE, TableSpec

TIEBREAK = "_tiebreak"


def content_hash(spec: TableSpec) -> Column:
    """Hash of the columns that do not order versions: two versions tie only if they are equal."""
    ordering = {spec.key, spec.change_column, spec.event_column}
    return F.xxhash64(*[c for c in spec.columns if c not in ordering])


def newest(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key of ``rows``, which carry the ``TIEBREAK`` column; it is dropped."""
    order = [F.desc_nulls_last(spec.change_column), F.desc_nulls_last(spec.event_column), F.desc(TIEBREAK)]
    if "batch_id" in rows.columns:
        order.append(F.desc_nulls_last("batch_id"))
    versions = Window.partitionBy(spec.key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(versions)).filter("_rank = 1").drop("_rank", TIEBREAK)


def latest_versions(df: DataFrame, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    return newest(df.withColumn(TIEBREAK, content_hash(spec)), spec)


def union_versions(first: DataFrame, second: DataFrame, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    """Union of two overlapping extracts, one row per key; a column missing on one side becomes null."""
    return latest_versions(first.unionByName(second, allowMissingColumns=True), spec)
