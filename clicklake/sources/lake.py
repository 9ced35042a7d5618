"""The lake's paths, scans and sinks. Paths are plain strings of any scheme Spark can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DoubleType, IntegerType, LongType, ShortType, StructType

from clicklake.operators.slices import Moment, as_day
from clicklake.schemas import BATCH_LOG, CLICK_TABLE, TableSpec
from clicklake.sources.snapshots import delete, is_snapshot_table, names_in, path_exists, read_snapshot, touch


@dataclass(frozen=True)
class Lake:
    root: str

    def bronze(self, spec: TableSpec = CLICK_TABLE) -> str:
        return f"{self.root}/bronze/{spec.name}"

    def silver(self, spec: TableSpec = CLICK_TABLE) -> str:
        return f"{self.root}/silver/{spec.name}"

    def gold(self, metric: str) -> str:
        return f"{self.root}/gold/{metric}"

    def keys(self, spec: TableSpec = CLICK_TABLE) -> str:
        return f"{self.root}/keys/{spec.name}"

    def late(self, spec: TableSpec = CLICK_TABLE) -> str:
        return f"{self.root}/late/{spec.name}"

    def handover(self, spec: TableSpec = CLICK_TABLE) -> str:
        return f"{self.root}/handover/{spec.name}"

    def pending(self, stage: str, spec: TableSpec = CLICK_TABLE) -> str:
        return f"{self.root}/pending/{stage}/{spec.name}"

    @property
    def batch_log(self) -> str:
        return f"{self.root}/batch_log"


class VerificationError(RuntimeError):
    """The stored rows are not those that were written."""


@dataclass(frozen=True)
class Written:
    rows: int
    dates: tuple[date, ...]


def day_of(number: int) -> date:
    """The date of a day's number, as ``unix_date`` gives it: sets of numbers cost less to gather than sets of texts."""
    return date(1970, 1, 1) + timedelta(days=number)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan with the declared schema; no rows when nothing is stored yet. Old files lack new columns: null. Of a table with
    versions, the latest is read.
    """
    if is_snapshot_table(spark, path):
        return read_snapshot(spark, path, schema)
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_with_evolution(spark: SparkSession, path: str) -> DataFrame:
    """Scan of files whose schemas differ: a column that some files lack is null there, and a type that was widened between files (a whole
    number to a longer one or to a fraction, a date to a moment) is the widest. A path that does not exist raises, so this is how sources are read.

    Files of one schema are read together, brought to the common types, and united.
    """
    partitioned = spark.read.parquet(path)
    groups: dict[str, tuple[StructType, list[str]]] = {}
    with ThreadPoolExecutor(16) as pool:
        files = partitioned.inputFiles()
        for file, schema in zip(files, pool.map(lambda f: spark.read.parquet(f).schema, files)):
            groups.setdefault(schema.json(), (schema, []))[1].append(file)
    if len(groups) < 2:
        return partitioned
    common: dict[str, DataType] = {}
    for schema, _ in groups.values():
        for held in schema:
            common[held.name] = wider(common[held.name], held.dataType, held.name) if held.name in common else held.dataType
    folders = [f for f in partitioned.schema if f.name not in common]
    out = None
    for schema, members in groups.values():
        rows = spark.read.option("basePath", path).schema(StructType([*schema.fields, *folders])).parquet(*members)
        columns = [
            F.col(f"`{n}`").cast(t).alias(n) if n in schema.names else F.lit(None).cast(t).alias(n) for n, t in common.items()
        ]
        rows = rows.select(*columns, *[f"`{f.name}`" for f in folders])
        out = rows if out is None else out.unionByName(rows)
    return out


#: Types that hold all values of those before them.
WHOLE = (ByteType(), ShortType(), IntegerType(), LongType())


def wider(one: DataType, other: DataType, name: str = "") -> DataType:
    """The type that holds all values of both; raises where there is none."""
    if one == other:
        return one
    pair = {one.typeName(), other.typeName()}
    if one in WHOLE and other in WHOLE:
        return max(one, other, key=WHOLE.index)
    if pair == {"float", "double"} or "double" in pair and pair <= {"double", "byte", "short", "integer"}:
        return DoubleType()
    if pair in ({"date", "timestamp"}, {"date", "timestamp_ntz"}):
        return one if one.typeName() != "date" else other
    if "void" in pair:
        return other if one.typeName() == "void" else one
    raise TypeError(f"{name}: no type holds both {one.simpleString()} and {other.simpleString()}")


def preview(df: DataFrame, *columns: str, rows: int = 5) -> DataFrame:
    """A few rows to look at; off unless asked for, since showing them runs the plan again."""
    return (df.select(*columns) if columns else df).limit(rows)


def between_dates(df: DataFrame, column: str, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """``[start, end)`` on a partition column, so only those partitions are listed and read."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(as_day(start)))
    if end is not None:
        df = df.filter(F.col(column) < F.lit(as_day(end)))
    return df


def read_bronze(
    spark: SparkSession,
    lake: Lake,
    start: Moment | None = None,
    end: Moment | None = None,
    spec: TableSpec = CLICK_TABLE,
) -> DataFrame:
    """Raw rows as last published; folders of days outside ``[start, end)`` are not listed."""
    path, low, high = lake.bronze(spec), *(None if m is None else as_day(m).isoformat() for m in (start, end))
    if low is None and high is None or not is_snapshot_table(spark, path):
        rows = read_table(spark, path, spec.bronze)
    else:
        inside = lambda day: day[:1].isdigit() and (low is None or day >= low) and (high is None or day < high)
        rows = read_snapshot(spark, path, spec.bronze, inside)
    return between_dates(rows, "extract_date", start, end)


def read_silver(
    spark: SparkSession, lake: Lake, dates: Iterable[date] | None = None, spec: TableSpec = CLICK_TABLE
) -> DataFrame:
    silver = read_table(spark, lake.silver(spec), spec.silver)
    return silver if dates is None else silver.filter(F.col("event_date").isin(list(dates)))


def overwrite_partitions(
    df: DataFrame, path: str, date_column: str, *extra: str, spread: bool = True, order: Iterable[Column] = ()
) -> Written:
    """Replace the partitions ``df`` has rows for and leave the others; one job, which also counts.

    ``spread`` lets adaptive execution cut a large date into several tasks and gather small ones, so a hot
    date is not one file from one task, and a small date is not a file per task. ``order`` sorts each file.
    """
    if spread:
        df = df.hint("rebalance", date_column)
    if order:
        df = df.sortWithinPartitions(date_column, *extra, *order)
    seen = Observation()
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(F.unix_date(F.col(date_column).cast("date"))).alias("days"),
    )
    writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(date_column, *extra).parquet(path)
    return Written(seen.get["rows"], tuple(sorted(day_of(number) for number in seen.get["days"])))


def clear_partitions(
    spark: SparkSession, path: str, schema: StructType, date_column: str, dates: Iterable[date]
) -> list[date]:
    """Empty the stored partitions of ``dates``. A dynamic overwrite cannot: it skips dates without rows."""
    dates = list(dates)
    if not dates:
        return []
    rows = read_table(spark, path, schema).filter(F.col(date_column).isin(dates))
    held = sorted(r[0] for r in rows.select(date_column).distinct().collect())
    empty = spark.createDataFrame([], StructType([f for f in schema if f.name != date_column]))
    for day in held:
        empty.coalesce(1).write.mode("overwrite").parquet(f"{path}/{date_column}={day.isoformat()}")
    return held


def replace_dates(
    df: DataFrame,
    path: str,
    schema: StructType,
    date_column: str,
    dates: Iterable[date],
    spread: bool = True,
    order: Iterable[Column] = (),
) -> Written:
    """Make the partitions of ``dates`` hold exactly the rows of ``df``, including those left with none."""
    written = overwrite_partitions(df, path, date_column, spread=spread, order=order)
    clear_partitions(df.sparkSession, path, schema, date_column, set(dates) - set(written.dates))
    return written


def verify_rows(spark: SparkSession, path: str, schema: StructType, where: Column, expected: int) -> int:
    """Count the stored rows of the partitions ``where`` selects and raise unless they are ``expected``."""
    found = read_table(spark, path, schema).filter(where).count()
    if found != expected:
        raise VerificationError(f"{path}: {found} rows stored, {expected} written")
    return found


def log_batch(
    spark: SparkSession,
    lake: Lake,
    batch_id: str,
    table: str,
    rows: int,
    started: datetime | None = None,
    success: bool = True,
) -> None:
    finished = datetime.now(timezone.utc)
    values = (batch_id, table, rows, started or finished, finished, success)
    # literals over one row: rows made in Python would start a worker for each entry
    entry = [F.lit(value).cast(held.dataType).alias(held.name) for value, held in zip(values, BATCH_LOG)]
    spark.range(0, 1, 1, 1).select(*entry).write.mode("append").parquet(lake.batch_log)


def read_batch_log(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.batch_log, BATCH_LOG)


def add_pending(
    spark: SparkSession, lake: Lake, dates: Iterable[date], spec: TableSpec = CLICK_TABLE, stage: str = "silver"
) -> None:
    """Note event dates that ``stage`` has yet to rebuild, each by an empty file of its name. The raw layer notes them for the refined
    one before it replaces rows, the refined layer for the aggregated one before and after it does; so a run that dies leaves
    its mark, in whatever order the stages are taken up again.
    """
    for day in sorted(set(dates) - set(pending_dates(spark, lake, spec, stage))):
        touch(spark, f"{lake.pending(stage, spec)}/{day.isoformat()}")


def pending_dates(
    spark: SparkSession, lake: Lake, spec: TableSpec = CLICK_TABLE, stage: str = "silver"
) -> list[date]:
    return [date.fromisoformat(n) for n in names_in(spark, lake.pending(stage, spec)) if n[:1].isdigit()]


def clear_pending(
    spark: SparkSession, lake: Lake, dates: Iterable[date], spec: TableSpec = CLICK_TABLE, stage: str = "silver"
) -> None:
    """``stage`` is current on ``dates``; to be called by that stage only."""
    for day in sorted(set(dates) & set(pending_dates(spark, lake, spec, stage))):
        delete(spark, f"{lake.pending(stage, spec)}/{day.isoformat()}")


def replace_table(df: DataFrame, path: str) -> int:
    """Replace a whole table by way of a second folder: a failed write leaves the old one. Returns its rows."""
    spark, seen = df.sparkSession, Observation()
    staged, old = (f"{path}.{kind}-{uuid.uuid4().hex}" for kind in ("staged", "old"))
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    system = as_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(as_path(path)):
        system.rename(as_path(path), as_path(old))
    if not system.rename(as_path(staged), as_path(path)):
        raise OSError(f"{staged} could not be moved to {path}")
    system.delete(as_path(old), True)
    return seen.get["rows"]


def write_idempotent(
    spark: SparkSession,
    df: DataFrame,
    lake: Lake,
    path: str,
    date_column: str,
    batch_id: str,
    table: str,
    dates: Iterable[date] = (),
    **options,
) -> Written:
    """Replace the partitions of one batch and log it; the same batch again leaves the same rows. ``dates`` are
    those the batch answers for: they are emptied where it has no rows.
    """
    started = datetime.now(timezone.utc)
    written = replace_dates(df, path, df.schema, date_column, dates, **options)
    log_batch(spark, lake, batch_id, table, written.rows, started)
    return written
