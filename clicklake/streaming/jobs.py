"""Streaming jobs. Each is exactly-once: the checkpoint fixes what a batch holds, and the sink commits a
batch atomically or overwrites only what the same batch wrote before.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clicklake.operators.rebuild import date_list
from clicklake.operators.slices import Moment, as_moment, next_day
from clicklake.plans.bronze import land, publish_rows, stage_rows
from clicklake.plans.silver import rebuild_silver
from clicklake.schemas import CHECKPOINT_INTERVAL, CLICK_TABLE, TableSpec
from clicklake.sources.lake import Lake, log_batch, read_batch_log
from clicklake.sources.snapshots import Staged, compact, current, expire, path_exists, publish, read_snapshot, read_text, stage, write_new
from clicklake.streaming.operators import watermarked
from clicklake.streaming.positions import replayed, watermark_of
from clicklake.streaming.sources import MALFORMED

#: Commits of a day that are read side by side before they are merged.
MOST = 8

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(spark: SparkSession, writer: DataStreamWriter, checkpoint: str, drain: bool) -> StreamingQuery:
    """Run on the checkpoint interval, or with ``drain`` over what there is now and then stop.

    State is kept in RocksDB, out of the executors' heaps; a query takes its settings when it starts.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=CHECKPOINT_INTERVAL)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return writer.start()
    finally:
        spark.conf.set(STATE_STORE, before)


def stream_to_files(stream: DataFrame, path: str, checkpoint: str, *partition_by: str, drain: bool = False):
    writer = stream.writeStream.format("parquet").option("path", path)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    return _start(stream.sparkSession, writer, checkpoint, drain)


def stream_to_bronze(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    batch_id: str = "stream",
    drain: bool = False,
    spec: TableSpec = CLICK_TABLE,
) -> StreamingQuery:
    """Land the stream as raw rows by change date. The folder is the stream's own: its commit log decides
    which files count, so batch jobs write elsewhere.
    """
    rows = stream.withColumns({"batch_id": F.lit(batch_id), "extract_date": F.to_date(spec.change_column)})
    return stream_to_files(rows, path, checkpoint, "extract_date", drain=drain)


def land_batch(
    rows: DataFrame, lake: Lake, run: str, number: int, spec: TableSpec = CLICK_TABLE, most: int = MOST, refine: bool = True
) -> None:
    """One micro-batch into the raw layer, and the refined dates of its keys rebuilt, or with ``refine`` off left noted as pending.

    The raw layer knows the last number that landed of each run, so a batch that runs again lands once, even if its files were merged
    with others since. Days that more than ``most`` commits hold are merged, so the number of folders that a reader
    lists stays the same however long a stream runs.
    """
    spark, name = rows.sparkSession, batch_of(run, number)
    if current(spark, lake.bronze(spec)).landed.get(run, -1) < number:
        landed = rows.withColumns({"batch_id": F.lit(name), "extract_date": F.to_date(spec.change_column)})
        started = datetime.now(timezone.utc)
        staged = stage_rows(landed, lake, spec, name)
        if staged.rows:
            publish_rows(spark, lake, staged, spec=spec, series=(run, number))
            log_batch(spark, lake, name, f"bronze.{spec.name}", staged.rows, started)
            if compact(spark, lake.bronze(spec), spec.bronze, [F.col(spec.key)], most, staged.partitions):
                expire(spark, lake.bronze(spec))
    if refine:
        rebuild_silver(spark, lake, [], spec)


def batch_of(run: str, number: int) -> str:
    return f"stream_{run}_{number:012d}"


def run_name(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def stream_to_silver(
    stream: DataFrame,
    lake: Lake,
    checkpoint: str,
    drain: bool = False,
    spec: TableSpec = CLICK_TABLE,
    most: int = MOST,
    delay: str | None = None,
    unknown: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Keep the refined layer current. Each micro-batch is a commit of the raw layer, named after the
    checkpoint and its number (``land_batch``); then the event dates of its keys are rebuilt by the batch operators. A whole or
    partial replay under a new checkpoint therefore ends in the same refined table, and batch runs may share the lake, one writer at a time.
    Messages that could not be decoded go to the lake's ``rejected`` folder, by batch. With a ``delay``, rows behind the watermark are set
    aside for ``repair_late``. ``unknown`` leaves of a batch what has yet to land.
    """
    run = run_name(checkpoint)

    def land_and_refine(rows: DataFrame, number: int) -> None:
        if MALFORMED in rows.columns:
            rejected = rows.filter(F.col(MALFORMED).isNotNull()).select(MALFORMED)
            folder = f"{lake.root}/rejected/{spec.name}/batch_id={batch_of(run, number)}"
            rejected.write.mode("overwrite").parquet(folder)
            rows = rows.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
        watermark = watermark_of(rows.sparkSession, checkpoint, number) if delay else 0
        timely = rows.filter(~behind(watermark, spec)) if watermark else rows
        with ThreadPoolExecutor(1) as pool:
            # staged while the others land: both are small jobs, and either lands once if the batch runs again
            aside = pool.submit(inheritable_thread_target(rows.sparkSession)(stage_late), rows, watermark, lake, run, number, spec)
            land_batch(unknown(timely) if unknown else timely, lake, run, number, spec, most)
        set_late_aside(rows.sparkSession, aside.result(), lake, run, number, spec)

    stream = watermarked(stream, delay, spec) if delay else stream
    return _start(stream.sparkSession, stream.writeStream.foreachBatch(land_and_refine), checkpoint, drain)


def behind(watermark: int, spec: TableSpec = CLICK_TABLE) -> Column:
    """Whether a row is behind the watermark (milliseconds). Rows without an event time are not."""
    return F.coalesce(F.unix_millis(spec.event_column) < F.lit(watermark), F.lit(False))


def stage_late(
    rows: DataFrame, watermark: int, lake: Lake, run: str, number: int, spec: TableSpec = CLICK_TABLE
) -> tuple[Staged, datetime] | None:
    """Write the rows of a batch that are behind its watermark where no reader sees them yet; with the moment it began. None before there is a
    watermark, and where they landed before.
    """
    spark, name = rows.sparkSession, batch_of(run, number)
    if not watermark or current(spark, lake.late(spec)).landed.get(run, -1) >= number:
        return None
    started = datetime.now(timezone.utc)
    late = rows.filter(behind(watermark, spec)).withColumns({"batch_id": F.lit(name), "extract_date": F.to_date(spec.change_column)})
    return stage(late, lake.late(spec), "extract_date", [F.col(spec.key)], name), started


def set_late_aside(
    spark: SparkSession, aside: tuple[Staged, datetime] | None, lake: Lake, run: str, number: int, spec: TableSpec = CLICK_TABLE
) -> None:
    """Publish the late rows of a batch in the late table and count them in the batch log."""
    if aside:
        staged, started = aside
        publish(spark, staged, series=(run, number))
        if staged.rows:
            log_batch(spark, lake, batch_of(run, number), f"late.{spec.name}", staged.rows, started)


def late_rows(spark: SparkSession, lake: Lake, spec: TableSpec = CLICK_TABLE) -> int:
    """How many rows were set aside so far, by all runs and restarts: a batch that is logged twice counts once."""
    logged = read_batch_log(spark, lake).filter(F.col("table") == f"late.{spec.name}")
    return logged.groupBy("batch_id").agg(F.max("rows").alias("rows")).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def repair_late(spark: SparkSession, lake: Lake, spec: TableSpec = CLICK_TABLE) -> int:
    """Land the rows that were set aside and rebuild the dates of their keys: no other row of history is extracted again. Returns
    how many there were. A repair that dies is made good by the next one.
    """
    table = current(spark, lake.late(spec))
    if not table.entries:
        return 0
    aside, number = read_snapshot(spark, lake.late(spec), spec.bronze), table.version
    if current(spark, lake.bronze(spec)).landed.get("late", -1) < number:
        staged = stage_rows(aside, lake, spec, f"late_{number:012d}")
        publish_rows(spark, lake, staged, spec=spec, series=("late", number))
    count = aside.count()
    rebuild_silver(spark, lake, [], spec)
    publish(spark, stage(aside.limit(0), lake.late(spec), "extract_date"), entries=table.entries)
    expire(spark, lake.late(spec))
    return count


def replay(spark: SparkSession, lake: Lake, checkpoint: str, start: int, spec: TableSpec = CLICK_TABLE) -> int:
    """Land the batches of a file stream again, from number ``start`` on, as its checkpoint recorded them, and then rebuild the dates of
    all their keys at once. Returns how many batches there were. If it dies on the way, the dates of those that landed stay noted as pending.
    """
    run, count = f"replay-{uuid.uuid4().hex[:12]}", 0
    for number, rows in replayed(spark, checkpoint, start, spec):
        land_batch(rows, lake, run, number, spec, refine=False)
        count += 1
    if count:
        rebuild_silver(spark, lake, [], spec)
    return count


def hybrid_run(
    spark: SparkSession,
    lake: Lake,
    history: DataFrame,
    stream: DataFrame,
    cutover: Moment,
    checkpoint: str,
    drain: bool = False,
    spec: TableSpec = CLICK_TABLE,
) -> StreamingQuery:
    """History by one batch run up to ``cutover``, then the stream, without a gap and without landing a row twice.

    The cut-over is stored with the lake once the history is in it; later calls go on with the stream from there, and one with another
    cut-over raises. Of a micro-batch, rows changed from the cut-over on are new. Rows changed before it are held against the raw rows of
    their days: what the history had is left out, what it missed, since it reached the source later, lands.
    """
    moment, path = as_moment(cutover), lake.handover(spec)
    if path_exists(spark, path):
        if (held := read_text(spark, path)) != moment:
            raise ValueError(f"{spec.name} was handed over at {held}, not at {moment}")
    else:
        before = history.filter(F.col(spec.change_column) < F.lit(moment).cast("timestamp"))
        first, last = before.agg(F.min(F.to_date(spec.change_column)), F.max(F.to_date(spec.change_column))).first()
        if first is not None:
            land(spark, lake, before, first, next_day(last), spec=spec)
            rebuild_silver(spark, lake, [], spec)
        write_new(spark, path, moment)

    def unknown(rows: DataFrame) -> DataFrame:
        changed = F.col(spec.change_column)
        old = rows.filter(changed < F.lit(moment).cast("timestamp"))
        days = date_list(old.select(F.to_date(changed)).distinct())
        if not days:
            return rows
        names = {d.isoformat() for d in days}
        held = read_snapshot(spark, lake.bronze(spec), spec.bronze, names.__contains__).select(*spec.columns)
        # both sides of equal hashes of the whole row: an equality that holds for nulls too
        told = lambda df: df.withColumn("_row", F.xxhash64(*spec.columns)).withColumn("_nulls", nulls)
        nulls = sum((F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(spec.columns)), F.lit(0))
        missed = told(old).join(told(held).select("_row", "_nulls").distinct(), ["_row", "_nulls"], "left_anti")
        new = rows.filter((changed >= F.lit(moment).cast("timestamp")) | changed.isNull())
        return new.unionByName(missed.drop("_row", "_nulls"))

    return stream_to_silver(stream, lake, checkpoint, drain, spec, unknown=unknown)
