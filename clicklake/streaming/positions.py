"""What a query's checkpoint tells: the watermark, the moment and the files of each of its batches; and replays from one of them.

A query writes the log of a batch before it runs it, so what is read here is what the batch itself goes by, also after a
restart.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.operators.slices import Moment, as_moment
from clicklake.schemas import CLICK_TABLE, TableSpec
from clicklake.sources.snapshots import names_in, read_text


def batch_metadata(spark: SparkSession, checkpoint: str, number: int) -> dict:
    """Watermark (``batchWatermarkMs``) and moment (``batchTimestampMs``) of a batch."""
    return json.loads(read_text(spark, f"{checkpoint}/offsets/{number}").splitlines()[1])


def watermark_of(spark: SparkSession, checkpoint: str, number: int) -> int:
    """Milliseconds; 0 before there is one."""
    return max(0, int(batch_metadata(spark, checkpoint, number)["batchWatermarkMs"]))


def batches(spark: SparkSession, checkpoint: str) -> list[int]:
    return sorted(int(n) for n in names_in(spark, f"{checkpoint}/offsets") if n.isdigit())


def batch_at(spark: SparkSession, checkpoint: str, moment: Moment) -> int | None:
    """The first batch that ran at the moment (UTC) or after it."""
    since = datetime.fromisoformat(as_moment(moment)).replace(tzinfo=timezone.utc).timestamp() * 1000
    for number in batches(spark, checkpoint):
        if batch_metadata(spark, checkpoint, number)["batchTimestampMs"] >= since:
            return number
    return None


def files_by_batch(spark: SparkSession, checkpoint: str, source: int = 0) -> dict[int, list[str]]:
    """The files that each batch of a file stream took, from the source's own log and its compacted parts."""
    folder = f"{checkpoint}/sources/{source}"
    out: dict[int, dict[str, None]] = {}
    for name in names_in(spark, folder):
        if not name.split(".")[0].isdigit():
            continue
        for line in read_text(spark, f"{folder}/{name}").splitlines()[1:]:
            entry = json.loads(line)
            out.setdefault(int(entry["batchId"]), {})[entry["path"]] = None
    return {number: list(files) for number, files in sorted(out.items())}


def replayed(
    spark: SparkSession, checkpoint: str, start: int, spec: TableSpec = CLICK_TABLE, source: int = 0
) -> Iterator[tuple[int, DataFrame]]:
    """Number and rows of each batch of a file stream from ``start`` on, as they were delivered."""
    for number, files in files_by_batch(spark, checkpoint, source).items():
        if number >= start:
            yield number, spark.read.schema(spec.schema).parquet(*files)


def stored_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The rows of a stateful operator's state as of the last batch: key, value and partition."""
    rows = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return rows.select("key", "value", F.col("partition_id"))
