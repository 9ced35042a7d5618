"""Streams of click rows: Parquet files, a message topic, and where to start reading again."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clicklake.operators.slices import Moment, as_moment
from clicklake.schemas import CLICK_TABLE, TableSpec


def stream_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None, spec: TableSpec = CLICK_TABLE
) -> DataFrame:
    reader = spark.readStream.schema(spec.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


#: Holds the text of a message that is not an object with the table's columns; null in sound rows.
MALFORMED = "malformed"


def decode_messages(messages: DataFrame, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    """Rows of a topic whose ``value`` is a JSON object with the table's columns, and ``malformed``."""
    schema = StructType([*spec.schema.fields, StructField(MALFORMED, StringType())])
    text = F.col("value").cast("string")
    row = F.from_json(text, schema, {"columnNameOfCorruptRecord": MALFORMED})
    decoded = messages.select(text.alias("text"), row.alias("row")).select("text", "row.*")
    unread = F.col(MALFORMED).isNull() & F.coalesce(*[F.col(c).cast("string") for c in spec.columns]).isNull()
    return decoded.withColumn(MALFORMED, F.when(unread, F.coalesce("text", F.lit(""))).otherwise(F.col(MALFORMED))).drop("text")


def topic_options(servers: str, spec: TableSpec = CLICK_TABLE, start: str | Moment = "earliest") -> dict[str, str]:
    """Options of a topic read from ``earliest``, from ``latest``, or from a moment on."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": spec.name}
    if start in ("earliest", "latest"):
        return {**options, "startingOffsets": start}
    since = datetime.fromisoformat(as_moment(start)).replace(tzinfo=timezone.utc)
    return {**options, "startingTimestamp": str(int(since.timestamp() * 1000))}


def stream_topic(
    spark: SparkSession, servers: str, spec: TableSpec = CLICK_TABLE, start: str | Moment = "earliest"
) -> DataFrame:
    """Needs the message connector on the class path; everything downstream takes any click stream."""
    reader = spark.readStream.format("kafka").options(**topic_options(servers, spec, start))
    return decode_messages(reader.load(), spec)


def changed_since(stream: DataFrame, moment: Moment, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    """The part of a stream changed at or after ``moment``: a partial replay of a source without offsets."""
    return stream.filter(F.col(spec.change_column) >= F.lit(as_moment(moment)).cast("timestamp"))
