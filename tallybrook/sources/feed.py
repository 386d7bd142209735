"""The change feed: ``(lsn BIGINT, payload STRING)`` from files or a message log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "lsn BIGINT, payload STRING"

# Files a trigger takes at most, unless told otherwise: the first batch of a new stream
# would else be the whole backlog.
FILES_PER_TRIGGER = 1000

BROKEN = "_broken_line"


def _reader(reader, file_format: str):
    """A line that is not a message keeps its text, as a payload without a position."""
    if file_format != "json":
        return reader.schema(MESSAGE_SCHEMA).format(file_format)
    return reader.schema(f"{MESSAGE_SCHEMA}, {BROKEN} STRING").option("columnNameOfCorruptRecord", BROKEN).format("json")


def _messages(landed: DataFrame) -> DataFrame:
    if BROKEN not in landed.columns:
        return landed
    broken = F.col(BROKEN).isNotNull()
    return landed.select(
        F.when(~broken, F.col("lsn")).alias("lsn"),
        F.when(broken, F.col(BROKEN)).otherwise(F.col("payload")).alias("payload"),
    )


def read_messages(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """A landed feed as a batch."""
    return _messages(_reader(spark.read, file_format).load(path))


def stream_messages(
    spark: SparkSession,
    path: str,
    file_format: str = "json",
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """A folder that keeps receiving feed files."""
    reader = _reader(spark.readStream, file_format).option("maxFilesPerTrigger", files_per_trigger)
    return _messages(reader.load(path))


def stream_topic(spark: SparkSession, servers: str, topic: str, per_trigger: int = 1_000_000) -> DataFrame:
    """A topic that carries the payloads, with the source position as message key.

    Needs Spark's Kafka connector on the class path. The offset cannot stand in for the
    position, as it only orders messages within one partition.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_trigger)
    )
    return reader.load().select(
        F.col("key").cast("string").try_cast("bigint").alias("lsn"),
        F.col("value").cast("string").alias("payload"),
    )
