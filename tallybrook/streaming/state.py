"""Continuously kept newest version per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybrook.functions.measures import latest_marker
from tallybrook.operators.live import latest
from tallybrook.schema import META_COLUMNS
from tallybrook.sources.changelog import run_of


def latest_stream(changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Newest version per key of a stream of changelog rows, in update mode.

    State holds one row of ``columns`` per key and never expires, as a change may arrive
    at any time; pass only the columns that are needed.
    """
    row = F.struct(*[c for c in columns if c != key], *META_COLUMNS)
    newest = changes.groupBy(key).agg(F.max_by(row, latest_marker()).alias("row"))
    return newest.select(key, "row.*")


def start_latest(
    spark: SparkSession, changes: DataFrame, key: str, columns: list[str], path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Write the keys whose newest version moved, one folder per run and batch.

    A new checkpoint is a new run, as its batches are numbered from zero again. State per
    key can outgrow executor memory: use the state store ``apply_settings`` chooses.
    """
    run = run_of(spark, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/run={run}/batch={number}")

    trigger = {"availableNow": True} if once else {"processingTime": "2 seconds"}
    return (
        latest_stream(changes, key, columns)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


def read_latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Newest version per key out of the folders ``start_latest`` wrote."""
    return latest(spark.read.parquet(path), key).drop("run", "batch")
