"""The continuous job: feed in, changelog tables out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallybrook.sources.changelog import ChangelogStore

# Fixed value: how often the feed is taken over.
FLUSH_INTERVAL = "2 seconds"

COMPACT_AFTER = 1800


def start_ingest(
    spark: SparkSession,
    messages: DataFrame,
    root: str,
    checkpoint: str,
    snapshot: Mapping[str, DataFrame] | None = None,
    once: bool = False,
    ingest_time: C | None = None,
    compact_after: int = COMPACT_AFTER,
) -> StreamingQuery:
    """Copy the source tables if no copy was finished before, then follow the feed.

    Batch size is bounded by the reader of ``messages`` (files or offsets per trigger).
    Offsets are committed after the tables are written, so a crash repeats a batch and
    never loses one. ``once`` takes what is there and stops. Once ``compact_after``
    batches wait they are folded, so readers list no more records than that.
    """
    store = ChangelogStore(spark, root)
    if snapshot and not store.snapshot_done():
        store.load_snapshot(snapshot)
    run = store.run_of(checkpoint)

    def take_over(batch: DataFrame, number: int) -> None:
        store.append_messages(batch, run, number, ingest_time)
        if store.waiting() >= compact_after:
            store.compact()

    trigger = {"availableNow": True} if once else {"processingTime": FLUSH_INTERVAL}
    return (
        messages.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(take_over)
        .start()
    )
