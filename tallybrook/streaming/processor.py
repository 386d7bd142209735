"""Stateful processors over streams of changelog rows.

``NewestVersion`` keeps the newest version of every key and emits, when it moves, the row
that goes (sign -1) and the row that comes (+1): what delta joins and additive sums need.
It starts from rows that are known already, and goes on from its checkpoint.

``Flush`` holds rows back and lets them out by number or by time: ``rows`` at a time as soon
as a group has as many, in feed order, and all it has ``seconds`` after the first of them
began to wait. Groups are buckets of a table's keys, so none holds a whole table; what is
left when a stream is to stop is let out by ``closing_rows``.

State stays in the state store that ``apply_settings`` chooses, and needs one that knows
column families (RocksDB).

Defined cases: of two rows of a key with one version the first stays; a late row changes
nothing; a deletion keeps its place, as an older row may still come, and only its old row is
emitted; a NULL key is a key like others, and so are a NULL table or bucket of rows that wait;
among these NULLs come first; an empty stream emits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallybrook.schema import META_COLUMNS

SIGN = "_sign"

# A table is flushed at this many rows or after this time.
FLUSH_ROWS, FLUSH_SECONDS = 200, 2


class NewestVersion(StatefulProcessor):
    """State: the newest row of a key, its columns in order, then version, place and
    whether it is deleted."""

    def __init__(self, key: str, columns: list[str], schema: str):
        self.key, self.columns, self.schema = key, [*columns, *META_COLUMNS], schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", self.schema)

    def _values(self, row: Row) -> tuple:
        return tuple(row[c] for c in self.columns)

    @staticmethod
    def _mark(values: tuple) -> tuple:
        return values[-3], values[-2]

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        values = self._values(initialState)
        known = self.newest.get()
        if known is None or self._mark(values) > self._mark(tuple(known)):
            self.newest.update(values)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # One question to the state store: a key without a state gives None.
        known = self.newest.get()
        before = None if known is None else tuple(known)
        now, places = before, None
        for row in rows:
            if places is None:
                places = [row.__fields__.index(c) for c in self.columns]
            values = tuple([row[i] for i in places])
            if now is None or self._mark(values) > self._mark(now):
                now = values
        if now is before:
            return
        self.newest.update(now)
        for values, sign in ((before, -1), (now, 1)):
            if values is not None and not values[-1]:
                yield Row(**{self.key: key[0]}, **dict(zip(self.columns, values)), **{SIGN: sign})


def _types(rows: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)


def signed_changes(changes: DataFrame, key: str, columns: list[str], base: DataFrame | None = None) -> DataFrame:
    """Old and new rows, with ``_sign``, of the keys whose newest version moves, out of a
    stream of changelog rows. ``base`` holds versions that are known when a checkpoint is
    new; it is not read again."""
    kept = [c for c in columns if c != key]
    rows = changes.select(key, *kept, *META_COLUMNS)
    initial = None if base is None else base.select(key, *kept, *META_COLUMNS).groupBy(key)
    return rows.groupBy(key).transformWithState(
        statefulProcessor=NewestVersion(key, kept, _types(rows, [*kept, *META_COLUMNS])),
        outputStructType=f"{_types(rows, [key, *kept, *META_COLUMNS])}, {SIGN} int",
        outputMode="update",
        timeMode="none",
        initialState=initial,
    )


def start_signed(
    spark: SparkSession,
    changes: DataFrame,
    key: str,
    columns: list[str],
    path: str,
    checkpoint: str,
    run: str,
    base: DataFrame | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Write the signed rows of every batch to its folder below ``path``; ``run`` names the
    checkpoint, as a new one numbers its batches from zero again."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/run={run}/batch={number}")

    trigger = {"availableNow": True} if once else {"processingTime": f"{FLUSH_SECONDS} seconds"}
    signed = signed_changes(changes, key, columns, base).writeStream.outputMode("update")
    return signed.option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(write).start()


def read_signed(spark: SparkSession, path: str) -> DataFrame:
    """All signed rows that were written."""
    return spark.read.parquet(path).drop("run", "batch")


def summed(signed: DataFrame) -> DataFrame:
    """Current rows: those that were put in once more than they were taken away."""
    columns = [c for c in signed.columns if c != SIGN]
    return signed.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) > 0).drop(SIGN)


# What ``flushed`` takes.
WAITING = "table string, bucket int, version bigint, seq int, payload string, closing boolean"


# What waits of a row, and rows that are let out at once.
ROW = pa.schema([("version", pa.int64()), ("seq", pa.int32()), ("payload", pa.string())])
IN_ORDER = [(name, "ascending") for name in ROW.names]
LET_OUT = 10_000


class Flush(StatefulProcessor):
    """State: the rows that wait, by their payload, and how often the group was flushed.

    A batch's rows of a group are held in Arrow arrays: their versions, places and payloads
    without an object for each.
    """

    def __init__(self, rows: int, seconds: float):
        self.rows, self.milliseconds = rows, int(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "version bigint, seq int, payload string")
        self.size = handle.getValueState("size", "n bigint, flushes bigint, due bigint")

    @staticmethod
    def _taken(chunk: pd.DataFrame) -> pa.Table:
        """The rows of a chunk; pandas has no NULLs among whole numbers, they come as marks."""
        columns = [
            pa.array(chunk["version"].to_numpy(np.int64), mask=chunk["no_version"].to_numpy(bool)),
            pa.array(chunk["seq"].to_numpy(np.int32), mask=chunk["no_seq"].to_numpy(bool)),
            pa.array(chunk["payload"], pa.string(), from_pandas=True),
        ]
        return pa.Table.from_arrays(columns, schema=ROW)

    def _held(self) -> pa.Table:
        """The rows that wait; they do not wait any more."""
        found = [tuple(r) for r in self.waiting.get()]
        self.waiting.clear()
        return pa.Table.from_pylist([dict(zip(ROW.names, r)) for r in found], ROW)

    def _out(self, key, rows: pa.Table, first: int, size: int, why: str) -> Iterator[pd.DataFrame]:
        """Rows in order, ``size`` with each flush from the ``first`` on."""
        table, bucket = key
        for at in range(0, len(rows), LET_OUT):
            some = rows.slice(at, LET_OUT)
            frame = some.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}.get)
            frame.insert(0, "table", pd.Series([table] * len(some), dtype=object))
            frame.insert(1, "bucket", pd.Series([None if bucket is None else int(bucket)] * len(some), dtype="Int32"))
            frame["flush"] = first + np.arange(at, at + len(some)) // size
            frame["why"] = why
            yield frame

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, flushes, due = self.size.get() if self.size.exists() else (0, 0, 0)
        closing, chunks = False, []
        for chunk in rows:
            ends = chunk["closing"].to_numpy(bool)
            closing = closing or bool(ends.any())
            chunks.append(self._taken(chunk[~ends]))
        fresh = pa.concat_tables([ROW.empty_table(), *chunks])
        if n + len(fresh) >= self.rows or closing:
            # A batch is bounded by the stream's reader; its rows leave in feed order, after
            # those that waited.
            parts = [_in_order(self._held())] if n else []
            every = pa.concat_tables([*parts, _in_order(fresh)])
            if due:
                self.handle.deleteTimer(due)
                due = 0
            full = len(every) // self.rows
            yield from self._out(key, every.slice(0, full * self.rows), flushes, self.rows, "rows")
            fresh, flushes, n = every.slice(full * self.rows), flushes + full, 0
            if closing and len(fresh):
                yield from self._out(key, fresh, flushes, self.rows, "close")
                fresh, flushes = fresh.slice(0, 0), flushes + 1
        if len(fresh):
            self.waiting.appendList([tuple(r.values()) for r in fresh.to_pylist()])
            n += len(fresh)
            if not due:
                due = timerValues.getCurrentProcessingTimeInMs() + self.milliseconds
                self.handle.registerTimer(due)
        self.size.update((n, flushes, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, flushes, _ = self.size.get() if self.size.exists() else (0, 0, 0)
        if not n:
            return
        held = _in_order(self._held())
        self.size.update((0, flushes + 1, 0))
        yield from self._out(key, held, flushes, self.rows, "time")


def _in_order(rows: pa.Table) -> pa.Table:
    return rows.take(pc.sort_indices(rows, sort_keys=IN_ORDER, null_placement="at_start"))


def flushed(rows: DataFrame, n: int = FLUSH_ROWS, seconds: float = FLUSH_SECONDS) -> DataFrame:
    """Rows (table, bucket, version, seq, payload, closing) of a stream, each let out once,
    with the number of its group's ``flush`` and ``why``: rows, time or close."""
    zero = F.lit(0)
    marked = rows.select(
        "table", F.col("bucket").cast("string").alias("bucket"), "payload", F.coalesce("closing", F.lit(False)).alias("closing"),
        F.coalesce("version", zero).alias("version"), F.col("version").isNull().alias("no_version"),
        F.coalesce("seq", zero).alias("seq"), F.col("seq").isNull().alias("no_seq"),
    )
    return marked.groupBy("table", "bucket").transformWithStateInPandas(
        statefulProcessor=Flush(n, seconds),
        outputStructType="table string, bucket int, version bigint, seq int, payload string, flush bigint, why string",
        outputMode="append",
        timeMode="processingTime",
    )


def waiting_rows(table: C, key: C, payload: C, version: C, seq: C, buckets: int) -> list[C]:
    """Columns that ``flushed`` takes: a table's rows are dealt over buckets by their key."""
    bucket = F.pmod(key.cast("bigint"), F.lit(buckets)).cast("int")
    return [
        table.alias("table"), F.coalesce(bucket, F.lit(0)).alias("bucket"), version.cast("bigint").alias("version"),
        seq.cast("int").alias("seq"), payload.alias("payload"), F.lit(False).alias("closing"),
    ]


def closing_rows(spark: SparkSession, tables: list[str], buckets: int) -> DataFrame:
    """One row per group that lets out what it holds: put in the stream's way at its end."""
    groups = [(t, b, None, None, None, True) for t in tables for b in range(buckets)]
    return spark.createDataFrame(groups, WAITING)


def start_flush(
    rows: DataFrame, path: str, checkpoint: str, n: int = FLUSH_ROWS, seconds: float = FLUSH_SECONDS, once: bool = False
) -> StreamingQuery:
    """Append what is let out to a Parquet table, exactly once.

    ``once`` takes what is there in one batch: with timers by the clock, ``availableNow``
    goes on with empty batches for ever, as a timer might be due.
    """
    trigger = {"once": True} if once else {"processingTime": f"{min(seconds, 0.5)} seconds"}
    out = flushed(rows, n, seconds).writeStream.format("parquet").outputMode("append")
    return out.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)
