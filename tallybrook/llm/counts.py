"""Token counts by a map-side look-up in two tiers.

Tier one is a compact table of frequent runs (a word with its leading space and what
clings to it) and their token counts, broadcast to all workers: the runs on end, where each
begins, and a count each. Which runs are listed affects nothing but speed, so they are
counted in a sample of at most about ``sample_rows`` documents, whatever the size of the
table. Tier two is a table each worker fills with the runs it meets besides. No pre-token of
any other document is ever shuffled, and every document is counted whole.

Defined cases: a NULL or empty text has no bytes and no tokens; a text of any length is
counted whole, over no limit of its own but a worker's memory; repeated rows are counted
each; an empty table gives an empty result; columns other than ``id_column`` and
``text_column`` are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.runs import TextRuns, byte_bpe_runs, held, load_tokenizer, runs
from tallybrook.llm.words import pieces

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

# Runs in the broadcast table; documents of the sample they come from, and runs a task may
# report of it.
FREQUENT = 65_536
SAMPLE_ROWS = 100_000
PER_TASK = 16_384
SEED = 7


class RunCounts(NamedTuple):
    """Runs as UTF-8 on end, the place where each begins (one more than runs), and the
    tokens of each."""

    data: bytes
    offsets: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, runs: list[str], counts: list[int]) -> RunCounts:
        packed = [r.encode() for r in runs]
        return cls(b"".join(packed), np.cumsum([0, *map(len, packed)]).astype(np.uint32), np.array(counts, np.uint16))

    def table(self) -> dict[str, int]:
        places = self.offsets.tolist()
        return {self.data[a:b].decode(): n for a, b, n in zip(places, places[1:], self.counts.tolist())}


@lru_cache(1)
def _held(data: bytes, offsets: bytes, counts: bytes) -> dict[str, int]:
    return RunCounts(data, np.frombuffer(offsets, np.uint32), np.frombuffer(counts, np.uint16)).table()


@held
def worker_runs_of(vocabulary: str, limit: int) -> TextRuns:
    """The worker's own table; it stays for all tasks the worker runs."""
    return byte_bpe_runs(vocabulary, len, limit)


def frequent_runs(
    texts: DataFrame, limit: int = FREQUENT, sample_rows: int = SAMPLE_ROWS, per_task: int = PER_TASK
) -> list[str]:
    """At most ``limit`` frequent runs of a sample. A task drops its rarest runs when it
    holds more than sixteen times what it may report, so its memory is bounded."""
    share = sample_rows / max(texts.count(), 1)
    some = texts.sample(share, SEED) if share < 1 else texts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            seen.update(chain.from_iterable(runs(t)[1:] for t in batch.column(0).to_pylist() if t))
            if len(seen) > 16 * per_task:
                seen = Counter(dict(seen.most_common(4 * per_task)))
        top = seen.most_common(per_task)
        yield pa.record_batch({"run": pa.array([r for r, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())})

    found = some.mapInArrow(count, "run string, n long").where(F.length("run") <= 64)
    # The most frequent of every bucket: no more rows reach the driver than are listed,
    # where a sort of all would send it as many from every task.
    buckets = max(1, min(64, limit // 64))
    counted = found.groupBy("run").agg(F.sum("n").alias("n"))
    first = Window.partitionBy(F.pmod(F.xxhash64("run"), F.lit(buckets))).orderBy(F.desc("n"), "run")
    top = counted.withColumn("place", F.row_number().over(first)).where(F.col("place") <= limit // buckets)
    return [r.run for r in top.orderBy(F.desc("n"), "run").select("run").collect()]


def token_counts(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    token_limit: int = 512,
    vocabulary: str = VOCABULARY,
    frequent: int = FREQUENT,
    sample_rows: int = SAMPLE_ROWS,
    worker_runs: int = 1_000_000,
) -> DataFrame:
    """Per document its id, ``n_bytes``, ``n_tokens`` and whether it is ``over_limit``."""
    spark = documents.sparkSession
    texts = documents.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    listed = frequent_runs(texts.select("_text"), frequent, sample_rows) if frequent else []
    counted = load_tokenizer(vocabulary).encode_batch_fast([" " + r for r in listed], add_special_tokens=False)
    compact = RunCounts.of(listed, [len(x) for x in counted])
    shared = spark.sparkContext.broadcast((compact.data, compact.offsets.tobytes(), compact.counts.tobytes()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths_of = worker_runs_of(vocabulary, worker_runs)
        lengths_of.table.keep(_held(*shared.value))
        for batch in batches:
            text = batch.column(1)
            n_bytes = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            n_tokens = np.zeros(len(text), np.int64)
            for at, upto in pieces(text):
                part = [t or "" for t in text.slice(at, upto - at).to_pylist()]
                lengths, first = lengths_of.values(part)
                n_tokens[at:upto] = np.add.reduceat(np.array(lengths, np.int64), first[:-1])
            yield pa.record_batch({"_id": batch.column(0), "n_bytes": n_bytes, "n_tokens": pa.array(n_tokens)})

    id_type = texts.schema["_id"].dataType.simpleString()
    counts = texts.mapInArrow(count, f"_id {id_type}, n_bytes long, n_tokens long")
    return counts.select(
        F.col("_id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > token_limit).alias("over_limit")
    )
