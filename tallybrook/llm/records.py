"""Token ids as length-delimited binary records, with an index of their offsets.

    <out>/records/part-*    records on end; files and records in ascending id order
    <out>/index/            Parquet: file, offset, length, document id, tokens, running sum

A record is: payload length (8 bytes), masked checksum of those 8 bytes (4), payload,
masked checksum of the payload (4), a line feed. The payload is: 1 byte that is 1 where
the id is NULL, the id (8 bytes), the token ids in 2 or 4 bytes each as the vocabulary
needs. All numbers are little-endian. A checksum is CRC-32, rotated right by 15 bits plus
0xA282EAD8, so that checksums of checksums stay sound. Files are written and committed
by Spark's own writer, so a lost task leaves nothing behind, on any file system.

Rows are dealt over files by ranges of id, then of a hash of the text, then of their place
in the input, so an id that a third of all rows have, or none, is spread over many files.
There are as many files as ``file_bytes`` of text on average ask for; none has more than
``per_file`` records.

Defined cases: a NULL or empty text gives the end id alone; NULL ids come first; equal
ids are ordered by a hash of their text; repeated rows are records each; a damaged record
raises an error; an empty table gives no records; columns other than the two named are not
read, so their names cannot clash. Texts are encoded whole; one record must fit in 2 GB.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.runs import ByteBpe, RunPool, held
from tallybrook.llm.words import pieces

# Text per file on average, and records of a file at most.
FILE_BYTES = 32 << 20
PER_FILE = 1 << 18

# Runs a worker keeps, and bytes of ids it hands on at once.
WORKER_RUNS = 500_000
HANDED_ON = 4 << 20

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
HEAD, TAIL, OWNER = "<QI", "<Is", "<?q"
HEAD_SIZE, TAIL_SIZE, OWNER_SIZE = map(struct.calcsize, (HEAD, TAIL, OWNER))


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return struct.pack(HEAD, len(payload), masked(length)) + payload + struct.pack(TAIL, masked(payload), b"\n")


def frames(content: bytes) -> Iterator[tuple[int, memoryview]]:
    """Offset and payload of every record of a file; an error at the first that is damaged."""
    view, at = memoryview(content), 0
    while at < len(view):
        length, check = struct.unpack_from(HEAD, view, at)
        if masked(view[at : at + 8]) != check:
            raise ValueError(f"damaged length at byte {at}")
        payload = view[at + HEAD_SIZE : at + HEAD_SIZE + length]
        if struct.unpack_from(TAIL, view, at + HEAD_SIZE + length) != (masked(payload), b"\n"):
            raise ValueError(f"damaged record at byte {at}")
        yield at, payload
        at += HEAD_SIZE + length + TAIL_SIZE


@held
def worker_runs_of(vocabulary: str, limit: int) -> RunPool:
    bpe = ByteBpe(vocabulary)

    def encode(opening: list[str], other: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, lengths = bpe.joined(opening, other)
        return ids, lengths, lengths

    return RunPool(encode, limit, bpe.width)


@cache
def id_type(vocabulary: str) -> np.dtype:
    return np.dtype(ByteBpe(vocabulary).width).newbyteorder("<")


def write_records(
    documents: DataFrame,
    out: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 0,
    vocabulary: str = VOCABULARY,
    file_bytes: int = FILE_BYTES,
    per_file: int = PER_FILE,
    worker_runs: int = WORKER_RUNS,
) -> None:
    """Encode every whole text, append ``end_id``, and write records and index."""
    spark = documents.sparkSession
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    total = texts.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    wanted = max(math.ceil(total.rows / per_file), math.ceil(total.bytes / file_bytes))
    files = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = worker_runs_of(vocabulary, worker_runs)
        end = np.array([end_id], id_type(vocabulary)).tobytes()
        for batch in batches:
            for at, upto in pieces(batch.column(1)):
                owners = batch.column(0).slice(at, upto - at).to_pylist()
                part = [t or "" for t in batch.column(1).slice(at, upto - at).to_pylist()]
                ids, first, _, _ = ids_of.of(part)
                packed, places = ids.astype(id_type(vocabulary), copy=False).tobytes(), (first * len(end)).tolist()
                out = [
                    frame(struct.pack(OWNER, owner is None, owner or 0) + packed[a:b] + end)[:-1]
                    for owner, a, b in zip(owners, places, places[1:])
                ]
                yield pa.record_batch({"record": pa.array(out, pa.binary())})

    # Rows alike in id and text may lie in any order, so their place may deal them out.
    placed = texts.withColumns({"hash": F.xxhash64("text"), "place": F.xxhash64(F.monotonically_increasing_id())})
    ordered = placed.repartitionByRange(files, "id", "hash", "place").sortWithinPartitions("id", "hash", "text").select("id", "text")
    # The text writer puts the bytes of a string as they are, and a line feed behind it.
    records = ordered.mapInArrow(encode, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.mode("overwrite").option("lineSep", "\n").option("maxRecordsPerFile", per_file).text(f"{out}/records")
    _contents(spark, out).mapInArrow(
        _index_rows(vocabulary), "file string, offset long, length long, id long, n_tokens long, before long"
    ).write.mode("overwrite").parquet(f"{out}/index")


def _contents(spark: SparkSession, out: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(f"{out}/records")
        .select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content")
    )


def _index_rows(vocabulary: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = id_type(vocabulary).itemsize
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found, before = [], 0
                for offset, payload in frames(content.as_buffer()):
                    null, owner = struct.unpack_from(OWNER, payload)
                    n = (len(payload) - OWNER_SIZE) // width
                    found.append((file, offset, len(payload) + HEAD_SIZE + TAIL_SIZE, None if null else owner, n, before))
                    before += n
                names = ("file", "offset", "length", "id", "n_tokens", "before")
                types = (pa.string(), *[pa.int64()] * 5)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), types)], names) if found else pa.record_batch(
                    [pa.array([], t) for t in types], names
                )

    return rows


def read_index(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/index")


def _read(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[list[tuple]]:
    """Records of whole files, some at a time: file, offset, id, ids in 4 bytes each, ids of
    the file before them."""
    kind = id_type(vocabulary)
    for batch in batches:
        for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            found, size, before = [], 0, 0
            for offset, payload in frames(content.as_buffer()):
                null, owner = struct.unpack_from(OWNER, payload)
                ids = np.frombuffer(payload, kind, offset=OWNER_SIZE).astype("<u4").tobytes()
                found.append((file, offset, None if null else owner, ids, before))
                before += len(ids) // 4
                size += len(ids)
                if size >= HANDED_ON:
                    yield found
                    found, size = [], 0
            if found:
                yield found


def read_records(spark: SparkSession, out: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """All records, checksums verified: file, offset, id, the token ids in 4 bytes each, and
    how many ids the file holds before them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ("file", "offset", "id", "ids", "before"), (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
        for found in _read(batches, vocabulary):
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

    return _contents(spark, out).mapInArrow(rows, "file string, offset long, id long, ids binary, before long")


def read_shuffled(spark: SparkSession, out: str, seed: int, vocabulary: str = VOCABULARY) -> DataFrame:
    """Records through the index in a seeded random order that reruns repeat: ``place``,
    id and token ids. The index is shuffled, not the files: a task reads its records'
    byte ranges, opening a file once per batch. ``out`` must be on a file system that
    pyarrow opens (local or shared folders, S3, GCS, HDFS)."""
    index = read_index(spark, out).select("file", "offset", "length", F.xxhash64("file", "offset", F.lit(seed)).alias("place"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = index.repartitionByRange(parts, "place").sortWithinPartitions("place")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = id_type(vocabulary)
        system, folder = pyarrow.fs.FileSystem.from_uri(f"{out}/records")
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                places = list(enumerate(zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length", "place")])))
                found: list = [None] * len(places)
                for file, own in groupby(sorted(places, key=lambda p: p[1][:2]), key=lambda p: p[1][0]):
                    with system.open_input_file(f"{folder}/{file}") as content:
                        for i, (_, offset, length, place) in own:
                            ((_, payload),) = frames(content.read_at(length, offset))
                            null, owner = struct.unpack_from(OWNER, payload)
                            ids = np.frombuffer(payload, kind, offset=OWNER_SIZE).astype("<u4").tobytes()
                            found[i] = place, None if null else owner, ids
                columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.binary()))]
                yield pa.record_batch(columns, ["place", "id", "ids"])

    return ordered.mapInArrow(rows, "place long, id long, ids binary")


def file_order() -> list[Column]:
    """Files in the order of their ranges: by the numbers in their names, which may have
    more digits than the names are padded to."""
    return [F.regexp_extract("file", rf"{before}(\d+)", 1).cast("long") for before in ("^part-", "-c")]


def record_digests(spark: SparkSession, out: str, id_column: str = "doc_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per record its id, ``start`` (ids of all records before it), ``n_tokens`` and
    ``ids_crc32``, out of the files. One row per file goes through the sum of the starts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("file", "before", "id", "n_tokens", "ids_crc32")
        for found in _read(batches, vocabulary):
            digests = [(file, before, owner, len(ids) // 4, zlib.crc32(ids)) for file, _, owner, ids, before in found]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*digests), (pa.string(), *[pa.int64()] * 4))], names)

    totals = read_index(spark, out).groupBy("file").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy(*file_order()).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("file_start"))
    records = _contents(spark, out).mapInArrow(rows, "file string, before long, id long, n_tokens long, ids_crc32 long")
    return records.join(starts, "file").select(
        F.col("id").alias(id_column), (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
