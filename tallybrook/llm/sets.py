"""Sets of word shingles: reading, comparing and linking them.

``linked_components`` takes sets that share keys (whatever an operator makes its keys of)
and finds the connected components of all similar pairs among sets that share one:

1. Sets go, with the least set they share a key with, into one group; large groups are cut
   into slices of about ``slice_sets``.
2. A set's row in the matrix of sets and shingles is kept as a few bits per shingle. The
   bits that a set has and a union of rows, or another row, lacks bound what they share.
   Sets of a slice that may be similar to another one of it are opened: their shingles are
   read again from their texts and compared exactly, by a product of matrix rows.
3. Keys that then still lie in several components are left. Of two components the smaller
   one's sets ask the slices in which the other's sets with that key are, if their sizes
   allow a link: the union of the slice first, then its members. What the bounds leave is opened and compared exactly.

So shingles are only moved for sets that come close to another one. A very large group
makes many slices, its sets never meet in one task, and no pair of them is ever a row.
Tasks first give back what their worker holds for other operators, which need not stay
beside the slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.components import components
from tallybrook.llm.runs import let_go
from tallybrook.llm.words import pieces, shingle_sets, text_bytes, words

U64 = np.uint64

# Sets in a slice, and sets that ask a slice at once, by their bits and by their shingles.
SLICE = 1024
ASKERS = 512
BIT_ASKERS = 4096

# Bits of a set's row of the matrix per token, rounded up to a power of two in all.
BITS_PER_TOKEN = 1

# Columns of the matrix that are multiplied at once.
COLUMNS = 1 << 12

# Ids of sets whose texts are read again are broadcast up to this number; beyond it the
# texts are joined by a shuffle. The result is the same.
BROADCAST_IDS = 1_000_000

# Sets a task remembers to have described.
REMEMBERED = 1 << 18

# Keys that a sample of sets, one in so many, shows to be common are handled apart: those
# of at least so many sets of the sample, and so many at most.
SAMPLED, COMMON, COMMON_KEYS = 64, 64, 100_000


def set_id(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def token_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    for at, upto in pieces(texts):
        yield from shingle_sets(words(text_bytes(texts.slice(at, upto - at)), lower=True), width)


def bits_of(tokens: np.ndarray) -> np.ndarray:
    """A set's row of the matrix: which of a power of two of places its tokens fall on."""
    width = max(64, 1 << (BITS_PER_TOKEN * max(len(tokens), 1) - 1).bit_length())
    row = np.zeros(width, bool)
    row[(tokens & U64(width - 1)).astype(np.int64)] = True
    return np.packbits(row, bitorder="little")


def narrowed(bits: np.ndarray, size: int) -> np.ndarray:
    """Rows in fewer places (bytes in the last axis): those that fall together are joined."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def may_link(mine: np.ndarray, n: int, union: np.ndarray, least: int, most: int, percent: int) -> bool:
    """Whether a set may be similar to a member of a group of sizes ``least`` to ``most``."""
    size = min(len(mine), len(union))
    lacking = int(np.bitwise_count(narrowed(mine, size) & ~narrowed(union, size)).sum())
    overlap = n - lacking
    # The best partner has no more tokens than it can share, as far as the group's sizes allow.
    other = min(max(least, overlap), most)
    return min(overlap, other) * (100 + percent) >= percent * (n + other)


class Rows:
    """Rows of the matrix, by their width and size, with the union of each width's rows."""

    def __init__(self, ids: list[int], sizes: list[int], bits: list[bytes]):
        self.by_width: dict[int, tuple] = {}
        for width in {len(x) for x in bits}:
            own = sorted((n, i, b) for n, i, b in zip(sizes, ids, bits) if len(b) == width)
            matrix = np.frombuffer(b"".join(b for _, _, b in own), np.uint8).reshape(len(own), width)
            held = np.array([n for n, _, _ in own]), np.array([i for _, i, _ in own]), np.bitwise_or.reduce(matrix, axis=0)
            self.by_width[width] = (*held, {width: matrix})

    def near(self, bits: bytes, n: int, percent: int) -> np.ndarray:
        """Ids of rows that may be similar to a set of ``n`` tokens with these bits."""
        mine, found = np.frombuffer(bits, np.uint8), []
        for width, (sizes, ids, union, matrices) in self.by_width.items():
            first, last = np.searchsorted(sizes, -(-percent * n // 100)), np.searchsorted(sizes, n * 100 // percent, "right")
            if first >= last or not may_link(mine, n, union, int(sizes[first]), int(sizes[last - 1]), percent):
                continue
            size = min(width, len(mine))
            if size not in matrices:
                matrices[size] = np.ascontiguousarray(narrowed(matrices[width], size))
            rows = matrices[size][first:last].view(np.uint64)
            own, other = narrowed(mine, size).copy().view(np.uint64), sizes[first:last]
            lacking = np.bitwise_count(own & ~rows).sum(axis=1, dtype=np.int64)
            beyond = np.bitwise_count(rows & ~own).sum(axis=1, dtype=np.int64)
            overlap = np.minimum(n - lacking, other - beyond)
            found.append(ids[first:last][overlap * (100 + percent) >= percent * (n + other)])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


Describe = Callable[[list[np.ndarray]], list[np.ndarray]]


def described_sets(texts: DataFrame, width: int, describe: Describe) -> DataFrame:
    """Per text its id, the size ``n`` and id of its set, the ``keys`` that ``describe``
    gives for it (64-bit numbers) and its ``bits``. A task lists a set once, so very many
    copies of a text are few lists; other rows have no keys and bits, and empty sets no id
    either."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen: set[int] = set()
        for batch in batches:
            for at, upto in pieces(batch.column(1)):
                found = list(token_sets(batch.column(1).slice(at, upto - at), width))
                ids = [set_id(x) if len(x) else None for x in found]
                fresh = [i for i, x in enumerate(ids) if x is not None and x not in seen and not seen.add(x)]
                if len(seen) > REMEMBERED:
                    seen.clear()
                keys: list[np.ndarray] = [np.zeros(0, np.int64)] * len(found)
                bits: list[bytes | None] = [None] * len(found)
                for i, own in zip(fresh, describe([found[i] for i in fresh])):
                    keys[i], bits[i] = own.view(np.int64), bits_of(found[i]).tobytes()
                ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
                flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
                yield pa.record_batch(
                    {
                        "id": batch.column(0).slice(at, upto - at),
                        "n": pa.array([len(x) for x in found], pa.int64()),
                        "set_id": pa.array(ids, pa.int64()),
                        "keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        "bits": pa.array(bits, pa.binary()),
                    }
                )

    return texts.mapInArrow(rows, "id long, n long, set_id long, keys array<long>, bits binary")


def emptied(spark: SparkSession, path: str) -> None:
    """Give back the space of a written step that is not read again."""
    spark.createDataFrame([], "done boolean").write.mode("overwrite").parquet(path)


def described_and_listed(texts: DataFrame, width: int, describe: Describe, folder: str) -> tuple[DataFrame, DataFrame]:
    """What ``described_sets`` gives, in two written tables: all but the keys, and the keys
    of the sets as rows (set_id, place, key). The second may be ``emptied`` once it is used,
    at ``folder``/keys."""
    spark = texts.sparkSession
    described_sets(texts, width, describe).write.parquet(f"{folder}/keys")
    every = spark.read.parquet(f"{folder}/keys")
    every.drop("keys").write.parquet(f"{folder}/described")
    return spark.read.parquet(f"{folder}/described"), every.select("set_id", F.posexplode("keys").alias("place", "key"))


def sharing(listed: DataFrame, folder: str) -> DataFrame:
    """Out of rows (set_id, key) those whose key more than one set has, each once, with the
    key's least set as ``lo``. Written to ``folder``.

    Keys are shuffled once. Those that very many sets have are told by a sample of sets;
    their rows stay where they are and meet one row per key, which is broadcast: at most
    about ``COMMON_KEYS`` of them, and no other key has more rows than that share of all.
    """
    spark = listed.sparkSession
    few = listed.where(F.pmod(F.xxhash64("set_id"), F.lit(SAMPLED)) == 0)
    least = max(COMMON, few.count() // COMMON_KEYS)
    few.groupBy(F.col("key").alias("of")).agg(F.count("*").alias("n")).where(F.col("n") >= least).select("of").write.parquet(
        f"{folder}/common"
    )
    common = F.broadcast(spark.read.parquet(f"{folder}/common"))
    is_common = F.col("key") == F.col("of")
    least_set, most_set = F.min("set_id"), F.max("set_id")
    ends = listed.join(common, is_common).groupBy("of").agg(least_set.alias("lo"), most_set.alias("hi"))
    ends.where("lo <> hi").write.parquet(f"{folder}/common-ends")
    ends = F.broadcast(spark.read.parquet(f"{folder}/common-ends"))
    of_common = listed.join(ends, is_common).select("key", "set_id", "lo")
    on_key = Window.partitionBy("key")
    others = listed.join(common, is_common, "left_anti").select(
        "key", "set_id", least_set.over(on_key).alias("lo"), most_set.over(on_key).alias("hi")
    )
    others.where("lo <> hi").drop("hi").unionByName(of_common).distinct().write.parquet(f"{folder}/sharing")
    return spark.read.parquet(f"{folder}/sharing")


def _tokens(width: int):
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            found = list(token_sets(batch.column(0), width))
            yield pa.record_batch(
                {
                    "set_id": pa.array([set_id(x) for x in found], pa.int64()),
                    "tokens": pa.array([x.tobytes() for x in found], pa.binary()),
                }
            )

    return tokens


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens any left and any right set share: the product of their rows in the
    matrix of sets and tokens, some columns at a time. Columns that cannot add to it, as
    only one set or one side has the token, are left out."""
    same = left is right
    sets = left if same else [*left, *right]
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    n_left = np.bincount(column[owner < len(left)], minlength=len(tokens))
    n_right = n_left - 1 if same else np.bincount(column[owner >= len(left)], minlength=len(tokens))
    both = (n_left > 0) & (n_right > 0)
    place = np.cumsum(both) - 1
    column, owner = place[column[both[column]]], owner[both[column]]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, int(both.sum()), COLUMNS):
        first, last = np.searchsorted(column, (at, at + COLUMNS))
        rows = np.zeros((len(sets), min(COLUMNS, int(column[last - 1]) + 1 - at)), np.float32)
        rows[owner[first:last], column[first:last] - at] = 1
        mine, others = rows[: len(left)], rows if same else rows[len(left) :]
        common += (mine @ others.T).astype(np.int64)
    if same:
        np.fill_diagonal(common, [len(x) for x in sets])
    return common


def similar(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which left set is similar to which right set."""
    common = overlaps(left, right)
    a, b = np.array([len(x) for x in left])[:, None], np.array([len(x) for x in right])[None, :]
    return 100 * common >= percent * (a + b - common)


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links, out of a square table of them, that suffice to connect what they connect."""
    owner, out = list(range(len(linked))), []

    def find(x: int) -> int:
        while owner[x] != x:
            owner[x] = owner[owner[x]]
            x = owner[x]
        return x

    for i, j in np.argwhere(np.triu(linked, 1)).tolist():
        a, b = find(i), find(j)
        if a != b:
            owner[b] = a
            out.append((i, j))
    return out


def runs_of_rows(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that follow each other with equal first columns: the key and the other columns."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:keys] != now:
                if rows:
                    yield now, rows
                now, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield now, rows


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _link_slices(percent: int):
    """Rows (group, slice, set_id, tokens), slice by slice."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for _, rows in runs_of_rows(batches, 2):
            sets = [np.frombuffer(tokens, U64) for _, tokens in rows]
            yield _edges([(rows[i][0], rows[j][0]) for i, j in spanning(similar(sets, sets, percent))])

    return link


def _near_in_slices(percent: int):
    """Rows (group, slice, set_id, n, bits), slice by slice: sets near to another one."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for (group, part), held in runs_of_rows(batches, 2):
            ids, sizes, bits = zip(*held)
            rows = Rows(list(ids), list(sizes), list(bits))
            found = [i for i, n, b in zip(ids, sizes, bits) if len(rows.near(b, n, percent)) > 1]
            if found:
                names = {"group": pa.array([group] * len(found), pa.int64()), "slice": pa.array([part] * len(found), pa.int64())}
                yield pa.record_batch({**names, "set_id": pa.array(found, pa.int64())})

    return near


def _near_to_slices(percent: int):
    """Rows (group, slice, chunk, asks, set_id, component, n, bits): the sets that ask and
    are near to a member of another component, and these members."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for (group, part, _), held in runs_of_rows(batches, 3):
            asking, members = [r[1:] for r in held if r[0]], [r[1:] for r in held if not r[0]]
            if not asking or not members:
                continue
            component = {i: c for i, c, _, _ in members}
            rows = Rows(*map(list, zip(*[(i, n, b) for i, _, n, b in members])))
            met: set[int] = set()
            out = []
            for i, own, n, bits in asking:
                others = [j for j in rows.near(bits, n, percent).tolist() if component[j] != own]
                met.update(others)
                out += [(True, i)] * bool(others)
            out += [(False, j) for j in met]
            if out:
                names = {"group": pa.array([group] * len(out), pa.int64()), "slice": pa.array([part] * len(out), pa.int64())}
                yield pa.record_batch({**names, "asks": pa.array([a for a, _ in out]), "set_id": pa.array([i for _, i in out], pa.int64())})

    return near


def _open_slices(percent: int):
    """Rows (group, slice, chunk, asks, set_id, component, tokens): those that ask against
    the members. One link per asking set and component."""

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for _, rows in runs_of_rows(batches, 3):
            asking, members = [r[1:] for r in rows if r[0]], [r[1:] for r in rows if not r[0]]
            if not asking or not members:
                continue
            found: dict[tuple[int, int], int] = {}
            table = similar([np.frombuffer(r[2], U64) for r in asking], [np.frombuffer(r[2], U64) for r in members], percent)
            for i, j in np.argwhere(table).tolist():
                if asking[i][1] != members[j][1]:
                    found.setdefault((asking[i][0], members[j][1]), members[j][0])
            yield _edges([(a, b) for (a, _), b in found.items()])

    return open_


SLICED = ("group", "slice")


def _chunked(asking: DataFrame, members: DataFrame, askers: int) -> DataFrame:
    """Sets that ask a slice in chunks of about ``askers``, each chunk with all members."""
    count = asking.groupBy(*SLICED).agg(F.ceil(F.count("*") / askers).alias("chunks"))
    some = asking.join(count, [*SLICED]).withColumn("chunk", F.pmod(F.xxhash64("set_id"), "chunks")).withColumn("asks", F.lit(True))
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    every = members.join(count, [*SLICED]).withColumn("chunk", chunks).withColumn("asks", F.lit(False))
    columns = (*SLICED, "chunk", "asks", "set_id")
    return some.select(*columns).unionByName(every.select(*columns))


def linked_components(
    hits: DataFrame,
    described: DataFrame,
    texts: DataFrame,
    folder: str,
    width: int,
    percent: int,
    slice_sets: int = SLICE,
    askers: int = ASKERS,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """``of`` (a set) and ``component_id``, the least document id it reaches, for all sets.

    ``hits`` is (key, set_id, lo): sets that share keys, with the least set of the key;
    ``described`` is what ``described_and_listed`` gave for ``texts``, which are (id, text).
    """
    spark = hits.sparkSession

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    sets = written(described.where("n > 0").groupBy("set_id").agg(F.min("id").alias("id")), "sets")

    def read_tokens(wanted: DataFrame, name: str) -> DataFrame:
        """The tokens of these sets, out of their texts."""
        ids = written(wanted.select("set_id").distinct().join(sets, "set_id").select(F.col("id").alias("of")).distinct(), f"{name}-ids")
        ids = F.broadcast(ids) if ids.count() <= broadcast_ids else ids
        again = texts.join(ids, F.col("id").eqNullSafe(F.col("of")), "left_semi").select("text")
        return written(again.mapInArrow(_tokens(width), "set_id long, tokens binary").dropDuplicates(["set_id"]), name)

    def by_slice(rows: DataFrame, *key: str) -> DataFrame:
        return rows.repartition(*key).sortWithinPartitions(*key)

    # Groups of sets that share keys, in slices.
    grouped = hits.groupBy("set_id").agg(F.min("lo").alias("group"))
    sizes = grouped.groupBy(F.col("group").alias("of")).agg(F.count("*").alias("sets"))
    sliced = grouped.join(sizes, F.col("group") == F.col("of"))
    grouped = written(
        sliced.select("set_id", "group", F.pmod(F.xxhash64("set_id"), F.ceil(F.col("sets") / slice_sets)).alias("slice")), "grouped"
    )
    listed = described.where("bits IS NOT NULL").select("set_id", "n", "bits").join(grouped.select("set_id"), "set_id", "left_semi")
    marks = written(listed.dropDuplicates(["set_id"]), "marks")

    # Every slice in itself, with the group's least set in each.
    least = grouped.select(F.col("group").alias("set_id"), *SLICED)
    members = grouped.select("set_id", *SLICED).unionByName(least).distinct().join(marks, "set_id")
    members = by_slice(members.select(*SLICED, "set_id", "n", "bits"), *SLICED)
    near = written(members.mapInArrow(_near_in_slices(percent), "group long, slice long, set_id long"), "near")
    tokens = read_tokens(near, "tokens")
    slices = by_slice(near.join(tokens, "set_id").select(*SLICED, "set_id", "tokens"), *SLICED)
    first_links = written(slices.mapInArrow(_link_slices(percent), "a long, b long"), "first-links")
    found = components(first_links, f"{folder}/first")
    named = grouped.join(found, F.col("set_id") == F.col("node"), "left").select(
        "set_id", *SLICED, F.coalesce("component", "set_id").alias("component")
    )
    weight = named.groupBy(F.col("component").alias("c")).agg(F.count("*").alias("sets"))
    named = named.join(weight, F.col("component") == F.col("c")).drop("c")
    named = written(named.join(marks.select("set_id", "n"), "set_id"), "named")

    # Keys that lie in more than one component: of two, the smaller one asks the slices of
    # the other, where a set with the key has a size that a similar set may have. Ends are
    # written, so that a hot key is split in the join.
    placed = hits.select("key", "set_id").join(named, "set_id")
    ends = placed.groupBy(F.col("key").alias("of")).agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    ends = written(ends.where("lo <> hi").select("of"), "crossing-keys")
    crossing = written(placed.join(ends, F.col("key") == F.col("of"), "left_semi"), "crossing")
    rank = F.struct("sets", "component")
    reach = F.max(rank).alias("greatest"), F.min("n").alias("least"), F.max("n").alias("most")
    askable = written(crossing.groupBy("key", *SLICED).agg(*reach), "askable")
    asks = crossing.select("key", "set_id", "n", rank.alias("own"))
    fits = (F.col("n") * percent <= F.col("most") * 100) & (F.col("least") * percent <= F.col("n") * 100)
    cells = written(asks.join(askable, "key").where("own < greatest").where(fits).select("set_id", *SLICED).distinct(), "cells")

    # Bits bound what a set can share with a slice, and with its members.
    inside = grouped.join(cells.select(*SLICED).distinct(), [*SLICED], "left_semi")
    component = named.select("set_id", "component")
    key = (*SLICED, "chunk")
    bounded = _chunked(cells, inside, BIT_ASKERS).join(component, "set_id").join(marks, "set_id")
    bounded = by_slice(bounded.select(*key, "asks", "set_id", "component", "n", "bits"), *key)
    close = bounded.mapInArrow(_near_to_slices(percent), "group long, slice long, asks boolean, set_id long").distinct()
    close = written(close, "close")

    # What is left is opened, some of the sets that ask at a time.
    more = close.select("set_id").distinct().join(tokens.select("set_id"), "set_id", "left_anti")
    tokens = tokens.unionByName(read_tokens(more, "more-tokens")).dropDuplicates(["set_id"])
    opened = _chunked(close.where("asks"), close.where("NOT asks").select("set_id", *SLICED), askers)
    opened = by_slice(opened.join(component, "set_id").join(tokens, "set_id").select(*key, "asks", "set_id", "component", "tokens"), *key)
    last_links = written(opened.mapInArrow(_open_slices(percent), "a long, b long"), "last-links")

    every = components(first_links.unionByName(last_links), f"{folder}/components")
    ids = sets.join(every, F.col("set_id") == F.col("node"), "left").select("set_id", "id", F.coalesce("component", "set_id").alias("component"))
    smallest = ids.groupBy(F.col("component").alias("c")).agg(F.min("id").alias("component_id"))
    return written(
        ids.join(smallest, F.col("component") == F.col("c")).select(F.col("set_id").alias("of"), "component_id"), "component-of"
    )
