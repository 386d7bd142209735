"""Ranked lexical search over norm buckets of impact vectors.

A document is a sparse vector of impacts, one per term, that rise with the term's share of
the document; an item asks for its terms with their weights. A score is the inner product
of both, in whole numbers. Half of every weight's logarithm goes to either side, so that

    score(q, d) = sum over terms of sqrt(w) * (sqrt(w) * impact)

1. *Profiles.* One pass over whole texts keeps, of every document, its number of terms and
   how often it holds the terms that any item of the block asks for. Document counts per
   term come from the profiles.
2. *Buckets.* Vectors are ordered by length (their norm), dealt over tasks by range, and cut
   into buckets of ``bucket_rows``. By Cauchy-Schwarz no document of a bucket scores above
   the item's norm times the bucket's greatest norm: an item whose k-th best score so far
   is above that passes the bucket over.
3. *Coordinates.* Inside, the terms of the item are added up over the bucket's postings,
   from the heaviest on, in steps. What the terms that are left can add is bounded twice, by
   the norms that are left of item and document, and by the greatest impact that the bucket
   holds of each term. Documents whose bound does not reach the k-th best score go; steps
   end when few survive.
4. *Rescoring.* Survivors are scored over all terms, in 64-bit whole numbers.

The longest vectors go first and give every item a threshold, with which all others are
read; a task raises its own thresholds as it goes on. A task returns at most k rows per
item. Items are taken in blocks of about ``block_terms`` terms; a block's terms and items
are what is broadcast and what reaches the driver, and documents are read once per block.
Terms are told apart by 64-bit hashes.

Defined cases: NULL and empty texts have no terms, are no documents of the counts and are
never listed; an item without terms, or whose terms no document holds, has no rows; rows
that share an item id are one item with the terms of all, NULL being an id like others;
rows that repeat a document id are documents of their own; equal scores go to the smaller
document id, NULL last; texts are read whole, whatever their length; an empty table on
either side gives an empty result; columns other than those named are not read, so their
names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.words import pieces, text_bytes, words
from tallybrook.session import work_folder

# Bytes that separate terms: ASCII other than letters and digits.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[:128] = True
for _first, _last in ("09", "AZ", "az"):
    SEPARATORS[ord(_first) : ord(_last) + 1] = False

BLOCK_TERMS = 1 << 20
BUCKET_ROWS = 2048
# The share of documents, the longest vectors, that give the first thresholds.
FIRST_SHARE = 1 / 32
# The shares of an item's squared norm that its terms cover step by step; steps end when
# one in so many of a bucket's documents survives.
FOCUS = (0.5, 0.8, 1.0)
FEW = 16

INT = np.int64


def weights(n_documents: int, holding: np.ndarray) -> np.ndarray:
    """A term's weight by the number of documents that hold it."""
    return np.floor(1000 * np.log((2 * n_documents + 2) / (2 * holding + 1))).astype(INT)


def impacts(counts: np.ndarray, length: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """What a term adds to a document's score per unit of weight, by its occurrences and
    the document's length against the mean."""
    m = 100 - 50 + (50 * length * n_documents) // n_terms
    return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


def term_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of every text its number of terms, and the hashes and counts of different ones."""
    for at, upto in pieces(texts):
        found = words(text_bytes(texts.slice(at, upto - at)), lower=True, separators=SEPARATORS)
        for first, last in zip(found.first[:-1], found.first[1:]):
            yield int(last - first), *np.unique(found.hashes[first:last], return_counts=True)


class Block(NamedTuple):
    """Items of a block: ids, terms as places in the vocabulary, and the vocabulary."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: np.ndarray


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [hashes.tobytes() for _, hashes, _ in term_sets(batch.column(1))]
        sizes = pa.array([len(x) // 8 for x in found], pa.int64())
        yield pa.record_batch({"item": batch.column(0), "n": sizes, "terms": pa.array(found, pa.binary())})


def _block(rows: list) -> Block:
    held: dict[object, list[np.ndarray]] = {}
    for r in rows:
        held.setdefault(r.item, []).append(np.frombuffer(r.terms, np.uint64))
    merged = [np.unique(np.concatenate(x)) for x in held.values()]
    vocabulary = np.unique(np.concatenate(merged)) if merged else np.zeros(0, np.uint64)
    return Block(list(held), [np.searchsorted(vocabulary, x) for x in merged], vocabulary)


def _profiles(vocabulary):
    """Per document with a term: its terms of the vocabulary, as places, and their counts."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            lengths, places, counts = [], [], []
            for n, hashes, times in term_sets(batch.column(1)):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                asked = known[at] == hashes
                lengths.append(n)
                places.append(at[asked].astype(np.int32).tobytes())
                counts.append(times[asked].astype(np.int32).tobytes())
            columns = {"n": pa.array(lengths, pa.int64()), "terms": pa.array(places, pa.binary()), "counts": pa.array(counts, pa.binary())}
            found = pa.record_batch({"id": batch.column(0), **columns})
            yield found.filter(pa.array(np.array(lengths, INT) > 0))

    return profile


def _holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a task's documents hold each term."""
    seen = np.zeros(0, INT)
    for batch in batches:
        places = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32)
        found = np.bincount(places, minlength=len(seen))
        found[: len(seen)] += seen
        seen = found
    terms = np.flatnonzero(seen)
    yield pa.record_batch({"term": pa.array(terms, pa.int64()), "df": pa.array(seen[terms], pa.int64())})


def _vectors(weight, n_documents: int, n_terms: int):
    """Impact vectors and their norms; documents without an asked term are left out."""

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weight.value
        for batch in batches:
            batch = batch.filter(pc.greater(pc.binary_length(batch.column(2)), 0))
            if not len(batch):
                continue
            sizes = pc.binary_length(batch.column(2)).to_numpy() // 4
            places = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int32)
            counts = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int32).astype(INT)
            lengths = np.repeat(batch.column(1).to_numpy(), sizes)
            found = impacts(counts, lengths, n_documents, n_terms)
            ends = np.cumsum(sizes)
            norms = np.sqrt(np.add.reduceat(w[places].astype(float) * found.astype(float) ** 2, ends - sizes))
            flat = found.astype(np.int32).tobytes()
            packed = [flat[4 * (e - s) : 4 * e] for e, s in zip(ends.tolist(), sizes.tolist())]
            columns = {"norm": pa.array(norms), "terms": batch.column(2), "impacts": pa.array(packed, pa.binary())}
            yield pa.record_batch({"id": batch.column(0), **columns})

    return vector


class Items(NamedTuple):
    """What tasks need of a block: every item's terms from the heaviest on, how many of
    them each step has reached, and the weights of all terms."""

    terms: list[np.ndarray]
    steps: list[list[int]]
    weight: np.ndarray


def _prepared(block: Block, weight: np.ndarray, focus: tuple[float, ...]) -> Items:
    terms, steps = [], []
    for places in block.terms:
        places = places[weight[places] > 0]
        places = places[np.argsort(-weight[places], kind="stable")]
        covered = np.cumsum(weight[places])
        terms.append(places)
        reached = {min(len(places), int(np.searchsorted(covered, f * covered[-1])) + 1) for f in focus if len(places)}
        steps.append(sorted(reached))
    return Items(terms, steps, weight)


class Best:
    """The k best documents an item has met, and the score that others must reach."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.scores, self.ids = np.zeros(0, INT), np.zeros(0, INT)
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        self.scores = np.concatenate((self.scores, scores))
        self.ids, self.null = np.concatenate((self.ids, ids)), np.concatenate((self.null, null))
        if len(self.scores) >= self.k:
            order = np.lexsort((self.ids, self.null, -self.scores))[: self.k]
            self.scores, self.ids, self.null = self.scores[order], self.ids[order], self.null[order]
            self.least = max(self.least, int(self.scores[-1]))


class Bucket:
    """Vectors of a bucket by document and by term."""

    def __init__(self, batch: pa.RecordBatch, weight: np.ndarray):
        ids = batch.column(0)
        self.null = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy()
        self.norms = batch.column(1).to_numpy()
        sizes = pc.binary_length(batch.column(2)).to_numpy() // 4
        self.places = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int32)
        self.impacts = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int32).astype(INT)
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(self.places, kind="stable")
        self.owner, self.adds = owner[order], self.impacts[order]
        self.squares = self.adds.astype(float) ** 2
        self.posting = np.searchsorted(self.places[order], np.arange(len(weight) + 1))
        self.greatest = np.zeros(len(weight), INT)
        np.maximum.at(self.greatest, self.places, self.impacts)

    def survivors(self, terms: np.ndarray, steps: list[int], weight: np.ndarray, least: int) -> np.ndarray:
        """Documents whose coordinate bound reaches ``least``."""
        most = np.cumsum((weight[terms] * self.greatest[terms])[::-1])[::-1]
        if not len(terms) or most[0] < least:
            return np.zeros(0, INT)
        total, square = np.zeros(len(self.ids)), self.norms**2
        # Rounding errors of the norms are far below this.
        slack, done, found = square * 1e-9, 0, np.zeros(0, INT)
        for upto in steps:
            for t in terms[done:upto].tolist():
                span = slice(self.posting[t], self.posting[t + 1])
                total[self.owner[span]] += weight[t] * self.adds[span]
                square[self.owner[span]] -= weight[t] * self.squares[span]
            rest = math.sqrt(float(weight[terms[upto:]].sum()))
            ahead = float(most[upto]) if upto < len(terms) else 0.0
            bound = total + np.minimum(rest * np.sqrt(np.maximum(square, 0) + slack), ahead) + 1
            found, done = np.flatnonzero(bound >= max(least, 1)), upto
            if len(found) * FEW <= len(total):
                break
        return found

    def scores(self, which: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores of some documents; ``weight_of`` is 0 for terms not asked for."""
        sizes = self.first[which + 1] - self.first[which]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(self.first[which] - ends + sizes, sizes)
        return np.add.reduceat(weight_of[self.places[places]] * self.impacts[places], ends - sizes)


def _rebatched(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _search(items, thresholds, k: int, bucket_rows: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, steps, weight = items.value
        norms = np.array([math.sqrt(float(weight[t].sum())) for t in terms])
        best = [Best(k, least) for least in thresholds.value]
        least = np.array(thresholds.value, float)
        weight_of = np.zeros_like(weight)
        for batch in _rebatched(batches, bucket_rows):
            bucket = Bucket(batch, weight)
            bound = norms * bucket.norms.max() * (1 + 1e-9) + 1
            for q in np.flatnonzero((bound >= least) & (norms > 0)).tolist():
                which = bucket.survivors(terms[q], steps[q], weight, best[q].least)
                if not len(which):
                    continue
                weight_of[terms[q]] = weight[terms[q]]
                scores = bucket.scores(which, weight_of)
                weight_of[terms[q]] = 0
                good = scores >= max(best[q].least, 1)
                if good.any():
                    which = which[good]
                    best[q].add(scores[good], bucket.ids[which], bucket.null[which])
                    least[q] = best[q].least
        for q, found in enumerate(best):
            if len(found.scores):
                numbers = {"q": pa.array(np.full(len(found.ids), q), pa.int64()), "id": pa.array(found.ids, pa.int64(), mask=found.null)}
                yield pa.record_batch({**numbers, "score": pa.array(found.scores, pa.int64())})

    return search


def rank_documents(
    documents: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_terms: int = BLOCK_TERMS,
    bucket_rows: int = BUCKET_ROWS,
    first_share: float = FIRST_SHARE,
    focus: tuple[float, ...] = FOCUS,
) -> DataFrame:
    """Per item its id, and ``rank`` from 1, document id and ``score`` of its k best
    documents with a score above 0. Ids are whole numbers."""
    spark = documents.sparkSession
    folder = work_folder(spark, "lexical")
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    asked = items.select(F.col(item_column).cast("long").alias("item"), F.col(item_text_column).alias("text"))
    asked.mapInArrow(_item_rows, "item long, n long, terms binary").write.parquet(f"{folder}/items")
    asked = spark.read.parquet(f"{folder}/items").where("n > 0")
    blocks = math.ceil((asked.agg(F.sum("n")).first()[0] or 0) / block_terms)
    ranked = spark.createDataFrame([], "item long, rank int, id long, score long")
    for number in range(blocks):
        block = _block(asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect())
        some = _ranked_block(texts, block, f"{folder}/{number}", k, bucket_rows, first_share, focus)
        ranked = ranked.unionByName(some) if some is not None else ranked
    return ranked.select(F.col("item").alias(item_column), "rank", F.col("id").alias(id_column), "score")


def _ranked_block(
    texts: DataFrame, block: Block, folder: str, k: int, bucket_rows: int, first_share: float, focus: tuple[float, ...]
) -> DataFrame | None:
    """The ranks of a block's items, written; None where no document or no item has terms."""
    if not len(block.vocabulary):
        return None
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    profiles = texts.mapInArrow(_profiles(shared(block.vocabulary)), "id long, n long, terms binary, counts binary")
    profiles = written(profiles, "profiles")
    totals = profiles.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    if not totals.documents:
        return None
    holding = np.zeros(len(block.vocabulary), INT)
    held = profiles.select("terms").mapInArrow(_holding, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in held.collect():
        holding[r.term] = r.df
    weight = np.where(holding > 0, weights(totals.documents, holding), 0)

    # Equal vectors have equal norms: the hash spreads them over ranges.
    vectors = profiles.mapInArrow(
        _vectors(shared(weight), totals.documents, totals.terms), "id long, norm double, terms binary, impacts binary"
    )
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_norm = vectors.repartitionByRange(ranges, F.desc("norm"), F.xxhash64("id")).sortWithinPartitions(F.desc("norm"))
    vectors = written(by_norm, "vectors")

    prepared = shared(_prepared(block, weight, focus))
    score = Window.partitionBy("q").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    schema = "q long, id long, score long"
    edge = vectors.agg(F.percentile_approx("norm", F.lit(1 - first_share), F.lit(1000))).first()[0]
    if edge is None:
        return None

    def best(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(score)).where(F.col("rank") <= k)

    def search(rows: DataFrame, least: list[int]) -> DataFrame:
        return rows.mapInArrow(_search(prepared, shared(least), k, bucket_rows), schema)

    none = [0] * len(block.ids)
    first = written(best(search(vectors.where(F.col("norm") >= edge), none)).drop("rank"), "first")
    thresholds = list(none)
    for r in first.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).collect():
        thresholds[r.q] = r.least
    rest = search(vectors.where(F.col("norm") < edge), thresholds)
    ranked = written(best(rest.unionByName(first)), "ranked")
    names = spark.createDataFrame([(q, item) for q, item in enumerate(block.ids)], "of long, item long")
    return ranked.join(F.broadcast(names), F.col("q") == F.col("of")).select("item", "rank", "id", "score")
