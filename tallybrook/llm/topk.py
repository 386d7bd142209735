"""Exact top-k search by inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance from it. Distances are cut
into rings, so a pivot has ``RINGS`` annuli, with the least and greatest distance and the
greatest norm of what they hold. By the triangle inequality no vector of an annulus is
nearer to a query than the gap between the query's distance from the pivot and the
annulus, which bounds its inner product: 2 q.x = |q|^2 + |x|^2 - |q - x|^2. A query opens
annuli in order of their bounds, and stops once no bound reaches its k-th best score.

There are about as many annuli as hold ``ANNULUS_ROWS`` vectors each, PIVOTS * RINGS at
most. Vectors of an annulus are dealt over slices by hash, so an annulus that holds a third
of all vectors is many rows. Slices and queries travel in blocks; each round opens, for
every query, the annuli that its bounds still ask for: the best few first, all the
others that qualify in the last.

Scores are exact: products of components are summed as doubles while no sum can pass
2 ** 53, else as 64-bit integers, and beyond these an error is raised.

Defined cases: vectors that are NULL, hold NULL or a non-finite component, or differ from
the others in length take no part (the length most vectors have counts); equal scores go
to the smaller id; rows that repeat an id are vectors of their own, as queries and as
candidates, also for each other; a query with fewer candidates than k gets all; NULL ids
take no part; an empty table gives an empty result; columns other than the two named are
not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.session import work_folder

PIVOTS = 64
RINGS = 16
ANNULUS_ROWS = 1024
SAMPLE = 4096
SLICE_ROWS = 4096
QUERY_ROWS = 256
SCALE = 1024

# Up to this size all whole numbers are doubles, and all sums 64-bit integers.
EXACT_DOUBLES, EXACT_LONGS = 2.0**53, 2.0**63

# Annuli a query opens in its first rounds; the last opens all that still qualify.
ROUNDS = (2, 16)


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id`` and the integer components floor(scale * x) of vectors that take part."""
    found = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    whole = F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return found.where(whole & F.coalesce(finite, F.lit(False))).select(
        "id", F.transform("v", lambda x: F.floor(x * float(scale)).cast("long")).alias("v")
    )


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)


def _packed(rows: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in rows]


def _unpacked(values: list[bytes], n: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.int64).reshape(n, -1)


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows."""
    a, b = left.astype(np.float64), right.astype(np.float64)
    greatest = math.sqrt(float((a**2).sum(axis=1).max())) * math.sqrt(float((b**2).sum(axis=1).max())) * (1 + 1e-9)
    if greatest < EXACT_DOUBLES:
        return (a @ b.T).astype(np.int64)
    if greatest < EXACT_LONGS:
        return left @ right.T
    raise OverflowError("inner products pass 64-bit integers")


def annuli_for(vectors: int, pivots: int = PIVOTS, rings: int = RINGS) -> tuple[int, int]:
    """Pivots and rings for so many vectors."""
    annuli = max(1, min(pivots * rings, vectors // ANNULUS_ROWS))
    some = min(rings, math.isqrt(max(1, annuli // 2)) or 1)
    return min(pivots, -(-annuli // some)), some


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (rows**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def fit_pivots(sample: np.ndarray, pivots: int = PIVOTS, steps: int = 8) -> np.ndarray:
    """Centres of a bounded sample, from spread-out rows of it and some steps of k-means."""
    centres = [sample[0]]
    near = _distances(sample, sample[:1])[:, 0]
    while len(centres) < min(pivots, len(sample)) and near.max() > 0:
        centres.append(sample[int(near.argmax())])
        near = np.minimum(near, _distances(sample, centres[-1][None, :])[:, 0])
    found = np.array(centres)
    for _ in range(steps):
        owner = _distances(sample, found).argmin(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, owner, sample)
        n = np.bincount(owner, minlength=len(found))
        found = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], found)
    return found


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    pivots: int | None = None,
    rings: int | None = None,
    sample_rows: int = SAMPLE,
    slice_rows: int = SLICE_ROWS,
    query_rows: int = QUERY_ROWS,
    rounds: tuple[int, ...] = ROUNDS,
) -> DataFrame:
    """``vectors`` has ``id`` and ``v`` (whole numbers); ``is_query`` is a condition on
    ``id``. Gives ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``. Pivots and rings
    follow from the number of vectors where they are not given."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    folder = work_folder(spark, "topk")
    commonest = vectors.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if commonest is None:
        return spark.createDataFrame([], schema)
    dimensions = commonest.d
    usual = annuli_for(commonest.n)
    pivots, rings = pivots or usual[0], rings or usual[1]
    vectors = vectors.where(F.size("v") == dimensions)

    # Pivots and ring edges come from a bounded sample; every vector is indexed.
    picked = vectors.orderBy(F.xxhash64("id"), "id").limit(sample_rows).toArrow()
    sample = _matrix(picked.column("v"), dimensions)
    centres = fit_pivots(sample, pivots)
    gaps = _distances(sample, centres)
    owner = gaps.argmin(axis=1)
    shares = np.linspace(0, 1, rings + 1)[1:-1]
    edges = np.array(
        [np.quantile(gaps[owner == p, p], shares) if (owner == p).any() else np.zeros(rings - 1) for p in range(len(centres))]
    )

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("v"), dimensions)
            gap = _distances(rows, centres)
            pivot = gap.argmin(axis=1)
            distance = gap[np.arange(len(rows)), pivot]
            ring = (edges[pivot] < distance[:, None]).sum(axis=1)
            yield pa.record_batch(
                {
                    "row": batch.column("row"),
                    "id": batch.column("id"),
                    "annulus": pa.array(pivot * rings + ring, pa.int64()),
                    "distance": pa.array(distance),
                    "norm": pa.array((rows**2).sum(axis=1)),
                    "v": pa.array(_packed(batch.column("v").flatten().to_numpy().reshape(-1, dimensions)), pa.binary()),
                }
            )

    # Rows are numbered once, in what is written: a query is a row, not an id.
    numbered = vectors.select(F.monotonically_increasing_id().alias("row"), "id", "v")
    numbered.mapInArrow(key, "row long, id long, annulus long, distance double, norm double, v binary").write.parquet(f"{folder}/keyed")
    keyed = spark.read.parquet(f"{folder}/keyed")
    # At most pivots * rings rows.
    annuli = (
        keyed.groupBy("annulus")
        .agg(F.min("distance").alias("lo"), F.max("distance").alias("hi"), F.max("norm").alias("norm"), F.count("*").alias("n"))
        .orderBy("annulus")
        .toPandas()
    )
    n_slices = dict(zip(annuli["annulus"].tolist(), (-(-annuli["n"] // slice_rows)).tolist()))
    slices = F.element_at(F.create_map(*[F.lit(int(x)) for pair in n_slices.items() for x in pair]), F.col("annulus").cast("int"))
    hashed = F.xxhash64("row")
    packed = (
        keyed.withColumn("slice", F.pmod(hashed, slices.cast("long")))
        .groupBy("annulus", "slice")
        .agg(F.collect_list(F.struct("row", "id", "v")).alias("held"))
    )
    packed.select("annulus", "slice", "held.row", "held.id", "held.v").write.parquet(f"{folder}/slices")
    held = spark.read.parquet(f"{folder}/slices")

    # Queries of one pivot and similar distance travel together, in full blocks; a pivot
    # with very many vectors has its queries dealt over parts.
    near = Window.partitionBy("pivot", "part").orderBy("annulus", "distance", "row")
    of_pivot = F.floor(F.col("annulus") / rings)
    parts_of = annuli.assign(pivot=annuli["annulus"] // rings, slices=-(-annuli["n"] // slice_rows)).groupby("pivot")["slices"].sum()
    n_parts = F.element_at(
        F.create_map(*[F.lit(int(x)) for p, n in parts_of.items() for x in (p, max(1, -(-n // (16 * rings))))]), of_pivot.cast("int")
    )
    queries = (
        keyed.where(is_query)
        .withColumn("pivot", of_pivot)
        .withColumn("part", F.pmod(hashed, n_parts.cast("long")))
        .withColumn("block", F.floor((F.row_number().over(near) - 1) / query_rows))
        .groupBy("pivot", "part", "block")
        .agg(F.collect_list(F.struct("row", "id", "v")).alias("asked"))
        .select("pivot", "part", "block", "asked.row", "asked.id", "asked.v")
    )
    queries.write.parquet(f"{folder}/queries")
    queries = spark.read.parquet(f"{folder}/queries")

    names = annuli["annulus"].to_numpy()
    lo, hi, norm = (annuli[c].to_numpy() for c in ("lo", "hi", "norm"))
    pivot_of = names // rings
    parts = np.array([n_slices[a] for a in names.tolist()])

    def bounds(rows: np.ndarray) -> np.ndarray:
        """The greatest inner product an annulus may hold for each query, rounded up."""
        gap = _distances(rows, centres)[:, pivot_of]
        beyond = np.maximum(np.maximum(lo - gap, gap - hi), 0)
        square = (rows**2).sum(axis=1)[:, None]
        # Distances and norms carry rounding errors of far less than this.
        slack = (square + norm) * 1e-9
        beyond = np.maximum(beyond - 1e-6 - np.sqrt(slack) * 1e-3, 0)
        return np.minimum((square + norm - beyond**2) / 2, np.sqrt(square * norm)) + slack + 1

    def opened(upto: int | None, passed: int):
        """Query blocks with the slices they open: the annuli from place ``passed`` on in
        order of bounds, up to place ``upto``, whose bound reaches the query's threshold."""

        def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for numbers, ids, vs, least in zip(*[batch.column(c) for c in ("row", "id", "v", "least")]):
                    numbers, ids = np.array(numbers.as_py(), np.int64), np.array(ids.as_py(), np.int64)
                    vs, least = _unpacked(vs.as_py(), len(ids)), np.array(least.as_py(), np.float64)
                    bound = bounds(vs.astype(np.float64))
                    order = np.argsort(-bound, axis=1, kind="stable")[:, passed:upto]
                    asks = np.zeros(bound.shape, bool)
                    np.put_along_axis(asks, order, True, axis=1)
                    asks &= bound >= least[:, None]
                    out: list = []
                    for place in np.flatnonzero(asks.any(axis=0)).tolist():
                        who = asks[:, place]
                        block = (numbers[who].tobytes(), ids[who].tobytes(), vs[who].tobytes(), least[who].tobytes())
                        out += [(int(names[place]), s, *block) for s in range(int(parts[place]))]
                    kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 4)
                    for at in range(0, len(out), 32):
                        some = list(zip(*out[at : at + 32]))
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(some, kinds)], ["annulus", "slice", "qrow", "q", "qv", "least"])

        return open_

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, q, qv, least, numbers, ids, vs in zip(*[batch.column(c) for c in ("qrow", "q", "qv", "least", "row", "id", "v")]):
                own, q = np.frombuffer(own.as_py(), np.int64), np.frombuffer(q.as_py(), np.int64)
                least = np.frombuffer(least.as_py(), np.float64)
                numbers, ids = numbers.values.to_numpy(), ids.values.to_numpy()
                scores = inner_products(_unpacked([qv.as_py()], len(q)), _unpacked(vs.as_py(), len(ids)))
                others = own[:, None] != numbers[None, :]
                found: list[tuple[np.ndarray, ...]] = []
                for i in range(len(q)):
                    good = np.flatnonzero((scores[i] >= least[i]) & others[i])
                    if len(good) > k:
                        # All that reach the k-th best score, then the smaller ids among them.
                        good = good[scores[i][good] >= np.partition(scores[i][good], len(good) - k)[len(good) - k]]
                    best = good[np.lexsort((ids[good], -scores[i][good]))][:k]
                    found.append((np.full(len(best), own[i]), np.full(len(best), q[i]), ids[best], scores[i][best]))
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found)]
                yield pa.record_batch(columns, ["query_row", "query_id", "vec_id", "score"])

    best_first = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k).drop("rank")

    best_so_far = None
    passed = 0
    for number, upto in enumerate((*rounds, None)):
        asking = queries.select(
            "row", "id", "v", F.transform("id", lambda _: F.lit(-math.inf)).alias("least")
        ) if best_so_far is None else _with_thresholds(queries, best_so_far, k)
        pairs = asking.repartition(tasks).mapInArrow(
            opened(upto, passed), "annulus long, slice long, qrow binary, q binary, qv binary, least binary"
        )
        # Both sides hold packed vectors, which Spark would take for small enough to broadcast.
        scored = pairs.hint("merge").join(held, ["annulus", "slice"]).mapInArrow(score, "query_row long, query_id long, vec_id long, score long")
        best(scored if best_so_far is None else scored.unionByName(best_so_far)).write.parquet(f"{folder}/best-{number}")
        best_so_far = spark.read.parquet(f"{folder}/best-{number}")
        passed = upto
    ranked = best_so_far.withColumn("rank", F.row_number().over(best_first))
    return ranked.select("query_id", "rank", "vec_id", "score")


def _with_thresholds(queries: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Query blocks with every query's k-th best score so far."""
    # A threshold above 2 ** 53 is rounded down, as a double may not reach it.
    kth = F.when(F.abs("kth") < EXACT_DOUBLES, F.col("kth").cast("double")).otherwise(F.col("kth").cast("double") - F.abs("kth") * 1e-15)
    least = best.groupBy("query_row").agg(F.min("score").alias("kth"), F.count("*").alias("n")).select(
        "query_row", F.when(F.col("n") >= k, kth).otherwise(F.lit(-math.inf)).alias("least")
    )
    key = ("pivot", "part", "block")
    rows = queries.select(*key, F.inline(F.arrays_zip("row", "id", "v")))
    joined = rows.join(least, rows.row == least.query_row, "left").select(
        *key, F.struct("row", "id", "v", F.coalesce("least", F.lit(-math.inf)).alias("least")).alias("r")
    )
    return joined.groupBy(*key).agg(F.collect_list("r").alias("rs")).select("rs.row", "rs.id", "rs.v", "rs.least")
