"""MinHash near-duplicates by tensored banding.

Documents are sets of word shingles. A table of the usual banding needs minhashes of its own
for every band. Here there are two small collections of half bands, ``halves`` in each, and
a table for every pair of a half from the one and a half from the other: its key is both
halves. So ``halves`` squared tables cost 2 * ``halves`` * ``rows`` minhashes instead of
``halves`` squared * 2 * ``rows``, about a square root of them. Two sets of similarity s
meet in some table with probability

    (1 - (1 - s ** rows) ** halves) ** 2

which is 0.998 at s = 0.8 with 3 rows and 10 halves, and 0.99998 at 0.9.

A table's key can only be shared where both of its halves are: halves that no other set
has are dropped first, 20 numbers per set, and only what is left is paired. Sets that meet
are confirmed on their full sets, and components are named by the least document id
(``sets``). Equal sets are one set from the start, and a task lists a set once, so copies
cost one row each.

Defined cases: NULL and empty texts have the empty set and link with nothing; a text of
fewer words than a shingle is one shingle; a NULL id is passed over when components are
named, and a component of NULL ids alone has the id NULL; repeated rows are copies of each
other; texts are read whole, whatever their length; an empty table gives an empty result;
columns other than the two named are not read, so their names cannot clash. Shingles and
sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.sets import ASKERS, BROADCAST_IDS, SLICE, U64, described_and_listed, linked_components, sharing
from tallybrook.llm.words import mix
from tallybrook.session import work_folder

ROWS = 3
HALVES = 10
SEED = 1


def chance(similarity: float, rows: int = ROWS, halves: int = HALVES) -> float:
    """Probability that two sets of this similarity share a table's key."""
    return (1 - (1 - similarity**rows) ** halves) ** 2


def half_bands(sets: list[np.ndarray], rows: int, halves: int, seed: int) -> np.ndarray:
    """Per set (not empty) its half bands of both collections: 2 * ``halves`` numbers.

    A minhash is the least of a * x + b over the set's shingles x, which are hashes
    already; places are mixed in, so halves of different places never agree.
    """
    if not sets:
        return np.zeros((0, 2 * halves), U64)
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(x) for x in sets])))[:-1]
    draws = mix(np.arange(4 * halves * rows, dtype=U64) + mix(np.array([seed], U64)))
    out = np.empty((2 * halves, len(sets)), U64)
    for place in range(2 * halves):
        half = np.full(len(sets), U64(place + 1), U64)
        for row in range(place * rows, place * rows + rows):
            least = np.minimum.reduceat(flat * (draws[2 * row] | U64(1)) + draws[2 * row + 1], starts)
            half = mix(half * U64(0xD6E8FEB86659FD93) + least)
        out[place] = half
    return out.T


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    halves: int = HALVES,
    seed: int = SEED,
    slice_sets: int = SLICE,
    askers: int = ASKERS,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """Per document its id, ``n_shingles``, ``component_id`` (the least id it reaches over
    links of at least ``percent`` hundredths of similarity) and whether it is ``kept``, being
    the least itself."""
    spark = documents.sparkSession
    folder = work_folder(spark, "minhash")
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))

    def describe(found: list[np.ndarray]) -> list[np.ndarray]:
        return list(half_bands(found, rows, halves, seed))

    described, listed = described_and_listed(texts, width, describe, folder)

    # Halves that more than one set has. Places are part of a half's hash, but a pair needs
    # to know which side it comes from.
    side = (F.col("place") >= halves).cast("long")
    both = sharing(listed.select("set_id", (F.shiftleft("key", 1) + side).alias("key")), f"{folder}/halves")
    is_right = F.col("key").bitwiseAND(1) == 1
    sides = both.groupBy("set_id").agg(
        F.collect_list(F.when(~is_right, F.col("key"))).alias("left"), F.collect_list(F.when(is_right, F.col("key"))).alias("right")
    )
    sides.where((F.size("left") > 0) & (F.size("right") > 0)).write.parquet(f"{folder}/sides")
    sides = spark.read.parquet(f"{folder}/sides")

    # Every pair of a half of the one side and a half of the other is a table's key.
    pairs = F.flatten(F.transform("left", lambda a: F.transform("right", lambda b: F.xxhash64(a, b))))
    hits = sharing(sides.select("set_id", F.explode(pairs).alias("key")), f"{folder}/tables")

    known = linked_components(hits, described, texts, folder, width, percent, slice_sets, askers, broadcast_ids)
    result = described.select("id", "n", "set_id").join(known, F.col("set_id") == F.col("of"), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return result.select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept")
    )
