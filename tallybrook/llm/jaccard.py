"""N-gram Jaccard join over a token-group matrix.

Documents are sets of word shingles (the tokens). Equal sets are one set from here on.

1. *Parts.* Two sets of the wanted similarity share at least that share of the larger one's
   tokens. So if the tokens of every set are put into one order, the same for all sets, and
   a set of n tokens lists the first n - ceil(n * percent / 100) + 1 of them, similar sets
   list a token in common. The rarest come first: tokens that a sample of the texts shows to
   be common come behind all others, by how often they were met there. A passage that many
   texts quote is so listed only by sets that have little else. Which tokens the sample shows
   affects nothing but speed.
2. *Groups.* Sets that list the same tokens go, with the least set they share one with, into
   one group; large groups are cut into slices. A row of the matrix of sets and tokens is kept
   as a few bits per token. Sets of a slice whose bits allow it are compared exactly.
3. *Matrix.* A slice's union is the union of its rows. For a set outside that lists a token
   of a member it is not connected to yet, the bits it has and the union lacks bound its
   overlap with any member, and those that a member lacks its overlap with that one.
4. *Opening.* Only where the bounds allow the similarity, the set is compared exactly with
   the members that are left. One link per connected part of the slice is enough.

All links between sets are so found, ruled out, or known to lie within a component.
Tokens and sets are told apart by 64-bit hashes. A very large group makes many slices;
its sets never meet in one task, and no pair of them is ever a row.

Defined cases: NULL and empty texts have the empty set and link with nothing; a text of
fewer words than a shingle is one token; texts are read whole, whatever their length; a
NULL id is passed over when components are named; repeated rows are copies of each other;
an empty table gives an empty result; columns other than the two named are not read, so
their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.runs import let_go
from tallybrook.llm.sets import (
    ASKERS, BROADCAST_IDS, SLICE, U64, described_and_listed, emptied, linked_components, sharing, token_sets,
)
from tallybrook.session import work_folder

# One text in so many is in the sample of tokens; tokens of at least so many texts of it are
# common, and so many at most, the most frequent ones.
SAMPLED_TEXTS, COMMON, COMMON_TOKENS = 32, 3, 400_000


class Common(NamedTuple):
    """Common tokens in ascending order, and the place of each when the rarest come first."""

    tokens: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, tokens: np.ndarray, counts: np.ndarray) -> Common:
        order = np.argsort(tokens)
        tokens, counts = tokens[order], counts[order]
        ranks = np.empty(len(tokens), np.int32)
        ranks[np.lexsort((tokens, counts))] = np.arange(len(tokens), dtype=np.int32)
        return cls(tokens, ranks)


NOTHING_COMMON = Common(np.zeros(0, U64), np.zeros(0, np.int32))


def common_tokens(texts: DataFrame, width: int, folder: str, one_in: int, least: int, most: int) -> Common:
    """The tokens that ``least`` texts or more of one in ``one_in`` have, copies of a text
    being one; at most ``most`` of them reach the driver."""
    spark = texts.sparkSession

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            found = np.concatenate([np.zeros(0, U64), *token_sets(batch.column(0), width)])
            yield pa.record_batch({"token": pa.array(found.view(np.int64))})

    some = texts.select("text").where(F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0).distinct()
    counted = some.mapInArrow(tokens, "token long").groupBy("token").agg(F.count("*").alias("n"))
    counted.where(F.col("n") >= least).write.parquet(f"{folder}/common-tokens")
    counted = spark.read.parquet(f"{folder}/common-tokens")
    # From which number on there are not too many.
    total, bound = 0, None
    for n, tokens_of_n in counted.groupBy("n").agg(F.count("*")).orderBy(F.desc("n")).collect():
        total += tokens_of_n
        if total > most:
            break
        bound = n
    if bound is None:
        return NOTHING_COMMON
    found = counted.where(F.col("n") >= bound).toArrow()
    return Common.of(found["token"].to_numpy().view(U64), found["n"].to_numpy())


def part_hashes(tokens: np.ndarray, percent: int, common: Common = NOTHING_COMMON) -> np.ndarray:
    """The part of a set (of tokens in ascending order) that it lists: the first ones in the
    order of all tokens, which is by number for those that are not common."""
    listed = len(tokens) - -(-percent * len(tokens) // 100) + 1
    if not len(common.tokens):
        return tokens[:listed]
    at = np.minimum(np.searchsorted(common.tokens, tokens), len(common.tokens) - 1)
    known = common.tokens[at] == tokens
    rare = tokens[~known][:listed]
    more = tokens[known][np.argsort(common.ranks[at[known]])[: listed - len(rare)]]
    return np.concatenate((rare, more))


def jaccard_components(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    percent: int = 80,
    slice_sets: int = SLICE,
    askers: int = ASKERS,
    broadcast_ids: int = BROADCAST_IDS,
    sampled_texts: int = SAMPLED_TEXTS,
    common_least: int = COMMON,
    common_most: int = COMMON_TOKENS,
) -> DataFrame:
    """Per document its id, ``n_shingles``, and ``component_id``: the least id it can reach
    over links of at least ``percent`` hundredths of similarity."""
    spark = documents.sparkSession
    folder = work_folder(spark, "jaccard")
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    common = spark.sparkContext.broadcast(tuple(common_tokens(texts, width, folder, sampled_texts, common_least, common_most)))

    def describe(found: list[np.ndarray]) -> list[np.ndarray]:
        known = Common(*common.value)
        return [part_hashes(tokens, percent, known) for tokens in found]

    described, listed = described_and_listed(texts, width, describe, folder)
    hits = sharing(listed.select("set_id", "key"), f"{folder}/parts")
    emptied(spark, f"{folder}/keys")
    known = linked_components(hits, described, texts, folder, width, percent, slice_sets, askers, broadcast_ids)
    result = described.select("id", "n", "set_id").join(known, F.col("set_id") == F.col("of"), "left")
    return result.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
