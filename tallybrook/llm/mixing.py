"""Mixing sources to target weights by fitting subset sums.

Documents are counted by exact length in every source. A source's target is met by whole
passes over it and a remainder. For the remainder, every length gets its even share of
documents, from the longest to the shortest so that what rounding leaves over is passed
on; the last ``window`` words are fitted by a bounded knapsack over the documents that
are left. Which documents of a length are taken is decided by a keyed hash of their ids.

A source has at most sqrt(2 * words) different lengths, so its table of lengths is small;
a length with very many documents is dealt over buckets by hash, and only the bucket in
which the count runs out is ranked.

Defined cases: NULL and empty texts have size 0 and nothing is taken of them; a NULL
source is a source of its own, last in order; documents with equal hash and id rank by
nothing else, as they are alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.session import work_folder

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 1 << 16
BUCKET_ROWS = 4096


def source_targets(sizes: dict[str | None, int], percent: int, most: int, weights: tuple[int, ...] = WEIGHTS) -> dict[str | None, float]:
    """Words per source: ``percent`` of all words shared by weight, nobody above ``most``
    times its own; what that cuts off is shared again among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    targets = {s: 0.0 for s in order}
    left, open_ = percent * sum(sizes.values()) / 100, list(order)
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total >= most * sizes[s]]
        if not full:
            targets |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            targets[s] = float(most * sizes[s])
        left -= sum(most * sizes[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return targets


def fit(lengths: list[int], counts: list[int], budget: int, window: int = WINDOW) -> list[int]:
    """How many documents of each length to take so that the words come near to the budget,
    at an even share of every length. Taking documents fits it from below, leaving the
    others out fits it from above; the nearer one counts."""
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget >= total:
        return list(counts)
    below = _fill(lengths, counts, budget, total, window)
    above = [c - n for c, n in zip(counts, _fill(lengths, counts, total - budget, total, window))]
    return min(below, above, key=lambda taken: abs(sum(n * t for n, t in zip(lengths, taken)) - budget))


def _fill(lengths: list[int], counts: list[int], budget: int, total: int, window: int) -> list[int]:
    taken = [0] * len(lengths)
    # Even shares up to a window before the budget, which the knapsack then fills.
    share = max(0, budget - window // 2)
    ahead = passed = 0
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:
        ahead += lengths[i] * counts[i]
        due = share * ahead // total - passed
        taken[i] = min(counts[i], max(0, due // lengths[i]))
        passed += taken[i] * lengths[i]
    left = budget - passed
    # Rounding may have left more than the window can hold.
    for i in order:
        if left <= window:
            break
        more = min(counts[i] - taken[i], (left - window // 2) // lengths[i])
        taken[i] += max(0, more)
        left -= max(0, more) * lengths[i]
    for i, n in knapsack([lengths[i] for i in order], [counts[i] - taken[i] for i in order], left).items():
        taken[order[i]] += n
    return taken


def knapsack(lengths: list[int], counts: list[int], budget: int) -> dict[int, int]:
    """Bounded knapsack: numbers of items whose lengths sum as near to the budget as
    possible from below. Sums are bits of one integer; counts are split into powers of two.
    Items are added from the shortest on until the sum is met."""
    mask = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    for i in sorted(range(len(lengths)), key=lambda i: lengths[i]):
        if lengths[i] <= 0 or lengths[i] > budget or reach >> budget & 1:
            continue
        rest, part = min(counts[i], budget // lengths[i]), 1
        while rest and not reach >> budget & 1:
            n = min(part, rest)
            wider = (reach | reach << (n * lengths[i])) & mask
            if wider != reach:
                steps.append((reach, i, n))
                reach = wider
            rest, part = rest - n, part * 2
    at = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for was, i, n in reversed(steps):
        if not was >> at & 1:
            chosen[i] = chosen.get(i, 0) + n
            at -= n * lengths[i]
    return chosen


def mix_sources(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    percent: int = 150,
    most: int = 2,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = 29,
    window: int = WINDOW,
) -> DataFrame:
    """Per document its id, size, its source's size and target, the words taken of it, and
    how many copies of it the mix holds."""
    spark = documents.sparkSession
    folder = work_folder(spark, "mixing")
    documents.select(
        F.col(id_column).alias("id"),
        F.col(source_column).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), id_column).alias("hash"),
    ).write.parquet(f"{folder}/sized")
    sized = spark.read.parquet(f"{folder}/sized")
    lengths = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    lengths.write.parquet(f"{folder}/lengths")
    lengths = spark.read.parquet(f"{folder}/lengths")

    # One row per source comes to the driver: sources are named in the mix's weights.
    sums = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).collect()
    totals = {r.source: r.words for r in sums}
    targets = source_targets(totals, percent, most, weights)
    plan = {s: (totals[s], targets[s]) for s in totals}

    def choose(groups: Iterator[pd.DataFrame]) -> pd.DataFrame:
        found = groups.sort_values("size")
        source = found["source"].iloc[0]
        words, target = plan[None if pd.isna(source) else source]
        passes = int(target // words) if words else 0
        rest = round(target) - passes * words
        some = found[found["size"] > 0]
        taken = dict(zip(some["size"], fit(some["size"].tolist(), some["n"].tolist(), rest, window)))
        return found.assign(
            source_size=words, target=target, passes=passes, more=[taken.get(x, 0) for x in found["size"]]
        )[["source", "size", "n", "source_size", "target", "passes", "more"]]

    chosen = lengths.groupBy("source").applyInPandas(
        choose, "source string, size long, n long, source_size long, target double, passes long, more long"
    )
    chosen.write.parquet(f"{folder}/chosen")
    chosen = spark.read.parquet(f"{folder}/chosen").select(
        F.col("source").alias("of"), F.col("size").alias("length"), "n", "source_size", "target", "passes", "more"
    )
    dealt = sized.join(chosen, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("length")))
    # The hash as a share of its range, in as many buckets as the length has documents for.
    buckets = F.ceil(F.col("n") / BUCKET_ROWS)
    dealt = dealt.withColumn("bucket", F.pmod(F.shiftrightunsigned("hash", 33), buckets))
    group = ("source", "size", "bucket")
    counts = dealt.where(F.col("n") > BUCKET_ROWS).groupBy(*group).agg(F.count("*").alias("in_bucket"))
    ahead = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col("source").alias("b_source"), F.col("size").alias("b_size"), F.col("bucket").alias("b_bucket"),
        F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0)).alias("before"),
    )
    ranked = dealt.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy("hash", "id")))
    joined = ranked.join(
        before,
        F.col("source").eqNullSafe(F.col("b_source")) & (F.col("size") == F.col("b_size")) & (F.col("bucket") == F.col("b_bucket")),
        "left",
    )
    copies = F.col("passes") + (F.col("place") + F.coalesce("before", F.lit(0)) <= F.col("more")).cast("long")
    return joined.withColumn("copies", copies).select(
        F.col("id").alias(id_column), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )
