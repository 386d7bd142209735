"""Source against target."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile_counts(sources: Mapping[str, DataFrame], targets: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of both sides per table, and how far the target is behind."""

    def counted(name: str, side: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n"
        )

    parts = [counted(n, "source", d) for n, d in sources.items()]
    parts += [counted(n, "target", d) for n, d in targets.items()]
    sides = reduce(DataFrame.unionByName, parts).groupBy("table_name")
    counts = sides.agg(
        F.sum(F.when(F.col("side") == "source", F.col("n"))).alias("source_rows"),
        F.sum(F.when(F.col("side") == "target", F.col("n"))).alias("target_rows"),
    )
    return counts.withColumn("behind", F.col("source_rows") - F.col("target_rows"))


def reconcile_diff(source: DataFrame, target: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys missing from the target, extra in it, or with other values.

    Only the key and two 64-bit hashes per row are shuffled. The hash passes over NULLs,
    so each column goes in together with whether it is NULL.
    """
    parts = [c for name in columns for c in (F.col(name), F.col(name).isNull())]

    def hashed(rows: DataFrame, suffix: str) -> DataFrame:
        return rows.select(
            key,
            F.struct(F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)).alias(suffix),
        )

    both = hashed(source, "source").join(hashed(target, "target"), key, "full_outer")
    state = (
        F.when(F.col("target").isNull(), "missing")
        .when(F.col("source").isNull(), "extra")
        .when(F.col("source") != F.col("target"), "different")
    )
    return both.select(key, state.alias("state")).where(F.col("state").isNotNull())
