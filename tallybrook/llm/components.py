"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 60


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``node`` and ``component`` (the least node it can reach) for every node of an edge.

    Alternating star rounds: every node tells its larger neighbours, then its smaller
    ones, of the least node it knows. Only sums and minima per node are shuffled, so a
    node with very many edges is no burden. Every round is written to ``folder``.
    """
    spark = edges.sparkSession
    edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().write.parquet(
        f"{folder}/0"
    )
    found = spark.read.parquet(f"{folder}/0")
    before = None
    for number in range(1, MAX_ROUNDS + 1):
        both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, both.a == least.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = (
            large.join(low, large.a == low.n)
            .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        small.write.parquet(f"{folder}/{number}")
        found = spark.read.parquet(f"{folder}/{number}")
        now = found.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")
    heads = found.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return found.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(heads)
