"""Surrogate keys and row samples."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.session import work_folder

# monotonically_increasing_id keeps the partition above this bit, the row below it.
ROW_BITS = 33


def assign_keys(rows: DataFrame, key: str, order: list[str], start: int | C = 0) -> DataFrame:
    """Number rows ``start + 1, start + 2, …`` in the given order, without gaps.

    Rows are sorted in ranges by many tasks, each range numbering its own rows; the
    number of rows in the ranges before is added afterwards. The numbered rows are
    written out once, so that lost executors cannot change a number already given.
    ``order`` should be unique: rows that tie stay in one range and are numbered anyhow.
    """
    spark = rows.sparkSession
    path = work_folder(spark, "keys")
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    written = spark.read.parquet(path)
    part = F.shiftright("_place", ROW_BITS)
    within = F.col("_place").bitwiseAND((1 << ROW_BITS) - 1)
    # One row per range: no more than the shuffle has partitions.
    sizes = written.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    first = start if isinstance(start, C) else F.lit(start).cast("bigint")
    return (
        written.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(key, first + F.col("_before") + within + 1)
        .drop("_part", "_before", "_place")
    )


def sample_rows(rows: DataFrame, n: int, seed: int | None = None, key: str | None = None) -> DataFrame:
    """Exactly ``n`` random rows; each task sends at most ``n`` of its own.

    With ``key`` the choice depends on key and seed alone, not on file layout.
    """
    order = F.rand(seed) if key is None else F.xxhash64(F.col(key), F.lit(seed or 0))
    return rows.orderBy(order).limit(n)
