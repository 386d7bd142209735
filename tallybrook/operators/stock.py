"""Stock changes applied one after another, none below zero.

One change turns a stock x into max(x + d, 0). A run of changes with sum S, whose least
running sum is P (at most 0, the sum of none), turns x into S + max(x, -P): what a run does
is two numbers, and two runs that follow each other make one run with the sums added and
the least of P1 and S1 + P2. So changes need not be walked through one by one: they are
dealt in ranges of product and order, every range is summed on its own, and the few ranges
of a product are put together. A product with very many changes spreads over many ranges.

Defined cases: changes that agree in product, order, amount and price are alike and may
stand in any order; others that tie in ``order`` go by amount, then by price, NULL first. A
NULL amount changes nothing, a NULL price leaves the price, a NULL place comes first.
Changes of no known product are left out; a product whose stock is NULL keeps it.
"""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.operators.changes import stamped
from tallybrook.operators.skew import join_many_to_one
from tallybrook.session import work_folder

KEY = "product_id"


def _summed_ranges(deltas: DataFrame, order: list[str]) -> DataFrame:
    """Like changes as one row with their number, dealt in ranges of product and order.

    They are written once: a range must not change when an executor is lost.
    """
    alike = [KEY, *order, "delta", "new_price"]
    rows = (
        deltas.where(F.col(KEY).isNotNull())
        .withColumn("delta", F.coalesce(F.col("delta").cast("bigint"), F.lit(0).cast("bigint")))
        .groupBy(*alike)
        .agg(F.count("*").alias("_times"))
    )
    path = work_folder(deltas.sparkSession, "stock")
    rows.repartitionByRange(*alike).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    written = deltas.sparkSession.read.parquet(path)
    return written.withColumn("_change", F.col("delta") * F.col("_times"))


def _running(rows: DataFrame, order: list[str]) -> DataFrame:
    """Within every range of a product: the sum up to each row, and the least one so far."""
    upto = Window.partitionBy(KEY, "_range").orderBy(*order, "delta", "new_price").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_sum", F.sum("_change").over(upto))
    return summed.withColumn("_least", F.least(F.min("_sum").over(upto), F.lit(0)))


def _ranges(running: DataFrame, order: list[str]) -> DataFrame:
    """One row per product and range: its sum, its least running sum, its last price."""
    place = F.struct(*order, "delta", "new_price")
    return running.groupBy(KEY, "_range").agg(
        F.sum("_change").alias("_sum"),
        F.min("_least").alias("_least"),
        F.max(F.when(F.col("new_price").isNotNull(), place)).alias("_last"),
    ).select(KEY, "_range", "_sum", "_least", F.col("_last.new_price").alias("_price"))


def _before(ranges: DataFrame) -> DataFrame:
    """Sum and least running sum of all of a product's ranges ahead of each."""
    ahead = Window.partitionBy(KEY).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    placed = ranges.withColumn("_sum_before", F.coalesce(F.sum("_sum").over(ahead), zero))
    reached = placed.withColumn("_reach", F.col("_sum_before") + F.col("_least"))
    return reached.withColumn("_least_before", F.least(F.coalesce(F.min("_reach").over(ahead), zero), zero))


def stock_steps(products: DataFrame, deltas: DataFrame, order: list[str]) -> DataFrame:
    """Every change of a known product with the ``stock`` it leaves; changes that are alike
    are one row, with their number in ``times`` and the stock after all of them.

    ``deltas`` holds (product_id, delta, new_price) and the columns of ``order``.
    """
    running = _running(_summed_ranges(deltas, order), order)
    before = _before(_ranges(running, order)).select(
        F.col(KEY).alias("_of"), F.col("_range").alias("_in"), "_sum_before", "_least_before"
    )
    # Ranges are few per product, so both sides are joined on product and range.
    placed = running.join(before, (F.col(KEY) == F.col("_of")) & (F.col("_range") == F.col("_in")))
    total = F.col("_sum_before") + F.col("_sum")
    least = F.least("_least_before", F.col("_sum_before") + F.col("_least"))
    stocks = products.select(KEY, F.col("stock").cast("bigint").alias("_stock"))
    known = join_many_to_one(placed.withColumns({"_total": total, "_lowest": least}), stocks, KEY)
    after = F.when(F.col("_stock").isNotNull(), F.col("_total") + F.greatest(F.col("_stock"), -F.col("_lowest")))
    return known.select(KEY, *order, "delta", "new_price", F.col("_times").alias("times"), after.cast("int").alias("stock"))


def apply_stock_delta_ordered(products: DataFrame, deltas: DataFrame, order: list[str], now: C, version: int) -> DataFrame:
    """Products that have changes, with the stock after all of them in ``order`` and the
    last price that was given.

    ``deltas`` holds (product_id, delta, new_price) and the columns of ``order``. Gives
    change rows, as all table changes do.
    """
    ranges = _ranges(_running(_summed_ranges(deltas, order), order), order)
    reached = _before(ranges).withColumn("_lowest", F.least("_least_before", F.col("_sum_before") + F.col("_least")))
    summed = reached.groupBy(KEY).agg(
        F.sum("_sum").alias("_total"),
        F.min("_lowest").alias("_lowest"),
        F.max(F.when(F.col("_price").isNotNull(), F.struct("_range", "_price"))).alias("_last"),
    )
    known = products.join(summed, KEY)
    stock = F.col("_total") + F.greatest(F.col("stock").cast("bigint"), -F.col("_lowest"))
    changed = known.withColumns(
        {
            "stock": F.when(F.col("stock").isNotNull(), stock).cast("int"),
            "price": F.coalesce(F.col("_last._price").cast("decimal(10,2)"), F.col("price")),
            "updated_at": now,
        }
    )
    return stamped(changed.select(*products.columns), version)
