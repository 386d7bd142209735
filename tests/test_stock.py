"""Stock changes in their order, against a walk through them."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybrook.operators.stock import apply_stock_delta_ordered, stock_steps

PRODUCTS = "product_id BIGINT, price DECIMAL(10,2), stock INT"
DELTAS = "product_id BIGINT, at INT, delta INT, new_price DECIMAL(10,2)"


def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def walked(products, deltas):
    """Final stock and price of changed products, and the stock after every change."""
    state = {p: [stock, price] for p, price, stock in products}
    none = (False, 0)
    steps, changed = [], set()
    low = lambda x: none if x is None else (True, x)
    for p, at, delta, price in sorted(deltas, key=lambda d: (low(d[1]), d[2] or 0, low(d[3]))):
        if p not in state:
            continue
        changed.add(p)
        if state[p][0] is not None:
            state[p][0] = max(state[p][0] + (delta or 0), 0)
        state[p][1] = state[p][1] if price is None else price
        steps.append((p, at, delta or 0, price, state[p][0]))
    return {p: tuple(state[p]) for p in changed}, steps


def checked(spark, products, deltas, partitions=7):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        stock = spark.createDataFrame(products, PRODUCTS).withColumn("updated_at", now())
        changes = spark.createDataFrame(deltas, DELTAS).repartition(3)
        rows = apply_stock_delta_ordered(stock, changes, ["at"], now(), 9).collect()
        final, steps = walked(products, deltas)
        assert {r.product_id: (r.stock, r.price) for r in rows} == final
        assert len(rows) == len(final) and {r._version for r in rows} <= {9}
        return stock_steps(stock, changes, ["at"]).collect(), steps
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_each_change_is_held_at_zero_by_itself(spark):
    products = [(1, Decimal("5.00"), 5), (2, Decimal("6.00"), 5), (3, Decimal("1.00"), None), (4, Decimal("1.00"), 9)]
    deltas = [(1, 1, -10, None), (1, 2, 3, Decimal("7.00")), (2, 2, -10, Decimal("8.00")), (2, 1, 3, Decimal("9.00"))]
    deltas += [(3, 1, -4, Decimal("2.00")), (99, 1, 5, None), (4, None, -20, Decimal("3.00")), (4, 5, None, None), (None, 1, 1, None)]
    found, steps = checked(spark, products, deltas)
    assert sorted((r.product_id, r.stock) for r in found if r.product_id < 3) == [(1, 0), (1, 3), (2, 0), (2, 8)]
    assert len(found) == len(steps)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_runs(spark, seed):
    chance = random.Random(seed)
    products = [(p, Decimal("1.00"), chance.randrange(30)) for p in range(12)]
    # A third of all changes are of one product.
    pick = lambda: 0 if chance.random() < 0.34 else chance.randrange(14)
    price = lambda: Decimal(chance.randrange(1, 900)) / 100 if chance.random() < 0.5 else None
    deltas = [(pick(), at, chance.randrange(-12, 12), price()) for at in range(1500)]
    found, steps = checked(spark, products, deltas)
    assert sorted((r.product_id, r.at, r.stock) for r in found) == sorted((p, at, stock) for p, at, _, _, stock in steps)


def test_repeated_rows_are_one_step(spark):
    products = [(1, Decimal("1.00"), 7)]
    deltas = [(1, 1, -3, None)] * 4 + [(1, 2, 2, None)] * 5 + [(1, 2, -2, None)] * 2
    found, _ = checked(spark, products, deltas)
    assert sorted((r.at, r.delta, r.times, r.stock) for r in found) == [(1, -3, 4, 0), (2, -2, 2, 0), (2, 2, 5, 10)]


def test_a_hot_product_is_dealt_over_ranges(spark):
    """No range holds more than a small part of the product's changes."""
    from tallybrook.operators import stock as s

    deltas = spark.range(40_000).selectExpr("IF(id % 3 = 0, id % 97, 1) AS product_id", "id AS at", "CAST(id % 5 - 2 AS INT) AS delta", "CAST(NULL AS DECIMAL(10,2)) AS new_price")
    spark.conf.set("spark.sql.shuffle.partitions", 32)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = s._summed_ranges(deltas, ["at"]).where("product_id = 1").groupBy("_range").count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(ranges) >= 16 and max(r["count"] for r in ranges) < 4_000


def test_nothing_to_change(spark):
    found, steps = checked(spark, [(1, Decimal("1.00"), 7)], [])
    assert found == steps == []
    found, _ = checked(spark, [], [(1, 1, 1, None)])
    assert found == []
