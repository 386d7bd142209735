"""Answers kept by signed changes, against the questions over current rows."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybrook.operators.live import live
from tallybrook.plans import business as B
from tallybrook.plans.incremental import Answers
from tallybrook.schema import TABLES
from tallybrook.session import work_folder

META = "_version BIGINT, _seq INT, _is_deleted INT"
SCHEMAS = {
    "orders": f"order_id BIGINT, customer_id BIGINT, status STRING, total_amount DECIMAL(10,2), city STRING, created_at TIMESTAMP, {META}",
    "order_items": f"item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, unit_price DECIMAL(10,2), {META}",
    "payments": f"payment_id BIGINT, method STRING, status STRING, amount DECIMAL(10,2), {META}",
    "products": f"product_id BIGINT, category_id BIGINT, name STRING, price DECIMAL(10,2), stock INT, {META}",
}
AS_OF = datetime(2024, 3, 1, 6)
DAYS = [AS_OF - timedelta(days=d, hours=h) for d in (1, 1, 2, 29, 30, 31) for h in (0, 7)]


def row(table, key, draw):
    money = lambda: Decimal(draw.randrange(1, 9000)) / 100
    if table == "orders":
        status = draw.choice(["pending", "shipped", "delivered", "cancelled"])
        return key, draw.randrange(6), status, money() if draw.random() < 0.9 else None, draw.choice(["Rom", "Oslo", None]), draw.choice(DAYS)
    if table == "order_items":
        return key, draw.randrange(14), draw.randrange(7), draw.randrange(1, 9), money()
    if table == "payments":
        return key, draw.choice(["card", "cash"]), draw.choice(["open", "done"]), money()
    return key, draw.randrange(3), f"p{key}", money(), draw.randrange(50)


KEYS = {"orders": 14, "order_items": 40, "payments": 12, "products": 7}


@pytest.fixture(scope="module")
def dimensions(spark):
    categories = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "category_id BIGINT, name STRING")
    customers = spark.createDataFrame([(i, f"n{i}", "x", "Rom") for i in range(6)], "customer_id BIGINT, first_name STRING, last_name STRING, city STRING")
    return categories, customers


def as_of():
    return F.lit(str(AS_OF)).cast("timestamp")


def compared(spark, state, log, dimensions):
    """All five answers of the state against those over the newest rows of the log."""
    categories, customers = dimensions
    tables = {t: live(spark.createDataFrame(rows, SCHEMAS[t]), TABLES[t].key) for t, rows in log.items()}
    tables |= {"categories": categories, "customers": customers}
    pairs = [
        (state.daily_category_revenue(categories, as_of()), B.daily_category_revenue(tables, as_of())),
        (state.customer_ltv(customers), B.customer_ltv(tables)),
        (state.city_fulfillment(), B.city_fulfillment(tables)),
        (state.product_performance(tables["products"], categories), B.product_performance(tables)),
        (state.payment_shares(), B.payment_shares(tables)),
    ]
    for ours, full in pairs:
        assert [tuple(r) for r in ours.collect()] == [tuple(r) for r in full.select(*ours.columns).collect()]


def changes_of(draw, version, tables):
    """Upserts and deletions, some of them older than what has been applied."""
    out = {}
    for t in tables:
        out[t] = []
        for n in range(draw.randrange(1, 9)):
            key, late = draw.randrange(KEYS[t]), draw.random() < 0.2
            out[t].append((*row(t, key, draw), max(0, version - 25) if late else version, n, int(draw.random() < 0.3)))
    return out


def test_batches_follow_the_full_answers(spark, dimensions):
    draw = random.Random(8)
    first = {t: [(*row(t, k, draw), 0, 0, 0) for k in range(n)] for t, n in KEYS.items()}
    state = Answers(spark, work_folder(spark, "answers"), buckets=4)
    state.start({t: spark.createDataFrame(rows, SCHEMAS[t]).drop("_version", "_seq", "_is_deleted") for t, rows in first.items()})
    compared(spark, state, first, dimensions)
    log = {t: list(rows) for t, rows in first.items()}
    for number, tables in enumerate([list(KEYS), ["orders"], ["order_items", "payments"], ["products"]], 1):
        changes = changes_of(draw, 10 * number, tables)
        frames = {t: spark.createDataFrame(rows, SCHEMAS[t]) for t, rows in changes.items()}
        state.apply(frames, number)
        if number == 2:
            # A batch that is applied again changes nothing.
            state.apply(frames, number)
        for t, rows in changes.items():
            log[t] += rows
        if number in (1, 2, 4):
            compared(spark, state, log, dimensions)
    compared(spark, state.folded(work_folder(spark, "answers")), log, dimensions)


def test_a_small_batch_reads_the_buckets_it_touches(spark, capsys):
    draw = random.Random(9)
    state = Answers(spark, work_folder(spark, "answers"), buckets=16)
    first = {t: [row(t, k, draw) for k in range(n)] for t, n in KEYS.items()}
    state.start({t: spark.createDataFrame([(*r, 0, 0, 0) for r in rows], SCHEMAS[t]) for t, rows in first.items()})
    change = spark.createDataFrame([(*row("orders", 3, draw), 7, 0, 0)], SCHEMAS["orders"])
    state.apply({"orders": change}, 1)
    bucket = state._touched(change, "order_id")
    assert len(bucket) == 1
    for name in ("orders", "lines"):
        read = state._read(name, 2, bucket)
        read.explain()
        plan = capsys.readouterr().out
        assert "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # Items are not read at all: no item is in the batch, and sums stand for them.
    orders, sums, _ = state._state_of(change.select("order_id"), bucket, 1)
    assert not any("/order_items/" in f for f in orders.inputFiles() + sums.inputFiles())


def test_batches_are_numbered_from_one(spark):
    with pytest.raises(ValueError):
        Answers(spark, "/nowhere").apply({}, 0)


def test_an_empty_start(spark, dimensions):
    state = Answers(spark, work_folder(spark, "answers"), buckets=2)
    log = {t: [] for t in KEYS}
    state.start({t: spark.createDataFrame([], SCHEMAS[t]) for t in KEYS})
    compared(spark, state, log, dimensions)
    draw = random.Random(4)
    log = {t: [(*row(t, k, draw), 1, k, 0) for k in range(n)] for t, n in KEYS.items()}
    state.apply({t: spark.createDataFrame(rows, SCHEMAS[t]) for t, rows in log.items()}, 1)
    compared(spark, state, log, dimensions)


def test_lines_are_read_for_orders_whose_part_in_an_answer_changes(spark, dimensions):
    draw = random.Random(5)
    state = Answers(spark, work_folder(spark, "answers"), buckets=2)
    log = {t: [(*row(t, k, draw), 0, 0, 0) for k in range(n)] for t, n in KEYS.items()}
    day, money = DAYS[0], Decimal("1.00")
    log["orders"] = [(k, 1, "shipped", money, "Rom", day, 0, 0, 0) for k in range(3)] + [(3, 1, "cancelled", money, "Rom", day, 0, 0, 0)]
    state.start({t: spark.createDataFrame(rows, SCHEMAS[t]).drop("_version", "_seq", "_is_deleted") for t, rows in log.items()})
    # Shipped and delivered count alike, and a cancelled order that goes counts nowhere.
    changed = [(0, 1, "delivered", money, "Rom", day, 5, 0, 0), (3, 1, "cancelled", money, "Rom", day, 5, 1, 1), (2, 1, "pending", money, "Rom", day, 5, 2, 0)]
    state.apply({"orders": spark.createDataFrame(changed, SCHEMAS["orders"])}, 1)
    assert [r.order_id for r in spark.read.parquet(f"{state.root}/touched/batch=1").collect()] == [2]
    log["orders"] += changed
    compared(spark, state, log, dimensions)
    # Both sides of the batch come from one reading of the lines' sums.
    orders, lines, _ = state._state_of(spark.createDataFrame([(2,)], "order_id BIGINT"), [0, 1], 1)
    signs = {r["_sign"] for r in state._sold_before_and_after(orders, lines, 1).select("_sign").collect()}
    assert signs <= {-1, 1} and len(signs) == 2
