from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import changes as c
from tallybrook.operators import quality as q
from tallybrook.operators.keys import assign_keys, sample_rows
from tallybrook.operators.reconcile import reconcile_counts, reconcile_diff
from tallybrook.plans import business as b
from tallybrook.schema import CUSTOMERS, ORDERS, PAYMENTS


def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def test_insert_if_absent_takes_the_first_of_equal_ones(spark):
    new = spark.createDataFrame(
        [("a", 2), ("a", 1), ("b", 1), (None, 1), (None, 2)], "email STRING, arrival INT"
    )
    existing = spark.createDataFrame([("b",), (None,)], "email STRING")
    new = new.withColumn("customer_id", F.col("arrival").cast("bigint"))
    rows = c.insert_if_absent(new, existing, CUSTOMERS, "email", ["arrival"], now(), 9).collect()
    assert sorted((r.email or "", r.customer_id) for r in rows) == [("", 1), ("", 2), ("a", 1)]
    assert rows[0].asDict().keys() == {*CUSTOMERS.column_names, "_version", "_seq", "_is_deleted"}
    assert {(r.country, r.phone, r._version, r._is_deleted) for r in rows} == {("Mexico", None, 9, 0)}


def test_deltas_of_one_product_add_up(spark):
    products = spark.createDataFrame([(1, Decimal("5.00"), 10)], "product_id BIGINT, price DECIMAL(10,2), stock INT").withColumn("updated_at", now())
    deltas = spark.createDataFrame([(1, -4, 6.0), (1, 1, 7.0)], "product_id BIGINT, delta INT, new_price DOUBLE")
    row = c.apply_stock_delta(products, deltas, now(), 9).collect()
    assert [(r.stock, r.price) for r in row] == [(7, Decimal("7.00"))]


def test_delete_orders_policies(spark):
    doomed = spark.createDataFrame([(1,), (2,)], "order_id BIGINT")
    items = spark.createDataFrame([(10, 1), (11, 1), (12, 2), (13, 3)], "item_id BIGINT, order_id BIGINT")
    payments = spark.createDataFrame([(20, 1)], "payment_id BIGINT, order_id BIGINT")
    kept = c.delete_orders(doomed, items, payments, 9)
    assert [r.order_id for r in kept.orders.collect()] == [2]
    assert [r.item_id for r in kept.items.collect()] == [12] and kept.payments.count() == 0
    gone = c.delete_orders(doomed, items, payments, 9, on_payment="cascade")
    assert sorted(r.item_id for r in gone.items.collect()) == [10, 11, 12]
    row = gone.payments.first()
    assert (row.payment_id, row._version, row._is_deleted) == (20, 9, 1)
    with pytest.raises(ValueError):
        c.delete_orders(doomed, items, payments, 9, on_payment="ignore")


def test_build_orders_takes_what_is_on_sale(spark):
    carts = spark.createDataFrame(
        [(1, 5, "León", "paypal", "pending", "a"), (2, 6, "León", "paypal", "pending", "b"),
         (3, 7, "León", "paypal", "failed", "c")],
        "cart_id BIGINT, customer_id BIGINT, city STRING, method STRING, payment_status STRING, transaction_ref STRING",
    )
    lines = spark.createDataFrame(
        [(1, 1, 2), (1, 2, 1), (2, 3, 1), (3, 1, 1), (3, 1, 1)], "cart_id BIGINT, product_id BIGINT, quantity INT"
    )
    products = spark.createDataFrame(
        [(1, Decimal("2.50"), 3, True), (2, Decimal("9.00"), 0, True), (3, Decimal("1.00"), 3, False)],
        "product_id BIGINT, price DECIMAL(10,2), stock INT, is_active BOOLEAN",
    )
    built = c.build_orders(carts, lines, products, now(), 9, last_order=100, last_item=50, last_payment=7)
    orders = {r.customer_id: (r.order_id, r.total_amount, r.status) for r in built.orders.collect()}
    assert orders == {5: (101, Decimal("5.00"), "pending"), 7: (102, Decimal("5.00"), "pending")}
    items = sorted((r.item_id, r.order_id, r.quantity) for r in built.items.collect())
    assert items == [(51, 101, 2), (52, 102, 2)]
    payments = sorted((r.payment_id, r.order_id, r.amount, r.status) for r in built.payments.collect())
    assert payments == [(8, 101, Decimal("5.00"), "pending"), (9, 102, Decimal("5.00"), "failed")]


def test_defaults(spark):
    rows = spark.createDataFrame([(1, None), (2, "Perú")], "customer_id BIGINT, country STRING")
    full = c.apply_defaults(rows, CUSTOMERS, now()).orderBy("customer_id")
    assert full.columns == CUSTOMERS.column_names
    assert [r.country for r in full.collect()] == ["Mexico", "Perú"]
    assert full.where("created_at IS NULL OR email IS NOT NULL").count() == 0


def test_keys_are_dense_and_ordered(spark):
    rows = spark.range(0, 20000, 1, 7).select((F.col("id") * 7919 % 20011).alias("value"), "id")
    numbered = assign_keys(rows, "key", ["value", "id"], start=500)
    ranked = numbered.orderBy("value", "id").select("key").collect()
    assert [r.key for r in ranked] == list(range(501, 20501))


def test_sample_is_exact_and_repeatable(spark):
    rows = spark.range(0, 1000, 1, 8)
    first = {r.id for r in sample_rows(rows, 20, seed=1, key="id").collect()}
    again = {r.id for r in sample_rows(rows.repartition(3), 20, seed=1, key="id").collect()}
    assert len(first) == 20 and first == again
    assert first != {r.id for r in sample_rows(rows, 20, seed=2, key="id").collect()}
    assert sample_rows(rows, 20).count() == 20


def test_domain_accepts_refunded_and_null(spark):
    payments = spark.createDataFrame(
        [(1, "paypal", "refunded"), (2, "cash", "pending"), (3, None, "open")],
        "payment_id BIGINT, method STRING, status STRING",
    )
    found = q.check_domain(payments, PAYMENTS).orderBy("payment_id").collect()
    assert [(r.payment_id, r.column_name, r.value) for r in found] == [(2, "method", "cash"), (3, "status", "open")]


def test_two_payments_for_one_order(spark):
    orders = spark.range(3).withColumnRenamed("id", "order_id")
    payments = spark.createDataFrame([(0,), (1,), (1,)], "order_id BIGINT")
    found = q.check_one_to_one(orders, payments, "order_id").collect()
    assert {r.order_id: r.children for r in found} == {1: 2, 2: 0}


def test_foreign_key_ignores_null(spark):
    children = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "item_id BIGINT, order_id BIGINT")
    parents = spark.createDataFrame([(1,)], "order_id BIGINT")
    found = q.check_foreign_key(children, parents, "order_id", "order_id").collect()
    assert [r.item_id for r in found] == [3]


def test_diff_sees_values_that_swap_with_null(spark):
    schema = "id BIGINT, a STRING, b STRING"
    source = spark.createDataFrame([(1, "x", None), (2, "x", "y"), (3, None, None)], schema)
    target = spark.createDataFrame([(1, None, "x"), (2, "x", "y"), (4, None, None)], schema)
    found = {r.id: r.state for r in reconcile_diff(source, target, "id", ["a", "b"]).collect()}
    assert found == {1: "different", 3: "missing", 4: "extra"}


def test_counts(spark):
    row = reconcile_counts({"orders": spark.range(5)}, {"orders": spark.range(3)}).first()
    assert (row.table_name, row.source_rows, row.target_rows, row.behind) == ("orders", 5, 3, 2)


def order_rows(spark, rows):
    return spark.createDataFrame(
        [(i, 1, s, None if t is None else Decimal(t), city) for i, (s, t, city) in enumerate(rows)],
        "order_id BIGINT, customer_id BIGINT, status STRING, total_amount DECIMAL(10,2), city STRING",
    )


def test_fulfillment_of_orders_without_total_or_city(spark):
    orders = order_rows(
        spark, [("delivered", "1.00", "León"), ("pending", None, "León"), ("cancelled", None, None)]
    )
    rows = {r.city: r for r in b.city_fulfillment({"orders": orders}).collect()}
    assert rows["León"].avg_ticket == Decimal("1.00") and rows["León"].fulfillment_pct == Decimal("50.00")
    assert rows[None].avg_ticket is None and rows[None].cancelled == 1


def test_average_is_rounded_once(spark):
    """9 999 999 payments averaging just under half a cent: six decimals would say 0.01."""
    payments = spark.createDataFrame([("a", "s", Decimal("49999.99"))], "method STRING, status STRING, amount DECIMAL(10,2)")
    rest = spark.range(9_999_999).select(F.lit("a").alias("method"), F.lit("s").alias("status"), F.lit(0).cast("decimal(10,2)").alias("amount"))
    assert b.payment_shares({"payments": payments.unionByName(rest)}).first().avg_amount == Decimal("0.00")


def test_top_k_keeps_the_smaller_key_on_ties(spark):
    tables = {
        "orders": spark.range(8).select(
            F.col("id").alias("order_id"), (F.col("id") % 4).alias("customer_id"), F.lit("shipped").alias("status"),
            now().alias("created_at"),
        ),
        "order_items": spark.range(8).select(
            F.col("id").alias("order_id"), F.lit(1).alias("quantity"), F.lit(3).cast("decimal(10,2)").alias("unit_price")
        ),
        "customers": spark.range(4).select(
            F.col("id").alias("customer_id"), F.lit("a").alias("first_name"), F.lit("b").alias("last_name"),
            F.lit("Cancún").alias("city"),
        ),
    }
    assert [r.customer_id for r in b.customer_ltv(tables, top=2).collect()] == [0, 1]
    assert {r.city for r in b.customer_ltv(tables).collect()} == {"Cancún"}


def test_settled_share_is_near_its_target(spark):
    fraction = spark.range(100_000).agg(F.avg((c.key_fraction("id") < c.FAILED_SHARE).cast("int"))).first()[0]
    assert abs(fraction - c.FAILED_SHARE) < 0.005


def test_advance_leaves_closed_orders(spark):
    orders = order_rows(spark, [(s, "1.00", "León") for s in ("pending", "confirmed", "shipped", "delivered", "cancelled")])
    moved = c.advance_status(orders, now(), 9).orderBy("order_id").collect()
    assert [r.status for r in moved] == ["confirmed", "shipped", "delivered"]


def test_advance_a_sample(spark):
    orders = order_rows(spark, [("pending", "1.00", "León")] * 100)
    moved = c.advance_status(sample_rows(orders, 15, seed=3, key="order_id"), now(), 9)
    assert moved.count() == 15 and {r.status for r in moved.collect()} == {"confirmed"}


def test_not_null_counts(spark):
    orders = order_rows(spark, [(None, None, None), ("pending", None, None)]).withColumns(
        {"created_at": now(), "updated_at": now()}
    )
    assert [(r.column_name, r.nulls) for r in q.check_not_null(orders, ORDERS).collect()] == [("status", 1)]


def test_references_between_tables(spark):
    tables = {
        "orders": spark.createDataFrame([(1, 1), (2, 9)], "order_id BIGINT, customer_id BIGINT"),
        "customers": spark.createDataFrame([(1,)], "customer_id BIGINT"),
        "payments": spark.createDataFrame([(5, 1), (6, 7)], "payment_id BIGINT, order_id BIGINT"),
    }
    found = {k: [tuple(r) for r in v.collect()] for k, v in q.check_references(tables).items()}
    assert found == {("orders", "customer_id"): [(2, 9)], ("payments", "order_id"): [(6, 7)]}
