"""Table changes as set operations.

Each function takes current rows and returns change rows in changelog shape: the full
row plus ``_version``, ``_seq`` and ``_is_deleted``, to be appended to the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions.measures import line_value
from tallybrook.operators.keys import assign_keys
from tallybrook.operators.skew import join_many_to_one
from tallybrook.schema import TableSpec

# The way of an order, and the timing and share of payment settlement.
NEXT_STATUS = {"pending": "confirmed", "confirmed": "shipped", "shipped": "delivered"}
CLOSED_STATUSES = ("delivered", "cancelled")
SETTLE_AFTER = "INTERVAL 45 SECONDS"
FAILED_SHARE = 0.12
EXPIRE_AFTER = "INTERVAL 3 MINUTES"

HASH_RANGE = 1 << 32


def stamped(rows: DataFrame, version: int, deleted: bool = False) -> DataFrame:
    return rows.withColumns(
        {
            "_version": F.lit(version).cast("bigint"),
            "_seq": F.lit(0),
            "_is_deleted": F.lit(int(deleted)),
        }
    )


def apply_defaults(rows: DataFrame, spec: TableSpec, now: C) -> DataFrame:
    """Full rows of a table: a column that an insert leaves out has its default, or NULL if
    it has none. A NULL in a column that is given counts as left out. Columns that are not
    the table's are kept behind its own."""
    done = []
    for column in spec.columns:
        given = F.col(column.name) if column.name in rows.columns else F.lit(None)
        default = now if column.default == "now" else F.lit(column.default)
        done.append(F.coalesce(given.cast(column.type), default.cast(column.type)).alias(column.name))
    return rows.select(*done, *[c for c in rows.columns if c not in spec.column_names])


def insert_if_absent(
    new: DataFrame, existing: DataFrame, spec: TableSpec, unique: str, arrival: list[str], now: C, version: int
) -> DataFrame:
    """New rows whose unique value is not taken; of equal new ones the first to arrive.
    NULL never conflicts. Columns left out have their defaults."""
    return stamped(_absent(new, existing, unique, arrival).transform(apply_defaults, spec, now).select(*spec.column_names), version)


def _absent(new: DataFrame, existing: DataFrame, unique: str, arrival: list[str]) -> DataFrame:
    first = Window.partitionBy(unique).orderBy(*arrival)
    fresh = (
        new.where(F.col(unique).isNotNull())
        .withColumn("_first", F.row_number().over(first))
        .where(F.col("_first") == 1)
        .drop("_first")
        .join(existing.select(unique), unique, "left_anti")
    )
    return fresh.select(*new.columns).union(new.where(F.col(unique).isNull()))


def advance_status(orders: DataFrame, now: C, version: int) -> DataFrame:
    """Every open order goes one step on; pass a sample of orders to move only some."""
    steps = F.create_map(*[F.lit(s) for pair in NEXT_STATUS.items() for s in pair])
    moved = orders.where(~F.col("status").isin(*CLOSED_STATUSES)).withColumns(
        {"status": steps[F.col("status")], "updated_at": now}
    )
    return stamped(moved, version)


def apply_stock_delta(products: DataFrame, deltas: DataFrame, now: C, version: int) -> DataFrame:
    """New price and changed stock; ``deltas`` holds (product_id, delta, new_price). Several
    deltas of one product add up, and the highest of their prices counts. Stock never falls
    below zero."""
    summed = deltas.groupBy("product_id").agg(F.sum("delta").cast("int").alias("delta"), F.max("new_price").alias("new_price"))
    changed = products.join(summed, "product_id").withColumns(
        {
            "stock": F.greatest(F.col("stock") + F.col("delta"), F.lit(0)),
            "price": F.col("new_price").cast("decimal(10,2)"),
            "updated_at": now,
        }
    )
    return stamped(changed.select(*products.columns), version)


def key_fraction(key: str) -> C:
    """A number in [0, 1) that depends on the key alone."""
    # A prime that keeps the product small, Knuth's multiplier.
    return F.pmod(F.pmod(F.col(key), F.lit(1_000_003)) * F.lit(2_654_435_761), F.lit(HASH_RANGE)) / F.lit(
        float(HASH_RANGE)
    )


def settle_old_payments(payments: DataFrame, now: C, version: int) -> DataFrame:
    """Payments that have been pending for long are completed, a share of them fails."""
    old = (F.col("status") == "pending") & (F.col("processed_at") < now - F.expr(SETTLE_AFTER))
    outcome = F.when(key_fraction("payment_id") < FAILED_SHARE, "failed").otherwise("completed")
    settled = payments.where(old).withColumns({"status": outcome, "processed_at": now})
    return stamped(settled, version)


def expired_orders(orders: DataFrame, now: C) -> DataFrame:
    return orders.where(
        (F.col("status") == "cancelled") & (F.col("updated_at") < now - F.expr(EXPIRE_AFTER))
    )


def expire_cancelled(orders: DataFrame, now: C, version: int) -> DataFrame:
    """Tombstones of orders cancelled some time ago."""
    return stamped(expired_orders(orders, now), version, deleted=True)


def cascade_delete(children: DataFrame, deleted: DataFrame, column: str, version: int) -> DataFrame:
    """Tombstones of the rows that refer to a deleted parent."""
    gone = join_many_to_one(children, deleted.select(column), column, "left_semi")
    return stamped(gone.select(*children.columns), version, deleted=True)


@dataclass(frozen=True)
class OrderDeletion:
    orders: DataFrame
    items: DataFrame
    payments: DataFrame


def delete_orders(
    doomed: DataFrame, items: DataFrame, payments: DataFrame, version: int, on_payment: str = "restrict"
) -> OrderDeletion:
    """Tombstones for orders, their items and, as told, their payments.

    ``restrict`` spares orders that have a payment, ``cascade`` deletes the payments too.
    """
    if on_payment == "restrict":
        # Distinct first: an order may have very many payments.
        paid = payments.select("order_id").distinct()
        doomed = doomed.join(paid, "order_id", "left_anti").select(*doomed.columns)
    elif on_payment != "cascade":
        raise ValueError(f"on_payment must be restrict or cascade, not {on_payment!r}")
    return OrderDeletion(
        orders=stamped(doomed, version, deleted=True),
        items=cascade_delete(items, doomed, "order_id", version),
        payments=cascade_delete(payments, doomed, "order_id", version),
    )


@dataclass(frozen=True)
class NewOrders:
    orders: DataFrame
    items: DataFrame
    payments: DataFrame


def build_orders(
    carts: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    now: C,
    version: int,
    last_order: int | C = 0,
    last_item: int | C = 0,
    last_payment: int | C = 0,
) -> NewOrders:
    """Orders, their items and one payment each, out of filled carts.

    ``carts`` is (cart_id, customer_id, city, method, payment_status, transaction_ref),
    ``lines`` is (cart_id, product_id, quantity); an order lists a product once, with the
    quantities of its lines added up. Only products on sale and in stock are taken, at
    their price of the moment; the total is the sum over the taken lines, and a cart
    without any gives no order.
    """
    on_sale = products.where(F.col("is_active") & (F.col("stock") > 0)).select(
        "product_id", F.col("price").alias("unit_price")
    )
    wanted = lines.groupBy("cart_id", "product_id").agg(F.sum("quantity").cast("int").alias("quantity"))
    priced = join_many_to_one(wanted, on_sale, "product_id").select("cart_id", "product_id", "quantity", "unit_price")
    totals = priced.groupBy("cart_id").agg(F.sum(line_value()).cast("decimal(10,2)").alias("total_amount"))
    headers = assign_keys(carts.join(totals, "cart_id"), "order_id", ["cart_id"], last_order)
    orders = headers.select(
        "order_id",
        "customer_id",
        F.lit("pending").alias("status"),
        "total_amount",
        "city",
        now.alias("created_at"),
        now.alias("updated_at"),
    )
    taken = join_many_to_one(priced, headers.select("cart_id", "order_id"), "cart_id")
    items = assign_keys(
        taken.select("order_id", "product_id", "quantity", "unit_price"),
        "item_id",
        ["order_id", "product_id"],
        last_item,
    ).select("item_id", "order_id", "product_id", "quantity", "unit_price")
    # Orders are numbered without gaps, and so are their payments.
    first_order = last_order if isinstance(last_order, C) else F.lit(last_order)
    first_payment = last_payment if isinstance(last_payment, C) else F.lit(last_payment)
    payments = headers.select(
        (F.col("order_id") - first_order + first_payment).cast("bigint").alias("payment_id"),
        "order_id",
        F.col("total_amount").alias("amount"),
        "method",
        F.col("payment_status").alias("status"),
        "transaction_ref",
        now.alias("processed_at"),
    )
    return NewOrders(stamped(orders, version), stamped(items, version), stamped(payments, version))
