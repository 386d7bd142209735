"""The shop tables and their change histories, derived from the test tables.

Every row of a test table becomes a first version; which rows change later follows from
their key, so that the same histories can be stated in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators.keys import assign_keys
from tallybrook.operators.live import live
from tallybrook.sources.changelog import ChangelogStore

# Columns of the test tables. Times are declared as TIMESTAMP, so that time
# filters reach the scan.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}
AS_OF = "2001-08-01 00:00:00"
OPENED = "1995-01-01 00:00:00"
MONEY = "decimal(10,2)"
# Added to a key when a message moves a row to another key.
MOVE = 1_000_000
# Position of the first message: snapshot rows have version 1.
FIRST_LSN = 2


def as_of() -> C:
    return F.lit(AS_OF).cast("timestamp")


def opened() -> C:
    return F.lit(OPENED).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(value: C, mapping: dict) -> C:
    """CASE over fixed values."""
    chosen = None
    for given, result in mapping.items():
        chosen = F.when(value == given, result) if chosen is None else chosen.when(value == given, result)
    return chosen


# How test columns stand in for shop columns.
STATUS_OF_PRIORITY = {
    "1-URGENT": "pending",
    "2-HIGH": "confirmed",
    "3-MEDIUM": "shipped",
    "4-NOT SPECIFIED": "delivered",
    "5-LOW": "cancelled",
}
METHODS = {0: "credit_card", 1: "debit_card", 2: "paypal", 3: "transfer"}
PAYMENT_OF_STATUS = {"F": "completed", "O": "pending", "P": "failed"}


def category_id() -> C:
    return F.substring("p_brand", 7, 10).cast("bigint")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_brand").distinct().select(
        category_id().alias("category_id"),
        F.col("p_brand").alias("name"),
        F.lit(None).cast("string").alias("description"),
        opened().alias("created_at"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        category_id().alias("category_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
        F.col("p_size").alias("stock"),
        (F.col("p_partkey") % 10 != 0).alias("is_active"),
        opened().alias("created_at"),
        opened().alias("updated_at"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, sf_dir, "customer").join(nation, "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.lit(None).cast("string").alias("phone"),
        F.col("n_name").alias("city"),
        F.lit(None).cast("string").alias("country"),
        opened().alias("created_at"),
        opened().alias("updated_at"),
    )


def orders(spark: SparkSession, sf_dir: str, with_city: bool = False) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        pick(F.col("o_orderpriority"), STATUS_OF_PRIORITY).alias("status"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )
    if not with_city:
        return rows
    return rows.join(customers(spark, sf_dir).select("customer_id", "city"), "customer_id")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("unit_price"),
    )


def keyed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a key of their own; the test tables have none."""
    return assign_keys(order_items(spark, sf_dir), "item_id", ["order_id", "product_id", "quantity", "unit_price"])


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        pick(F.col("o_custkey") % 4, METHODS).alias("method"),
        pick(F.col("o_orderstatus"), PAYMENT_OF_STATUS).alias("status"),
        F.concat(F.lit("TX-"), F.col("o_orderkey").cast("string")).alias("transaction_ref"),
        F.col("o_orderdate").alias("processed_at"),
    )


def _versions(rows: DataFrame, later: dict[int, C]) -> DataFrame:
    """Each row as version 1, and once more for every later version that applies."""
    numbers = F.array(*[F.when(applies, F.lit(v).cast("bigint")) for v, applies in ({1: F.lit(True)} | later).items()])
    return rows.withColumn("_version", F.explode(F.array_compact(numbers))).withColumn("_seq", F.lit(0))


def orders_log(spark: SparkSession, sf_dir: str, with_city: bool = False) -> DataFrame:
    """Version 2 delivers every third order, version 3 deletes every seventh."""
    key = F.col("order_id")
    log = _versions(orders(spark, sf_dir, with_city), {2: key % 3 == 0, 3: key % 7 == 0})
    return log.withColumns(
        {
            "status": F.when(F.col("_version") == 2, "delivered").otherwise(F.col("status")),
            "_is_deleted": (F.col("_version") == 3).cast("int"),
            "_batch_id": F.col("_version") - 1,
        }
    )


def products_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 2 raises the price of every fifth product."""
    log = _versions(products(spark, sf_dir), {2: F.col("product_id") % 5 == 0})
    raised = (F.col("price") + F.lit(1)).cast(MONEY)
    return log.withColumns(
        {
            "price": F.when(F.col("_version") == 2, raised).otherwise(F.col("price")),
            "_is_deleted": F.lit(0),
            "_batch_id": F.col("_version") - 1,
        }
    )


def live_orders(spark: SparkSession, sf_dir: str, with_city: bool = False) -> DataFrame:
    return live(orders_log(spark, sf_dir, with_city), "order_id").drop("_batch_id")


def live_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live(products_log(spark, sf_dir), "product_id").drop("_batch_id")


class Tables(Mapping):
    """Tables by name, each defined when it is asked for."""

    def __init__(self, **makers: Callable[[], DataFrame]):
        self._makers = makers

    def __getitem__(self, name: str) -> DataFrame:
        return self._makers[name]()

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def shop(spark: SparkSession, sf_dir: str, orders: Callable[[], DataFrame] | None = None) -> Tables:
    """Current state of the six tables."""
    return Tables(
        categories=lambda: categories(spark, sf_dir),
        customers=lambda: customers(spark, sf_dir),
        products=lambda: live_products(spark, sf_dir),
        orders=orders or (lambda: live_orders(spark, sf_dir)),
        order_items=lambda: order_items(spark, sf_dir),
        payments=lambda: payments(spark, sf_dir),
    )


def shop_sources(spark: SparkSession, sf_dir: str) -> Tables:
    """The six tables as the source has them."""
    return Tables(
        categories=lambda: categories(spark, sf_dir),
        customers=lambda: customers(spark, sf_dir),
        products=lambda: products(spark, sf_dir),
        orders=lambda: orders(spark, sf_dir, with_city=True),
        order_items=lambda: keyed_items(spark, sf_dir),
        payments=lambda: payments(spark, sf_dir),
    )


def stored_shop(spark: SparkSession, sf_dir: str, folder: str, compact_after: int | None = None) -> ChangelogStore:
    """The same tables in a changelog store: a snapshot and two batches of changes, and
    the store compacted after the snapshot (0) or one of the batches (1, 2), if asked for."""
    store = ChangelogStore(spark, folder)
    store.load_snapshot(shop_sources(spark, sf_dir))
    if compact_after == 0:
        store.compact()
    changed_orders = orders_log(spark, sf_dir, with_city=True)
    changed_products = products_log(spark, sf_dir)
    store.append_rows(
        {
            "orders": changed_orders.where("_batch_id = 1").drop("_batch_id"),
            "products": changed_products.where("_batch_id = 1").drop("_batch_id"),
        },
        "changes",
        0,
    )
    if compact_after == 1:
        store.compact()
    store.append_rows({"orders": changed_orders.where("_batch_id = 2").drop("_batch_id")}, "changes", 1)
    if compact_after == 2:
        store.compact()
    return store


def event_kind() -> C:
    return (
        F.when(F.col("event_type") == "error", "delete")
        .when(F.col("event_type") == "signup", "insert")
        .otherwise("update")
    )


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a version of its user's row; errors delete it."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        "event_type",
        F.col("value").cast(MONEY).alias("amount"),
        "ts",
        F.col("event_id").alias("_version"),
        F.lit(0).alias("_seq"),
        (F.col("event_type") == "error").cast("int").alias("_is_deleted"),
    )


def _names(*names: str) -> C:
    return F.array(*[F.lit(n) for n in names])


def _values(*values: C) -> C:
    return F.array(*[v.cast("variant") for v in values])


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change message per event, ``(lsn, payload)``.

    The event's user is an order that is inserted (signup), updated or deleted (error);
    a purchase also pays, in the same message. Clicks leave out the city, which is then
    in the old image. Planted among them: payloads that are not JSON, an unknown table,
    an unknown kind, unreadable amounts, and updates that change the key.
    """
    events = table(spark, sf_dir, "events")
    number = F.col("event_id")
    kind = event_kind()
    amount = F.col("value").cast(MONEY)
    time = F.concat(F.col("ts").cast("string"), F.lit("+00"))
    moved = (kind == "update") & (number % 50 == 0)
    order_id = F.when(moved, F.col("user_id") + MOVE).otherwise(F.col("user_id"))
    new_amount = F.when(number % 83 == 0, F.lit("n/a").cast("variant")).otherwise(amount.cast("variant"))

    # The column names of the message.
    whole = ("order_id", "customer_id", "status", "total_amount", "city", "created_at", "updated_at")
    in_click = tuple(n for n in whole if n != "city")
    city = F.col("props")
    values = (order_id, number, F.col("event_type"), new_amount, city, time, time)
    click_values = (order_id, number, F.col("event_type"), new_amount, time, time)
    old_values = (F.col("user_id"), number, F.col("event_type"), amount, city, time, time)
    click = F.col("event_type") == "click"
    order_change = F.struct(
        F.when(number % 79 == 0, "truncate").otherwise(kind).alias("kind"),
        F.when(number % 89 == 0, "audit_log").otherwise("orders").alias("table"),
        F.when(kind == "delete", None)
        .when(click, _names(*in_click))
        .otherwise(_names(*whole))
        .alias("columnnames"),
        F.when(kind == "delete", None)
        .when(click, _values(*click_values))
        .otherwise(_values(*values))
        .alias("columnvalues"),
        F.when(
            kind == "delete",
            F.struct(
                _names(*whole).alias("keynames"),
                _values(*old_values).alias("keyvalues"),
            ),
        )
        .when(
            click,
            F.struct(
                _names("order_id", "city").alias("keynames"),
                _values(F.col("user_id"), city).alias("keyvalues"),
            ),
        )
        .when(
            kind == "update",
            F.struct(_names("order_id").alias("keynames"), _values(F.col("user_id")).alias("keyvalues")),
        )
        .alias("oldkeys"),
    )
    payment_change = F.struct(
        F.lit("insert").alias("kind"),
        F.lit("payments").alias("table"),
        _names("payment_id", "order_id", "amount", "method", "status", "transaction_ref", "processed_at").alias(
            "columnnames"
        ),
        _values(
            number, F.col("user_id"), amount, pick(number % 4, METHODS), F.lit("completed"), F.lit(None), time
        ).alias("columnvalues"),
        F.lit(None).cast("struct<keynames: array<string>, keyvalues: array<variant>>").alias("oldkeys"),
    )
    changes = F.when(F.col("event_type") == "purchase", F.array(order_change, payment_change)).otherwise(
        F.array(order_change)
    )
    payload = F.when(number % 97 == 0, F.concat(F.lit("not json "), number.cast("string"))).otherwise(
        F.to_json(F.struct(changes.alias("change")))
    )
    return events.select((number + FIRST_LSN).alias("lsn"), payload.alias("payload"))
