"""The five business queries over current state.

``tables`` maps table names to current rows, from a changelog or from anywhere else.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions.measures import line_value, money_average, percentage
from tallybrook.operators.skew import SPREAD, join_many_to_one

Tables = Mapping[str, DataFrame]

# Fixed values of the queries.
REVENUE_STATUSES = ("shipped", "delivered")
RECENT = "INTERVAL 30 DAYS"
MIN_ORDERS = 2
TOP_CUSTOMERS = 50
TOP_PRODUCTS = 25

ORDER_SPREAD = "_order_spread"


def daily_category_revenue(tables: Tables, as_of: C | None = None, approximate: bool = False) -> DataFrame:
    """Revenue per category and UTC day over the last 30 days.

    Lines are first summed per order, category and day, which is where the join on orders
    has put them; each order is then one row of its category and day, and counting rows
    counts orders.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    recent = (
        tables["orders"]
        .where(F.col("status").isin(*REVENUE_STATUSES) & (F.col("created_at") >= as_of - F.expr(RECENT)))
        .select("order_id", F.date_trunc("day", "created_at").alias("day"))
    )
    # Recent orders cut the items down before anything else is joined to them.
    lines = tables["order_items"].select("order_id", "product_id", line_value().alias("value"))
    sold = join_many_to_one(lines, recent, "order_id", keep_spread=True)
    category = tables["products"].select("product_id", "category_id").join(
        tables["categories"].select("category_id", F.col("name").alias("category")), "category_id"
    )
    # Rows already carry the order's spread, so the product's takes another name.
    sold = sold.withColumnRenamed(SPREAD, ORDER_SPREAD)
    sold = join_many_to_one(sold, category.select("product_id", "category"), "product_id")
    if approximate:
        days = sold.groupBy("category", "day").agg(
            F.approx_count_distinct("order_id").alias("total_orders"),
            F.sum("value").alias("revenue"),
            F.count("value").alias("lines"),
        )
    else:
        per_order = sold.groupBy(ORDER_SPREAD, "order_id", "category", "day").agg(
            F.sum("value").alias("value"), F.count("value").alias("lines")
        )
        days = per_order.groupBy("category", "day").agg(
            F.count("*").alias("total_orders"), F.sum("value").alias("revenue"), F.sum("lines").alias("lines")
        )
    average = F.col("revenue").cast("double") / F.nullif("lines", F.lit(0))
    return (
        days.withColumn("avg_item_revenue", average)
        .drop("lines")
        .orderBy(F.desc("day"), F.desc("revenue"), "category")
    )


def customer_ltv(tables: Tables, top: int = TOP_CUSTOMERS) -> DataFrame:
    """Customers with at least two orders, by what they spent.

    Lines are summed per order and orders per customer ahead of each join, so neither a
    huge order nor a customer with very many orders makes a join key hot. As each order
    is one row by then, counting rows counts distinct orders.
    """
    per_order = tables["order_items"].groupBy("order_id").agg(
        F.sum(line_value()).alias("value"), F.count(line_value()).alias("items")
    )
    kept = tables["orders"].where(F.col("status") != "cancelled").select("order_id", "customer_id", "created_at")
    per_customer = (
        kept.join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("orders_placed"),
            F.sum("value").cast("decimal(38,2)").alias("lifetime_value"),
            F.sum("items").alias("items"),
            F.max("created_at").alias("last_order_at"),
        )
        .where(F.col("orders_placed") >= MIN_ORDERS)
    )
    names = tables["customers"].select(
        "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"), "city"
    )
    return (
        per_customer.join(names, "customer_id")
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .limit(top)
        .select(
            "customer_id",
            "full_name",
            "city",
            "orders_placed",
            "lifetime_value",
            money_average(F.col("lifetime_value"), F.col("items")).alias("avg_item_value"),
            "last_order_at",
        )
    )


def city_fulfillment(tables: Tables) -> DataFrame:
    """Share of delivered orders and average ticket per city."""
    delivered = F.count_if(F.col("status") == "delivered")
    return (
        tables["orders"]
        .groupBy("city")
        .agg(
            F.count("*").alias("total_orders"),
            delivered.alias("delivered"),
            F.count_if(F.col("status") == "cancelled").alias("cancelled"),
            percentage(delivered, F.count("*")).alias("fulfillment_pct"),
            money_average(F.sum("total_amount"), F.count("total_amount")).alias("avg_ticket"),
        )
        .orderBy(F.desc_nulls_last("fulfillment_pct"), "city")
    )


def product_performance(tables: Tables, top: int = TOP_PRODUCTS, approximate: bool = False) -> DataFrame:
    """Products by revenue. Sales are summed per product before products are joined, so
    a product in very many orders weighs one row in that join.

    Within the partitions of the join on orders, lines are summed per order and product;
    after that, counting rows of a product counts its orders.
    """
    kept = tables["orders"].where(F.col("status") != "cancelled").select("order_id")
    sold = join_many_to_one(tables["order_items"], kept, "order_id", keep_spread=True)
    sums = {
        "units_sold": F.sum("quantity"),
        "total_revenue": F.sum(line_value()),
        "price_sum": F.sum("unit_price"),
        "lines": F.count("unit_price"),
    }
    if approximate:
        sales = sold.groupBy("product_id").agg(
            F.approx_count_distinct("order_id").alias("times_ordered"), *[c.alias(n) for n, c in sums.items()]
        )
    else:
        per_order = sold.groupBy(SPREAD, "order_id", "product_id").agg(*[c.alias(n) for n, c in sums.items()])
        sales = per_order.groupBy("product_id").agg(
            F.count("*").alias("times_ordered"), *[F.sum(n).alias(n) for n in sums]
        )
    products = tables["products"].select(
        "product_id",
        F.col("name").alias("product_name"),
        "category_id",
        F.col("price").alias("current_price"),
        F.col("stock").alias("current_stock"),
    )
    categories = tables["categories"].select("category_id", F.col("name").alias("category"))
    return (
        sales.join(products, "product_id")
        .join(categories, "category_id")
        .select(
            "product_id",
            "product_name",
            "category",
            "current_price",
            "current_stock",
            "times_ordered",
            "units_sold",
            F.round("total_revenue", 2).alias("total_revenue"),
            money_average(F.col("price_sum"), F.col("lines")).alias("avg_sell_price"),
        )
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(top)
    )


def payment_shares(tables: Tables) -> DataFrame:
    """Payments per method and status, with the share of the status in its method."""
    per_status = tables["payments"].groupBy("method", "status").agg(
        F.count("*").alias("tx_count"),
        F.round(F.sum("amount"), 2).alias("total_amount"),
        money_average(F.sum("amount"), F.count("amount")).alias("avg_amount"),
    )
    in_method = F.sum("tx_count").over(Window.partitionBy("method"))
    return per_status.withColumn("status_share_pct", percentage(F.col("tx_count"), in_method)).orderBy(
        "method", F.desc("total_amount"), "status"
    )
