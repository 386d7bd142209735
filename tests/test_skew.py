"""A third of all rows under one key: results stay whole and the work is split."""

from pyspark.sql import functions as F

from tallybrook.operators.live import latest, live
from tallybrook.operators.skew import join_many_to_one
from tallybrook.plans import business

ROWS = 300_000


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def with_settings(spark, settings):
    class Settings:
        def __enter__(self):
            self.before = {k: spark.conf.get(k, None) for k in settings}
            for k, v in settings.items():
                spark.conf.set(k, v)

        def __exit__(self, *_):
            for k, v in self.before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    return Settings()


SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def hot_lines(spark):
    number = F.col("id")
    return spark.range(0, ROWS, 1, 16).select(
        F.when(number % 3 == 0, 7).otherwise(number % 1000).alias("order_id"),
        (number % 50).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(2).cast("decimal(10,2)").alias("unit_price"),
    )


def orders_log(spark):
    return spark.range(1000).repartition(3).select(
        F.col("id").alias("order_id"),
        F.lit("shipped").alias("status"),
        F.lit(1).cast("bigint").alias("_version"),
        F.lit(0).alias("_seq"),
        F.lit(0).alias("_is_deleted"),
    )


def test_hot_parent_is_split_after_version_collapse(spark):
    with with_settings(spark, SHUFFLED):
        joined = join_many_to_one(hot_lines(spark), live(orders_log(spark), "order_id"), "order_id")
        rows = joined.groupBy("order_id").agg(F.count("*").alias("n"))
        counts = {r.order_id: r.n for r in rows.collect()}
        assert sum(counts.values()) == ROWS
        assert counts[7] == ROWS // 3 + len([i for i in range(ROWS) if i % 3 and i % 1000 == 7])
        assert "skew=true" in plan_of(rows)


def test_plain_join_would_not_be_split(spark):
    with with_settings(spark, SHUFFLED):
        rows = hot_lines(spark).join(live(orders_log(spark), "order_id"), "order_id").groupBy("order_id").count()
        rows.collect()
        assert "skew=true" not in plan_of(rows)


def test_hot_parent_is_split_in_anti_and_semi_joins(spark):
    with with_settings(spark, SHUFFLED):
        some = live(orders_log(spark), "order_id").where("order_id <> 7")
        hot = hot_lines(spark)
        missing = join_many_to_one(hot, some, "order_id", "left_anti")
        found = join_many_to_one(hot, some, "order_id", "left_semi")
        assert missing.collect() and "skew=true" in plan_of(missing)
        assert missing.count() + found.count() == ROWS


def hot_shop(spark):
    """A third of the lines in one order, half of all lines with one product."""
    return {
        "orders": live(orders_log(spark), "order_id").withColumns(
            {
                "customer_id": F.when(F.col("order_id") % 3 == 0, 1).otherwise(F.col("order_id")),
                "created_at": F.timestamp_seconds(F.lit(1714521600) + F.col("order_id") * 600),
            }
        ),
        "order_items": hot_lines(spark).withColumn(
            "product_id", F.when(F.col("order_id") % 2 == 0, 3).otherwise(F.col("product_id"))
        ),
        "products": spark.range(50).select(
            F.col("id").alias("product_id"),
            F.lit(1).cast("bigint").alias("category_id"),
            F.lit("p").alias("name"),
            F.lit(1).cast("decimal(10,2)").alias("price"),
            F.lit(1).alias("stock"),
        ),
        "categories": spark.sql("SELECT cast(1 AS bigint) AS category_id, 'c' AS name"),
        "customers": spark.range(1000).select(
            F.col("id").alias("customer_id"), F.lit("a").alias("first_name"), F.lit("b").alias("last_name"),
            F.lit("x").alias("city"),
        ),
    }


def hot_lines_in_python():
    """(order, product) of every line of ``hot_shop``."""
    for i in range(ROWS):
        order = 7 if i % 3 == 0 else i % 1000
        yield order, 3 if order % 2 == 0 else i % 50


def test_product_performance_with_hot_order_and_product(spark):
    lines, orders = {}, {}
    for order, product in hot_lines_in_python():
        lines[product] = lines.get(product, 0) + 1
        orders.setdefault(product, set()).add(order)
    with with_settings(spark, SHUFFLED):
        top = business.product_performance(hot_shop(spark), top=50)
        rows = top.collect()
        assert "skew=true" in plan_of(top)
    assert {r.product_id: (r.units_sold, r.times_ordered) for r in rows} == {
        p: (n, len(orders[p])) for p, n in lines.items()
    }


def test_daily_revenue_with_hot_order_and_product(spark):
    lines, orders = {}, {}
    for order, _ in hot_lines_in_python():
        day = (1714521600 + order * 600) // 86400
        lines[day] = lines.get(day, 0) + 1
        orders.setdefault(day, set()).add(order)
    with with_settings(spark, SHUFFLED):
        daily = business.daily_category_revenue(hot_shop(spark), F.lit("2024-05-10").cast("timestamp"))
        rows = daily.select("*", F.unix_seconds("day").alias("s")).collect()
        daily.collect()
        assert "skew=true" in plan_of(daily)
    assert {r.s // 86400: (int(r.revenue) // 2, r.total_orders) for r in rows} == {
        d: (n, len(orders[d])) for d, n in lines.items()
    }


def test_lifetime_value_with_hot_order_and_customer(spark):
    lines, orders = {}, {}
    for order, _ in hot_lines_in_python():
        customer = 1 if order % 3 == 0 else order
        lines[customer] = lines.get(customer, 0) + 1
        orders.setdefault(customer, set()).add(order)
    with with_settings(spark, SHUFFLED):
        rows = business.customer_ltv(hot_shop(spark), top=1000).collect()
    assert {r.customer_id: (int(r.lifetime_value) // 2, r.orders_placed) for r in rows} == {
        c: (n, len(orders[c])) for c, n in lines.items() if len(orders[c]) >= 2
    }


def test_hot_key_leaves_one_version_per_task(spark):
    """A key with a third of all changes is cut to one row per task ahead of the shuffle."""
    changes = spark.range(0, ROWS, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("order_id"),
        F.col("id").alias("_version"),
        F.lit(0).alias("_seq"),
        F.lit(0).alias("_is_deleted"),
    )
    newest = latest(changes, "order_id")
    assert newest.where("order_id = 0").first()._version == ROWS - 3
    assert newest.count() == 1 + ROWS - ROWS // 3
    plan = plan_of(newest)
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
