from datetime import datetime

from pyspark.sql import functions as F

from tallybrook.functions.typing import default_filled
from tallybrook.operators.live import latest, live, lookup, register_views
from tallybrook.schema import ORDERS, PRODUCTS

SCHEMA = "order_id BIGINT, status STRING, day INT, _version BIGINT, _seq INT, _is_deleted INT"
CHANGES = [
    (1, "pending", 1, 1, 0, 0),
    (1, "shipped", 1, 3, 0, 0),
    (1, "confirmed", 1, 2, 0, 0),
    (2, "pending", 2, 1, 0, 0),
    (2, None, None, 4, 0, 1),
    (3, None, None, 2, 0, 1),
    (3, "pending", 5, 5, 0, 0),
    (4, "pending", 6, 7, 0, 0),
    (4, "shipped", 6, 7, 1, 0),
]


def statuses(frame):
    return {r.order_id: r.status for r in frame.collect()}


EXPECTED = {1: "shipped", 3: "pending", 4: "shipped"}


def test_newest_version_wins_whatever_the_order(spark):
    changes = spark.createDataFrame(CHANGES, SCHEMA)
    assert statuses(live(changes, "order_id")) == EXPECTED
    assert statuses(live(changes.orderBy(F.rand(3)).repartition(5), "order_id")) == EXPECTED
    assert statuses(live(changes.union(changes), "order_id")) == EXPECTED


def test_filter_before_collapse_would_bring_deleted_rows_back(spark):
    changes = spark.createDataFrame(CHANGES, SCHEMA)
    early = latest(changes.where("_is_deleted = 0"), "order_id")
    assert 2 in statuses(early) and 2 not in statuses(live(changes, "order_id"))


def test_immutable_predicate_keeps_key_only_tombstones(spark):
    changes = spark.createDataFrame(CHANGES, SCHEMA)
    assert statuses(live(changes, "order_id", immutable=F.col("day") < 5)) == {1: "shipped"}
    assert statuses(live(changes, "order_id", immutable=F.col("day") >= 1)) == EXPECTED


def test_immutable_predicate_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame(CHANGES, SCHEMA).write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    plan = live(log, "order_id", immutable=F.col("day") >= 5)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(day,5),EqualTo(_is_deleted,1))]" in plan


def test_lookup_reaches_the_scan_and_reads_needed_columns(spark, tmp_path):
    spark.createDataFrame(CHANGES, SCHEMA).write.parquet(f"{tmp_path}/log")
    found = lookup(spark.read.parquet(f"{tmp_path}/log"), "order_id", 1).select("status")
    assert found.collect()[0].status == "shipped"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_id,1)" in plan and "day" not in plan


def test_views(spark):
    log = spark.createDataFrame(
        [(1, 2, "a", "s", 1, 3, True, None, None, 1, 0, 0), (1, 2, "b", "s", 1, 3, True, None, None, 2, 0, 0)],
        PRODUCTS.changelog_schema.replace("DECIMAL(10,2)", "INT"),
    )
    register_views({"products": log}, prefix="live_")
    assert [r.name for r in spark.sql("SELECT name FROM live_products").collect()] == ["b"]


def test_default_filled_form(spark):
    rows = spark.createDataFrame(
        [(1, 1, "pending", None, None, None, None)],
        "order_id BIGINT, customer_id BIGINT, status STRING, total_amount DECIMAL(10,2), city STRING, "
        "created_at TIMESTAMP, updated_at TIMESTAMP",
    )
    row = default_filled(rows, ORDERS, F.lit("2024-06-01").cast("timestamp")).first()
    assert (row.total_amount, row.city) == (0, "")
    assert isinstance(row.created_at, datetime)


def test_flags(spark):
    rows = spark.createDataFrame([(1, True), (2, False), (3, None)], "product_id BIGINT, is_active BOOLEAN")
    filled = default_filled(rows, PRODUCTS, F.current_timestamp()).orderBy("product_id")
    assert [r.is_active for r in filled.collect()] == [1, 0, 0]
