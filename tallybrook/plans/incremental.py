"""The business answers, kept by signed changes.

A change takes its key's old row away (sign -1) and puts its new one in (+1). What an order
adds to an answer is a sum over its lines, so a batch is answered by the orders it touches
alone: what they added before is taken away, what they add now is put in. Sums, counts and
counted values (from which a greatest one can be told after deletions, too) are all
additive, so nothing that is written is ever changed: a batch appends its signed rows, and
a state is the sum of all batches.

    <root>/<name>/batch=<n>/bucket=<b>   signed rows of a table, or sums by key

Rows are kept by their key's bucket, sums of lines by their order's: a batch reads the
buckets of the keys it changes and of the orders it touches, and no table from end to end.
A batch is a folder that a repeated run writes again, so replays change nothing. ``folded``
gives the same state as one batch elsewhere.

Defined cases: of several changes of a key the newest counts, and one that is older than
what has been applied changes nothing, also after a deletion. A product that moves to
another category, appears or goes takes its lines with it, which reads the sums of lines
once. An empty batch adds nothing. Answers equal those of ``business`` over the current
rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.functions.measures import line_value, money_average, percentage
from tallybrook.operators.live import latest
from tallybrook.operators.skew import SPREAD, join_many_to_one
from tallybrook.plans import business as B
from tallybrook.schema import TABLES

BUCKETS = 64
SIGN = "_sign"
META = ("_version", "_seq", "_is_deleted")

# Whether a value is there before a batch and after it.
WAS, IS = "_was", "_is"
# What counts of an order in the answers on lines.
PLACED = ["order_id", "customer_id", "created_at", "kept", "earned"]
PLACED_TYPES = {"customer_id": "bigint", "created_at": "timestamp", "kept": "boolean", "earned": "boolean"}

# What is kept of the rows of each table.
KEPT = {
    "orders": ("customer_id", "status", "total_amount", "city", "created_at"),
    "order_items": ("order_id", "product_id", "quantity", "unit_price"),
    "payments": ("method", "status", "amount"),
    "products": ("category_id",),
}

# The sums: their keys, and what is added up by key.
MONEY = "decimal(38,2)"
KEYS = {
    "lines": {"order_id": "bigint", "product_id": "bigint"},
    "q1": {"category_id": "bigint", "created_at": "timestamp"},
    "q2": {"customer_id": "bigint"},
    "q2_times": {"customer_id": "bigint", "created_at": "timestamp"},
    "q3": {"city": "string"},
    "q4": {"product_id": "bigint"},
    "q5": {"method": "string", "status": "string"},
}
_SOLD = {"quantity": "bigint", "value": MONEY, "price_sum": MONEY, "n_values": "bigint", "n_prices": "bigint"}
MEASURES = {
    "lines": _SOLD,
    "q1": {"value": MONEY, "n_values": "bigint"},
    "q2": {"value": MONEY, "n_values": "bigint"},
    "q2_times": {},
    "q3": {"delivered": "bigint", "cancelled": "bigint", "amount": MONEY, "n_amounts": "bigint"},
    "q4": _SOLD,
    "q5": {"amount": MONEY, "n_amounts": "bigint"},
}


def _columns(name: str) -> dict[str, str]:
    """Columns and types of a state: rows of a table, or sums; ``n`` counts what they sum."""
    if name in KEYS:
        return KEYS[name] | {"n": "bigint"} | MEASURES[name]
    spec = TABLES[name]
    own = {c: str(spec.column(c).type) for c in (spec.key, *KEPT[name])}
    return own | {"_version": "bigint", "_seq": "int", "_is_deleted": "int", SIGN: "bigint"}


def _ddl(kinds: dict[str, str]) -> str:
    return ", ".join(f"{c} {kind}" for c, kind in kinds.items())


def _added(rows: DataFrame, name: str) -> DataFrame:
    """Sums by key, without keys of which nothing is left."""
    sums = [F.sum(c).cast(kind).alias(c) for c, kind in _columns(name).items() if c not in KEYS[name]]
    return rows.groupBy(*KEYS[name]).agg(*sums).where("n <> 0")


def _signed(value: C, name: str) -> C:
    return F.sum(F.coalesce(value, F.lit(0)) * F.col(SIGN)).alias(name)


def _known(value: str, name: str) -> C:
    return F.sum(F.col(value).isNotNull().cast("bigint") * F.col(SIGN)).alias(name)


class Answers:
    """The state of all five answers below ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _bucket(self, key: str) -> C:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, name: str, batch: int, more: Mapping[str, str] | None = None) -> DataFrame:
        """A batch's part of a state, with ``more`` columns that its readers pass over; it is
        read from what is written."""
        path, kinds = f"{self.root}/{name}/batch={batch}", _columns(name) | dict(more or {})
        by = next(iter(kinds)) if name in KEPT or name == "lines" else None
        typed = rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])
        # Rows are dealt over the buckets where they were collapsed or summed: a small batch
        # leaves one file in a bucket, a large one a file for each of its tasks.
        dealt = typed.withColumn("bucket", self._bucket(by) if by else F.lit(0))
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)
        return self.spark.read.schema(_ddl(kinds)).parquet(path).drop("bucket")

    def _read(
        self, name: str, before: int | None = None, buckets: list[int] | None = None, with_batch: bool = False
    ) -> DataFrame:
        """A state up to a batch, in some buckets."""
        schema = _ddl(_columns(name) | {"batch": "int", "bucket": "int"})
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        return rows.drop("bucket") if with_batch else rows.drop("bucket", "batch")

    def _touched(self, rows: DataFrame, key: str) -> list[int]:
        """At most ``buckets`` numbers."""
        return sorted(r.b for r in rows.select(self._bucket(key).alias("b")).distinct().collect())

    # ---- a batch ---------------------------------------------------------------------

    def _rows(self, table: str, before: int, keys: DataFrame) -> DataFrame:
        """Rows of some keys, deleted ones included, that were current before a batch. The
        join on the key deals them out as the sums and a later join need them."""
        key = TABLES[table].key
        signed = self._read(table, before, self._touched(keys, key)).join(keys.select(key), key, "left_semi")
        columns = [c for c in signed.columns if c != SIGN]
        return signed.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) > 0)

    def _moved(self, table: str, versions: DataFrame, batch: int) -> DataFrame:
        """Signed rows of the keys that a batch moves."""
        key = TABLES[table].key
        kept = versions.select(key, *KEPT[table], *META)
        # Rows of a start are one per key: they are not sorted ahead of the shuffle.
        newest = latest(kept.repartition(F.col(key)) if batch == 0 else kept, key).withColumn(SIGN, F.lit(1))
        typed = newest.select(*[F.col(c).cast(kind).alias(c) for c, kind in _columns(table).items()])
        if batch == 0:
            return self._write(typed, table, 0)
        now = self._rows(table, batch, typed).withColumn(SIGN, F.lit(-1).cast("bigint"))
        old = now.select(F.struct(*typed.columns).alias("old"), F.col(key).alias("_of"))
        both = typed.select(F.struct(*typed.columns).alias("new"), key).join(old, F.col(key) == F.col("_of"), "left")
        newer = F.struct("new._version", "new._seq") > F.struct("old._version", "old._seq")
        moved = both.where(F.col("old").isNull() | newer)
        sides = moved.select(F.explode(F.array_compact(F.array("old", "new"))).alias("row")).select("row.*")
        return self._write(sides, table, batch)

    def start(self, tables: Mapping[str, DataFrame]) -> None:
        """Take the current rows of the tables as they are; they count as version 0."""
        first = {"_version": F.lit(0), "_seq": F.lit(0), "_is_deleted": F.lit(0)}
        self._take({t: tables[t].withColumns(first) for t in KEPT}, 0)

    def apply(self, changes: Mapping[str, DataFrame], batch: int) -> None:
        """Take over a batch of changelog rows of some tables. Batches are numbered from 1
        and applied in turn; one that is applied again must be the last."""
        if batch < 1:
            raise ValueError("batches are numbered from 1")
        self._take(changes, batch)

    def _take(self, changes: Mapping[str, DataFrame], batch: int) -> None:
        none = {t: self.spark.createDataFrame([], _ddl(_columns(t))) for t in KEPT if t not in changes}
        signed = {t: self._moved(t, none[t] if t in none else changes[t], batch) for t in KEPT}
        live = {t: rows.where("_is_deleted = 0") for t, rows in signed.items()}
        self._write(_q3(live["orders"]), "q3", batch)
        self._write(_q5(live["payments"]), "q5", batch)
        if batch == 0:
            # The join on orders puts lines where they are summed, and is kept next to the sums.
            orders = _placed(live["orders"]).select(*PLACED)
            known = join_many_to_one(live["order_items"], orders, "order_id", "left", keep_spread=True)
            summed = _lines(known, SPREAD, *PLACED[1:])
            every = self._write(summed, "lines", batch, PLACED_TYPES).withColumn(SIGN, F.lit(1))
            sold, products = every.where("kept or earned"), live["products"].select("product_id", "category_id", F.lit(0).alias(WAS), F.lit(1).alias(IS))
        else:
            lines = self._write(_lines(live["order_items"]), "lines", batch)
            touched, buckets = self._touched_orders(live["orders"], lines, live["products"], batch)
            orders, rows, products = self._state_of(touched, buckets, batch)
            both = self._sold_before_and_after(orders, rows, batch)
            # The answers below read these lines; the join they come from is made once.
            path = f"{self.root}/sold/batch={batch}"
            both.write.mode("overwrite").parquet(path)
            sold = self.spark.read.schema(both.schema).parquet(path)
        for name, rows in _contributions(sold, products).items():
            self._write(rows, name, batch)

    def _touched_orders(self, orders: DataFrame, lines: DataFrame, products: DataFrame, batch: int) -> tuple[DataFrame, list[int]]:
        """Orders whose lines or products' categories a batch has changed, or what of their
        row counts in an answer on lines, and their buckets."""
        counts = _placed(orders).where("kept or earned").groupBy(*PLACED).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) != 0)
        touched = counts.select("order_id").union(lines.select("order_id"))
        moved = products.groupBy("product_id", "category_id").agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) != 0)
        if not moved.isEmpty():
            listing = self._read("lines", batch).join(moved.select("product_id").distinct(), "product_id", "left_semi")
            touched = touched.union(listing.select("order_id"))
        path = f"{self.root}/touched/batch={batch}"
        touched.distinct().write.mode("overwrite").parquet(path)
        touched = self.spark.read.schema("order_id bigint").parquet(path)
        return touched, self._touched(touched, "order_id")

    @staticmethod
    def _before_and_after(rows: DataFrame, columns: list[str], batch: int) -> DataFrame:
        """Values that current rows have before a batch (``_was``), after it (``_is``) or both."""
        before = F.when(F.col("batch") < batch, F.col(SIGN)).otherwise(0)
        sums = rows.where("_is_deleted = 0").groupBy(*columns).agg(F.sum(before).alias(WAS), F.sum(SIGN).alias(IS))
        return sums.where((F.col(WAS) > 0) | (F.col(IS) > 0))

    def _state_of(self, touched: DataFrame, buckets: list[int], batch: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The touched orders and all products, before the batch and after it, and the sums of
        lines in the orders' buckets."""
        changed = self._read("orders", batch + 1, buckets, with_batch=True).join(touched, "order_id", "left_semi")
        orders = self._before_and_after(_placed(changed), PLACED, batch).where("kept or earned")
        products = self._before_and_after(self._read("products", batch + 1, with_batch=True), ["product_id", "category_id"], batch)
        return orders, self._read("lines", batch + 1, buckets, with_batch=True), products

    @staticmethod
    def _sold_before_and_after(orders: DataFrame, lines: DataFrame, batch: int) -> DataFrame:
        """Lines of the touched orders with what their orders were before the batch (sign -1)
        and are after it (+1). States are read once for both, and lines are summed where
        the join on orders has put them."""
        rows = join_many_to_one(lines, orders, "order_id", keep_spread=True)
        kinds = {c: kind for c, kind in _columns("lines").items() if c not in KEYS["lines"]}
        before = [F.sum(F.when(F.col("batch") < batch, F.col(c)).otherwise(0)).cast(kind).alias(f"_before_{c}") for c, kind in kinds.items()]
        after = [F.sum(c).cast(kind).alias(f"_after_{c}") for c, kind in kinds.items()]
        sums = rows.groupBy(SPREAD, *KEYS["lines"], *PLACED[1:], WAS, IS).agg(*before, *after)

        def side(state: str, sign: int, prefix: str) -> C:
            measures = [F.col(f"{prefix}{c}").alias(c) for c in kinds]
            return F.when((F.col(state) > 0) & (F.col(f"{prefix}n") != 0), F.struct(F.lit(sign).alias(SIGN), *measures))

        sides = F.array_compact(F.array(side(WAS, -1, "_before_"), side(IS, 1, "_after_")))
        return sums.select(*KEYS["lines"], *PLACED[1:], F.inline(sides))

    # ---- answers ---------------------------------------------------------------------

    def _state(self, name: str) -> DataFrame:
        """The sum of all batches."""
        return _added(self._read(name), name)

    def daily_category_revenue(self, categories: DataFrame, as_of: C) -> DataFrame:
        recent = self._state("q1").where(F.col("created_at") >= as_of - F.expr(B.RECENT))
        names = categories.select("category_id", F.col("name").alias("category"))
        days = recent.join(names, "category_id").groupBy("category", F.date_trunc("day", "created_at").alias("day")).agg(
            F.sum("n").alias("total_orders"), F.sum("value").alias("revenue"), F.sum("n_values").alias("lines")
        )
        revenue = F.when(F.col("lines") > 0, F.col("revenue"))
        return days.withColumns(
            {"revenue": revenue, "avg_item_revenue": revenue.cast("double") / F.nullif("lines", F.lit(0))}
        ).drop("lines").orderBy(F.desc("day"), F.desc("revenue"), "category")

    def customer_ltv(self, customers: DataFrame, top: int = B.TOP_CUSTOMERS) -> DataFrame:
        last = self._state("q2_times").groupBy("customer_id").agg(F.max("created_at").alias("last_order_at"))
        names = customers.select("customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"), "city")
        value = F.when(F.col("n_values") > 0, F.col("value")).cast("decimal(38,2)")
        kept = self._state("q2").where(F.col("n") >= B.MIN_ORDERS).join(names, "customer_id").withColumn("lifetime_value", value)
        best = kept.orderBy(F.desc("lifetime_value"), "customer_id").limit(top)
        return (
            best.join(last, "customer_id")
            .select(
                "customer_id", "full_name", "city", F.col("n").alias("orders_placed"), "lifetime_value",
                money_average(F.col("lifetime_value"), F.col("n_values")).alias("avg_item_value"), "last_order_at",
            )
            .orderBy(F.desc("lifetime_value"), "customer_id")
        )

    def city_fulfillment(self) -> DataFrame:
        return self._state("q3").select(
            "city",
            F.col("n").alias("total_orders"),
            "delivered",
            "cancelled",
            percentage(F.col("delivered"), F.col("n")).alias("fulfillment_pct"),
            money_average(F.col("amount"), F.col("n_amounts")).alias("avg_ticket"),
        ).orderBy(F.desc_nulls_last("fulfillment_pct"), "city")

    def product_performance(self, products: DataFrame, categories: DataFrame, top: int = B.TOP_PRODUCTS) -> DataFrame:
        named = products.select(
            "product_id", F.col("name").alias("product_name"), "category_id", F.col("price").alias("current_price"), F.col("stock").alias("current_stock")
        )
        return (
            self._state("q4")
            .join(named, "product_id")
            .join(categories.select("category_id", F.col("name").alias("category")), "category_id")
            .select(
                "product_id", "product_name", "category", "current_price", "current_stock", F.col("n").alias("times_ordered"),
                F.col("quantity").alias("units_sold"), F.round(F.when(F.col("n_values") > 0, F.col("value")), 2).alias("total_revenue"),
                money_average(F.col("price_sum"), F.col("n_prices")).alias("avg_sell_price"),
            )
            .orderBy(F.desc("total_revenue"), "product_id")
            .limit(top)
        )

    def payment_shares(self) -> DataFrame:
        per_status = self._state("q5").select(
            "method",
            "status",
            F.col("n").alias("tx_count"),
            F.round(F.when(F.col("n_amounts") > 0, F.col("amount")), 2).alias("total_amount"),
            money_average(F.col("amount"), F.col("n_amounts")).alias("avg_amount"),
        )
        in_method = F.sum("tx_count").over(Window.partitionBy("method"))
        return per_status.withColumn("status_share_pct", percentage(F.col("tx_count"), in_method)).orderBy(
            "method", F.desc("total_amount"), "status"
        )

    def folded(self, root: str) -> Answers:
        """The same state as one batch, written below another root."""
        other = Answers(self.spark, root, self.buckets)
        for table in KEPT:
            signed = self._read(table)
            columns = [c for c in signed.columns if c != SIGN]
            other._write(signed.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) > 0), table, 0)
        for name in KEYS:
            other._write(self._state(name), name, 0)
        return other


def _lines(items: DataFrame, *known: str) -> DataFrame:
    """Signed items as sums per order and product, and what else is known of the order."""
    return items.withColumn("value", line_value()).groupBy("order_id", "product_id", *known).agg(
        F.sum(SIGN).alias("n"),
        _signed(F.col("quantity"), "quantity"),
        _signed(F.col("value"), "value"),
        _signed(F.col("unit_price"), "price_sum"),
        _known("value", "n_values"),
        _known("unit_price", "n_prices"),
    )


def _q3(orders: DataFrame) -> DataFrame:
    status = lambda s: _signed((F.col("status") == s).cast("bigint"), s)
    amounts = (_signed(F.col("total_amount"), "amount"), _known("total_amount", "n_amounts"))
    return orders.groupBy("city").agg(F.sum(SIGN).alias("n"), status("delivered"), status("cancelled"), *amounts)


def _q5(payments: DataFrame) -> DataFrame:
    amounts = (_signed(F.col("amount"), "amount"), _known("amount", "n_amounts"))
    return payments.groupBy("method", "status").agg(F.sum(SIGN).alias("n"), *amounts)


def _placed(orders: DataFrame) -> DataFrame:
    """Orders with what counts of their status."""
    status = F.col("status")
    return orders.withColumns(
        {
            "kept": F.coalesce(status != "cancelled", F.lit(False)),
            "earned": F.coalesce(status.isin(*B.REVENUE_STATUSES), F.lit(False)),
        }
    )


def _contributions(sold: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """What signed lines, with their orders, add to the answers."""
    counted = F.sum(SIGN).alias("n")

    def added(*columns: str) -> list[C]:
        return [F.sum(F.when(F.col(SIGN) < 0, F.negative(c)).otherwise(F.col(c))).alias(c) for c in columns]

    q4 = sold.where("kept").groupBy("product_id").agg(counted, *added(*_SOLD))
    # A file holds all lines of an order, or many, so one row per order is shuffled.
    sums = [F.sum(c).alias(c) for c in ("value", "n_values")]
    per_order = sold.where("kept").groupBy("order_id", "customer_id", "created_at", SIGN).agg(*sums)
    q2 = per_order.groupBy("customer_id").agg(counted, *added("value", "n_values"))
    times = sold.where("kept").select("order_id", "customer_id", "created_at", SIGN).distinct()
    times = times.groupBy("customer_id", "created_at").agg(counted)
    in_category = join_many_to_one(
        sold.where("earned").select("order_id", "product_id", "created_at", SIGN, "value", "n_values"), products, "product_id"
    ).where(((F.col(SIGN) < 0) & (F.col(WAS) > 0)) | ((F.col(SIGN) > 0) & (F.col(IS) > 0)))
    # An order counts once in a category, however many of its products it lists.
    once = in_category.groupBy("order_id", "created_at", "category_id", SIGN).agg(*sums)
    q1 = once.groupBy("category_id", "created_at").agg(counted, *added("value", "n_values"))
    return {"q1": q1, "q2": q2, "q2_times": times, "q4": q4}
