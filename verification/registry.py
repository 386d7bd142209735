"""One query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions import measures as M
from tallybrook.functions import typing as Y
from tallybrook.operators import changes as CH
from tallybrook.operators import decode as D
from tallybrook.operators import hashtree as HT
from tallybrook.operators import keys as K
from tallybrook.operators import live as L
from tallybrook.operators import quality as Q
from tallybrook.operators import reconcile as R
from tallybrook.operators import stock as ST
from tallybrook.operators.skew import join_many_to_one
from tallybrook.plans import business as B
from tallybrook.plans.incremental import Answers
from tallybrook.schema import META_COLUMNS, ORDERS, PRODUCTS, TABLES
from tallybrook.session import apply_settings, work_folder
from tallybrook.sources.changelog import ChangelogStore
from tallybrook.sources.feed import read_messages, stream_messages
from tallybrook.sources.snapshot import snapshot_rows
from tallybrook.streaming.ingest import start_ingest
from tallybrook.streaming import processor as P
from tallybrook.streaming.state import read_latest, start_latest
from verification import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Version of the change rows the table-change queries give.
NEXT_VERSION = 10


def plain(rows: DataFrame) -> DataFrame:
    """Column types both engines share: BIGINT, DOUBLE, times without zone."""
    shown = []
    for field in rows.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        shown.append(column.alias(field.name))
    return rows.select(*shown)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(apply_settings(spark), sf_dir))

    QUERIES[function.__name__] = run
    return run


# ---- business queries ----------------------------------------------------------------


@query
def q1_daily_category_revenue(spark, sf):
    """An order's date never changes, so the time bound may go below the version collapse."""
    recent = F.col("created_at") >= X.as_of() - F.expr(B.RECENT)
    orders = L.live(X.orders_log(spark, sf), "order_id", immutable=recent)
    return B.daily_category_revenue(X.shop(spark, sf, orders=lambda: orders), X.as_of())


@query
def q2_customer_ltv(spark, sf):
    return B.customer_ltv(X.shop(spark, sf))


@query
def q3_city_fulfillment(spark, sf):
    return B.city_fulfillment(X.shop(spark, sf, orders=lambda: X.live_orders(spark, sf, with_city=True)))


@query
def q4_product_performance(spark, sf):
    return B.product_performance(X.shop(spark, sf))


@query
def q5_payment_share(spark, sf):
    return B.payment_shares(X.shop(spark, sf))


STORES: dict[tuple[str, str], ChangelogStore] = {}


def _stored(spark, sf) -> ChangelogStore:
    """All tables in a store: a compacted snapshot with two batches of changes waiting."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in STORES:
        STORES[key] = X.stored_shop(spark, sf, work_folder(spark, "shop"), compact_after=0)
    return STORES[key]


def _live_tables(spark, sf, **immutable) -> dict[str, DataFrame]:
    store = _stored(spark, sf)
    return {name: store.live(name, immutable.get(name)) for name in TABLES}


@query
def q1_from_store(spark, sf):
    recent = F.col("created_at") >= X.as_of() - F.expr(B.RECENT)
    return B.daily_category_revenue(_live_tables(spark, sf, orders=recent), X.as_of())


@query
def q2_from_store(spark, sf):
    return B.customer_ltv(_live_tables(spark, sf))


@query
def q4_from_store(spark, sf):
    return B.product_performance(_live_tables(spark, sf))


ANSWERS: dict[tuple[str, str], Answers] = {}


def _answers(spark, sf) -> Answers:
    """Answers that started from the first copy of the tables and took over two batches."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in ANSWERS:
        state = Answers(spark, work_folder(spark, "answers"), buckets=8)
        state.start(X.shop_sources(spark, sf))
        logs = {"orders": X.orders_log(spark, sf, with_city=True), "products": X.products_log(spark, sf)}
        for number in (1, 2):
            state.apply({name: log.where(F.col("_batch_id") == number) for name, log in logs.items()}, number)
        ANSWERS[key] = state
    return ANSWERS[key]


@query
def q1_incremental(spark, sf):
    return _answers(spark, sf).daily_category_revenue(X.categories(spark, sf), X.as_of())


@query
def q2_incremental(spark, sf):
    return _answers(spark, sf).customer_ltv(X.customers(spark, sf))


@query
def q3_incremental(spark, sf):
    return _answers(spark, sf).city_fulfillment()


@query
def q4_incremental(spark, sf):
    return _answers(spark, sf).product_performance(X.live_products(spark, sf), X.categories(spark, sf))


@query
def q5_incremental(spark, sf):
    """Out of the state folded into one batch."""
    return _answers(spark, sf).folded(work_folder(spark, "answers-folded")).payment_shares()


@query
def q3_sql(spark, sf):
    """The question in SQL, over views of the stored tables."""
    _stored(spark, sf).register_views("shop_")
    return spark.sql(
        """
        SELECT city, count(*) AS total_orders, count_if(status = 'delivered') AS delivered,
               count_if(status = 'cancelled') AS cancelled,
               round(100.0 * count_if(status = 'delivered') / count(*), 2) AS fulfillment_pct,
               round(cast(sum(total_amount) AS decimal(24,2)) / cast(count(total_amount) AS decimal(14,0)), 2) AS avg_ticket
        FROM shop_orders GROUP BY city
        """
    )


@query
def q5_sql(spark, sf):
    """The question in SQL, over views of the stored tables."""
    _stored(spark, sf).register_views("shop_")
    return spark.sql(
        """
        SELECT method, status, tx_count, total_amount,
               round(cast(total_amount AS decimal(24,2)) / cast(tx_count AS decimal(14,0)), 2) AS avg_amount,
               round(100.0 * tx_count / sum(tx_count) OVER (PARTITION BY method), 2) AS status_share_pct
        FROM (SELECT method, status, count(*) AS tx_count, sum(amount) AS total_amount
              FROM shop_payments GROUP BY method, status)
        """
    )


# ---- changelog and current state -----------------------------------------------------

STATE = ("order_id", "customer_id", "status", "total_amount", "created_at", "_version", "_is_deleted")


@query
def snapshot_load(spark, sf):
    return snapshot_rows(X.products(spark, sf), PRODUCTS)


@query
def snapshot_load_all(spark, sf):
    """The first copy of all six tables in a store: rows, keys and versions of each."""
    store = ChangelogStore(spark, work_folder(spark, "load"))
    store.load_snapshot(X.shop_sources(spark, sf))
    counted = [
        store.history(name).agg(F.count("*").alias("rows"), F.sum(spec.key).alias("key_sum"), F.max("_version").alias("version")).select(
            F.lit(name).alias("table_name"), "rows", "key_sum", "version"
        )
        for name, spec in TABLES.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def changelog_history(spark, sf):
    return X.orders_log(spark, sf).select(*STATE)


@query
def latest_state(spark, sf):
    return L.latest(X.orders_log(spark, sf), "order_id").select(*STATE)


@query
def live_rows(spark, sf):
    return L.live(X.events_log(spark, sf), "user_id")


@query
def live_orders(spark, sf):
    return X.live_orders(spark, sf)


@query
def live_products(spark, sf):
    return X.live_products(spark, sf)


def _live_of(name: str) -> Query:
    """Current rows of a table that has had no change since its snapshot."""
    spec = TABLES[name]

    def live_table(spark, sf):
        return L.live(snapshot_rows(getattr(X, name)(spark, sf), spec), spec.key)

    live_table.__name__ = f"live_{name}"
    return live_table


for _name in ("categories", "customers", "payments"):
    query(_live_of(_name))


@query
def live_order_items(spark, sf):
    """Items have no key in the test tables; their orders' deletions are what changes them."""
    orders = X.orders_log(spark, sf)
    deleted = L.latest(orders, "order_id").where("_is_deleted = 1")
    return join_many_to_one(X.order_items(spark, sf), deleted.select("order_id"), "order_id", "left_anti")


@query
def point_lookup(spark, sf):
    """A price that was updated has arrived."""
    return L.lookup(X.products_log(spark, sf), "product_id", 10).select("product_id", "price")


def _batches(log: DataFrame) -> list[tuple[int, DataFrame]]:
    """The changelog fixture as the batches it arrived in."""
    return [(n, log.where(F.col("_batch_id") == n)) for n in range(3)]


@query
def compact_changelog(spark, sf):
    """Two batches, compaction, a third batch, compaction again: newest versions."""
    store = ChangelogStore(spark, work_folder(spark, "compact"))
    log = X.orders_log(spark, sf, with_city=True)
    for number, rows in _batches(log):
        store.append_rows({"orders": rows.drop("_batch_id")}, "log", number)
        if number > 0:
            store.compact()
    return store.newest("orders").drop("_seq")


@query
def changelog_history_store(spark, sf):
    """All versions of all batches, two of them folded into a base."""
    store = ChangelogStore(spark, work_folder(spark, "history"))
    for number, rows in _batches(X.orders_log(spark, sf, with_city=True)):
        store.append_rows({"orders": rows.drop("_batch_id")}, "log", number)
        if number == 1:
            store.compact()
    return store.history("orders").select(*STATE, "_batch_id")


@query
def late_batch_after_compaction(spark, sf):
    """The first batch arrives after the two that follow it have been folded."""
    store = ChangelogStore(spark, work_folder(spark, "late-batch"))
    first, *others = _batches(X.orders_log(spark, sf, with_city=True))
    for number, rows in others:
        store.append_rows({"orders": rows.drop("_batch_id")}, "log", number)
    store.compact()
    store.append_rows({"orders": first[1].drop("_batch_id")}, "log", first[0])
    return store.live("orders")


@query
def quarantine_kept(spark, sf):
    """What could not be applied stays, whatever compaction does to the batches."""
    store = ChangelogStore(spark, work_folder(spark, "quarantine"))
    for number, part in enumerate(_halves(spark, sf)):
        store.append_messages(part, "feed", number, X.as_of())
        store.compact()
    return store.quarantine().select("_version", "_seq", F.col("_table").alias("table_name"), "reason")


@query
def change_counts_store(spark, sf):
    """Changes per batch, table and kind, out of the changelog."""
    store = ChangelogStore(spark, work_folder(spark, "counts"))
    for number, part in enumerate(_halves(spark, sf)):
        store.append_messages(part, "feed", number, X.as_of())
    return store.change_counts().drop("run")


@query
def feed_broken_lines(spark, sf):
    """Why messages were not applied, out of a landed feed with broken lines and with
    messages that have lost their position."""
    folder = work_folder(spark, "broken")
    event = F.col("lsn") - X.FIRST_LSN
    line = F.to_json(F.struct(F.when(event % 103 != 0, F.col("lsn")).alias("lsn"), "payload"))
    X.messages(spark, sf).select(F.when(event % 101 == 0, F.lit("{broken")).otherwise(line).alias("value")).write.text(folder)
    return D.quarantine(D.decode_changes(read_messages(spark, folder))).groupBy("reason").agg(F.count("*").alias("changes"))


@query
def change_counts(spark, sf):
    return D.change_counts(D.decode_changes(X.messages(spark, sf)))


# ---- decoding ------------------------------------------------------------------------


def _decoded(spark, sf) -> DataFrame:
    return D.decode_changes(X.messages(spark, sf))


@query
def cdc_decode(spark, sf):
    return _decoded(spark, sf).where(F.col("_malformed").isNull()).select(
        "_version",
        "_seq",
        F.col("_table").alias("table_name"),
        F.col("_kind").alias("kind"),
        F.coalesce(F.size("_names"), F.lit(-1)).alias("new_values"),
        F.coalesce(F.size("_old_names"), F.lit(-1)).alias("old_values"),
        F.try_variant_get(
            Y.named_value(F.coalesce("_names", "_old_names"), F.coalesce("_values", "_old_values"), F.lit("status")),
            "$",
            "string",
        ).alias("status"),
    )


@query
def cdc_route(spark, sf):
    return _decoded(spark, sf).select(
        "_version", "_seq", D.route().alias("route"), F.col("_table").alias("table_name")
    )


@query
def cdc_upsert_rows(spark, sf):
    return D.change_rows(_decoded(spark, sf), ORDERS).where("_is_deleted = 0")


@query
def cdc_tombstones(spark, sf):
    return D.change_rows(_decoded(spark, sf), ORDERS).where("_is_deleted = 1")


@query
def cdc_key_change(spark, sf):
    """Keys that rows have left, and where they went."""
    moved = D.typed_changes(_decoded(spark, sf), ORDERS).where("_kind = 'update' and _reason is null")
    new_key = Y.typed_value(F.get("_values", F.lit(0)), ORDERS.column("order_id"))
    return moved.where("_is_deleted = 1").select("_version", "order_id", new_key.alias("new_order_id"))


@query
def cdc_quarantine(spark, sf):
    return D.quarantine(_decoded(spark, sf)).select("_version", "_seq", F.col("_table").alias("table_name"), "reason")


@query
def coerce_defaults(spark, sf):
    """Every tenth order has lost its city, every tenth its total."""
    orders = X.orders(spark, sf, with_city=True).select(
        "order_id",
        F.when(F.col("order_id") % 10 != 0, F.col("total_amount")).alias("total_amount"),
        F.when(F.col("order_id") % 10 != 1, F.col("city")).alias("city"),
    )
    return Y.default_filled(orders, ORDERS, X.as_of())


@query
def coerce_timestamps(spark, sf):
    """Every tenth event has an unreadable time, every tenth an empty one."""
    number = F.col("event_id")
    text = F.when(number % 10 == 0, "no time").when(number % 10 == 1, "").otherwise(F.col("ts").cast("string"))
    return X.table(spark, sf, "events").select("event_id", Y.time_or_now(text, X.as_of()).alias("ts"))


@query
def coerce_booleans(spark, sf):
    number = F.col("event_id")
    flag = F.when(number % 10 != 0, number % 2 == 0)
    return X.table(spark, sf, "events").select("event_id", Y.as_flag(flag).alias("flag"))


# ---- continuous ingestion ------------------------------------------------------------


def _halves(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The feed up to its middle position, and from there on."""
    feed = X.messages(spark, sf)
    middle = X.table(spark, sf, "events").agg(F.max("event_id")).first()[0] // 2 + X.FIRST_LSN
    return feed.where(F.col("lsn") <= middle), feed.where(F.col("lsn") > middle)


def _ingest(spark, folder: str, **options) -> ChangelogStore:
    """Take over what has landed in ``folder`` and stop."""
    start_ingest(
        spark,
        stream_messages(spark, f"{folder}/feed"),
        f"{folder}/tables",
        f"{folder}/checkpoint",
        once=True,
        ingest_time=X.as_of(),
        **options,
    ).awaitTermination()
    return ChangelogStore(spark, f"{folder}/tables")


def _land(messages: DataFrame, folder: str) -> None:
    messages.write.mode("append").json(f"{folder}/feed")


@query
def cdc_stream_changelog(spark, sf):
    """All tables the feed writes to, after one stream has fanned it out."""
    folder = work_folder(spark, "stream")
    _land(X.messages(spark, sf), folder)
    store = _ingest(spark, folder)
    orders = store.history("orders").select(
        F.lit("orders").alias("table_name"),
        F.col("order_id").alias("key"),
        F.col("total_amount").alias("amount"),
        *META_COLUMNS,
    )
    payments = store.history("payments").select(
        F.lit("payments").alias("table_name"), F.col("payment_id").alias("key"), "amount", *META_COLUMNS
    )
    return orders.unionByName(payments)


@query
def cdc_resume(spark, sf):
    """Snapshot, half of the feed, a restart, the other half: current orders."""
    folder = work_folder(spark, "resume")
    snapshot = {"orders": X.orders(spark, sf, with_city=True), "payments": X.payments(spark, sf)}
    first, second = _halves(spark, sf)
    _land(first, folder)
    _ingest(spark, folder, snapshot=snapshot)
    _land(second, folder)
    return _ingest(spark, folder, snapshot=snapshot).live("orders")


@query
def late_change_ignored(spark, sf):
    """The older half of the feed arrives after the newer one and changes nothing newer."""
    folder = work_folder(spark, "late")
    older, newer = _halves(spark, sf)
    _land(newer, folder)
    _ingest(spark, folder)
    _land(older, folder)
    return _ingest(spark, folder).live("orders")


@query
def latest_state_stream(spark, sf):
    """Newest version per order, kept by a stateful stream."""
    folder = work_folder(spark, "state")
    _land(X.messages(spark, sf), folder)
    changes = D.change_rows(D.decode_changes(stream_messages(spark, f"{folder}/feed")), ORDERS)
    columns = ["customer_id", "status", "total_amount"]
    start_latest(
        spark, changes, "order_id", columns, f"{folder}/state", f"{folder}/checkpoint", once=True
    ).awaitTermination()
    return read_latest(spark, f"{folder}/state", "order_id").drop("_seq")


STATE_COLUMNS = ["customer_id", "status", "total_amount"]


@query
def latest_state_processor(spark, sf):
    """Current orders out of the signed rows of a stateful processor, stopped in the middle
    of the feed and started again."""
    folder = work_folder(spark, "processor")
    for part in _halves(spark, sf):
        _land(part, folder)
        changes = D.change_rows(D.decode_changes(stream_messages(spark, f"{folder}/feed")), ORDERS)
        P.start_signed(
            spark, changes, "order_id", STATE_COLUMNS, f"{folder}/signed", f"{folder}/checkpoint", "run", once=True
        ).awaitTermination()
    return P.summed(P.read_signed(spark, f"{folder}/signed")).drop("_seq")


@query
def processor_from_base(spark, sf):
    """Signed rows of the second half of the feed, under a new checkpoint that starts from
    the newest versions of the first half."""
    folder = work_folder(spark, "processor-base")
    first, second = _halves(spark, sf)
    base = L.latest(D.change_rows(D.decode_changes(first), ORDERS), "order_id")
    _land(second, folder)
    changes = D.change_rows(D.decode_changes(stream_messages(spark, f"{folder}/feed")), ORDERS)
    P.start_signed(
        spark, changes, "order_id", STATE_COLUMNS, f"{folder}/signed", f"{folder}/checkpoint", "run", base, once=True
    ).awaitTermination()
    return P.read_signed(spark, f"{folder}/signed").drop("_seq").withColumnRenamed("_sign", "sign")


@query
def flush_policy(spark, sf):
    """With which flush of its group every change of orders and payments leaves, 50 at a
    time; the stream is stopped in the middle of the feed, and closed at its end."""
    folder = work_folder(spark, "flush")
    buckets = 4

    def waiting(messages: DataFrame) -> DataFrame:
        decoded = D.decode_changes(messages)
        parts = []
        for name in ("orders", "payments"):
            key = F.col(TABLES[name].key)
            payload = F.concat_ws(":", key.cast("string"), F.col("_is_deleted").cast("string"))
            columns = P.waiting_rows(F.lit(name), key, payload, F.col("_version"), F.col("_seq"), buckets)
            parts.append(D.change_rows(decoded, TABLES[name]).select(*columns))
        return reduce(DataFrame.unionByName, parts)

    for number, part in enumerate(_halves(spark, sf)):
        _land(part, folder)
        closing = P.closing_rows(spark, ["orders", "payments"], buckets).where(F.lit(number == 1))
        closing.write.mode("append").parquet(f"{folder}/closing")
        ends = spark.readStream.schema(P.WAITING).parquet(f"{folder}/closing")
        rows = waiting(stream_messages(spark, f"{folder}/feed")).unionByName(ends)
        # Time does not count here: it would let out rows whenever the query happens to run.
        P.start_flush(rows, f"{folder}/out", f"{folder}/checkpoint", n=50, seconds=3600, once=True).awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    return out.select(F.col("table").alias("table_name"), "bucket", "version", "seq", "payload", "flush")


@query
def state_new_checkpoint(spark, sf):
    """The second half of the feed comes under a new checkpoint, which numbers from zero."""
    folder = work_folder(spark, "state-again")
    columns = ["customer_id", "status", "total_amount"]
    for number, part in enumerate(_halves(spark, sf)):
        part.write.json(f"{folder}/feed-{number}")
        changes = D.change_rows(D.decode_changes(stream_messages(spark, f"{folder}/feed-{number}")), ORDERS)
        start_latest(
            spark, changes, "order_id", columns, f"{folder}/state", f"{folder}/checkpoint-{number}", once=True
        ).awaitTermination()
    return read_latest(spark, f"{folder}/state", "order_id").drop("_seq")


# ---- relational operators ------------------------------------------------------------


def _sold(spark, sf) -> DataFrame:
    """Live orders with their items."""
    return join_many_to_one(X.order_items(spark, sf), X.live_orders(spark, sf), "order_id")


@query
def line_revenue(spark, sf):
    return X.order_items(spark, sf).select("order_id", "product_id", M.line_value().alias("revenue"))


@query
def filter_in(spark, sf):
    return X.live_orders(spark, sf).where(F.col("status").isin("shipped", "delivered")).select("order_id", "status")


@query
def filter_ne(spark, sf):
    return X.live_orders(spark, sf).where(F.col("status") != "cancelled").select("order_id", "status")


@query
def filter_not_in(spark, sf):
    return X.live_orders(spark, sf).where(~F.col("status").isin(*CH.CLOSED_STATUSES)).select("order_id", "status")


@query
def filter_recent(spark, sf):
    return X.live_orders(spark, sf).where(F.col("created_at") >= X.as_of() - F.expr(B.RECENT)).select(
        "order_id", "created_at"
    )


@query
def filter_conjunction(spark, sf):
    old = F.col("created_at") < X.as_of() - F.expr(CH.EXPIRE_AFTER)
    return X.live_orders(spark, sf).where((F.col("status") == "cancelled") & old).select("order_id", "created_at")


@query
def join_two(spark, sf):
    return _sold(spark, sf).select("order_id", "status", "product_id", "quantity")


@query
def join_four(spark, sf):
    products = X.live_products(spark, sf).select("product_id", "category_id", F.col("name").alias("product_name"))
    categories = X.categories(spark, sf).select("category_id", F.col("name").alias("category"))
    return (
        join_many_to_one(_sold(spark, sf), products, "product_id")
        .join(categories, "category_id")
        .select("order_id", "status", "product_name", "category", "quantity")
    )


@query
def group_by_columns(spark, sf):
    return _sold(spark, sf).groupBy("status", "product_id").agg(F.sum("quantity").alias("units"))


@query
def group_by_day(spark, sf):
    return X.live_orders(spark, sf).groupBy(F.date_trunc("day", "created_at").alias("day")).agg(
        F.count("*").alias("orders"), F.sum("total_amount").alias("total")
    )


@query
def having_min_orders(spark, sf):
    counts = X.live_orders(spark, sf).groupBy("customer_id").agg(F.count_distinct("order_id").alias("orders"))
    return counts.where(F.col("orders") >= B.MIN_ORDERS)


@query
def share_of_partition(spark, sf):
    counts = X.live_orders(spark, sf).groupBy("customer_id", "status").agg(F.count("*").alias("orders"))
    whole = F.sum("orders").over(Window.partitionBy("customer_id"))
    return counts.withColumn("share_pct", M.percentage(F.col("orders"), whole))


@query
def top_k(spark, sf):
    return X.live_orders(spark, sf).orderBy(F.desc("total_amount"), "order_id").limit(100).select(
        "order_id", "total_amount"
    )


def sample_n_rows(spark, sf) -> DataFrame:
    open_orders = X.live_orders(spark, sf).where(~F.col("status").isin(*CH.CLOSED_STATUSES))
    return K.sample_rows(open_orders, 15, seed=7, key="order_id")


@query
def sample_n(spark, sf):
    """Fifteen random open orders, as the status update takes them."""
    return sample_n_rows(spark, sf)


@query
def sample_n_summary(spark, sf):
    """How many rows and orders the sample has, and whether all of them are open."""
    closed = F.col("status").isin(*CH.CLOSED_STATUSES)
    return sample_n_rows(spark, sf).agg(
        F.count("*").alias("rows"), F.count_distinct("order_id").alias("orders"), F.bool_and(~closed).alias("all_open")
    )


# ---- aggregate functions -------------------------------------------------------------


def _per_status(spark, sf, *aggregates) -> DataFrame:
    return _sold(spark, sf).groupBy("status").agg(*aggregates)


@query
def agg_count(spark, sf):
    return _per_status(spark, sf, F.count("*").alias("lines"))


@query
def agg_count_distinct(spark, sf):
    return _per_status(spark, sf, M.distinct_count("order_id").alias("orders"))


@query
def agg_approx_distinct(spark, sf):
    return _per_status(spark, sf, M.distinct_count("order_id", approximate=True).alias("orders"))


@query
def agg_approx_within_error(spark, sf):
    """Exact counts, and whether the approximate ones lie within three standard errors."""
    counts = _per_status(spark, sf, M.distinct_count("order_id").alias("orders"), M.distinct_count("order_id", approximate=True).alias("close"))
    return counts.select("status", "orders", (F.abs(F.col("close") - F.col("orders")) <= 0.15 * F.col("orders")).alias("within"))


@query
def agg_count_if(spark, sf):
    return _per_status(spark, sf, F.count_if(F.col("quantity") > 25).alias("large_lines"))


@query
def agg_sum(spark, sf):
    return _per_status(spark, sf, F.sum(M.line_value()).alias("revenue"))


@query
def agg_sum_if(spark, sf):
    return _per_status(spark, sf, F.sum(F.when(F.col("quantity") > 25, M.line_value())).alias("large_revenue"))


@query
def agg_avg(spark, sf):
    return _per_status(
        spark, sf, M.money_average(F.sum("unit_price"), F.count("unit_price")).alias("avg_unit_price")
    )


@query
def agg_max(spark, sf):
    return _per_status(spark, sf, F.max("created_at").alias("last_order_at"))


# ---- scalar functions ----------------------------------------------------------------


@query
def fn_date_trunc(spark, sf):
    return X.table(spark, sf, "events").select("event_id", F.date_trunc("day", "ts").alias("day"))


@query
def fn_round(spark, sf):
    """Half a cent goes up: a quarter of each price, to cents."""
    return X.order_items(spark, sf).select("unit_price", F.round(F.col("unit_price") / 4, 2).alias("quarter"))


@query
def fn_concat(spark, sf):
    return X.customers(spark, sf).select(
        "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name")
    )


@query
def fn_nullif(spark, sf):
    """Stock per item on hand above one; none for products with a single one."""
    above = F.nullif(F.col("stock") - 1, F.lit(0))
    return X.products(spark, sf).select("product_id", (F.col("stock").cast("double") / above).alias("ratio"))


@query
def fn_case(spark, sf):
    outcome = F.when(CH.key_fraction("payment_id") < CH.FAILED_SHARE, "failed").otherwise("completed")
    return X.payments(spark, sf).select("payment_id", outcome.alias("outcome"))


@query
def fn_greatest(spark, sf):
    return X.products(spark, sf).select("product_id", F.greatest(F.col("stock") - 25, F.lit(0)).alias("stock"))


@query
def fn_percentage(spark, sf):
    counts = X.payments(spark, sf).groupBy("method").agg(
        F.count_if(F.col("status") == "completed").alias("completed"), F.count("*").alias("payments")
    )
    return counts.withColumn("completed_pct", M.percentage(F.col("completed"), F.col("payments")))


@query
def fn_substring(spark, sf):
    """Text cut to the width of a phone number, and a prefixed code."""
    return X.products(spark, sf).select(
        "product_id",
        F.substring("name", 1, 20).alias("short_name"),
        F.concat(F.lit("SKU-"), F.col("product_id").cast("string")).alias("sku"),
    )


# ---- table changes -------------------------------------------------------------------


@query
def insert_if_absent(spark, sf):
    """A third of the customers exist; all arrive, the even ones twice."""
    everyone = X.customers(spark, sf).select("customer_id", "email", "first_name", "last_name", "city")
    existing = everyone.where(F.col("customer_id") % 3 == 0)
    arrivals = F.when(F.col("customer_id") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    new = everyone.withColumn("arrival", F.explode(arrivals))
    return CH.insert_if_absent(new, existing, TABLES["customers"], "email", ["arrival"], X.as_of(), NEXT_VERSION)


@query
def advance_status(spark, sf):
    return CH.advance_status(X.live_orders(spark, sf, with_city=True), X.as_of(), NEXT_VERSION)


@query
def apply_stock_delta(spark, sf):
    products = X.live_products(spark, sf)
    deltas = X.table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        (F.col("p_partkey") % 76 - 15).cast("int").alias("delta"),
        (F.col("p_retailprice") * 2).alias("new_price"),
    )
    changed = CH.apply_stock_delta(products, deltas, X.as_of(), NEXT_VERSION)
    return changed.select("product_id", "price", "stock", "updated_at", "_version", "_is_deleted")


PLACE = ["shipped_at", "order_id", "line"]


def _line_deltas(spark, sf) -> DataFrame:
    """Every line takes its quantity off its product's stock, or puts it back when it was
    returned; the first line of an order gives no price."""
    back = F.col("l_returnflag") == "R"
    return X.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.when(back, F.col("l_quantity")).otherwise(-F.col("l_quantity")).cast("int").alias("delta"),
        F.when(F.col("l_linenumber") > 1, F.col("l_extendedprice")).cast(X.MONEY).alias("new_price"),
        F.col("l_shipdate").alias("shipped_at"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
    )


@query
def apply_stock_delta_ordered(spark, sf):
    """Products after all lines, one after another."""
    changed = ST.apply_stock_delta_ordered(X.live_products(spark, sf), _line_deltas(spark, sf), PLACE, X.as_of(), NEXT_VERSION)
    return changed.select("product_id", "price", "stock", "updated_at", "_version", "_is_deleted")


@query
def stock_steps(spark, sf):
    """The stock that every line leaves."""
    return ST.stock_steps(X.live_products(spark, sf), _line_deltas(spark, sf), PLACE).drop("new_price")


@query
def settle_old_payments(spark, sf):
    settled = CH.settle_old_payments(X.payments(spark, sf), X.as_of(), NEXT_VERSION)
    return settled.select("payment_id", "status", "amount", "processed_at", "_version", "_is_deleted")


@query
def expire_cancelled(spark, sf):
    return CH.expire_cancelled(X.live_orders(spark, sf, with_city=True), X.as_of(), NEXT_VERSION)


@query
def delete_restricted(spark, sf):
    """Cancelled orders go unless they are paid, which every even one is; a tenth of the
    payments are for one order."""
    doomed = CH.expired_orders(X.live_orders(spark, sf, with_city=True), X.as_of())
    order = F.col("order_id")
    paid = X.payments(spark, sf).where(order % 2 == 0).withColumn("order_id", F.when(order % 10 == 0, F.lit(2)).otherwise(order))
    gone = CH.delete_orders(doomed, X.order_items(spark, sf), paid, NEXT_VERSION)
    parts = [
        gone.orders.select(F.lit("orders").alias("table_name"), "order_id", F.col("total_amount").alias("amount")),
        gone.items.select(F.lit("order_items").alias("table_name"), "order_id", F.col("unit_price").alias("amount")),
        gone.payments.select(F.lit("payments").alias("table_name"), "order_id", "amount"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def cascade_delete(spark, sf):
    """Cancelled orders go, with their items and payments."""
    doomed = CH.expired_orders(X.live_orders(spark, sf), X.as_of())
    gone = CH.delete_orders(
        doomed, X.order_items(spark, sf), X.payments(spark, sf), NEXT_VERSION, on_payment="cascade"
    )
    parts = [
        gone.orders.select(F.lit("orders").alias("table_name"), "order_id", F.col("total_amount").alias("amount")),
        gone.items.select(F.lit("order_items").alias("table_name"), "order_id", F.col("unit_price").alias("amount")),
        gone.payments.select(F.lit("payments").alias("table_name"), "order_id", "amount"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _built(spark, sf) -> CH.NewOrders:
    """Every order of the test tables as a cart, its line items as the cart's lines."""
    orders = X.table(spark, sf, "orders")
    carts = orders.select(
        F.col("o_orderkey").alias("cart_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("city"),
        X.pick(F.col("o_custkey") % 4, X.METHODS).alias("method"),
        X.pick(F.col("o_orderstatus"), X.PAYMENT_OF_STATUS).alias("payment_status"),
        F.concat(F.lit("TX-"), F.col("o_orderkey").cast("string")).alias("transaction_ref"),
    )
    lines = X.order_items(spark, sf).select(F.col("order_id").alias("cart_id"), "product_id", "quantity")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    products = X.live_products(spark, sf)
    return CH.build_orders(carts, lines, products, X.as_of(), NEXT_VERSION, last_order=last, last_payment=last)


@query
def live_from_store(spark, sf):
    """Current orders out of a compacted changelog with one more batch waiting."""
    store = ChangelogStore(spark, work_folder(spark, "store"))
    for number, rows in _batches(X.orders_log(spark, sf, with_city=True)):
        store.append_rows({"orders": rows.drop("_batch_id")}, "log", number)
        if number == 1:
            store.compact()
    return store.live("orders")


@query
def build_orders(spark, sf):
    return _built(spark, sf).orders.drop("_seq")


@query
def build_orders_items(spark, sf):
    return _built(spark, sf).items.drop("_seq")


@query
def build_orders_payments(spark, sf):
    return _built(spark, sf).payments.drop("_seq")


@query
def apply_defaults(spark, sf):
    """Every fourth order has no status; nobody gives the time of the update."""
    orders = X.orders(spark, sf, with_city=True)
    partial = orders.withColumn("status", F.when(F.col("order_id") % 4 != 0, F.col("status"))).drop("updated_at")
    return CH.apply_defaults(partial, ORDERS, X.as_of())


@query
def assign_keys(spark, sf):
    """Orders numbered by date."""
    orders = X.orders(spark, sf).select("order_id", "created_at")
    return K.assign_keys(orders, "number", ["created_at", "order_id"], start=1000)


# ---- integrity -----------------------------------------------------------------------


def _spoiled(spark, sf) -> DataFrame:
    """Orders with planted faults."""
    number = F.col("order_id")
    return X.orders(spark, sf, with_city=True).withColumns(
        {
            "status": F.when(number % 100 == 1, "lost")
            .when(number % 100 == 2, None)
            .when(number % 100 == 3, F.repeat(F.lit("x"), 31))
            .otherwise(F.col("status")),
            "created_at": F.when(number % 100 != 4, F.col("created_at")),
            "city": F.when(number % 100 == 5, F.repeat(F.lit("y"), 101)).otherwise(F.col("city")),
        }
    )


@query
def check_unique(spark, sf):
    lines = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return Q.check_unique(lines, ["l_orderkey", "l_linenumber"])


@query
def check_unique_columns(spark, sf):
    """Customers whose e-mail was made to repeat."""
    number = F.col("customer_id")
    email = F.when(number % 10 == 0, F.concat(F.lit("x"), (number % 50).cast("string"))).otherwise(F.col("email"))
    return Q.check_unique_columns(X.customers(spark, sf).withColumn("email", email), TABLES["customers"])


@query
def check_domain(spark, sf):
    return Q.check_domain(_spoiled(spark, sf), ORDERS)


@query
def check_range(spark, sf):
    """Over-long texts in orders, and products whose stock was lowered below zero."""
    products = X.products(spark, sf).withColumns(
        {"stock": F.col("stock") - 10, "price": (F.col("price") - 950).cast(X.MONEY)}
    )
    texts = Q.check_range(_spoiled(spark, sf), ORDERS).withColumnRenamed("order_id", "key")
    return texts.unionByName(Q.check_range(products, PRODUCTS).withColumnRenamed("product_id", "key"))


@query
def check_not_null(spark, sf):
    return Q.check_not_null(_spoiled(spark, sf), ORDERS)


@query
def check_foreign_keys(spark, sf):
    """Items whose order has been deleted."""
    return Q.check_foreign_key(X.order_items(spark, sf), X.live_orders(spark, sf), "order_id", "order_id")


@query
def check_one_to_one(spark, sf):
    """Customers with no order or with several."""
    return Q.check_one_to_one(X.customers(spark, sf), X.orders(spark, sf), "customer_id")


def _faulty(spark, sf) -> dict[str, DataFrame]:
    """All tables with planted faults of every rule."""

    def every(n: int, key: str, column: str, value) -> dict:
        return {column: F.when(F.col(key) % n == 1, value).otherwise(F.col(column))}

    customers = X.customers(spark, sf).withColumns(
        every(10, "customer_id", "email", F.concat(F.lit("x"), (F.col("customer_id") % 50).cast("string")))
        | every(40, "customer_id", "first_name", F.lit(None).cast("string"))
    )
    products = X.products(spark, sf).withColumns(
        {"stock": F.col("stock") - 10, "price": (F.col("price") - 950).cast(X.MONEY)}
        | every(20, "product_id", "sku", F.lit("SKU-0"))
        | every(30, "product_id", "category_id", F.lit(999).cast("bigint"))
    )
    payments = X.payments(spark, sf).withColumns(
        every(100, "payment_id", "method", F.lit("cash"))
        | every(70, "payment_id", "status", F.lit("open"))
        | every(50, "payment_id", "transaction_ref", F.lit("TX-0"))
        | every(60, "payment_id", "order_id", F.lit(-1).cast("bigint"))
    )
    items = X.keyed_items(spark, sf).withColumns(
        every(90, "product_id", "quantity", F.lit(0)) | every(80, "product_id", "unit_price", F.lit(-1).cast(X.MONEY))
    )
    categories = X.categories(spark, sf).withColumn("name", F.when(F.col("category_id") < 20, "twice").otherwise(F.col("name")))
    orders = _spoiled(spark, sf).withColumns(every(45, "order_id", "customer_id", F.lit(-1).cast("bigint")))
    return {
        "categories": categories,
        "customers": customers,
        "products": products,
        "orders": orders,
        "order_items": items,
        "payments": payments,
    }


@query
def check_all_rules(spark, sf):
    """Value sets, bounds, lengths and uniqueness, of every table."""
    return Q.check_tables(_faulty(spark, sf))


@query
def check_all_nulls(spark, sf):
    return Q.check_nulls(_faulty(spark, sf))


@query
def check_all_references(spark, sf):
    """Rows without their parent, for all five references."""
    return Q.missing_parents(_faulty(spark, sf))


@query
def check_one_payment_per_order(spark, sf):
    """Orders without a payment or with several: every third payment is for the next order."""
    order = F.col("order_id")
    moved = X.payments(spark, sf).withColumn("order_id", F.when(order % 3 == 0, order + 1).otherwise(order))
    return Q.check_one_to_one(X.orders(spark, sf), moved, "order_id")


@query
def check_order_totals(spark, sf):
    return Q.check_order_totals(X.live_orders(spark, sf), X.order_items(spark, sf))


# ---- reconciliation ------------------------------------------------------------------


@query
def reconcile_counts(spark, sf):
    sources = {"orders": X.orders(spark, sf), "products": X.products(spark, sf)}
    targets = {"orders": X.live_orders(spark, sf), "products": X.live_products(spark, sf)}
    return R.reconcile_counts(sources, targets)


@query
def reconcile_counts_all(spark, sf):
    """Row counts of all six tables, the target's out of the store."""
    return R.reconcile_counts(X.shop_sources(spark, sf), _live_tables(spark, sf))


@query
def reconcile_diff(spark, sf):
    columns = ["customer_id", "status", "total_amount", "created_at"]
    return R.reconcile_diff(X.orders(spark, sf), X.live_orders(spark, sf), "order_id", columns)


@query
def reconcile_tree(spark, sf):
    """The same by a tree of checksums, the source's written before the comparison."""
    columns = ["customer_id", "status", "total_amount", "created_at"]
    shape = {"leaf_keys": 64, "fanout": 8, "levels": 3}
    folder = work_folder(spark, "tree")
    HT.hash_tree(X.orders(spark, sf), "order_id", columns, **shape).write.parquet(folder)
    known = spark.read.parquet(folder)
    return HT.reconcile_tree(X.orders(spark, sf), X.live_orders(spark, sf), "order_id", columns, source_tree=known, **shape)
