"""Time the headline queries: one JSON line, total and per query.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of cores. The tables are put into a
changelog store, as a snapshot and two batches of changes, and the store is compacted; the
five business queries run on its current state and make up the total. They run again
while a batch of changes waits. The other figures are the steps around them: loading, compaction, decoding and ingesting a landed feed, state
out of versions, and reconciliation. Everything is warmed up, the queries four times and
the steps once, and then run five and three times, of which the median counts; results are
fully computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.operators import decode
from tallybrook.operators.reconcile import reconcile_diff
from tallybrook.plans import business
from tallybrook.schema import ORDERS, TABLES
from tallybrook.session import local_session, work_folder
from tallybrook.sources.changelog import ChangelogStore
from tallybrook.sources.feed import read_messages, stream_messages
from tallybrook.streaming.ingest import start_ingest
from verification import fixtures

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def median_seconds(run: Callable[[], object], runs: int = 3, warm_up: int = 1) -> float:
    def once() -> float:
        start = time.perf_counter()
        run()
        return time.perf_counter() - start

    for _ in range(warm_up):
        once()
    return round(statistics.median(once() for _ in range(runs)), 3)


def compute(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(cores=CPUS, **{"spark.ui.showConsoleProgress": "false"})
    stores: list[ChangelogStore] = []

    def load() -> None:
        stores.append(fixtures.stored_shop(spark, SF_DIR, work_folder(spark, "bench")))

    loading = median_seconds(load)
    versions = stores.pop()
    compacting = []
    for store in stores:
        start = time.perf_counter()
        store.compact()
        compacting.append(time.perf_counter() - start)
    store = stores[0]

    def questions(tables: dict[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
        return {
            "q1": lambda: business.daily_category_revenue(tables, fixtures.as_of()),
            "q2": lambda: business.customer_ltv(tables),
            "q3": lambda: business.city_fulfillment(tables),
            "q4": lambda: business.product_performance(tables),
            "q5": lambda: business.payment_shares(tables),
        }

    recent = F.col("created_at") >= fixtures.as_of() - F.expr(business.RECENT)

    def timed(state: ChangelogStore, suffix: str = "") -> dict[str, float]:
        tables = {name: state.live(name) for name in TABLES}
        asked = questions(tables) | {"q1": questions(tables | {"orders": state.live("orders", recent)})["q1"]}
        return {name + suffix: median_seconds(lambda q=query: compute(q()), 5, 4) for name, query in asked.items()}

    times = timed(store)
    total = sum(times.values())
    tables = {name: store.live(name) for name in TABLES}
    # The same with one order in 700 changed since the compaction.
    changed = fixtures.orders_log(spark, SF_DIR, with_city=True).where("_version = 1 AND order_id % 700 = 0")
    store.append_rows({"orders": changed.withColumn("_version", F.lit(9).cast("bigint")).drop("_batch_id")}, "bench", 0)
    times |= timed(store, "_waiting")

    folder = work_folder(spark, "bench-feed")
    fixtures.messages(spark, SF_DIR).repartition(CPUS).write.json(f"{folder}/feed")

    def ingest() -> None:
        target = work_folder(spark, "bench-ingest")
        feed = stream_messages(spark, f"{folder}/feed")
        start_ingest(spark, feed, f"{target}/tables", f"{target}/checkpoint", once=True).awaitTermination()

    def decoded() -> DataFrame:
        return decode.change_rows(decode.decode_changes(read_messages(spark, f"{folder}/feed")), ORDERS)

    source = fixtures.orders(spark, SF_DIR, with_city=True)
    compared = ["customer_id", "status", "total_amount", "city", "created_at"]
    times |= {
        "load_tables": loading,
        "compact_tables": round(statistics.median(compacting), 3),
        "versions_to_state": median_seconds(lambda: compute(versions.live("orders"))),
        "decode_feed": median_seconds(lambda: compute(decoded())),
        "ingest_feed": median_seconds(ingest),
        "reconcile_diff": median_seconds(lambda: compute(reconcile_diff(source, tables["orders"], "order_id", compared))),
    }
    print(
        json.dumps(
            {
                "metric": "business_queries_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
