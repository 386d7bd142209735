"""The business queries over a changelog store, and their approximate forms."""

import pytest

from tallybrook.plans import business
from tallybrook.schema import TABLES
from verification import fixtures as x
from verification.registry import QUERIES, plain

RUNS = {
    "q1_daily_category_revenue": lambda t: business.daily_category_revenue(t, x.as_of()),
    "q2_customer_ltv": business.customer_ltv,
    "q3_city_fulfillment": business.city_fulfillment,
    "q4_product_performance": business.product_performance,
    "q5_payment_share": business.payment_shares,
}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return x.stored_shop(spark, "/root/testdata/sf0.001", str(tmp_path_factory.mktemp("shop")))


@pytest.mark.parametrize("compacted", [False, True])
def test_store_gives_the_same_answers(spark, sf_dir, store, compacted):
    if compacted:
        store.compact()
    tables = {name: store.live(name) for name in TABLES}
    for name, run in RUNS.items():
        assert plain(run(tables)).collect() == QUERIES[name](spark, sf_dir).collect(), name


@pytest.mark.parametrize("query", [business.daily_category_revenue, business.product_performance])
def test_approximate_form_differs_in_the_count_only(spark, sf_dir, query):
    options = {"as_of": x.as_of()} if query is business.daily_category_revenue else {}
    count = "total_orders" if options else "times_ordered"
    exact = query(x.shop(spark, sf_dir), **options).collect()
    close = query(x.shop(spark, sf_dir), approximate=True, **options).collect()
    for a, b in zip(exact, close, strict=True):
        assert a.asDict() | {count: 0} == b.asDict() | {count: 0}
        assert abs(a[count] - b[count]) <= 1 + 0.15 * a[count]


def test_product_performance_shuffles_items_once(spark, sf_dir):
    """The sums per order reuse the partitioning of the join on orders."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = business.product_performance(x.shop(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("hashpartitioning(order_id") == 3  # versions, orders, items
    assert "hashpartitioning(_spread" not in plan and "hashpartitioning(product_id#" in plan
