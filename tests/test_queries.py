"""Every registered query against DuckDB, over whole tables."""

import pytest

import __spark_entry__ as entry
from verification.compare import differences, open_oracle
from verification.oracle import ORACLE
from verification.registry import QUERIES

# Answers without an SQL form: a random sample and an approximate count.
UNCHECKED = {"sample_n", "agg_approx_distinct"}


@pytest.fixture(scope="module")
def oracle(spark):
    connection = open_oracle("/root/testdata/sf0.001")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, oracle, sf_dir, name):
    assert differences(spark, oracle, name, sf_dir) is None


def test_only_the_unchecked_have_no_sql():
    assert set(QUERIES) - set(ORACLE) == UNCHECKED
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 49


def test_sample_size(spark, sf_dir):
    rows = entry.queries()["sample_n"](spark, sf_dir).collect()
    assert len({r.order_id for r in rows}) == 15


def test_approximate_count_is_close(spark, sf_dir):
    exact = {r.status: r.orders for r in entry.queries()["agg_count_distinct"](spark, sf_dir).collect()}
    close = {r.status: r.orders for r in entry.queries()["agg_approx_distinct"](spark, sf_dir).collect()}
    assert exact.keys() == close.keys()
    assert all(abs(close[s] - n) <= 3 * 0.05 * n for s, n in exact.items())
