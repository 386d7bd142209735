"""Integrity rules of all tables in one pass."""

import re

from tallybrook.operators import quality as Q
from tallybrook.schema import TABLES
from tallybrook.streaming.processor import NewestVersion

PAYMENT = "payment_id BIGINT, order_id BIGINT, amount DECIMAL(10,2), method STRING, status STRING, transaction_ref STRING, processed_at TIMESTAMP"


def test_all_rules_in_one_pass_and_every_row_counts(spark, tmp_path):
    rows = [(1, 1, "5", "cash", "completed", "T", None), (1, 1, "5", "cash", "completed", "T", None), (None, 2, "5", "paypal", "completed", None, None),
            (None, 2, "5", "cash", "completed", None, None), (3, 3, "5", "paypal", "completed", "U", None)]
    frame = spark.createDataFrame(rows, PAYMENT.replace("DECIMAL(10,2)", "STRING")).withColumn("amount", Q.F.col("amount").cast("decimal(10,2)"))
    frame.write.parquet(f"{tmp_path}/payments")
    found = Q.check_tables({"payments": spark.read.parquet(f"{tmp_path}/payments")})
    cash = [("payments", key, "method", "domain", "cash") for key in (1, 1, None)]
    twice = [("payments", None, "payment_id", "unique", "1"), ("payments", None, "transaction_ref", "unique", "T")]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, cash + twice))
    # The table is read once, for rules of every kind.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[", plan)) == 1 and TABLES["payments"].key == "payment_id"


class Value:
    def __init__(self):
        self.value, self.asked = None, []

    def exists(self):
        self.asked.append("exists")
        return self.value is not None

    def get(self):
        self.asked.append("get")
        return self.value

    def update(self, value):
        self.asked.append("update")
        self.value = value


def test_one_question_to_the_state_store_per_key(spark):
    state, row = Value(), spark.createDataFrame([(1, "a", 5, 0, 0), (1, "b", 6, 0, 0)], "id INT, name STRING, _version INT, _seq INT, _is_deleted INT").collect()
    processor = NewestVersion("id", ["name"], "")
    processor.newest = state
    assert [(r["name"], r["_sign"]) for r in processor.handleInputRows((1,), iter(row[:1]), None)] == [("a", 1)]
    assert [(r["name"], r["_sign"]) for r in processor.handleInputRows((1,), iter(row[1:]), None)] == [("a", -1), ("b", 1)]
    assert list(processor.handleInputRows((1,), iter(row[:1]), None)) == []
    assert state.asked == ["get", "update", "get", "update", "get"]
