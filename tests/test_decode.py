from datetime import datetime
from decimal import Decimal

import messages as m
import pytest
from pyspark.sql import functions as F

from tallybrook.operators import decode as d
from tallybrook.operators.live import live
from tallybrook.schema import ORDERS, PRODUCTS

NOW = datetime(2024, 6, 1)


def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def rows(spark, *payloads, spec=ORDERS, **options):
    decoded = d.decode_changes(m.frame(spark, *payloads))
    return d.change_rows(decoded, spec, **options).orderBy("_version", "_seq", "_is_deleted").collect()


def reasons(spark, *payloads):
    decoded = d.decode_changes(m.frame(spark, *payloads))
    return [r.reason for r in d.quarantine(decoded).orderBy("_version", "_seq").collect()]


def state(spark, *payloads):
    decoded = d.decode_changes(m.frame(spark, *payloads))
    return {r.order_id: r.status for r in live(d.change_rows(decoded, ORDERS), "order_id").collect()}


def test_insert_is_typed(spark):
    (row,) = rows(spark, m.insert(1, "shipped", "12345678.10"))
    assert row.total_amount == Decimal("12345678.10")
    assert row.city == "Mérida"
    assert row.created_at.replace(tzinfo=None) is not None
    assert (row._version, row._seq, row._is_deleted) == (10, 0, 0)


def test_decimals_stay_exact(spark):
    assert rows(spark, m.insert(1, total="999.90"))[0].total_amount == Decimal("999.90")


def test_offset_is_taken_to_utc(spark):
    change = m.insert(1, created="2024-05-01 10:00:00.123456-06")
    decoded = d.decode_changes(m.frame(spark, change))
    text = d.change_rows(decoded, ORDERS).select(F.col("created_at").cast("string")).first()[0]
    assert text == "2024-05-01 16:00:00.123456"


def test_malformed_payload_is_quarantined_and_empty_ones_are_not(spark):
    assert reasons(spark, "not json", "{}", '{"change":[]}') == [d.MALFORMED]
    assert rows(spark, "not json", "{}", '{"change":[]}') == []


def test_half_malformed_payload_applies_nothing(spark):
    broken = m.payload(m.insert(1))[:-1]
    assert reasons(spark, broken) == [d.MALFORMED]
    assert rows(spark, broken) == []


def test_unknown_table_and_kind_are_dropped_and_counted(spark):
    feed = m.frame(spark, m.change("insert", table="audit", values=[1], names=["id"]), m.change("truncate"))
    decoded = d.decode_changes(feed)
    counts = {r.route: r.changes for r in d.change_counts(decoded).collect()}
    assert counts == {d.UNKNOWN_TABLE: 1, d.UNKNOWN_KIND: 1}
    assert d.quarantine(decoded).count() == 0


def test_duplicate_name_takes_the_last_value(spark):
    change = m.change("insert", names=[*m.ORDER, "status"], values=[*m.order(1), "shipped"])
    assert rows(spark, change)[0].status == "shipped"


def test_missing_values_read_as_null(spark):
    change = m.change("insert", values=m.order(1)[:4])
    (row,) = rows(spark, change)
    assert row.city is None and row.created_at is None


def test_unknown_columns_are_ignored(spark):
    change = m.change("insert", names=["extra", *m.ORDER], values=["x", *m.order(1)])
    assert rows(spark, change)[0].order_id == 1


def test_update_is_completed_from_the_old_image(spark):
    old = m.order(1, "pending", "10.00")
    change = m.change("update", names=["order_id", "status"], values=[1, "shipped"], old_names=m.ORDER, old_values=old)
    (row,) = rows(spark, change)
    assert (row.status, row.total_amount, row.city) == ("shipped", Decimal("10.00"), "Mérida")


def test_update_to_null_stays_null(spark):
    new = m.order(1)
    new[4] = None
    change = m.change("update", values=new, old_names=m.ORDER, old_values=m.order(1))
    assert rows(spark, change)[0].city is None


def test_update_that_stays_incomplete_is_quarantined(spark):
    change = m.change("update", names=["order_id", "status"], values=[1, "shipped"])
    assert reasons(spark, change) == ["incomplete update"]


def test_delete_with_key_only(spark):
    (row,) = rows(spark, m.delete(5))
    assert (row.order_id, row.status, row._is_deleted) == (5, None, 1)


def test_delete_keeps_the_old_image(spark):
    change = m.change("delete", old_names=m.ORDER, old_values=m.order(5, "cancelled"))
    (row,) = rows(spark, change)
    assert (row.order_id, row.status, row._is_deleted) == (5, "cancelled", 1)


def test_key_change_moves_the_row(spark):
    moved = m.change("update", values=m.order(2, "shipped"), old_names=["order_id"], old_values=[1])
    assert state(spark, m.insert(1), moved) == {2: "shipped"}


def test_rejected_key_change_leaves_the_old_row(spark):
    moved = m.change("update", values=m.order(2, total='"n/a"'), old_names=["order_id"], old_values=[1])
    assert state(spark, m.insert(1), moved) == {1: "pending"}
    assert reasons(spark, moved) == ["bad value in total_amount"]


@pytest.mark.parametrize("value", ["123456789.00", '"n/a"'])
def test_value_that_does_not_fit_is_quarantined(spark, value):
    assert reasons(spark, m.insert(1, total=value), m.insert(2)) == ["bad value in total_amount"]
    assert [r.order_id for r in rows(spark, m.insert(1, total=value), m.insert(2))] == [2]


def test_missing_key_is_quarantined(spark):
    assert reasons(spark, m.insert(None), m.change("delete")) == ["no key", "no key"]


def test_quarantined_change_can_be_sent_again(spark):
    decoded = d.decode_changes(m.frame(spark, m.insert(1, total='"n/a"')))
    record = d.quarantine(decoded).first().record
    again = d.decode_changes(m.frame(spark, f'{{"change":[{record.replace(chr(34) + "n/a" + chr(34), "5")}]}}'))
    assert d.change_rows(again, ORDERS).first().total_amount == Decimal("5.00")


def test_missing_and_unreadable_times_become_the_batch_time(spark):
    changes = (m.insert(1, created="soon"), m.insert(2, created=None), m.delete(3))
    decoded = d.decode_changes(m.frame(spark, *changes))
    typed = d.typed_changes(decoded, ORDERS, now()).orderBy("_version")
    result = typed.select(F.col("created_at").cast("string").alias("t"), "_time_filled", "_reason").collect()
    assert [(r.t, r._time_filled, r._reason) for r in result] == [
        ("2024-06-01 00:00:00", True, None),
        ("2024-06-01 00:00:00", True, None),
        (None, False, None),
    ]


def test_insert_update_delete_insert(spark):
    assert state(spark, m.insert(1), m.update(1, "shipped"), m.delete(1), m.insert(1, "confirmed")) == {1: "confirmed"}
    assert state(spark, m.insert(1), m.delete(1)) == {}


def test_later_change_in_one_message_wins(spark):
    assert state(spark, m.payload(m.insert(1), m.update(1, "shipped"))) == {1: "shipped"}
    assert state(spark, m.payload(m.insert(1), m.delete(1))) == {}


def test_booleans(spark):
    names = PRODUCTS.column_names

    def product(key, active):
        return m.change(
            "insert", "products", names, [key, 1, "n", f"SKU-{key}", m.Raw("1.00"), 3, active, m.TIME, m.TIME]
        )

    found = rows(spark, product(1, True), product(2, False), product(3, None), spec=PRODUCTS)
    assert [r.is_active for r in found] == [True, False, None]
