"""Hand-written change messages."""

import json

ORDER = ["order_id", "customer_id", "status", "total_amount", "city", "created_at", "updated_at"]
TIME = "2024-05-01 10:00:00+00"


def order(order_id, status="pending", total="10.00", city="Mérida", customer=1, created=TIME, updated=TIME):
    return [order_id, customer, status, Raw(total), city, created, updated]


class Raw(str):
    """A JSON number kept digit by digit."""


def text(value):
    if isinstance(value, Raw):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{text(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(text(v) for v in value) + "]"
    return json.dumps(value, ensure_ascii=False)


def change(kind, table="orders", names=ORDER, values=None, old_names=None, old_values=None):
    record = {"kind": kind, "schema": "public", "table": table}
    if values is not None:
        record |= {"columnnames": names, "columnvalues": values}
    if old_names is not None:
        record |= {"oldkeys": {"keynames": old_names, "keyvalues": old_values}}
    return record


def insert(*values, **options):
    return change("insert", values=order(*values, **options))


def update(*values, **options):
    return change("update", values=order(*values, **options), old_names=["order_id"], old_values=[values[0]])


def delete(order_id):
    return change("delete", old_names=["order_id"], old_values=[order_id])


def payload(*changes):
    return text({"change": list(changes)})


def frame(spark, *payloads, first=10):
    """Messages at consecutive positions."""
    rows = [(first + i, p if isinstance(p, str) else payload(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "lsn BIGINT, payload STRING")
