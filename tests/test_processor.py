"""Stateful processors: signed changes and flushes."""

import time
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybrook.streaming import processor as P

CHANGES = "id BIGINT, name STRING, _version BIGINT, _seq INT, _is_deleted INT"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def land(spark, rows, path, schema=CHANGES):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)


def signed(spark, folder, checkpoint="c", base=None):
    changes = spark.readStream.schema(CHANGES).json(f"{folder}/in")
    P.start_signed(spark, changes, "id", ["name"], f"{folder}/out", f"{folder}/{checkpoint}", checkpoint, base, once=True).awaitTermination()
    found = spark.read.parquet(f"{folder}/out")
    return sorted(((r.run, r.batch, r.id, r.name, r._sign) for r in found.collect()), key=str)


def test_old_and_new_rows_of_keys_that_move(spark, folder):
    land(spark, [(1, "a", 5, 0, 0), (1, "b", 5, 1, 0), (2, "x", 3, 0, 0), (3, "gone", 4, 0, 1), (None, "n", 1, 0, 0)], f"{folder}/in")
    first = [("c", 0, 1, "b", 1), ("c", 0, 2, "x", 1), ("c", 0, None, "n", 1)]
    assert sorted(signed(spark, folder), key=str) == sorted(first, key=str)
    # Late rows and rows before a deletion change nothing; a tie keeps the first.
    land(spark, [(1, "late", 4, 9, 0), (2, "tie", 3, 0, 0), (3, "before", 3, 0, 0)], f"{folder}/in")
    assert len(signed(spark, folder)) == 3
    land(spark, [(1, "c", 6, 0, 0), (2, None, 9, 0, 1), (3, "back", 8, 0, 0)], f"{folder}/in")
    later = [r for r in signed(spark, folder) if r[1] > 0]
    assert sorted((i, n, s) for _, _, i, n, s in later) == [(1, "b", -1), (1, "c", 1), (2, "x", -1), (3, "back", 1)]
    current = P.summed(P.read_signed(spark, f"{folder}/out")).select("id", "name").collect()
    assert sorted(map(str, current)) == sorted(["Row(id=1, name='c')", "Row(id=3, name='back')", "Row(id=None, name='n')"])


def test_a_base_is_known_from_the_start(spark, folder):
    base = spark.createDataFrame([(1, "old", 5, 0, 0), (2, "kept", 5, 0, 0), (3, "dead", 5, 0, 1)], CHANGES)
    land(spark, [(1, "new", 6, 0, 0), (2, "late", 4, 0, 0), (3, "older", 4, 0, 0), (4, "first", 1, 0, 0)], f"{folder}/in")
    found = signed(spark, folder, "with-base", base)
    assert sorted((i, n, s) for _, _, i, n, s in found) == [(1, "new", 1), (1, "old", -1), (4, "first", 1)]
    # The base is not taken again after a restart.
    land(spark, [(2, "newer", 7, 0, 0)], f"{folder}/in")
    later = [r[2:] for r in signed(spark, folder, "with-base", base) if r[1] > 0]
    assert later == [(2, "kept", -1), (2, "newer", 1)]


def waiting(n, start=0, table="t"):
    return [(table, 0, start + i, 0, f"p{start + i}", False) for i in range(n)]


def flush(spark, folder, n, once=True, seconds=3600.0):
    rows = spark.readStream.schema(P.WAITING).json(f"{folder}/in")
    query = P.start_flush(rows, f"{folder}/out", f"{folder}/c", n=n, seconds=seconds, once=once)
    if once:
        query.awaitTermination()
    return query


def left(spark, folder):
    if not Path(folder, "out").exists():
        return []
    schema = "table string, bucket int, version bigint, seq int, payload string, flush bigint, why string"
    return sorted((r.version, r.flush, r.why) for r in spark.read.schema(schema).parquet(f"{folder}/out").collect())


def test_rows_leave_by_number_and_when_closed(spark, folder):
    land(spark, waiting(7), f"{folder}/in", P.WAITING)
    flush(spark, folder, 10)
    assert left(spark, folder) == []
    land(spark, waiting(18, 7), f"{folder}/in", P.WAITING)
    flush(spark, folder, 10)
    assert left(spark, folder) == [(i, i // 10, "rows") for i in range(20)]
    land(spark, [("t", 0, None, None, None, True)], f"{folder}/in", P.WAITING)
    flush(spark, folder, 10)
    assert left(spark, folder) == [(i, i // 10, "rows" if i < 20 else "close") for i in range(25)]
    # Groups that hold nothing have nothing to close; numbers go on.
    land(spark, [("u", 3, None, None, None, True), *waiting(10, 50)], f"{folder}/in", P.WAITING)
    flush(spark, folder, 10)
    assert left(spark, folder)[25:] == [(50 + i, 3, "rows") for i in range(10)]


def test_rows_leave_by_time(spark, folder):
    land(spark, waiting(3), f"{folder}/in", P.WAITING)
    query = flush(spark, folder, 200, once=False, seconds=0.2)
    try:
        end = time.time() + 60
        while not left(spark, folder) and time.time() < end:
            time.sleep(0.5)
    finally:
        query.stop()
    assert left(spark, folder) == [(i, 0, "time") for i in range(3)]


def test_rows_of_a_batch_are_taken_in_arrays_and_leave_in_feed_order(spark, folder):
    """More rows than are let out at once, in no order, with equal places, NULLs and a version
    beyond the whole numbers that doubles have."""
    far = 2**53 + 1
    rows = [("t", 0, far + i // 2, 1, f"é{i % 2}", False) for i in range(25_000)]
    some = [("t", 0, far, None, "no place", False), ("t", 0, None, None, None, False), ("u", None, 1, 0, "x", None), (None, 7, 2, 0, "y", False)]
    ends = [("t", 0, None, None, None, True), ("u", None, None, None, None, True), (None, 7, None, None, None, True)]
    land(spark, [*reversed(rows), *some, *ends], f"{folder}/in", P.WAITING)
    flush(spark, folder, 100)
    found = spark.read.parquet(f"{folder}/out").collect()
    group = sorted((r for r in found if r.table == "t"), key=lambda r: (r.flush, r.version or 0, r.seq or 0, r.payload or ""))
    wanted = [some[1][2:5], some[0][2:5], *(r[2:5] for r in rows)]
    assert [(r.version, r.seq, r.payload) for r in group] == wanted
    assert [(r.flush, r.why) for r in group] == [(i // 100, "rows" if i < 25_000 else "close") for i in range(25_002)]
    assert [tuple(r) for r in found if r.table == "u"] == [("u", None, 1, 0, "x", 0, "close")]
    assert [tuple(r) for r in found if r.table is None] == [(None, 7, 2, 0, "y", 0, "close")]


def test_rows_of_a_group_are_not_python_objects():
    chunk = pd.DataFrame({"version": [2, 1], "no_version": [False] * 2, "seq": [0, 0], "no_seq": [False] * 2, "payload": ["b", "a"]})
    taken = P.Flush._taken(chunk)
    assert isinstance(taken, pa.Table) and taken.schema == P.ROW and taken.nbytes < 100


def test_buckets_and_closing_rows(spark):
    rows = P.closing_rows(spark, ["a", "b"], 3)
    assert rows.count() == 6 and rows.where("closing AND payload IS NULL").count() == 6
    columns = P.waiting_rows(F.lit("t"), F.col("id"), F.col("id").cast("string"), F.col("id"), F.lit(0), 4)
    found = spark.range(-2, 3).union(spark.sql("SELECT CAST(NULL AS BIGINT)")).select(*columns).collect()
    assert sorted(r.bucket for r in found) == [0, 0, 1, 2, 2, 3]
