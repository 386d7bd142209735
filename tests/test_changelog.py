import messages as m
import pytest
from pyspark.sql import functions as F

from tallybrook.operators import decode as d
from tallybrook.schema import ORDERS, TABLES
from tallybrook.sources.changelog import ChangelogStore
from tallybrook.sources.feed import read_messages, stream_messages
from tallybrook.streaming.ingest import start_ingest
from tallybrook.streaming.state import read_latest, start_latest

FIRST = (m.insert(1), m.insert(2), m.insert(3), m.insert(4))
SECOND = (m.update(1, "shipped"), m.delete(2))
THIRD = (m.delete(3), m.insert(2, "confirmed"), m.insert(5))
EXPECTED = {1: "shipped", 2: "confirmed", 4: "pending", 5: "pending"}


def land(spark, folder, *payloads, first=10):
    m.frame(spark, *payloads, first=first).coalesce(1).write.mode("append").json(f"{folder}/feed")


def ingest(spark, folder, files=100, **options):
    feed = stream_messages(spark, f"{folder}/feed", files_per_trigger=files)
    start_ingest(spark, feed, f"{folder}/tables", f"{folder}/checkpoint", once=True, **options).awaitTermination()
    return ChangelogStore(spark, f"{folder}/tables")


def statuses(frame):
    return {r.order_id: r.status for r in frame.collect()}


def filled(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path))
    for batch, changes in enumerate((FIRST, SECOND, THIRD)):
        store.append_messages(m.frame(spark, *changes, first=10 * (batch + 1)), "run", batch)
    return store


def test_history_and_live(spark, tmp_path):
    store = filled(spark, tmp_path)
    assert store.history("orders").count() == 9
    assert {r._batch_id for r in store.history("orders").collect()} == {0, 1, 2}
    assert statuses(store.live("orders")) == EXPECTED
    assert store.live("products").count() == 0
    assert statuses(store.lookup("orders", 1)) == {1: "shipped"} and store.lookup("products", 1).count() == 0


def test_committed_batch_is_not_written_again(spark, tmp_path):
    store = filled(spark, tmp_path)
    store.append_messages(m.frame(spark, m.insert(9)), "run", 2)
    assert statuses(store.live("orders")) == EXPECTED


def test_uncommitted_batch_is_not_read_and_is_replaced(spark, tmp_path):
    store = filled(spark, tmp_path)
    half = d.change_rows(d.decode_changes(m.frame(spark, m.insert(8))), ORDERS)
    half.write.parquet(f"{tmp_path}/orders/run=run/batch=3")
    assert statuses(store.live("orders")) == EXPECTED
    store.append_messages(m.frame(spark, m.insert(9), first=90), "run", 3)
    assert statuses(store.live("orders")) == EXPECTED | {9: "pending"}


def test_batch_numbers_of_two_runs_do_not_collide(spark, tmp_path):
    store = filled(spark, tmp_path)
    store.append_messages(m.frame(spark, m.insert(9), first=90), "other", 0)
    assert statuses(store.live("orders")) == EXPECTED | {9: "pending"}


@pytest.mark.parametrize(
    "order, compact_after, per_bucket",
    [((0, 1, 2), (0, 1, 2), 1), ((0, 1, 2), (1,), 1000), ((2, 0, 1), (0,), 1), ((1, 2, 0), (0, 1), 1000)],
)
def test_compaction_changes_nothing(spark, tmp_path, order, compact_after, per_bucket):
    store = ChangelogStore(spark, str(tmp_path), rows_per_bucket=per_bucket)
    for place, batch in enumerate(order):
        changes = (FIRST, SECOND, THIRD)[batch]
        store.append_messages(m.frame(spark, *changes, first=10 * (batch + 1)), "run", batch)
        if place in compact_after:
            store.compact()
            store.compact()
            assert store.waiting() == 0
    newest = store.newest("orders")
    assert statuses(newest.where("_is_deleted = 0")) == EXPECTED
    assert newest.count() == 5
    assert store.history("orders").count() == 9
    assert statuses(store.lookup("orders", 2)) == {2: "confirmed"} and statuses(store.lookup("orders", 3)) == {}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_base_is_read_once_and_not_shuffled(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path), rows_per_bucket=1)
    store.append_messages(m.frame(spark, *FIRST), "run", 0)
    store.compact()
    assert "Exchange" not in plan_of(store.newest("orders"))
    store.append_messages(m.frame(spark, *SECOND, first=20), "run", 1)
    recent = F.col("created_at") >= F.lit("2020-01-01").cast("timestamp")
    plan = plan_of(store.live("orders", immutable=recent))
    initial = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    scans = [line for line in initial.splitlines() if "base_orders" in line and "FileScan" in line]
    assert len(scans) == 1 and "Bucketed: true" in scans[0] and "created_at" in scans[0].split("DataFilters")[1]
    # Of both sides only the waiting changes go through a shuffle.
    assert "FullOuter" in initial
    assert "Exchange" not in initial[initial.index("FullOuter") : initial.index("base_orders")]


def test_reader_between_pointer_and_move_sees_everything_once(spark, tmp_path):
    store = filled(spark, tmp_path)
    moved = store._move_folded
    store._move_folded = lambda pointer: None
    store.compact()
    assert statuses(store.live("orders")) == EXPECTED and store.newest("orders").count() == 5
    assert store.commits().count() == 3 and store.waiting() == 0
    store._move_folded = moved
    store.append_messages(m.frame(spark, m.delete(1), first=90), "run", 3)
    store.compact()
    assert store.control.names("_waiting") == [] and len(store.control.names("_folded")) == 4
    assert statuses(store.live("orders")) == {k: v for k, v in EXPECTED.items() if k != 1}


def test_second_of_two_compactions_changes_nothing(spark, tmp_path):
    store, other = filled(spark, tmp_path), ChangelogStore(spark, str(tmp_path))
    before = other._state()
    store.compact()
    other._state = lambda: before
    with pytest.raises(FileExistsError):
        other.compact()
    assert statuses(ChangelogStore(spark, str(tmp_path)).live("orders")) == EXPECTED


def test_replaced_bases_go(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path))
    for batch in range(5):
        store.append_messages(m.frame(spark, m.update(1, f"s{batch}"), first=10 * (batch + 1)), "run", batch)
        store.compact()
    assert len(list((tmp_path / "_base").iterdir())) == 2
    assert len(store.control.names("_pointer")) == 2


def test_late_change_loses_against_compacted_tombstone(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path))
    store.append_messages(m.frame(spark, m.insert(1), m.delete(1), first=50), "run", 0)
    store.compact()
    store.append_messages(m.frame(spark, m.update(1, "shipped"), first=20), "run", 1)
    assert statuses(store.live("orders")) == {}
    store.compact()
    assert statuses(store.live("orders")) == {}


def test_quarantine_is_stored(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path))
    store.append_messages(m.frame(spark, "not json", m.insert(1, total='"n/a"'), m.insert(2)), "run", 0)
    assert sorted(r.reason for r in store.quarantine().collect()) == ["bad value in total_amount", d.MALFORMED]
    assert statuses(store.live("orders")) == {2: "pending"}
    store.compact()
    assert store.quarantine().count() == 2
    assert {(r.batch, r.route, r.kind, r.changes) for r in store.change_counts().collect()} == {
        (0, d.APPLIED, "insert", 2),
        (0, d.MALFORMED, None, 1),
    }


def test_nothing_vanishes_without_a_trace(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " "), (4, '{"change":[null]}'), (5, '{"change":[]}'), (None, m.payload(m.insert(7)))]
    store = ChangelogStore(spark, str(tmp_path))
    store.append_messages(spark.createDataFrame(rows, "lsn BIGINT, payload STRING"), "run", 0)
    found = sorted((r._version or 0, r.reason) for r in store.quarantine().collect())
    assert found == [(0, d.NO_POSITION), *[(n, d.MALFORMED) for n in (1, 2, 3, 4)]]
    assert store.live("orders").count() == 0


def test_broken_lines_of_a_feed_reach_the_quarantine(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    good = m.frame(spark, m.insert(1)).toJSON().first()
    (tmp_path / "feed" / "a.json").write_text(f"{good}\nnot a line\n{{\"lsn\": \"x\", \"payload\": \"y\"}}\n")
    store = ingest(spark, str(tmp_path))
    assert statuses(store.live("orders")) == {1: "pending"}
    records = {r.record for r in store.quarantine().collect()}
    assert len(records) == 2 and "not a line" in records


def test_views_show_the_stored_state(spark, tmp_path):
    store = filled(spark, tmp_path)
    store.compact()
    store.register_views("seen_")
    rows = spark.sql("SELECT order_id, status FROM seen_orders").collect()
    assert {r.order_id: r.status for r in rows} == EXPECTED
    assert spark.sql("SELECT count(*) AS n FROM seen_payments").first().n == 0


def test_times_filled_are_counted(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path))
    store.append_messages(m.frame(spark, m.insert(1, created="soon"), m.insert(2)), "run", 0)
    commit = store.control.read("_waiting/run.000000000000.json")
    assert commit["times_filled"] == 1 and commit["rows"] == {"orders": 2}
    assert store.live("orders").where("created_at IS NULL").count() == 0


def snapshot(spark):
    rows = [(1, 1, "pending", 5, "León"), (7, 1, "pending", 5, "León")]
    orders = spark.createDataFrame(rows, "order_id INT, customer_id INT, status STRING, total_amount INT, city STRING")
    return {"orders": orders.withColumns({c: F.current_timestamp() for c in ("created_at", "updated_at")})}


def test_stream_fans_out_and_resumes(spark, tmp_path):
    folder = str(tmp_path)
    payment = m.change(
        "insert", "payments",
        ["payment_id", "order_id", "amount", "method", "status", "transaction_ref", "processed_at"],
        [1, 1, m.Raw("5.00"), "paypal", "refunded", None, m.TIME],
    )
    land(spark, folder, m.payload(FIRST[0], payment), *FIRST[1:])
    land(spark, folder, *SECOND, first=20)
    store = ingest(spark, folder, files=1, snapshot=snapshot(spark))
    assert store.live("payments").first().status == "refunded"
    assert store.commits().count() == 3
    land(spark, folder, *THIRD, first=30)
    store = ingest(spark, folder, files=1, snapshot=snapshot(spark))
    assert statuses(store.live("orders")) == EXPECTED | {7: "pending"}
    assert store.commits().where("run = 'snapshot'").count() == 1


def test_broken_snapshot_is_taken_again(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path))
    broken = snapshot(spark) | {"payments": spark.createDataFrame([(1,)], "payment_id INT")}
    with pytest.raises(Exception):
        store.load_snapshot(broken)
    assert not store.snapshot_done()
    store.load_snapshot(snapshot(spark))
    assert store.snapshot_done() and store.live("orders").count() == 2


def test_new_checkpoint_gets_a_new_run(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path))
    one = store.run_of(f"{tmp_path}/one")
    assert store.run_of(f"{tmp_path}/one") == one != store.run_of(f"{tmp_path}/two")


def test_stateful_stream_agrees_with_the_changelog(spark, tmp_path):
    folder = str(tmp_path)
    for i, changes in enumerate((FIRST, SECOND, THIRD)):
        land(spark, folder, *changes, first=10 * (i + 1))
    feed = stream_messages(spark, f"{folder}/feed", files_per_trigger=1)
    changes = d.change_rows(d.decode_changes(feed), ORDERS)
    start_latest(
        spark, changes, "order_id", ["status"], f"{folder}/state", f"{folder}/check", once=True
    ).awaitTermination()
    newest = read_latest(spark, f"{folder}/state", "order_id")
    assert statuses(newest.where("_is_deleted = 0")) == EXPECTED
    assert read_messages(spark, f"{folder}/feed").count() == 9


def test_new_checkpoint_keeps_the_state_of_the_old_one(spark, tmp_path):
    folder = str(tmp_path)
    for run, changes in enumerate((FIRST, SECOND + THIRD)):
        m.frame(spark, *changes, first=10 * (run + 1)).write.json(f"{folder}/feed-{run}")
        feed = d.change_rows(d.decode_changes(stream_messages(spark, f"{folder}/feed-{run}")), ORDERS)
        start_latest(spark, feed, "order_id", ["status"], f"{folder}/state", f"{folder}/check-{run}", once=True).awaitTermination()
    newest = read_latest(spark, f"{folder}/state", "order_id")
    assert statuses(newest.where("_is_deleted = 0")) == EXPECTED


def test_ingest_compacts_when_enough_batches_wait(spark, tmp_path):
    folder = str(tmp_path)
    for i, changes in enumerate((FIRST, SECOND, THIRD)):
        land(spark, folder, *changes, first=10 * (i + 1))
    store = ingest(spark, folder, files=1, compact_after=2)
    assert store.waiting() == 1 and statuses(store.live("orders")) == EXPECTED


def test_a_snapshot_is_dealt_out_once_and_a_late_change_counts(spark, tmp_path, capsys):
    store = ChangelogStore(spark, str(tmp_path))
    rows = [(k, f"c{k}") for k in (1, 2, 3, 3, None, None)]
    source = spark.createDataFrame(rows, "category_id BIGINT, name STRING")
    missing = [f"CAST(NULL AS {c.type}) AS {c.name}" for c in TABLES["categories"].columns if c.name not in source.columns]
    source = source.selectExpr("*", *missing)
    store.load_snapshot({"categories": source})
    first = store._first_base("categories", store._state()[1], 4)
    first.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    change = source.where("category_id = 2").selectExpr("*", "5L AS _version", "0 AS _seq", "1 AS _is_deleted")
    store.append_rows({"categories": change}, "changes", 0)
    store.compact()
    found = {(r.category_id, r._is_deleted) for r in store.newest("categories").collect()}
    assert found == {(1, 0), (2, 1), (3, 0), (None, 0)}
    assert store.newest("categories").count() == 4


def test_decoded_changes_are_read_from_files_until_the_commit(spark, tmp_path, monkeypatch):
    from tallybrook.operators import decode

    store, counts, read = ChangelogStore(spark, str(tmp_path)), decode.change_counts, []
    monkeypatch.setattr(decode, "change_counts", lambda decoded: read.extend(decoded.inputFiles()) or counts(decoded))
    store.append_messages(m.frame(spark, "not json", m.insert(1), m.insert(2)), "run", 0)
    assert read and all("/_decoded/run=run/batch=0/" in f for f in read)
    assert not (tmp_path / "_decoded/run=run/batch=0").exists()
    assert store.live("orders").count() == 2 and store.quarantine().count() == 1
