"""Append-only versioned tables in Parquet.

    <root>/<table>/run=R/batch=N/       changes of one batch; they stay, as the history
    <root>/_quarantine/run=R/batch=N/   what of a batch could not be applied
    <root>/_decoded/run=R/batch=N/      its decoded changes, until they are in their tables
    <root>/_waiting/R.N.json            this batch is whole, for every table
    <root>/_folded/R.N.json             the same, once compaction has taken it over
    <root>/_base/<table>-<id>/          one row per key, in buckets by key
    <root>/_pointer/V.json              the base of every table, and the waiting batches
                                        that these bases hold already

Readers go by these records only, so they never see half a batch, and nothing that is
being read is overwritten. Batches may come in any order: a base names the batches it
holds one by one. The records need a file system whose rename fails if the target
exists (HDFS and local disks do; object stores need a committer that adds this).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators import decode
from tallybrook.operators.live import latest, without_deleted
from tallybrook.schema import META_COLUMNS, TABLES, TableSpec
from tallybrook.sources.files import ControlFiles
from tallybrook.sources.snapshot import snapshot_rows

SNAPSHOT_RUN = "snapshot"
SNAPSHOT_BATCH = 0

# Rows a bucket of a base is meant to hold, few enough for a task to sort them in memory;
# the number of buckets grows with the table.
ROWS_PER_BUCKET = 1_000_000
FEW_ROWS = 1000

PLACE_SCHEMA = "run STRING, batch BIGINT"
CHANGES_SCHEMA = "changes ARRAY<STRUCT<route: STRING, table_name: STRING, kind: STRING, changes: BIGINT>>"
COMMIT_SCHEMA = f"{PLACE_SCHEMA}, rows MAP<STRING, BIGINT>, quarantined BOOLEAN, times_filled BIGINT, {CHANGES_SCHEMA}"
QUARANTINE_SCHEMA = "_version BIGINT, _seq INT, _table STRING, reason STRING, record STRING"

NO_POINTER = {"version": 0, "tables": {}, "holds": []}


class ChangelogStore:
    def __init__(
        self, spark: SparkSession, root: str, rows_per_file: int = 5_000_000, rows_per_bucket: int = ROWS_PER_BUCKET
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.control = ControlFiles(spark, self.root)
        self.rows_per_file = rows_per_file
        self.rows_per_bucket = rows_per_bucket

    # ---- writing -------------------------------------------------------------------

    def _batch_path(self, table: str, run: str, batch: int) -> str:
        return f"{self.root}/{table}/run={run}/batch={batch}"

    @staticmethod
    def _record_name(run: str, batch: int) -> str:
        return f"{run}.{batch:012d}.json"

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").option("maxRecordsPerFile", self.rows_per_file).parquet(path)

    def committed(self, run: str, batch: int) -> bool:
        name = self._record_name(run, batch)
        return self.control.exists(f"_waiting/{name}") or self.control.exists(f"_folded/{name}")

    def snapshot_done(self) -> bool:
        return self.committed(SNAPSHOT_RUN, SNAPSHOT_BATCH)

    def load_snapshot(self, sources: Mapping[str, DataFrame]) -> None:
        """Copy whole source tables; the record comes last, so a broken copy is redone."""
        copies = {name: snapshot_rows(table, TABLES[name]) for name, table in sources.items()}
        self.append_rows(copies, SNAPSHOT_RUN, SNAPSHOT_BATCH)

    def run_of(self, checkpoint: str) -> str:
        """Name of the run that belongs to a stream checkpoint. Batch numbers start anew
        with a new checkpoint, and must not replace those of an older run."""
        return run_of(self.spark, checkpoint)

    def append_rows(self, changes: Mapping[str, DataFrame], run: str, batch: int) -> None:
        """Append changelog rows that are typed already, one table each, as one batch.
        The tables are written side by side."""
        if self.committed(run, batch):
            return

        def write(name: str) -> int:
            seen = Observation()
            rows = changes[name].select(*TABLES[name].column_names, *META_COLUMNS).observe(seen, F.count("*").alias("n"))
            self._write(rows, self._batch_path(name, run, batch))
            return seen.get["n"]

        with ThreadPoolExecutor(max_workers=4) as pool:
            rows = dict(zip(changes, pool.map(write, changes)))
        self._commit(run, batch, {"rows": rows})

    def _commit(self, run: str, batch: int, record: dict) -> None:
        self.control.create(f"_waiting/{self._record_name(run, batch)}", {"run": run, "batch": batch} | record)

    def append_messages(self, messages: DataFrame, run: str, batch: int, ingest_time: C | None = None) -> None:
        """Decode one batch of messages and append it to every table it touches.

        A batch that comes again after its commit is left alone; one that broke before
        its commit is written again to the same folders.
        """
        if self.committed(run, batch):
            return
        if ingest_time is None:
            # One value for the whole batch, whichever task or retry evaluates it.
            now = self.spark.sql("SELECT unix_micros(current_timestamp())").first()[0]
            ingest_time = F.timestamp_micros(F.lit(now))
        # Decoded once and read for every table: in files they are a fraction of what they are
        # in memory, where a task would read as much of them as a split of messages makes.
        place = self._batch_path("_decoded", run, batch)
        changes = decode.decode_changes(messages)
        self._write(changes, place)
        decoded = self.spark.read.schema(changes.schema).parquet(place)
        try:
            # At most one row per table and kind, and a few for dropped changes.
            counts = decode.change_counts(decoded).collect()
            touched = sorted({c.table_name for c in counts if c.route == decode.APPLIED})
            broken = sum(c.changes for c in counts if c.route in decode.QUARANTINED)

            def write(name: str) -> dict:
                spec = TABLES[name]
                typed = decode.typed_changes(decoded, spec, ingest_time)
                seen = Observation()
                good = F.col("_reason").isNull()
                observed = typed.select(*spec.column_names, *META_COLUMNS, "_reason", "_time_filled").observe(
                    seen,
                    F.count_if(good).alias("good"),
                    F.count_if(~good).alias("bad"),
                    F.count_if(good & F.col("_time_filled")).alias("filled"),
                )
                self._write(observed.where(good).drop("_reason", "_time_filled"), self._batch_path(name, run, batch))
                return seen.get

            with ThreadPoolExecutor(max_workers=4) as pool:
                seen = dict(zip(touched, pool.map(write, touched)))
            rejecting = [name for name, s in seen.items() if s["bad"]]
            broken += sum(s["bad"] for s in seen.values())
            if broken:
                self._write(decode.quarantine(decoded, rejecting), self._batch_path("_quarantine", run, batch))
        finally:
            self.control.delete(place.removeprefix(f"{self.root}/"))
        self._commit(
            run,
            batch,
            {
                "rows": {name: s["good"] for name, s in seen.items()},
                "quarantined": broken > 0,
                "times_filled": sum(s["filled"] for s in seen.values()),
                "changes": [c.asDict() for c in counts],
            },
        )

    # ---- reading -------------------------------------------------------------------

    def _state(self) -> tuple[dict, dict[str, dict]]:
        """The newest pointer, and the records of the waiting batches it does not hold.

        The batches are listed before the pointer is read: one that compaction takes over
        in between is then in the pointer, and one that it has moved away is listed still.
        """
        listed = self.control.names("_waiting")
        pointers = self.control.names("_pointer")
        pointer = self.control.read(f"_pointer/{pointers[-1]}") if pointers else NO_POINTER
        waiting = sorted(set(listed) - set(pointer["holds"]))
        with ThreadPoolExecutor(max_workers=16) as pool:
            return pointer, dict(zip(waiting, pool.map(self._record, waiting)))

    def _record(self, name: str) -> dict:
        place = "_waiting" if self.control.exists(f"_waiting/{name}") else "_folded"
        return self.control.read(f"{place}/{name}")

    def waiting(self) -> int:
        """How many batches no base holds yet; readers read one record for each."""
        return len(self._state()[1])

    def commits(self) -> DataFrame:
        """One row per committed batch."""
        folders = [f"{self.root}/{f}" for f in ("_waiting", "_folded") if self.control.names(f)]
        if not folders:
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        # A record that is just being moved may show twice.
        return self.spark.read.schema(COMMIT_SCHEMA).json(folders).dropDuplicates(["run", "batch"])

    def change_counts(self) -> DataFrame:
        """Changes per batch, table and kind, as they were decoded."""
        return self.commits().select("run", "batch", F.inline("changes"))

    def _waiting_changes(self, table: str, waiting: dict[str, dict]) -> DataFrame | None:
        spec = TABLES[table]
        paths = [self._batch_path(table, r["run"], r["batch"]) for r in waiting.values() if r["rows"].get(table)]
        if not paths:
            return None
        rows = self.spark.read.schema(spec.changelog_schema).option("basePath", f"{self.root}/{table}").parquet(*paths)
        return rows.select(*spec.column_names, *META_COLUMNS)

    def history(self, table: str) -> DataFrame:
        """All versions of all batches, with the batch they came in."""
        spec = TABLES[table]
        if not self.control.exists(table):
            return self.spark.createDataFrame([], f"{spec.changelog_schema}, _run STRING, _batch_id BIGINT")
        rows = self.spark.read.schema(f"{spec.changelog_schema}, {PLACE_SCHEMA}").parquet(f"{self.root}/{table}")
        whole = rows.join(self.commits().select("run", "batch"), ["run", "batch"], "left_semi")
        return whole.select(*spec.column_names, *META_COLUMNS, F.col("run").alias("_run"), F.col("batch").alias("_batch_id"))

    def _base_name(self, place: str) -> str:
        return f"base_{place.replace('-', '_')}"

    def _base(self, table: str, pointer: dict) -> DataFrame | None:
        """The table's base as a bucketed table: Spark then knows how it is laid out."""
        entry = pointer["tables"].get(table)
        if entry is None:
            return None
        name, spec = self._base_name(entry["place"]), TABLES[table]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({spec.changelog_schema}) USING parquet "
            f"CLUSTERED BY ({spec.key}) SORTED BY ({spec.key}) INTO {entry['buckets']} BUCKETS "
            f"LOCATION '{self.root}/_base/{entry['place']}'"
        )
        return self.spark.table(name)

    def newest(self, table: str, immutable: C | None = None) -> DataFrame:
        """Newest version per key, tombstones included.

        The base holds one row per key already, in buckets by key. Waiting changes are
        collapsed and joined to it: the base is read once and not shuffled, however many
        changes wait. ``immutable`` is a predicate on columns that never change for a
        key; it reaches every scan. Tombstones always pass it.
        """
        pointer, waiting = self._state()
        return self._newest(table, pointer, waiting, immutable)

    def _newest(self, table: str, pointer: dict, waiting: dict[str, dict], immutable: C | None = None) -> DataFrame:
        spec = TABLES[table]
        base, changes = self._base(table, pointer), self._waiting_changes(table, waiting)
        if base is not None and immutable is not None:
            base = base.where(immutable | (F.col("_is_deleted") == 1))
        if changes is None:
            return base if base is not None else self.spark.createDataFrame([], spec.changelog_schema)
        fresh = latest(changes, spec.key, immutable)
        if base is None:
            return fresh
        return merged(base, fresh, spec, pointer["tables"][table]["buckets"])

    def live(self, table: str, immutable: C | None = None) -> DataFrame:
        rows = without_deleted(self.newest(table, immutable))
        if immutable is not None:
            rows = rows.where(immutable)
        return rows.drop(*META_COLUMNS)

    def lookup(self, table: str, value) -> DataFrame:
        """Current row of one key: of the base, only the key's bucket is read."""
        spec = TABLES[table]
        pointer, waiting = self._state()
        found = [self._base(table, pointer), self._waiting_changes(table, waiting)]
        mine = [rows.where(F.col(spec.key) == value) for rows in found if rows is not None]
        if not mine:
            return self.spark.createDataFrame([], spec.changelog_schema).drop(*META_COLUMNS)
        versions = mine[0] if len(mine) == 1 else mine[0].unionByName(mine[1])
        return without_deleted(latest(versions, spec.key)).drop(*META_COLUMNS)

    def register_views(self, prefix: str = "") -> None:
        """Temporary views over the current state of every table, for queries in SQL.
        A view shows the state at this moment."""
        for name in TABLES:
            self.live(name).createOrReplaceTempView(prefix + name)

    def quarantine(self) -> DataFrame:
        """Everything that could not be applied, of all committed batches."""
        if not self.control.exists("_quarantine"):
            return self.spark.createDataFrame([], QUARANTINE_SCHEMA)
        rows = self.spark.read.schema(f"{QUARANTINE_SCHEMA}, {PLACE_SCHEMA}").parquet(f"{self.root}/_quarantine")
        return rows.join(self.commits().select("run", "batch"), ["run", "batch"], "left_semi").drop("run", "batch")

    # ---- compaction ----------------------------------------------------------------

    def compact(self) -> None:
        """Fold the waiting batches into new bases; one pointer record makes them count.

        A table without waiting changes keeps its base. Tombstones stay: without them a
        change that arrives late could bring a deleted row back. Of two compactions at
        once the second to finish fails and changes nothing.
        """
        pointer, waiting = self._state()
        self._move_folded(pointer)
        if not waiting:
            return
        version = pointer["version"] + 1

        def fold(table: str) -> dict | None:
            if self._waiting_changes(table, waiting) is None:
                return pointer["tables"].get(table)
            spec, was = TABLES[table], pointer["tables"].get(table)
            fresh = sum(r["rows"].get(table, 0) for r in waiting.values())
            buckets = self._buckets((was["rows"] if was else 0) + fresh)
            if was is None:
                rows = self._first_base(table, waiting, buckets)
            else:
                rows = self._newest(table, pointer, waiting)
                if was["buckets"] != buckets:
                    rows = rows.repartition(buckets, spec.key)
            # Otherwise the join above has left every bucket in a task of its own.
            place = f"{table}-{uuid.uuid4().hex}"
            seen = Observation()
            (
                rows.select(*spec.column_names, *META_COLUMNS)
                .observe(seen, F.count("*").alias("n"))
                .write.format("parquet")
                .bucketBy(buckets, spec.key)
                .sortBy(spec.key)
                .option("path", f"{self.root}/_base/{place}")
                .saveAsTable(self._base_name(place))
            )
            return {"place": place, "buckets": buckets, "rows": seen.get["n"]}

        with ThreadPoolExecutor(max_workers=4) as pool:
            entries = dict(zip(TABLES, pool.map(fold, TABLES)))
        now = {
            "version": version,
            "tables": {name: entry for name, entry in entries.items() if entry},
            "holds": sorted({*waiting, *pointer["holds"]} & set(self.control.names("_waiting"))),
        }
        self.control.create(f"_pointer/{version:012d}.json", now)
        self._move_folded(now)
        self._drop_replaced(now, pointer)

    def _first_base(self, table: str, waiting: dict[str, dict], buckets: int) -> DataFrame:
        """Newest versions, dealt over the buckets of a table that has no base. A snapshot has
        a row per key: it is dealt out once, as it is, and collapsed where it arrives. Changes
        may have hot keys, and are collapsed ahead of that."""
        key = TABLES[table].key
        copied = {name: r for name, r in waiting.items() if r["run"] == SNAPSHOT_RUN}
        changed = {name: r for name, r in waiting.items() if name not in copied}
        copy, changes = self._waiting_changes(table, copied), self._waiting_changes(table, changed)
        if copy is None:
            return latest(changes, key).repartition(buckets, key)
        rows = copy if changes is None else copy.unionByName(latest(changes, key))
        return latest(rows.repartition(buckets, key), key)

    def _buckets(self, rows: int) -> int:
        """As many as the rows need; for few rows, as many as tasks run well side by side."""
        side_by_side = min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), rows // FEW_ROWS)
        return max(1, math.ceil(rows / self.rows_per_bucket), side_by_side)

    def _move_folded(self, pointer: dict) -> None:
        """Records that the pointer holds need not be listed by readers any more."""
        for name in pointer["holds"]:
            if self.control.exists(f"_waiting/{name}"):
                self.control.move(f"_waiting/{name}", f"_folded/{name}")

    def _drop_replaced(self, now: dict, before: dict) -> None:
        """Bases older than the last pointer's; readers that have just begun use that one."""
        kept = {e["place"] for p in (now, before) for e in p["tables"].values()}
        for name in self.control.names("_pointer"):
            if int(name.removesuffix(".json")) < before["version"]:
                for entry in self.control.read(f"_pointer/{name}")["tables"].values():
                    if entry["place"] not in kept:
                        self.spark.sql(f"DROP TABLE IF EXISTS {self._base_name(entry['place'])}")
                        self.control.delete(f"_base/{entry['place']}")
                self.control.delete(f"_pointer/{name}")


def merged(base: DataFrame, fresh: DataFrame, spec: TableSpec, buckets: int) -> DataFrame:
    """Per key the newer of two rows, out of tables with one row per key each. The fresh
    rows are dealt out as the base is, so that Spark has no reason to deal that anew."""
    columns = [*spec.column_names, *META_COLUMNS]
    new = fresh.repartition(buckets, spec.key).select(*[F.col(c).alias(f"_new_{c}") for c in columns])
    key = spec.key
    both = base.select(*columns).join(new.hint("shuffle_hash"), F.col(key) == F.col(f"_new_{key}"), "full_outer")
    newer = F.struct("_new__version", "_new__seq") > F.struct("_version", "_seq")
    take = F.col(key).isNull() | (F.col(f"_new_{key}").isNotNull() & newer)
    return both.select(*[F.when(take, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns])


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """A name that belongs to a stream checkpoint and to no other."""
    beside = ControlFiles(spark, checkpoint)
    if not beside.exists("run.json"):
        beside.create("run.json", {"run": uuid.uuid4().hex})
    return beside.read("run.json")["run"]
