"""Change messages to changelog rows.

A message is ``(lsn, payload)``; the payload is a JSON document with a list ``change``
of inserts, updates and deletes. All of it is column expressions: a message that does
not parse or a value that does not fit never fails a job, it ends up in quarantine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.typing import completed, has_name, in_order, is_null_value, named_value, typed_value
from tallybrook.schema import META_COLUMNS, TABLES, Column, TableSpec

# The message envelope and its change kinds.
KINDS = ("insert", "update", "delete")
CHANGE_TYPE = (
    "STRUCT<kind: STRING, table: STRING, columnnames: ARRAY<STRING>, columnvalues: ARRAY<VARIANT>, "
    "oldkeys: STRUCT<keynames: ARRAY<STRING>, keyvalues: ARRAY<VARIANT>>>"
)
# Variants keep decimals exact; strings would pass JSON numbers through double.
ENVELOPE = f"change ARRAY<{CHANGE_TYPE}>, _corrupt_record STRING"

MALFORMED = "malformed message"
NO_POSITION = "no position"
UNKNOWN_TABLE = "unknown table"
UNKNOWN_KIND = "unknown kind"
APPLIED = "applied"

# Dropped changes that are kept for inspection; other tables and kinds are not ours.
QUARANTINED = (MALFORMED, NO_POSITION)


def decode_changes(messages: DataFrame) -> DataFrame:
    """One row per change in message order, and one row per malformed message: one that is
    not JSON, is empty or NULL, or has neither a position nor changes; and one per change
    that is null."""
    parsed = messages.select(
        "lsn",
        "payload",
        F.from_json("payload", ENVELOPE, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("m"),
    )
    lost = F.col("lsn").isNull() & F.col("m.change").isNull()
    bad = F.col("m._corrupt_record").isNotNull() | F.col("m").isNull() | lost
    one_empty = F.array(F.lit(None).cast(CHANGE_TYPE))
    changes = parsed.select(
        "lsn",
        F.coalesce("payload", F.lit("")).alias("payload"),
        F.posexplode(F.when(bad, one_empty).otherwise(F.col("m.change"))).alias("_seq", "c"),
    )
    return changes.select(
        F.col("lsn").alias("_version"),
        "_seq",
        F.col("c.table").alias("_table"),
        F.col("c.kind").alias("_kind"),
        F.col("c.columnnames").alias("_names"),
        F.col("c.columnvalues").alias("_values"),
        F.col("c.oldkeys.keynames").alias("_old_names"),
        F.col("c.oldkeys.keyvalues").alias("_old_values"),
        F.when(F.col("c").isNull(), F.col("payload")).alias("_malformed"),
    )


def route() -> C:
    """What becomes of a decoded change."""
    return (
        F.when(F.col("_malformed").isNotNull(), MALFORMED)
        .when(F.col("_version").isNull(), NO_POSITION)
        .when(~F.coalesce(F.col("_table").isin(*TABLES), F.lit(False)), UNKNOWN_TABLE)
        .when(~F.coalesce(F.col("_kind").isin(*KINDS), F.lit(False)), UNKNOWN_KIND)
        .otherwise(APPLIED)
    )


def change_counts(decoded: DataFrame) -> DataFrame:
    """Changes per table and kind; dropped ones are counted per reason only, as their
    names are free text."""
    routed = decoded.withColumn("route", route())
    applied = F.col("route") == APPLIED
    return routed.groupBy(
        "route",
        F.when(applied, F.col("_table")).alias("table_name"),
        F.when(applied, F.col("_kind")).alias("kind"),
    ).agg(F.count("*").alias("changes"))


def _is(kind: str) -> C:
    return F.col("_kind") == kind


def _old() -> tuple[C, C]:
    return F.col("_old_names"), F.col("_old_values")


def _new_image(spec: TableSpec) -> C:
    """Values of the new row in declared order; an update may lean on the old image."""
    new = (F.col("_names"), F.col("_values"))
    wanted = spec.column_names
    return F.when(_is("update"), completed(*new, *_old(), wanted)).when(~_is("delete"), in_order(*new, wanted))


def _old_key(spec: TableSpec) -> C:
    return typed_value(named_value(*_old(), F.lit(spec.key)), spec.column(spec.key))


def _incomplete(spec: TableSpec) -> C:
    """An update that leaves out a column which the old image does not have either."""
    wanted = F.array(*[F.lit(n) for n in spec.column_names])
    names, old_names = F.col("_names"), F.col("_old_names")
    return _is("update") & F.exists(wanted, lambda n: ~has_name(names, n) & ~has_name(old_names, n))


def _value(spec: TableSpec, image: str, column: Column) -> C:
    return F.get(image, F.lit(spec.column_names.index(column.name)))


def _reason(spec: TableSpec, image: str, old_key: C, incomplete: C, typed: Callable[[Column], C]) -> C:
    """Why a change cannot be applied, or NULL. ``typed`` gives a column's typed new value."""
    row_key = F.when(_is("delete"), old_key).otherwise(typed(spec.column(spec.key)))
    reason = F.when(row_key.isNull(), "no key").when(incomplete, "incomplete update")
    for column in spec.columns:
        if column.type != "TIMESTAMP":
            misfit = ~is_null_value(_value(spec, image, column)) & typed(column).isNull()
            reason = reason.when(misfit, f"bad value in {column.name}")
    return reason


def typed_changes(decoded: DataFrame, spec: TableSpec, ingest_time: C | None = None) -> DataFrame:
    """Changelog rows of one table, each with ``_reason`` set where it cannot be applied.

    Inserts and updates give the full new row, columns missing from an update coming
    from the old image. Deletes give a tombstone from the old image, and so does an
    update that changes the key, for the key it leaves.
    """
    changes = decoded.where((route() == APPLIED) & (F.col("_table") == spec.name))
    raw = changes.select(
        "*",
        _new_image(spec).alias("_new"),
        _old_key(spec).alias("_old_key"),
        _incomplete(spec).alias("_incomplete"),
    )

    def typed(image: str, column: Column) -> C:
        return typed_value(_value(spec, image, column), column).alias(column.name)

    rows = raw.select("*", *[typed("_new", c) for c in spec.columns])
    reason = _reason(spec, "_new", F.col("_old_key"), F.col("_incomplete"), lambda c: F.col(c.name))
    deleted = _is("delete")
    leaves = _is("update") & (F.col("_old_key") != F.col(spec.key))
    times = [c.name for c in spec.columns if c.type == "TIMESTAMP"]
    no_time = reduce(C.__or__, [F.col(t).isNull() for t in times], F.lit(False))
    marked = rows.withColumns(
        {
            "_why": reason,
            "_no_time": ~deleted & no_time,
            "_old": F.when(deleted | leaves, in_order(*_old(), spec.column_names)),
        }
    )
    if ingest_time is not None:
        marked = marked.withColumns({t: F.coalesce(t, ingest_time) for t in times})

    # The marks travel inside the images: a filter on them stays behind the explode,
    # where it cannot repeat the work above.
    marks = (F.col("_why").alias("_reason"), F.col("_no_time").alias("_time_filled"))
    new_row = F.struct(*spec.column_names, F.lit(0).alias("_is_deleted"), *marks)
    tombstone = F.struct(*[typed("_old", c) for c in spec.columns], F.lit(1).alias("_is_deleted"), *marks)
    images = (
        F.when(deleted, F.array(tombstone))
        .when(leaves & F.col("_why").isNull(), F.array(new_row, tombstone))
        .otherwise(F.array(new_row))
    )
    return marked.select(*[c for c in decoded.columns if c != "_malformed"], F.inline(images))


def change_rows(decoded: DataFrame, spec: TableSpec, ingest_time: C | None = None) -> DataFrame:
    """Changelog rows of one table that can be applied, in declared column order."""
    rows = typed_changes(decoded, spec, ingest_time).where(F.col("_reason").isNull())
    return rows.select(*spec.column_names, *META_COLUMNS)


def _record() -> C:
    """The change as JSON text, to be looked at and sent again."""
    change = F.struct(
        F.col("_kind").alias("kind"),
        F.col("_table").alias("table"),
        F.col("_names").alias("columnnames"),
        F.col("_values").alias("columnvalues"),
        F.struct(F.col("_old_names").alias("keynames"), F.col("_old_values").alias("keyvalues")).alias("oldkeys"),
    )
    return F.to_json(change)


def quarantine(decoded: DataFrame, tables: Iterable[str] | None = None) -> DataFrame:
    """Everything that could not be applied, malformed messages, changes without a position
    and rejected changes, in one pass over the changes of all tables. With ``tables`` only
    changes of these are looked at again: those that are known to hold rejected ones."""

    def mine(spec: TableSpec) -> C:
        return (route() == APPLIED) & (F.col("_table") == spec.name)

    def image(spec: TableSpec) -> str:
        return f"_new_{spec.name}"

    specs = [TABLES[name] for name in (TABLES if tables is None else tables)]
    if tables is not None:
        names = [s.name for s in specs]
        decoded = decoded.where(route().isin(*QUARANTINED) | ((route() == APPLIED) & F.col("_table").isin(names)))
    raw = decoded.select("*", *[F.when(mine(s), _new_image(s)).alias(image(s)) for s in specs])
    reason = F.when(route().isin(*QUARANTINED), route())
    for spec in specs:
        def typed(column: Column, spec: TableSpec = spec) -> C:
            return typed_value(_value(spec, image(spec), column), column)

        reason = reason.when(mine(spec), _reason(spec, image(spec), _old_key(spec), _incomplete(spec), typed))
    judged = raw.select(*decoded.columns, reason.alias("_why"))
    found = F.when(
        F.col("_why").isNotNull(),
        F.array(F.struct(F.col("_why").alias("reason"), F.coalesce("_malformed", _record()).alias("record"))),
    )
    return judged.select("_version", "_seq", "_table", F.inline(found))
