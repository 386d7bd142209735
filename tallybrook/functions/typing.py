"""Typed values out of feed variants, and the default-filled form of a row."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.schema import Column, TableSpec


def named_value(names: C, values: C, name: C) -> C:
    """The value standing at ``name``; of repeated names the last one counts.

    A name beyond the end of ``values`` reads as NULL, as does an absent name.
    """
    from_end = F.array_position(F.reverse(names), name)
    return F.try_element_at(values, (F.size(names) - from_end + 1).cast("int"))


def has_name(names: C, name: C) -> C:
    return F.coalesce(F.array_contains(names, name), F.lit(False))


def in_order(names: C, values: C, wanted: list[str]) -> C:
    """Values in the order of ``wanted``; a message that has that order is taken as is."""
    order = F.array(*[F.lit(n) for n in wanted])
    as_is = (names == order) & (F.size(values) == len(wanted))
    return F.when(as_is, values).otherwise(F.transform(order, lambda n: named_value(names, values, n)))


def completed(names: C, values: C, old_names: C, old_values: C, wanted: list[str]) -> C:
    """As ``in_order``, with values that were left out taken from the old image."""
    order = F.array(*[F.lit(n) for n in wanted])
    as_is = (names == order) & (F.size(values) == len(wanted))
    return F.when(as_is, values).otherwise(
        F.transform(
            order,
            lambda n: F.when(has_name(names, n), named_value(names, values, n)).otherwise(
                named_value(old_names, old_values, n)
            ),
        )
    )


def typed_value(value: C, column: Column) -> C:
    """Cast a variant to the declared type; a value that does not fit gives NULL."""
    if column.type == "TIMESTAMP":
        return F.try_variant_get(value, "$", "string").try_cast("timestamp")
    return F.try_variant_get(value, "$", column.type)


def is_null_value(value: C) -> C:
    """True for SQL NULL and for the JSON null."""
    return value.isNull() | F.is_variant_null(value)


def filled(value: C, column: Column) -> C:
    """NULL becomes the column's fill value; columns without one keep NULL."""
    if column.fill is None:
        return value
    return F.coalesce(value, F.lit(column.fill).cast(column.type))


def time_or_now(value: C, ingest_time: C) -> C:
    """A missing or unreadable time becomes the ingestion time of its batch."""
    return F.coalesce(value.try_cast("timestamp"), ingest_time)


def as_flag(value: C) -> C:
    """Booleans as 0/1, NULL counting as 0."""
    return F.coalesce(value.cast("boolean"), F.lit(False)).cast("int")


def default_filled(rows: DataFrame, spec: TableSpec, ingest_time: C) -> DataFrame:
    """Rows with NULLs filled, times completed and booleans as 0/1.

    Current state keeps NULL; this is the form for readers that expect none.
    """
    done = {}
    for column in spec.columns:
        value = F.col(column.name)
        if column.type == "TIMESTAMP":
            done[column.name] = time_or_now(value, ingest_time)
        elif column.type == "BOOLEAN":
            done[column.name] = as_flag(value)
        elif column.fill is not None:
            done[column.name] = filled(value, column)
    return rows.withColumns({n: c for n, c in done.items() if n in rows.columns})
