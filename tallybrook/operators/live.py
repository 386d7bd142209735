"""Current state of a table from its versions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.schema import META_COLUMNS, TABLES

ROW_NUMBER = "_row_number"


def latest(changes: DataFrame, key: str, immutable: C | None = None) -> DataFrame:
    """The newest version of every key, tombstones included.

    Spark keeps one row per key and task ahead of the shuffle, so a key with very many
    versions costs its reducer one row per task, and only used columns are read.

    Other predicates must stay above this operator, or superseded rows come back.
    ``immutable`` is a predicate on columns that never change for a key; it may be
    applied to the scan. Tombstones always pass it, as their columns can be NULL.
    """
    if immutable is not None:
        changes = changes.where(immutable | (F.col("_is_deleted") == 1))
    newest_first = Window.partitionBy(key).orderBy(F.desc("_version"), F.desc("_seq"))
    return (
        changes.withColumn(ROW_NUMBER, F.row_number().over(newest_first))
        .where(F.col(ROW_NUMBER) == 1)
        .drop(ROW_NUMBER)
    )


def without_deleted(newest: DataFrame) -> DataFrame:
    """Drop tombstones. Goes after ``latest``: before it, deleted rows would return."""
    return newest.where(F.col("_is_deleted") == 0)


def live(changes: DataFrame, key: str, immutable: C | None = None) -> DataFrame:
    """Current rows of a table without the version columns."""
    newest = without_deleted(latest(changes, key, immutable))
    if immutable is not None:
        newest = newest.where(immutable)
    return newest.drop(*META_COLUMNS)


def lookup(changes: DataFrame, key: str, value) -> DataFrame:
    """Current row of one key; the predicate reaches the scan."""
    return live(changes, key).where(F.col(key) == value)


def register_views(changelogs: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Temporary views over current state out of changelogs, for queries written in SQL; a
    changelog store has views of its own, over its compacted tables."""
    for name, changes in changelogs.items():
        live(changes, TABLES[name].key).createOrReplaceTempView(prefix + name)
