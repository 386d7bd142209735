"""The first full copy of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.schema import SNAPSHOT_VERSION, TableSpec


def snapshot_rows(table: DataFrame, spec: TableSpec) -> DataFrame:
    """Source rows as first versions: declared columns and types, no filter."""
    return table.select(
        *[F.col(c.name).cast(c.type).alias(c.name) for c in spec.columns],
        F.lit(SNAPSHOT_VERSION).cast("bigint").alias("_version"),
        F.lit(0).alias("_seq"),
        F.lit(0).alias("_is_deleted"),
    )


def read_source_table(
    spark: SparkSession, url: str, spec: TableSpec, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """A source table over JDBC, read in ranges of its key by many tasks at once."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=spec.name, **options)
        .option("partitionColumn", spec.key)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
        .select(*spec.column_names)
    )
