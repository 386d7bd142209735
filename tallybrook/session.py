"""Session set-up and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Days and interval bounds are UTC whatever the cluster's zone is.
ZONE = "spark.sql.session.timeZone"

# A join whose skewed side feeds an aggregate on the same key is only split by AQE when
# an extra shuffle is allowed for that case.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Texts travel to Python workers some at a time: executors hold several batches at once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # State per key can outgrow executor memory; RocksDB keeps it on disk, and uploads
    # changes instead of whole snapshots.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Work in UTC, and set the options above where the cluster was started without them."""
    spark.conf.set(ZONE, "UTC")
    given = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, memory: str = "8g", **options: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallybrook")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.extraJavaOptions", "-XX:+UseParallelGC")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``, or, where
    that is not set, below the warehouse, which all executors share as well."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
