"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Bytes of a file that a task reads at most where it sorts its whole split: packed columns take many times their size as rows.
SORTED_SPLIT = 8 << 20


def build_session(app: str = "carriageway", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the jobs assume; a cluster's own values win.

    Adaptive execution sizes shuffles, turns joins with a small measured side
    into broadcasts and splits skewed join partitions, so no plan here carries
    a fixed partition count or an unchecked broadcast hint.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Recording the source line of every Column call dominates plan building.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for key, value in {**defaults, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Time zone used whenever a zone-less timestamp has to become an instant."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def small_splits(spark: SparkSession, most: int = SORTED_SPLIT) -> Iterator[None]:
    """Jobs run inside read their files in splits of at most ``most`` bytes, so that a task's rows do not grow with the table."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written intermediates, visible to every executor.

    The base is ``spark.checkpoint.dir``; where that is unset, as in tests, a
    folder of the session's warehouse. Never a machine's own temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_runs"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def checkpoint_dir(spark: SparkSession) -> None:
    """Makes ``DataFrame.checkpoint`` usable: where the session has no folder for it, one in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoints"))
