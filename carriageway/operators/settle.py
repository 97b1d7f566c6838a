"""Cut a plan at a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from carriageway.session import shared_dir


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder.

    Used where a result of a long scan is needed more than once: the scan runs
    once, its partial results survive lost executors, and every later use sees
    the same rows. This is an action.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
