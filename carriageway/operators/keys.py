"""De-duplication, latest row, first feed wins, new keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carriageway.operators.settle import settled

#: Repeated keys that are few: their hashes, eight bytes each, stay below the size that Spark broadcasts by itself.
FEW_KEYS = 500_000


def top_rows_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key in the given order.

    Catalyst turns the row-number filter into a per-task limit ahead of the
    shuffle, so a hot key sends at most ``n`` rows per map task.
    """
    spot = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_spot", spot).where(F.col("_spot") <= n).drop("_spot")


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the same one in every run: the least by a hash of all columns.

    A row number cut to 1 rather than ``dropDuplicates``: that aggregates the
    first value of every column, which for text columns sorts and rebuilds each
    row on both sides of the shuffle. Here rows are only sorted, and each map
    task still sends one row per key at most.
    """
    return top_rows_per_key(df, keys, [F.xxhash64(*df.columns)])


def one_row_per_stored_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, bool]:
    """The rows of ``one_row_per_key`` of a stored table, and whether all of them were dealt out by key.

    Hashes of the keys alone are shuffled first. Where no or few keys repeat,
    only rows under repeated hashes are dealt out by key and the others stay
    where they were read; else all rows are dealt out. This is an action.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    repeated = settled(hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash"), "repeated-keys")
    n = repeated.count()
    if n > FEW_KEYS:
        return one_row_per_key(df, keys), True
    if n == 0:
        return df, False
    once = hashed.join(repeated, "_hash", "left_anti").drop("_hash")
    return once.unionByName(one_row_per_key(hashed.join(repeated, "_hash", "left_semi").drop("_hash"), keys)), False


def latest_per_key(df: DataFrame, keys: Sequence[str], when: str, *tie_break: str) -> DataFrame:
    return top_rows_per_key(df, keys, [F.col(when).desc(), *[F.col(c) for c in tie_break]])


def first_feed_wins(feeds: Sequence[DataFrame], key: str, *tie_break: str) -> DataFrame:
    """One row per key over several feeds of one shape; the earlier feed wins."""
    ranked = None
    for place, feed in enumerate(feeds):
        tagged = feed.withColumn("_feed", F.lit(place))
        ranked = tagged if ranked is None else ranked.unionByName(tagged)
    order = [F.col("_feed"), *[F.col(c) for c in tie_break]]
    return top_rows_per_key(ranked, [key], order).drop("_feed")


def unseen(found: DataFrame, known: DataFrame, key: str, usable: Column) -> DataFrame:
    """Usable rows whose key is not in the known set."""
    return found.where(usable).join(known.select(key).distinct(), key, "left_anti")


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where the predicate is true, and all others."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.where(hit), df.where(~hit)
