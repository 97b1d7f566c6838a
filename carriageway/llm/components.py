"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carriageway.operators.settle import settled

MOST_TURNS = 60


def _least_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its greater neighbours to the least node around it."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).select(F.col("u").alias("at"), F.least("u", "least").alias("least"))
    return (both.where("v > u").join(least, F.col("u") == F.col("at"))
            .select(F.col("v").alias("u"), F.col("least").alias("v")).where("u != v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links its lesser neighbours, and itself, to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_neighbour(down).select(F.col("u").alias("at"), "least")
    moved = down.join(least, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select(F.col("at").alias("u"), F.col("least").alias("v"))).where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v); the root is the least node reachable.

    Each turn is two aggregations with partial sums and two joins, so a node
    with very many links is no task of its own; turns grow with the logarithm
    of the longest path. Every turn is written to the shared folder.
    """
    now, seen = settled(links.select("u", "v").where("u != v").distinct(), "components"), None
    for _ in range(MOST_TURNS):
        # A sum of hashes stands for the whole table: stars that no turn changes any more have the same sum.
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0])
        if mark == seen:
            break
        seen = mark
        now = settled(_small_star(_large_star(now)), "components")
    else:
        raise RuntimeError(f"components not settled after {MOST_TURNS} turns")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
