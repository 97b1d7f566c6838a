"""Documents dealt into shards so that linked ones stay together and shards hold equal counts.

Links form groups (here: equal texts). Each turn of label propagation is a few
joins: groups count their rows per shard (partially before the shuffle), every
row asks for the shard that most rows of its groups are in, and the requests
are granted within quotas. A small group moves as a whole, so its share is
granted by a hash of the group; rows of a group too heavy for that are granted
one by one. Afterwards each shard keeps its even share, linked rows first, and
the rest fills the shards that lack rows.

The law is ``rows``: counts differ by at most one. Order within shards comes
from slices: rows are numbered inside slices of bounded size, and only slice
totals meet. The groups' heaviest member never gets a task of its own size:
its rows are sliced by row instead of by group.

Defined results: a null text counts as empty, of size 1; repeated rows and rows
without id are placed one by one; with fewer rows than shards some shards stay
empty; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carriageway.llm.common import whole_text
from carriageway.operators.settle import settled

SHARDS = 8
TURNS = 6
SLICE_ROWS = 16384
#: While rows move, a shard may hold this much over its even share; evening out takes unlinked rows away again.
SLACK = 0.1
#: Groups with more than this share of a shard are granted row by row.
HEAVY_SHARE = 1 / 64


def share(*of: Column) -> Column:
    """A number from 0 to 1 that follows from a hash of the columns."""
    return F.pmod(F.xxhash64(*of), F.lit(1 << 31)) / float(1 << 31)


def numbered(df: DataFrame, within: str, slices: int, key: Column, order: list[str], first: Column) -> DataFrame:
    """Column ``number``: places from 0 per value of ``within``, rows with the lesser ``first`` before others.

    Rows of one ``key`` stay next to each other. A window holds one slice, or the totals of all slices of one value.
    """
    rows = df.withColumns({"_first": first, "_slice": F.pmod(F.xxhash64(key, F.lit("slice")), F.lit(slices))})
    by = [within, "_first", "_slice"]
    totals = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(within).orderBy("_first", "_slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select(*[F.col(c).alias(f"{c}_of") for c in by], F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    joined = rows.withColumn("_place", place).join(starts, [F.col(c) == F.col(f"{c}_of") for c in by])
    return joined.withColumn("number", (F.col("_start") + F.col("_place")).cast("long")).drop(
        "_first", "_slice", "_place", "_start", *[f"{c}_of" for c in by])


def propagated(rows: DataFrame, links: DataFrame, n: int, shards: int, turns: int) -> DataFrame:
    """Rows (row, shard, group, heavy) after label propagation.

    ``rows`` has row, group (its first link or null) and heavy; ``links`` has row and group.
    """
    quota = int((1 + SLACK) * n / shards) + 1
    now = settled(rows.withColumn("shard", F.pmod(F.xxhash64(F.lit("start"), "row"), F.lit(shards)).cast("int")), "sharding-start")
    for turn in range(turns):
        placed = links.join(now.select(F.col("row").alias("row_of"), "shard"), F.col("row") == F.col("row_of"))
        held = placed.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("held"))
        best = held.groupBy("group").agg(F.max_by("shard", F.struct(F.col("held"), F.xxhash64("group", "shard"))).alias("best"), F.max("held").alias("held"))
        votes = (links.join(best, "group").groupBy("row", "best").agg(F.sum("held").alias("held"))
                 .groupBy("row").agg(F.max_by("best", F.struct(F.col("held"), F.xxhash64("row", "best"))).alias("wish")))
        asked = now.join(votes.select(F.col("row").alias("row_of"), "wish"), F.col("row") == F.col("row_of"), "left").drop("row_of")
        asked = settled(asked.withColumn("wish", F.when(F.col("wish") != F.col("shard"), F.col("wish"))), "sharding-turn")
        # At most shards squared rows come back: the sums of what stays and what wants to move.
        flow = asked.groupBy("shard", "wish").agg(F.count(F.lit(1)).alias("n")).collect()
        size = {s: sum(r["n"] for r in flow if r["shard"] == s) for s in range(shards)}
        leave = {s: sum(r["n"] for r in flow if r["shard"] == s and r["wish"] is not None) for s in range(shards)}
        want = {s: sum(r["n"] for r in flow if r["wish"] == s) for s in range(shards)}
        if not any(want.values()):
            return asked.drop("wish")
        # Half of what wants to leave counts as gone: it may not be granted itself.
        grant = {s: min(1.0, max(0, quota - size[s] + leave[s] // 2) / want[s]) if want[s] else 0.0 for s in range(shards)}
        if not any(grant.values()):
            return asked.drop("wish")
        rate = F.element_at(F.array(*[F.lit(float(grant[s])) for s in range(shards)]), F.coalesce("wish", F.lit(0)) + 1)
        lot = share(F.coalesce(F.when(~F.col("heavy"), F.col("group")), F.col("row")), F.lit(turn))
        now = settled(asked.withColumn("shard", F.when(F.col("wish").isNotNull() & (lot < rate), F.col("wish")).otherwise(F.col("shard"))).drop("wish"),
                      "sharding-moved")
    return now


def evened(placed: DataFrame, n: int, shards: int) -> DataFrame:
    """Rows with counts per shard at most one apart and ``slot`` from 0; those without links move first."""
    slices = max(1, -(-n // (shards * SLICE_ROWS)))
    key = F.coalesce(F.when(~F.col("heavy"), F.col("group")), F.col("row"))
    ordered = numbered(placed, "shard", slices, key, ["group", "row"], F.when(F.col("group").isNull(), 1).otherwise(0))
    ordered = settled(ordered, "sharding-ordered")
    count = {r["shard"]: r["n"] for r in ordered.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    low, more = divmod(n, shards)
    # The largest shards keep the one row more, so that the fewest rows move.
    by_size = sorted(range(shards), key=lambda s: (-count.get(s, 0), s))
    goal = {s: low + (k < more) for k, s in enumerate(by_size)}
    of = lambda d: F.element_at(F.array(*[F.lit(d.get(s, 0)).cast("long") for s in range(shards)]), F.col("shard") + 1)
    stay = ordered.where(F.col("number") < of(goal)).select("row", "shard", F.col("number").alias("slot"))
    spare = ordered.where(F.col("number") >= of(goal)).drop("number").withColumn("all", F.lit(0))
    moved = numbered(spare, "all", max(1, -(-n // SLICE_ROWS)), key, ["group", "row"], F.when(F.col("group").isNull(), 1).otherwise(0))
    target, slot, at = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        room = max(0, goal[s] - count.get(s, 0))
        inside = (F.col("number") >= at) & (F.col("number") < at + room)
        target = F.when(inside, F.lit(s)).otherwise(target)
        slot = F.when(inside, F.col("number") - at + min(count.get(s, 0), goal[s])).otherwise(slot)
        at += room
    return stay.unionByName(moved.select("row", target.alias("shard"), slot.alias("slot")))


def sharded(docs: DataFrame, shards: int = SHARDS, turns: int = TURNS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of documents linked by equal texts."""
    text = F.encode(whole_text(), "UTF-8")
    every = settled(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("copy_of"),
    ), "sharding-rows")
    copies = (every.groupBy("copy_of").agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("group")).where("copies > 1"))
    n = every.count()
    heavy_from = max(1.0, HEAVY_SHARE * n / shards)
    rows = settled(every.select("row", "copy_of").join(copies.withColumnRenamed("copy_of", "copy_key"), F.col("copy_of") == F.col("copy_key"), "left")
                   .select("row", "group", F.coalesce(F.col("copies") > heavy_from, F.lit(False)).alias("heavy")), "sharding-links")
    placed = evened(propagated(rows, rows.where("group is not null").select("row", "group"), n, shards, turns), n, shards)
    placed = placed.withColumnRenamed("row", "row_of")
    return every.join(placed, F.col("row") == F.col("row_of")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))
