"""Benchmark passages in documents, by SimHash of item-sized windows.

Words are lower-case runs of letters and digits; shingles are five words. At
the similarity a window shares a least number of shingles with an item of its
size, in whatever order. All windows with so many shingles of items of the size
exist, at every start, and no others.
Windows and items of one size get SimHash fingerprints; blocks of bits (one
more than the radius) guarantee that every pair within the radius meets in a
block, and a pair counts in its first common block only. The multiset
similarity of shingles, counted exactly, decides.

Column functions only. Documents with equal texts are one text here: copies
meet in partial aggregation, and the verdict is joined back to all of them.
The benchmark's shingles and the keys of texts with hits are written tables:
counted ones of bounded size are broadcast, larger ones joined by shuffle.

Defined results: null texts on either side are empty; items with fewer than
five words have no shingle and match nothing; a text shorter than an item is
compared as a whole; repeated rows give repeated results, repeated item ids
are items of their own; empty tables give no rows; further columns are carried
by ``clean`` and ignored by ``report``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.llm.common import shingle_hashes, side, whole_text
from carriageway.operators.settle import settled

SHINGLE = 5
SIMILARITY = 0.8
#: Two windows of 40 shingles at the similarity differ in 10 bits on average, with a deviation of 3.
RADIUS = 20

_BETWEEN_WORDS = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _BETWEEN_WORDS), "")


def shingled(df: DataFrame, text: str) -> DataFrame:
    """Column ``_h``: hashes of the shingles of a text column, in order; the text goes."""
    split = df.withColumn("_w", words(F.col(text))).drop(text)
    return split.withColumn("_h", shingle_hashes(F.col("_w"), SHINGLE)).drop("_w")


def fingerprints(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _fp) of rows (keys, h): a bit is the sign of the sum over the hashes, one aggregation."""
    bit = lambda b: F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1)) * 2 - 1
    sums = shingles.groupBy(*keys).agg(*[F.sum(bit(b)).alias(f"_b{b}") for b in range(64)])
    fp = F.lit(0).cast("long")
    for b in range(64):
        fp = fp.bitwiseOR(F.when(F.col(f"_b{b}") > 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fp.alias("_fp"))


def blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``radius + 1`` blocks that cut 64 bits as evenly as can be."""
    n = radius + 1
    edges = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def block_values(fp: Column, radius: int) -> Column:
    return F.array(*[F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << w) - 1)) for a, w in blocks(radius)])


def window_starts(similarity: float) -> Column:
    """Starts of all windows that can reach the similarity with an item of their size, of rows (size, held, at).

    ``at`` are the sorted places of shingles that some item of the size has, ``held`` is the text's number of
    shingles. A window needs a least number of such places, and those with so many start, for some run of that
    many places, at or before the run's first and end at or behind its last.
    """
    size, held = F.col("size"), F.col("held")
    # Rounding must not ask for one more than the similarity does.
    need = F.ceil((F.least(held, size) + size) * (similarity / (1 + similarity)) - F.lit(1e-6)).cast("int")
    last = lambda i: F.get(F.col("at"), i + need - 1)
    runs = F.filter(F.transform("at", lambda p, i: F.struct(p.alias("first"), last(i).alias("last"))),
                    lambda r: r["last"].isNotNull() & (r["last"] - r["first"] < size))
    return F.array_distinct(F.flatten(F.transform(runs, lambda r: F.sequence(
        F.greatest(r["last"] - size + 1, F.lit(0)), F.least(r["first"], F.greatest(held - size, F.lit(0)))))))


def near_pairs(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """Windows joined with the items of their size whose fingerprints lie within the radius."""
    left = windows.select("*", F.posexplode(block_values(F.col("_fp"), radius)).alias("_block", "_value"))
    right = items.select(F.col("item").alias("near_item"), F.col("size").alias("item_size"), F.col("_fp").alias("item_fp"),
                         F.posexplode(block_values(F.col("_fp"), radius)).alias("_item_block", "_item_value"))
    apart = F.col("_fp").bitwiseXOR(F.col("item_fp"))
    first = F.coalesce(*[F.when(F.shiftrightunsigned(apart, a).bitwiseAND(F.lit((1 << w) - 1)) == 0, F.lit(k))
                         for k, (a, w) in enumerate(blocks(radius))])
    met = left.join(right, (F.col("size") == F.col("item_size")) & (F.col("_block") == F.col("_item_block"))
                    & (F.col("_value") == F.col("_item_value")) & (F.bit_count(apart) <= radius) & (first == F.col("_block")))
    return met.select("key", "size", "start", "near_item")


def leaks(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """(key, item_id, start, similarity): for each text key and item, the best window at or over the similarity."""
    items = benchmark.select(F.col("item_id"), F.monotonically_increasing_id().alias("item"), whole_text().alias("_t"))
    # Outer explodes: for inner ones the optimizer adds a filter on the array and pushes it down to
    # the scan, where the array's expression would be evaluated again for each of its elements.
    parts = settled(shingled(items, "_t").select("item_id", "item", F.size("_h").alias("size"), F.posexplode_outer("_h").alias("at", "h"))
                    .where("at is not null"), "leak-items")
    known = settled(parts.select("h").distinct(), "leak-shingles")

    texts = docs.select(F.md5(whole_text().cast("binary")).alias("key"), whole_text().alias("_t"))
    spots = shingled(texts, "_t").select("key", F.size("_h").alias("held"), F.posexplode_outer("_h").alias("pos", "h"))
    hits = settled(spots.join(side(known.withColumnRenamed("h", "known_h")), F.col("h") == F.col("known_h")).select("key", "held", "pos", "h").distinct(), "leak-hits")

    places = parts.select("size", F.col("h").alias("item_h")).distinct()
    shared_at = hits.join(places, F.col("h") == F.col("item_h")).groupBy("key", "size").agg(
        F.max("held").alias("held"), F.sort_array(F.collect_set("pos")).alias("at"))
    starts = settled(shared_at.select("key", "size", F.explode(window_starts(similarity)).alias("start")), "leak-starts")

    # Texts are not shuffled for the few that have hits, as long as their keys can be broadcast.
    found = settled(starts.select(F.xxhash64("key").alias("found_key")).distinct(), "leak-texts")
    own = (docs.select(F.md5(whole_text().cast("binary")).alias("text_key"), whole_text().alias("_t"))
           .join(side(found), F.xxhash64("text_key") == F.col("found_key"), "left_semi").groupBy("text_key").agg(F.first("_t").alias("_t")))
    cut = starts.join(shingled(own, "_t"), F.col("key") == F.col("text_key"))
    inside = settled(cut.select("key", "size", "start", F.slice("_h", F.col("start") + 1, F.col("size")).alias("_in")), "leak-windows")
    window_key = ["key", "size", "start"]
    shingles = inside.select(*window_key, F.explode("_in").alias("h"))
    pairs = near_pairs(settled(fingerprints(shingles, window_key), "leak-window-prints"),
                       settled(fingerprints(parts.select("item", "size", "h"), ["item", "size"]), "leak-item-prints"), radius)

    window_counts = shingles.groupBy(*window_key, "h").agg(F.count(F.lit(1)).alias("n"))
    item_counts = parts.groupBy("item", "item_id", "size", "h").agg(F.count(F.lit(1)).alias("item_n")).select(
        "item", "item_id", F.col("h").alias("item_h"), "item_n")
    candidates = settled(pairs.join(inside.select(*[F.col(c).alias(f"{c}_of") for c in window_key], F.size("_in").alias("held")),
                                    [F.col(c) == F.col(f"{c}_of") for c in window_key]).drop(*[f"{c}_of" for c in window_key]), "leak-candidates")
    both = (candidates.join(window_counts.toDF("key_of", "size_of", "start_of", "h", "n"), [F.col(c) == F.col(f"{c}_of") for c in window_key])
            .join(item_counts, (F.col("near_item") == F.col("item")) & (F.col("h") == F.col("item_h"))))
    shared = both.groupBy(*window_key, "held", "item", "item_id").agg(F.sum(F.least("n", "item_n")).alias("shared"))
    alike = shared.withColumn("similarity", F.col("shared") / (F.col("held") + F.col("size") - F.col("shared"))).where(F.col("similarity") >= similarity)
    return alike.groupBy("key", "item", "item_id").agg(
        F.max("similarity").alias("similarity"), F.min_by("start", F.struct(-F.col("similarity"), F.col("start"))).alias("start"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, similarity): ``start`` is the word at which the best window begins."""
    found = settled(leaks(docs, benchmark), "leak-verdicts").select(F.col("key").alias("leak_key"), "item_id", "start", "similarity")
    keyed = docs.select("doc_id", F.md5(whole_text().cast("binary")).alias("key"))
    return keyed.join(found, F.col("key") == F.col("leak_key")).select("doc_id", "item_id", F.col("start").cast("long").alias("start"), "similarity")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, with the columns they came with."""
    found = settled(leaks(docs, benchmark).select(F.col("key").alias("leak_key")).distinct(), "leak-verdicts")
    keyed = docs.withColumn("_leak_key", F.md5(whole_text().cast("binary")))
    return keyed.join(side(found), F.col("_leak_key") == F.col("leak_key"), "left_anti").select(*docs.columns)
