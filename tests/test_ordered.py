"""Sliced windows against plain windows, with one key holding most rows."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from carriageway.operators import ordered
from carriageway.operators import keys
from carriageway.operators.keys import one_row_per_key, one_row_per_stored_key, top_rows_per_key


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.7 else rng.choice(["a", "b", None]), n, rng.choice([None, *range(-5, 40)]), rng.random())
            for n in rng.sample(range(100000), 3000)]
    return spark.createDataFrame(rows, "k string, seq int, v int, x double").cache()


def same(a, b):
    assert sorted(repr(tuple(r)) for r in a.collect()) == sorted(repr(tuple(r)) for r in b.collect())


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_totals(skewed, inclusive):
    got = ordered.running_totals(skewed, ["k"], [F.col("seq")], F.floor(F.col("seq") / 500), {"t": F.col("seq")}, inclusive)
    frame = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    same(got, skewed.withColumn("t", F.coalesce(F.sum("seq").over(frame), F.lit(0))))


def test_row_numbers(skewed):
    got = ordered.row_numbers(skewed, ["k"], [F.col("seq")], F.floor(F.col("seq") / 100), "n")
    same(got, skewed.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("seq")).cast("long")))


def test_next_values_cross_slices(skewed):
    got = ordered.next_values(skewed, ["k"], "seq", F.floor(F.col("seq") / 7), {"after": "seq", "after_v": "v"})
    w = Window.partitionBy("k").orderBy("seq")
    same(got, skewed.withColumns({"after": F.lead("seq").over(w), "after_v": F.lead("v").over(w)}))


def test_rank_with_nulls_negatives_and_ties(skewed):
    got = ordered.rank_desc(skewed, ["k"], "v", "place")
    same(got, skewed.withColumn("place", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last()))))


def test_rank_of_doubles(skewed):
    got = ordered.rank_desc(skewed, ["k"], "x", "place")
    same(got, skewed.withColumn("place", F.rank().over(Window.partitionBy("k").orderBy(F.desc("x")))))


def test_spread_scores(skewed):
    got = ordered.spread_scores(skewed, ["k"], "x", "m", "s").select("seq", F.round("m", 9), F.round("s", 9))
    w = Window.partitionBy("k")
    same(got, skewed.select("seq", F.round(F.avg("x").over(w), 9), F.round(F.stddev_samp("x").over(w), 9)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=2, max_size=30))
def test_value_slice_never_decreases(values):
    import math

    def cut(v):
        return int(math.copysign(1, v) * math.floor(math.log2(abs(v) + 1) * 64)) if v else 0

    cuts = [cut(v) for v in sorted(values)]
    assert cuts == sorted(cuts)


def test_one_row_per_key_limits_map_output(spark):
    copies = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit("x").alias("v"))
    assert one_row_per_key(copies, ["k"]).count() == 3
    plan = top_rows_per_key(copies, ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_one_row_per_null_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert one_row_per_key(df, ["k"]).count() == 2


def test_nan_and_infinity_rank_above_numbers(spark):
    from carriageway.operators.ordered import rank_desc

    df = spark.createDataFrame([("g", float("nan")), ("g", float("inf")), ("g", 3.0), ("g", float("-inf")), ("g", None)], "k string, v double")
    got = {str(r["v"]): r["place"] for r in rank_desc(df, ["k"], "v", "place").collect()}
    assert got == {"nan": 1, "inf": 2, "3.0": 3, "-inf": 4, "None": 5}


def test_the_kept_row_does_not_change_with_the_partitions(spark):
    rows = [(k % 5, v) for k in range(50) for v in range(3)]
    few = one_row_per_key(spark.createDataFrame(rows, "k int, v int").repartition(2), ["k"])
    many = one_row_per_key(spark.createDataFrame(rows[::-1], "k int, v int").repartition(9), ["k"])
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


@pytest.mark.parametrize("few", [0, 1, 500_000])
def test_stored_rows_are_made_unique_with_little_shuffled(spark, monkeypatch, few):
    """Whole rows move only where keys repeat; the rows kept are the same, whichever way is taken."""
    monkeypatch.setattr(keys, "FEW_KEYS", few)
    rows = [(f"k{i}", i, "x") for i in range(200)] + [("k3", 900, "y"), ("k3", 901, "y"), (None, 1, "n"), (None, 2, "n"), ("k7", 7, "x")]
    df = spark.createDataFrame(rows, "k string, v int, t string").repartition(5)
    got, dealt = one_row_per_stored_key(df, ["k"])
    assert dealt == (few < 3) and got.columns == df.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, one_row_per_key(df, ["k"]).collect())) and got.count() == 201
    plain, dealt = one_row_per_stored_key(spark.range(50), ["id"])
    assert not dealt and "Exchange" not in plain._jdf.queryExecution().executedPlan().toString() and plain.count() == 50


@pytest.mark.parametrize("first", [0, 1_700_000_000])
def test_slices_follow_the_values_wherever_they_lie(spark, first):
    """A hundred thousand distinct seconds are spread over all slices, from zero on and from an epoch on."""
    df = spark.range(first, first + 100_000).toDF("at")
    sizes = [r["count"] for r in df.select(ordered.value_slice(df, "at").alias("s")).groupBy("s").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 4 * 100_000 / 64


def test_ranks_of_epoch_seconds(spark):
    df = spark.range(5000).selectExpr("1700000000 + id % 1700 AS at")
    got = ordered.rank_desc(df, [], "at", "place").distinct().collect()
    counts = [sum(1 for i in range(5000) if i % 1700 == k) for k in range(1700)]
    above, want = 0, {}
    for k in reversed(range(1700)):
        want[1_700_000_000 + k] = above + 1
        above += counts[k]
    assert {r["at"]: r["place"] for r in got} == want
