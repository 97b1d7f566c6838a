"""Stored snapshot metrics: merged slices equal one slice, errors stay bounded, drift against plain counting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from carriageway.operators import snapshots
from carriageway.operators.settle import settled


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(7)
    out = [(d, draw.choice([None, float("nan"), 0.0, -3.5, math.exp(draw.uniform(-8, 12)), -math.exp(draw.uniform(-8, 12))]), f"t{draw.randrange(900)}")
           for d in range(30) for _ in range(200)]
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return settled(spark.createDataFrame(rows, "day int, x double, word string"), "snapshot-test").repartition(6)


def test_month_equals_the_merge_of_its_days(df):
    by_day = snapshots.metrics(df, ["day"], ["x", "word"]), snapshots.buckets(df, ["day"], ["x", "word"])
    at_once = snapshots.metrics(df, [], ["x", "word"]), snapshots.buckets(df, [], ["x", "word"])
    merged, whole = ({r["column_name"]: r.asDict() for r in snapshots.stored_profile(*pair).collect()} for pair in (by_day, at_once))
    assert merged.keys() == whole.keys() == {"x", "word"}
    for name in whole:
        for key, value in whole[name].items():
            close = pytest.approx(value, rel=0.05) if key == "distinct_count" else pytest.approx(value, rel=1e-9) if isinstance(value, float) else value
            assert merged[name][key] == close, key


def test_profile_against_plain_python(df, rows):
    out = {r["column_name"]: r for r in snapshots.stored_profile(
        snapshots.metrics(df, ["day"], ["x", "word"]), snapshots.buckets(df, ["day"], ["x"])).collect()}
    values = sorted(x for _, x, _ in rows if x is not None and not math.isnan(x))
    x = out["x"]
    assert (x["row_count"], x["null_count"]) == (len(rows), len(rows) - len(values))
    assert (x["min_value"], x["max_value"]) == (values[0], values[-1])
    assert x["mean_value"] == pytest.approx(sum(values) / len(values))
    assert x["distinct_count"] == pytest.approx(len(set(values)), rel=0.05)
    assert out["word"]["distinct_count"] == pytest.approx(len({w for _, _, w in rows}), rel=0.05)
    for share, name in ((0.25, "q1_value"), (0.5, "median_value"), (0.75, "q3_value")):
        exact = values[math.ceil(share * len(values)) - 1]
        assert x[name] == pytest.approx(exact, rel=0.011, abs=1e-12), name
    assert out["word"]["mean_value"] is None and out["word"]["stddev_value"] is None and out["word"]["median_value"] is None


def test_drift_against_plain_counting(df, rows):
    got = snapshots.stored_drift(snapshots.buckets(df, ["day"], ["x"]), F.col("day") < 10, F.col("day") >= 10).first()

    def place(x):
        return 0 if x == 0 else math.copysign(math.ceil(math.log(abs(x)) / math.log(snapshots.GROWTH)) + snapshots.SHIFT, x)

    sides = [[place(x) for d, x, _ in rows if (d < 10) is early and x is not None and not math.isnan(x)] for early in (True, False)]
    ranges = sorted(set(sides[0]) | set(sides[1]))
    shares = [[side.count(r) / len(side) for r in ranges] for side in sides]
    ks = max(abs(sum(shares[0][:k + 1]) - sum(shares[1][:k + 1])) for k in range(len(ranges)))
    assert (got["baseline_values"], got["current_values"], got["ranges"]) == (len(sides[0]), len(sides[1]), len(ranges))
    assert got["ks_distance"] == pytest.approx(ks)
    assert got["tv_distance"] == pytest.approx(sum(abs(a - b) for a, b in zip(*shares)) / 2)


def test_ends_of_the_number_line(spark):
    far = spark.createDataFrame([(1, v) for v in (float("inf"), float("-inf"), 5e-324, -5e-324, 1.7e308)], "day int, x double")
    numbers = [r["bucket"] for r in far.select(snapshots.bucket_of(F.col("x")).alias("bucket")).collect()]
    assert len(set(numbers)) == 5 and numbers[0] > numbers[4] > numbers[2] > 0 > numbers[3] > numbers[1]
    out = snapshots.stored_profile(snapshots.metrics(far, ["day"], ["x"]), snapshots.buckets(far, ["day"], ["x"])).first()
    assert out["q3_value"] == pytest.approx(1.7e308, rel=0.02)


def test_without_rows_and_without_values(spark):
    none = spark.createDataFrame([], "day int, x double")
    assert snapshots.stored_profile(snapshots.metrics(none, ["day"], ["x"]), snapshots.buckets(none, ["day"], ["x"])).count() == 0
    empty = spark.createDataFrame([(1, None), (1, None)], "day int, x double")
    row = snapshots.stored_profile(snapshots.metrics(empty, ["day"], ["x"]), snapshots.buckets(empty, ["day"], ["x"]), ["day"]).first()
    assert (row["row_count"], row["null_count"], row["distinct_count"], row["mean_value"], row["median_value"]) == (2, 2, 0, None, None)
    with pytest.raises(ValueError):
        snapshots.buckets(spark.createDataFrame([("a",)], "word string"), [], ["word"])


def test_coarser_profile_reads_no_raw_rows(spark, df):
    stored = settled(snapshots.metrics(df, ["day"], ["x"]), "m"), settled(snapshots.buckets(df, ["day"], ["x"]), "b")
    files = {f for f in snapshots.stored_profile(*stored).inputFiles()}
    assert files == set(stored[0].inputFiles()) | set(stored[1].inputFiles())
