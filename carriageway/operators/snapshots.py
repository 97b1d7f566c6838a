"""Stored metrics of table snapshots that merge: profiles of coarser slices and drift without a second scan of rows.

Two narrow tables are stored per snapshot. ``METRICS`` has a row per slice and
column: counts, range, sums, and a sketch of the distinct values. ``BUCKETS``
has a row per slice, column and value range of a number: how many values lie in
it. Ranges grow by two percent, so a quantile is within one percent of a value
of its rank, whatever the data. Both tables merge by adding, so merged slices
give what one slice over all their rows would: the same ranges and quantiles,
distinct counts within the sketch's error.

Defined results: NULL and NaN count as missing; a column without a value has
neither range nor mean nor quantiles; infinities lie in the outermost ranges,
which are named by the least and greatest value; a snapshot without rows has no
row.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carriageway.functions.rules import ratio

#: Ratio of a range's upper to its lower border.
GROWTH = 1.02
#: Added to the range number of a value's size, so that a positive value has a positive number.
SHIFT = 40_000
#: Registers of a distinct sketch, as a power of two: a standard error of 1.6 %.
DISTINCT_BITS = 12


def _numeric(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]


def _value(name: str) -> Column:
    """A number as a double; NaN counts as missing."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def bucket_of(value: Column) -> Column:
    """Number of the range that holds a value: its size's power of ``GROWTH``, with the value's sign; 0 for zero."""
    power = F.ceil(F.ln(F.abs(value)) / F.lit(log(GROWTH))) + F.lit(SHIFT)
    size = F.when(F.abs(value) == F.lit(float("inf")), F.lit(2 * SHIFT)).otherwise(power)
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * size).cast("long")


def bucket_value(bucket: Column) -> Column:
    """The value that stands for a range: within one percent of all values in it."""
    size = F.pow(F.lit(GROWTH), F.abs(bucket) - F.lit(SHIFT)) * F.lit(2 / (1 + GROWTH))
    return F.when(bucket == 0, F.lit(0.0)).otherwise(F.signum(bucket) * size)


def metrics(df: DataFrame, slices: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``METRICS`` of a table: one aggregate, its partial sums made in each map task."""
    numbers = set(_numeric(df, columns))
    nothing = F.lit(None).cast("double")
    measures, rows = [F.count(F.lit(1)).alias("row_count")], []
    for i, name in enumerate(columns):
        number = name in numbers
        value = _value(name) if number else F.col(name)
        measures += [F.count(value).alias(f"filled_{i}"), F.hll_sketch_agg(value.cast("string"), DISTINCT_BITS).alias(f"values_{i}")]
        if number:
            measures += [F.min(value).alias(f"least_{i}"), F.max(value).alias(f"greatest_{i}"),
                         F.sum(value).alias(f"total_{i}"), F.sum(value * value).alias(f"squares_{i}")]
        rows.append(F.struct(
            F.lit(name).alias("column_name"), F.col("row_count"), F.col(f"filled_{i}").alias("filled"),
            *[(F.col(f"{m}_{i}") if number else nothing).alias(m) for m in ("least", "greatest", "total", "squares")],
            F.col(f"values_{i}").alias("distinct_sketch")))
    return df.groupBy(*slices).agg(*measures).select(*slices, F.inline(F.array(*rows)))


def buckets(df: DataFrame, slices: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``BUCKETS`` of a table's numbers; every map task sends one row per slice, column and range at most."""
    entries = [F.struct(F.lit(c).alias("column_name"), bucket_of(_value(c)).alias("bucket")) for c in _numeric(df, columns)]
    if not entries:
        raise ValueError(f"none of {list(columns)} is a number")
    return (df.select(*slices, F.inline(F.array(*entries))).where(F.col("bucket").isNotNull())
            .groupBy(*slices, "column_name", "bucket").agg(F.count(F.lit(1)).alias("n")))


def merged_metrics(stored: DataFrame, slices: Sequence[str] = ()) -> DataFrame:
    """Stored metrics of finer slices as those of coarser ones; none named: of everything."""
    return stored.groupBy(*slices, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("filled").alias("filled"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"))


def merged_buckets(stored: DataFrame, slices: Sequence[str] = ()) -> DataFrame:
    return stored.groupBy(*slices, "column_name", "bucket").agg(F.sum("n").alias("n"))


def quantiles(counted: DataFrame, slices: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """A row per slice and column with a named value per share: that of the range in which the share's rank lies.

    The running count is a window over ranges, of which a column has some thousands at most.
    """
    keys = [*slices, "column_name"]
    spot = Window.partitionBy(*keys)
    ranked = counted.withColumns({
        "_upto": F.sum("n").over(spot.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_all": F.sum("n").over(spot)})
    return ranked.groupBy(*keys).agg(*[
        bucket_value(F.min(F.when(F.col("_upto") >= F.ceil(F.lit(share) * F.col("_all")), F.col("bucket")))).alias(name)
        for name, share in shares.items()])


def stored_profile(stored: DataFrame, counted: DataFrame, slices: Sequence[str] = ()) -> DataFrame:
    """Profile of coarser slices out of stored metrics and buckets: no row of the table itself is read."""
    keys = [*slices, "column_name"]
    merged = merged_metrics(stored, slices)
    spread = F.col("squares") - ratio(F.col("total") * F.col("total"), F.col("filled"))
    middle = quantiles(merged_buckets(counted, slices), slices, {"q1_value": 0.25, "median_value": 0.5, "q3_value": 0.75})
    middle = middle.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return merged.join(middle, same, "left").select(
        *keys, "row_count", (F.col("row_count") - F.col("filled")).alias("null_count"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_count"),
        F.col("least").alias("min_value"), F.col("greatest").alias("max_value"),
        ratio(F.col("total"), F.col("filled")).alias("mean_value"),
        F.when(spread.isNotNull() & (F.col("filled") > 1), F.sqrt(F.greatest(spread, F.lit(0.0)) / (F.col("filled") - 1))).alias("stddev_value"),
        # A range's value may lie beyond the values it holds.
        *[F.greatest(F.col("least"), F.least(F.col("greatest"), F.col(q))).alias(q) for q in ("q1_value", "median_value", "q3_value")])


def stored_drift(counted: DataFrame, baseline: Column, current: Column) -> DataFrame:
    """Distance of two distributions per column, from stored buckets alone.

    ``baseline`` and ``current`` say which slices make up either side; a slice may
    lie in both. ``ks_distance`` is the greatest gap between the two cumulative shares,
    ``tv_distance`` half of the summed gaps between the shares of the ranges. NULL
    where a side has no value.
    """
    def part(side: Column) -> Column:
        return F.sum(F.when(side, F.col("n")).otherwise(F.lit(0).cast("long")))

    sides = counted.where(baseline | current).groupBy("column_name", "bucket").agg(part(baseline).alias("_b"), part(current).alias("_c"))
    spot = Window.partitionBy("column_name")
    upto = spot.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = sides.withColumns({
        "_all_b": F.sum("_b").over(spot), "_all_c": F.sum("_c").over(spot),
        "_upto_b": F.sum("_b").over(upto), "_upto_c": F.sum("_c").over(upto)})
    return shares.groupBy("column_name").agg(
        F.max("_all_b").alias("baseline_values"), F.max("_all_c").alias("current_values"),
        F.max(F.abs(ratio(F.col("_upto_b"), F.col("_all_b")) - ratio(F.col("_upto_c"), F.col("_all_c")))).alias("ks_distance"),
        (F.sum(F.abs(ratio(F.col("_b"), F.col("_all_b")) - ratio(F.col("_c"), F.col("_all_c")))) / 2).alias("tv_distance"),
        F.count(F.lit(1)).alias("ranges"))
