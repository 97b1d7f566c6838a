"""Snapshot profiles of a mart and drift between two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carriageway.functions.rules import ratio


def profile(
    df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = False, accuracy: int = 10000
) -> DataFrame:
    """One row per column: counts, distinct values, range, mean, spread, median.

    One aggregate over one scan. Distinct counts are sketches unless
    ``exact_distinct`` asks for the costlier exact form, which repeats every
    row once per column in the shuffle; quantiles are bounded sketches.
    """
    columns = list(columns or df.columns)
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    distinct = F.countDistinct if exact_distinct else F.approx_count_distinct
    measures = [F.count(F.lit(1)).alias("row_count")]
    for i, name in enumerate(columns):
        measures += [F.count(name).alias(f"present_{i}"), distinct(F.col(name)).alias(f"distinct_{i}")]
        if name in numeric:
            value = F.col(name).cast("double")
            measures += [
                F.min(value).alias(f"min_{i}"), F.max(value).alias(f"max_{i}"), F.avg(value).alias(f"mean_{i}"),
                F.stddev_samp(value).alias(f"sd_{i}"),
                F.percentile_approx(value, 0.5, accuracy).alias(f"median_{i}"),
            ]
    nothing = F.lit(None).cast("double")
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("row_count"),
            (F.col("row_count") - F.col(f"present_{i}")).alias("null_count"),
            F.col(f"distinct_{i}").alias("distinct_count"),
            *[
                (F.col(f"{short}_{i}") if name in numeric else nothing).alias(full)
                for short, full in (
                    ("min", "min_value"), ("max", "max_value"), ("mean", "mean_value"),
                    ("sd", "stddev_value"), ("median", "median_value"),
                )
            ],
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def numeric_drift(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Shift of mean and null share per numeric column between two snapshots."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        measures = [m for i, c in enumerate(columns) for m in (F.avg(c).alias(f"mean_{i}"), F.count(c).alias(f"present_{i}"))]
        rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"mean_{i}").alias(f"{tag}_mean"),
                         ratio(F.col("row_count") - F.col(f"present_{i}"), "row_count").alias(f"{tag}_null_rate"))
                for i, c in enumerate(columns)]
        return df.agg(F.count(F.lit(1)).alias("row_count"), *measures).select(F.inline(F.array(*rows)))

    return side(baseline, "baseline").join(side(current, "current"), "column_name", "inner").select(
        "*",
        (F.col("current_mean") - F.col("baseline_mean")).alias("mean_shift"),
        (F.col("current_null_rate") - F.col("baseline_null_rate")).alias("null_rate_shift"),
    )


def category_drift(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total-variation distance of category shares per column.

    Both snapshots are counted in one group-by per column, so only
    (column, category) rows meet.
    """
    tagged = baseline.select(*columns, F.lit(1).alias("_b"), F.lit(0).alias("_c")).unionByName(
        current.select(*columns, F.lit(0).alias("_b"), F.lit(1).alias("_c"))
    )
    long = tagged.select(
        "_b", "_c",
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category")) for c in columns
        ])),
    )
    shares = long.groupBy("column_name", "category").agg(F.sum("_b").alias("b"), F.sum("_c").alias("c"))
    # The sizes of the snapshots are the sums of their category counts.
    sizes = shares.groupBy("column_name").agg(F.sum("b").alias("all_b"), F.sum("c").alias("all_c"))
    gap = F.abs(ratio(F.col("b"), F.col("all_b")) - ratio(F.col("c"), F.col("all_c")))
    return (
        shares.join(sizes, "column_name").withColumn("gap", gap)
        .groupBy("column_name")
        .agg((F.sum("gap") / 2).alias("tv_distance"), F.count(F.lit(1)).alias("categories"))
    )
