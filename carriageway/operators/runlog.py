"""Run log of jobs and models: parameters and metrics as rows, comparisons over time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.functions.rules import as_col
from carriageway.operators.keys import latest_per_key
from carriageway.operators.ordered import row_numbers


def log_rows(metrics: DataFrame, run: str, logged_at: Column, params: Mapping[str, object] = {}) -> DataFrame:
    """(run, kind, key, value, logged_at) rows from a one-row metric frame and plain parameters."""
    entries = [
        F.struct(F.lit("metric").alias("kind"), F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
        for c in metrics.columns
    ] + [
        F.struct(F.lit("param").alias("kind"), F.lit(k).alias("key"), F.lit(str(v)).alias("value"))
        for k, v in params.items()
    ]
    return metrics.select(
        F.lit(run).alias("run"), F.inline(F.array(*entries))
    ).withColumn("logged_at", logged_at)


def latest_runs(runs: DataFrame) -> DataFrame:
    """Newest run of each model."""
    return latest_per_key(runs, ["run_name"], "start_time", "run_id")


def numbered_runs(runs: DataFrame, out: str = "run_number") -> DataFrame:
    """Position of a run among its model's runs, oldest first; sliced by minute."""
    minute = F.date_trunc("minute", "start_time")
    return row_numbers(runs, ["run_name"], [F.col("start_time"), F.col("run_id")], minute, out)


def metrics_long(runs: DataFrame, metrics: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Wide metric columns to (metric, value) rows, empty values dropped."""
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return runs.select(*keep, F.inline(F.array(*entries))).where(F.col("value").isNotNull())


def first_to_last(runs: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """First and last value per key and the change; a zero first value gives 0 percent."""
    when = F.struct(*[F.col(c) for c in order])
    ends = runs.where(as_col(value).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.min_by(value, when).alias("first_value"),
        F.max_by(value, when).alias("last_value"),
    )
    delta = F.col("last_value") - F.col("first_value")
    pct = F.coalesce(F.try_divide(delta, F.col("first_value")) * 100, F.lit(0.0))
    return ends.withColumns({"delta": delta, "delta_pct": pct})
