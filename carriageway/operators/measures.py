"""Aggregation vocabulary shared by the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_by(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Group-by with named measures (map-side partial, then final)."""
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in measures.items()])


def counts(column: str, **named: Column) -> dict[str, Column]:
    """A key count followed by conditional counts."""
    return {column: F.count(F.lit(1)), **{name: F.count_if(p) for name, p in named.items()}}


def sum_where(predicate: Column, value: Column | str) -> Column:
    """Conditional sum of a measure; rows outside add zero."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(predicate, value).otherwise(F.lit(0)))


def share_where(predicate: Column) -> Column:
    """Share of rows for which the predicate is true."""
    return F.avg(F.when(predicate, F.lit(1.0)).otherwise(F.lit(0.0)))
