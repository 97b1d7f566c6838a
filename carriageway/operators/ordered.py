"""Ordered windows over keys of any size.

A plain window hands one key to one task. When a single route, state or score
list may hold a third of a table, the order is cut into slices first: each
slice is windowed on its own, and slice totals (a few rows per key) carry the
running state across slices. ``slice_by`` is any expression that never
decreases along the order, e.g. a day, or a sequence number divided by 10,000;
equal order values must fall in one slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICE = "_slice"


def _with_slice(df: DataFrame, slice_by: Column) -> DataFrame:
    return df.withColumn(_SLICE, slice_by)


def beside(df: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on same-named keys where NULL matches NULL, key columns kept once."""
    renamed = extra.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    return df.join(renamed, cond, "left").drop(*[f"_right_{key}" for key in keys])


def _attach(df: DataFrame, carried: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    on = [*keys, _SLICE]
    return beside(df, carried.select(*on, *columns), on)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    slice_by: Column,
    totals: dict[str, Column],
    inclusive: bool = True,
    descending: bool = False,
) -> DataFrame:
    """Running sums along the order, up to the row (or up to the one before it)."""
    sliced = _with_slice(df, slice_by).withColumns({f"_v_{n}": v for n, v in totals.items()})
    across = Window.partitionBy(*keys).orderBy(F.col(_SLICE).desc() if descending else F.col(_SLICE))
    carried = (
        sliced.groupBy(*keys, _SLICE)
        .agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals])
        .withColumns({
            f"_b_{n}": F.coalesce(F.sum(f"_s_{n}").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            for n in totals
        })
    )
    within = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    local = sliced.withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(within) for n in totals})
    out = _attach(local, carried, keys, [f"_b_{n}" for n in totals])
    out = out.withColumns({n: F.coalesce(F.col(f"_l_{n}"), F.lit(0)) + F.col(f"_b_{n}") for n in totals})
    return out.drop(_SLICE, *[f"_{p}_{n}" for n in totals for p in "vlb"])


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], slice_by: Column, out: str, descending: bool = False
) -> DataFrame:
    """Sequence number per key along the order."""
    return running_totals(df, keys, order, slice_by, {out: F.lit(1)}, descending=descending)


def next_values(
    df: DataFrame, keys: Sequence[str], order: str, slice_by: Column, columns: dict[str, str]
) -> DataFrame:
    """Values of the following row per key: ``columns`` maps output name to source column."""
    sliced = _with_slice(df, slice_by)
    within = Window.partitionBy(*keys, _SLICE).orderBy(order)
    local = sliced.withColumns({
        "_more": F.lead(F.lit(True), 1, False).over(within),
        **{f"_n_{name}": F.lead(source).over(within) for name, source in columns.items()},
    })
    across = Window.partitionBy(*keys).orderBy(_SLICE)
    firsts = sliced.groupBy(*keys, _SLICE).agg(
        F.min_by(F.struct(*[F.col(s).alias(n) for n, s in columns.items()]), F.col(order)).alias("_head")
    )
    carried = firsts.withColumn("_next", F.lead("_head").over(across)).drop("_head")
    out = _attach(local, carried, keys, ["_next"]).withColumns({
        name: F.when(F.col("_more"), F.col(f"_n_{name}")).otherwise(F.col(f"_next.{name}")) for name in columns
    })
    return out.drop(_SLICE, "_more", "_next", *[f"_n_{n}" for n in columns])


def rank_by(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[Column],
    out: str,
    slice_by: Column | None = None,
) -> DataFrame:
    """Rank with ties by ``columns`` in ``order``, whose first column descends, NULL last.

    Rows are first counted per distinct value, so ties cost nothing and only
    distinct values are ordered; the rank of a value is one plus the rows above.
    """
    tied = df.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("_rows"))
    # A NULL sits below every value: give it the lowest slice there is.
    cut = slice_by if slice_by is not None else value_slice(tied, columns[0])
    cut = F.coalesce(cut.cast("double"), F.lit(float("-inf")))
    above = running_totals(tied, keys, order, cut, {"_above": F.col("_rows")}, inclusive=False, descending=True)
    ranks = above.select(*keys, *columns, (F.col("_above") + 1).cast("int").alias(out))
    return beside(df, ranks, [*keys, *columns])


def rank_desc(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Rank with ties by one number, highest first, NULL last."""
    return rank_by(df, keys, [value], [F.col(value).desc_nulls_last()], out)


def value_slice(df: DataFrame, value: str, slices: int = 64, of: Column | None = None) -> Column:
    """Slice number of a value of unknown range and distribution: how many of its approximate quantiles in ``df`` it exceeds.

    The quantiles are a scalar subquery over all rows, with partial aggregation;
    it reuses the exchange that made ``df``. NaN is above every number, as in
    Spark's order. ``of`` is the value to place, where it is no column of that name.
    """
    v = F.col(value).cast("double")
    w = v if of is None else of.cast("double")
    places = F.array(*[F.lit(k / slices) for k in range(1, slices)])
    borders = F.coalesce(df.agg(F.percentile_approx(F.when(~F.isnan(v), v), places, 100 * slices)).scalar(), F.array().cast("array<double>"))
    reached = F.array_position(F.sort_array(F.array_append(borders, w)), w) - 1
    return F.when(F.isnan(w), slices).when(w.isNotNull(), reached)


def spread_scores(df: DataFrame, keys: Sequence[str], value: str, mean: str, spread: str) -> DataFrame:
    """Group mean and sample deviation beside every row.

    An aggregate joined back instead of an unordered window: the window would
    buffer a whole group in one task, the aggregate combines on the map side.
    """
    stats = df.groupBy(*keys).agg(F.avg(value).alias(mean), F.stddev_samp(value).alias(spread))
    return beside(df, stats, keys)
