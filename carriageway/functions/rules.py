"""Business-rule building blocks: bands, lookups, guarded arithmetic, rounding."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def banded(value: Column | str, op: str, cuts: Sequence[tuple], otherwise) -> Column:
    """First label whose cut holds, in the order given; NULL falls to ``otherwise``."""
    value, compare = as_col(value), _COMPARE[op]
    out = None
    for cut, label in cuts:
        branch = compare(value, F.lit(cut))
        out = F.when(branch, F.lit(label)) if out is None else out.when(branch, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def looked_up(value: Column | str, table: Mapping, default=None) -> Column:
    """Simple CASE over a fixed value list."""
    value = as_col(value)
    out = None
    for key, label in table.items():
        out = F.when(value == key, F.lit(label)) if out is None else out.when(value == key, F.lit(label))
    return out.otherwise(F.lit(default))


def truthy(predicate: Column) -> Column:
    """Predicate as a two-valued flag: NULL counts as false."""
    return F.coalesce(predicate, F.lit(False))


def _spare_scale(digits: int) -> int:
    """Decimal places kept before rounding: always some beyond the ones asked for."""
    return 6 if digits <= 4 else 10


def rounded(value: Column | str, digits: int) -> Column:
    """Half-up rounding of a bounded per-row number, equal in other SQL engines.

    The value passes through a decimal first, so binary noise around a tie
    cannot flip the last digit. Up to four digits the decimal is long-backed.
    Range: below 10^12.
    """
    scale = _spare_scale(digits)
    return F.round(as_col(value).cast(f"decimal({12 + scale},{scale})"), digits).cast("double")


def rounded_total(value: Column | str, digits: int) -> Column:
    """As ``rounded``, for sums over any number of rows."""
    return F.round(as_col(value).cast(f"decimal(38,{_spare_scale(digits)})"), digits).cast("double")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; zero or NULL denominator gives NULL."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def guarded_ratio(numerator, denominator, fallback) -> Column:
    """Quotient only where the denominator is positive, else ``fallback``."""
    denominator = as_col(denominator)
    return F.when(denominator > 0, as_col(numerator) / denominator).otherwise(fallback)


def change_pct(now: Column | str, before: Column | str, digits: int = 1) -> Column:
    """Percent change against an earlier value; zero or NULL earlier gives NULL."""
    now, before = as_col(now), as_col(before)
    return rounded_total(ratio(now - before, before) * 100, digits)


def trend_arrow(now: Column | str, before: Column | str) -> Column:
    """Up only on a known rise; an unknown earlier value points down."""
    return F.when(as_col(now) > as_col(before), F.lit("▲")).otherwise(F.lit("▼"))


def clamped(value: Column | str, low: float, high: float) -> Column:
    return F.least(F.greatest(as_col(value), F.lit(low)), F.lit(high))


def tally(predicate: Column) -> Column:
    """Rows for which the predicate is true (NULL is not)."""
    return F.count_if(predicate)


def hash_draw(key: Column, salt: Column | str) -> Column:
    """Repeatable draw in [0, 1) from a key, the same under any partitioning.

    28 bits of an md5 digest: any SQL engine can reproduce it.
    """
    salt = F.lit(salt) if isinstance(salt, str) else salt
    digest = F.md5(F.concat(key.cast("string"), F.lit("|"), salt))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("double") / F.lit(268435456.0)
