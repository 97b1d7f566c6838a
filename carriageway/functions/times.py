"""Date functions. Rules never read the clock: they take an ``as_of`` date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from carriageway.functions.rules import as_col

AS_OF = date(2024, 12, 31)
REF_YEAR = 2024

# Weekday names, 1 = Sunday.
DAY_NAMES = {1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday", 5: "Thursday", 6: "Friday"}


def is_weekend(value: Column | str) -> Column:
    return F.coalesce(F.dayofweek(as_col(value)).isin(1, 7), F.lit(False))


def days_since(value: Column | str, as_of: date = AS_OF) -> Column:
    return F.datediff(F.lit(as_of), F.to_date(as_col(value)))


def years_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier) / F.lit(365.25)


def age_in(year: Column | str, ref_year: int = REF_YEAR) -> Column:
    return F.lit(ref_year) - as_col(year)


def instant(value: Column | str) -> Column:
    """Zone-less timestamp as an instant in the session zone (watermarks need one)."""
    return as_col(value).cast("timestamp")


def wall_clock(value: Column | str) -> Column:
    """Instant back to a zone-less timestamp."""
    return as_col(value).cast("timestamp_ntz")


def at_midnight(as_of: date) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def in_hours(hour: Column | str, *spans: tuple[int, int]) -> Column:
    """Hour inside any of the inclusive spans."""
    hour = as_col(hour)
    out = hour.between(*spans[0])
    for span in spans[1:]:
        out = out | hour.between(*span)
    return out
