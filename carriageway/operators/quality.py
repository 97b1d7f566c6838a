"""Data-quality suites, column tests, stream expectations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.functions.rules import ratio


@dataclass(frozen=True)
class Check:
    """A bad-row predicate in SQL text and the share of bad rows still accepted."""

    name: str
    bad: str
    threshold: float = 0.0


# Accepted severities and the rules of each suite.
SEVERITY_LIST = "'Fatal','Serious Injury','Minor Injury','Property Damage Only','Unknown'"


def incident_checks(as_of: date) -> list[Check]:
    return [
        Check("incident_id not null", "incident_id IS NULL"),
        Check("incident_datetime not null", "incident_datetime IS NULL"),
        Check("severity is valid", f"severity NOT IN ({SEVERITY_LIST})", 0.01),
        Check("latitude in valid range", "latitude < -90 OR latitude > 90"),
        Check("fatalities non-negative", "fatalities < 0"),
        Check("no future incidents", f"incident_datetime > TIMESTAMP_NTZ '{as_of} 00:00:00'"),
    ]


BRIDGE_CHECKS = [
    Check("bridge_id not null", "bridge_id IS NULL"),
    Check("year_built plausible", "year_built < 1800 OR year_built > 2025", 0.01),
    Check("sufficiency_rating 0-100", "sufficiency_rating < 0 OR sufficiency_rating > 100", 0.01),
    Check("avg_daily_traffic non-negative", "avg_daily_traffic < 0"),
]
VEHICLE_CHECKS = [
    Check("vin not null", "vin IS NULL"),
    Check("model_year plausible", "model_year < 1900 OR model_year > 2025", 0.01),
    Check("gvwr positive", "gvwr_lbs <= 0", 0.01),
]
PAVEMENT_CHECKS = [
    Check("segment_id not null", "segment_id IS NULL"),
    Check("iri non-negative", "iri < 0"),
    Check("cracking_percent 0-100", "cracking_percent < 0 OR cracking_percent > 100", 0.01),
]


def run_checks(df: DataFrame, domain: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check. All checks share one pass over the table."""
    bad_counts = [F.count_if(F.expr(c.bad)).alias(f"bad_{i}") for i, c in enumerate(checks)]
    totals = df.agg(F.count(F.lit(1)).alias("total"), *bad_counts)
    entries = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.col(f"bad_{i}").alias("bad_rows"),
            F.lit(float(c.threshold)).alias("threshold"),
        )
        for i, c in enumerate(checks)
    ]
    rows = totals.select("total", F.inline(F.array(*entries)))
    rate = F.coalesce(ratio("bad_rows", "total"), F.lit(0.0))
    return rows.select(
        F.lit(domain).alias("domain"), "check_name", "bad_rows", F.col("total").alias("total_rows"),
        rate.alias("bad_rate"), "threshold",
        F.when(rate <= F.col("threshold"), "PASS").otherwise("FAIL").alias("status"),
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with the row count; NULL is not a key."""
    return (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    )


def negative_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def future_rows(df: DataFrame, column: str, as_of: Column) -> DataFrame:
    return df.where(F.col(column) > as_of)


def orphan_rows(df: DataFrame, codes: DataFrame, column: str, code: str) -> DataFrame:
    """Rows whose code is missing from the code table (NULL codes included)."""
    return df.join(codes.select(F.col(code).alias("_code")).distinct(), F.col(column) == F.col("_code"), "left_anti")


def keep_expected(df: DataFrame, must_hold: Mapping[str, str]) -> DataFrame:
    """Drop rows failing any rule; a NULL result is a failure."""
    for rule in must_hold.values():
        df = df.where(F.coalesce(F.expr(rule), F.lit(False)))
    return df


def violations(rules: Mapping[str, str]) -> list[Column]:
    """Aggregates counting the rows that fail each rule (for ``observe`` or ``agg``)."""
    return [
        F.count_if(~F.coalesce(F.expr(rule), F.lit(False))).alias(name) for name, rule in rules.items()
    ]
