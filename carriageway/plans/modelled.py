"""Second variants of silver and gold, as the declarative model project defines them.

They differ on purpose from ``silver`` and ``gold``: more columns are trimmed,
unknown casualties count as zero, flags become booleans, labels use a plain
hyphen, rates are not rounded, and nothing is de-duplicated (a uniqueness test
guards the key instead).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carriageway.functions.rules import banded, ratio, truthy
from carriageway.functions.text import means_true, trimmed, trimmed_upper
from carriageway.functions.times import AS_OF, age_in, days_since
from carriageway.operators.measures import rollup_by
from carriageway.operators.ordered import rank_by
from carriageway.operators.settle import settled
from carriageway.plans.gold import (
    BRIDGE_KEYS, CORRIDOR_KEYS, INCIDENT_KEYS, bridge_measures, corridor_measures, incident_measures,
)
from carriageway.plans.silver import (
    AGE_BANDS, INSPECTION_CYCLE_DAYS, OLDEST_BAND, bridge_risk, incident_clock, priority_tier,
    severity_score, worst_condition,
)

# Hyphen forms of the tier labels, plausible building years.
PRIORITY_CUTS = [
    (70, "Priority 1 - Immediate"),
    (45, "Priority 2 - Near Term"),
    (20, "Priority 3 - Planned"),
]
LOWEST_PRIORITY = "Priority 4 - Monitor"
CORRIDOR_TIERS = [(10, "Top 10 - Critical"), (25, "Top 25 - High Risk"), (50, "Top 50 - Elevated")]
BUILT_BETWEEN = (1800, 2025)

_UPPER = ("state_code", "county_code", "route_id")


def _stamped(df: DataFrame, stamp: bool, name: str) -> DataFrame:
    return df.withColumn(name, F.current_timestamp()) if stamp else df


def _present(df: DataFrame, rules: dict) -> dict:
    """Rules for the columns the source has; raw and already cleaned inputs both work."""
    return {name: rule for name, rule in rules.items() if name in df.columns}


def model_incidents(raw: DataFrame, stamp: bool = True) -> DataFrame:
    """P21."""
    kept = raw.where(F.col("incident_id").isNotNull() & F.col("incident_datetime").isNotNull())
    plain = ("severity", "road_condition", "weather_condition", "status")
    cleaned = kept.withColumns(_present(kept, {
        **{c: trimmed_upper(c) for c in ("incident_type", *_UPPER)},
        **{c: trimmed(c) for c in plain},
    }))
    derived = cleaned.withColumns({
        **incident_clock(),
        "has_fatality": truthy(F.col("fatalities") > 0),
        "total_casualties": F.coalesce("fatalities", F.lit(0)) + F.coalesce("injuries", F.lit(0)),
        "severity_score": severity_score(),
    })
    return _stamped(derived, stamp, "silver_loaded_at")


def model_bridges(raw: DataFrame, as_of: date = AS_OF, stamp: bool = True) -> DataFrame:
    """P22."""
    kept = raw.where(F.col("bridge_id").isNotNull() & F.col("year_built").between(*BUILT_BETWEEN))
    flags = ("structurally_deficient", "functionally_obsolete")
    cleaned = kept.withColumns(_present(kept, {
        **{c: trimmed_upper(c) for c in _UPPER},
        **{c: trimmed(c) for c in ("bridge_type", "material_type", "owner_type")},
        **{c: means_true(c) for c in flags},
    }))
    derived = cleaned.withColumns({
        "bridge_age_years": age_in("year_built"),
        "age_category": banded(age_in("year_built"), "<", AGE_BANDS, OLDEST_BAND),
        "worst_condition": worst_condition(),
        "risk_score": bridge_risk(F.col("structurally_deficient")),
        "days_since_inspection": days_since("last_inspection_date", as_of),
    }).withColumns({
        "priority_tier": priority_tier("risk_score", PRIORITY_CUTS, LOWEST_PRIORITY),
        "inspection_overdue": truthy(F.col("days_since_inspection") > INSPECTION_CYCLE_DAYS),
    })
    return _stamped(derived, stamp, "silver_loaded_at")


def model_incident_summary(silver: DataFrame, stamp: bool = True) -> DataFrame:
    """P23."""
    mart = rollup_by(silver, INCIDENT_KEYS, incident_measures()).withColumns({
        "fatality_rate": ratio("total_fatalities", "total_incidents"),
        "injury_rate": ratio("total_injuries", "total_incidents"),
    })
    return _stamped(mart, stamp, "gold_loaded_at")


def model_corridors(silver: DataFrame, stamp: bool = True) -> DataFrame:
    """P24. Rank with tie-breakers: fatalities, then incidents, then route id."""
    mart = rollup_by(silver, CORRIDOR_KEYS, corridor_measures()).withColumn(
        "fatality_concentration", ratio("total_fatalities", "incident_count")
    )
    order = [F.col("total_fatalities").desc_nulls_last(), F.col("incident_count").desc(), F.col("route_id")]
    ranked = rank_by(settled(mart, "corridors"), ["state_code"], ["total_fatalities", "incident_count", "route_id"], order, "state_rank")
    out = ranked.withColumn("risk_tier", banded("state_rank", "<=", CORRIDOR_TIERS, "Standard"))
    return _stamped(out, stamp, "gold_loaded_at")


def model_bridge_health(silver: DataFrame, stamp: bool = True) -> DataFrame:
    """P25."""
    flags = (F.col("structurally_deficient"), F.col("functionally_obsolete"))
    mart = rollup_by(silver, BRIDGE_KEYS, bridge_measures(*flags)).withColumns({
        "deficiency_rate": ratio("structurally_deficient_count", "bridge_count"),
        "total_estimated_repair_cost_m": F.col("total_estimated_repair_cost_k") / F.lit(1000.0),
    })
    return _stamped(mart, stamp, "gold_loaded_at")
