"""Typed and enriched asset tables: incidents, bridges, vehicles, pavement."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.functions.rules import banded, looked_up, rounded, truthy
from carriageway.functions.text import starts_with
from carriageway.functions.times import AS_OF, REF_YEAR, age_in, at_midnight, days_since, is_weekend
from carriageway.operators.keys import one_row_per_key

# Labels, cut points and scores of the silver rules.
SEVERITY_SCORES = {"Fatal": 5, "Serious Injury": 4, "Minor Injury": 3, "Property Damage Only": 2}
AGE_BANDS = [(20, "New (<20 yrs)"), (40, "Mature (20-40 yrs)"), (60, "Aging (40-60 yrs)")]
OLDEST_BAND = "Old (60+ yrs)"
PRIORITY_CUTS = [
    (70, "Priority 1 – Immediate"),
    (45, "Priority 2 – Near Term"),
    (20, "Priority 3 – Planned"),
]
LOWEST_PRIORITY = "Priority 4 – Monitor"
WEIGHT_CLASSES = [
    (6000, "Class 1-2 – Light Duty"),
    (10000, "Class 3"),
    (14000, "Class 4"),
    (19500, "Class 5"),
    (26000, "Class 6"),
    (33000, "Class 7"),
]
HEAVIEST_CLASS = "Class 8 – Heavy Duty"
ROUGHNESS_BANDS = [(60, "Very Good"), (95, "Good"), (170, "Fair"), (220, "Mediocre")]
TREATMENT_CUTS = [(60, "Immediate Rehab"), (40, "Preventive Treatment"), (20, "Monitor")]
TRAFFIC_CUTS = [(50000, "High Volume"), (10000, "Medium Volume")]
CONDITION_PARTS = ("deck_condition", "superstructure_condition", "substructure_condition")
INSPECTION_CYCLE_DAYS = 730
CLEAN_FUELS = ("Electric", "Hybrid")


def severity_score(severity: str = "severity") -> Column:
    return looked_up(severity, SEVERITY_SCORES, 1)


def worst_condition(parts=CONDITION_PARTS) -> Column:
    """Poor if any part's code starts with P, else Fair for F, else Good.

    Codes C and N are not looked at, so three critical parts come out Good;
    the rule is kept as published.
    """

    def any_part(letter: str) -> Column:
        hit = truthy(starts_with(parts[0], letter))
        for part in parts[1:]:
            hit = hit | truthy(starts_with(part, letter))
        return hit

    return F.when(any_part("P"), "Poor").when(any_part("F"), "Fair").otherwise("Good")


def bridge_risk(deficient: Column | None, ref_year: int = REF_YEAR) -> Column:
    """Composite 0..100+ score; ``deficient`` adds 20 where true, None leaves the term out."""
    score = (100 - F.col("sufficiency_rating")) * 0.5 + age_in("year_built", ref_year).cast("double") * 0.3
    if deficient is not None:
        score = score + F.when(deficient, F.lit(20)).otherwise(F.lit(0))
    return rounded(score, 1)


def priority_tier(score: Column | str, cuts=None, lowest=LOWEST_PRIORITY) -> Column:
    return banded(score, ">=", cuts or PRIORITY_CUTS, lowest)


def _stamped(df: DataFrame, stamp: bool, name: str = "silver_timestamp") -> DataFrame:
    return df.withColumn(name, F.current_timestamp()) if stamp else df


def incident_clock(when: str = "incident_datetime") -> dict[str, Column]:
    """Calendar parts of the incident time."""
    return {
        "incident_year": F.year(when),
        "incident_month": F.month(when),
        "incident_hour": F.hour(when),
        "day_of_week": F.dayofweek(when),
        "is_weekend": is_weekend(when),
    }


def timed_incidents(raw: DataFrame) -> DataFrame:
    """Incidents with id and time."""
    return raw.where(F.col("incident_id").isNotNull() & F.col("incident_datetime").isNotNull())


def silver_incidents(raw: DataFrame, stamp: bool = True) -> DataFrame:
    """P1. Unknown casualties stay unknown; rows without id or time are dropped.

    The drop comes before the de-duplication: NULL keys never reach its
    shuffle, however many there are.
    """
    return enriched_incidents(one_row_per_key(timed_incidents(raw), ["incident_id"]), stamp)


def enriched_incidents(single: DataFrame, stamp: bool = True) -> DataFrame:
    """P1 for rows that are unique by id."""
    cleaned = single.withColumns({
        "incident_type": F.upper(F.trim("incident_type")),
        "severity": F.trim("severity"),
        "state_code": F.upper("state_code"),
    })
    derived = cleaned.withColumns({
        **incident_clock(),
        "has_fatality": truthy(F.col("fatalities") > 0),
        "total_casualties": F.col("fatalities") + F.col("injuries"),
        "severity_score": severity_score(),
    })
    return _stamped(derived, stamp)


def silver_bridges(raw: DataFrame, as_of: date = AS_OF, stamp: bool = True) -> DataFrame:
    """P2. Flags stay text and count only when spelled exactly ``true``."""
    return enriched_bridges(one_row_per_key(raw, ["bridge_id"]), as_of, stamp)


def enriched_bridges(single: DataFrame, as_of: date = AS_OF, stamp: bool = True) -> DataFrame:
    """P2 for rows that are unique by id."""
    scored = single.withColumns({
        "state_code": F.upper("state_code"),
        "bridge_age_years": age_in("year_built"),
        "age_category": banded(age_in("year_built"), "<", AGE_BANDS, OLDEST_BAND),
        "worst_condition": worst_condition(),
        "risk_score": bridge_risk(F.col("structurally_deficient") == "true"),
        "days_since_inspection": days_since("last_inspection_date", as_of),
    })
    ranked = scored.withColumns({
        "priority_tier": priority_tier("risk_score"),
        "inspection_overdue": truthy(F.col("days_since_inspection") > INSPECTION_CYCLE_DAYS),
    })
    return _stamped(ranked, stamp)


def silver_vehicles(raw: DataFrame, as_of: date = AS_OF, stamp: bool = True) -> DataFrame:
    """P3."""
    return enriched_vehicles(one_row_per_key(raw, ["vin"]), as_of, stamp)


def enriched_vehicles(single: DataFrame, as_of: date = AS_OF, stamp: bool = True) -> DataFrame:
    """P3 for rows that are unique by number."""
    derived = single.withColumns({
        "state_code": F.upper("state_code"),
        "vehicle_age": age_in("model_year"),
        "weight_class": banded("gvwr_lbs", "<=", WEIGHT_CLASSES, HEAVIEST_CLASS),
        "is_electric": F.col("fuel_type").isin(*CLEAN_FUELS),
        "is_commercial": F.col("commercial_vehicle") == "true",
        "is_expired": F.col("expiration_date") < at_midnight(as_of),
        "reg_year": F.year("registration_date"),
    })
    return _stamped(derived, stamp)


def distress_index() -> Column:
    return rounded(
        F.col("cracking_percent") * 0.4 + F.col("rutting_in") * 5 + (100 - F.col("pcr")) * 0.6, 1
    )


def silver_pavement(raw: DataFrame, stamp: bool = True) -> DataFrame:
    """P4."""
    return enriched_pavement(one_row_per_key(raw, ["segment_id"]), stamp)


def enriched_pavement(single: DataFrame, stamp: bool = True) -> DataFrame:
    """P4 for rows that are unique by id."""
    derived = single.withColumns({
        "state_code": F.upper("state_code"),
        "pavement_age": age_in("year_constructed"),
        "iri_category": banded("iri", "<=", ROUGHNESS_BANDS, "Poor"),
        "distress_index": distress_index(),
        "traffic_category": banded("aadt", ">=", TRAFFIC_CUTS, "Low Volume"),
    }).withColumn("maintenance_priority", banded("distress_index", ">=", TREATMENT_CUTS, "No Action"))
    return _stamped(derived, stamp)
