"""Reporting marts aggregated from the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.functions.rules import (
    banded, guarded_ratio, looked_up, ratio, rounded_total, tally,
)
from carriageway.functions.times import in_hours
from carriageway.operators.measures import rollup_by, sum_where
from carriageway.operators.ordered import rank_desc
from carriageway.operators.settle import settled

# Corridor tiers, treatment unit costs in dollars per lane mile,
# hours of the day spans, ratings that count as poor.
CORRIDOR_TIERS = [(10, "Top 10 – Critical"), (25, "Top 25 – High Risk"), (50, "Top 50 – Elevated")]
UNIT_COSTS = {"Immediate Rehab": 800000, "Preventive Treatment": 250000, "Monitor": 10000}
MORNING, EVENING, NIGHT = [(6, 9)], [(15, 19)], [(22, 23), (0, 5)]
POOR_RATINGS = ("Poor", "Very Poor")


def _stamped(df: DataFrame, stamp: bool) -> DataFrame:
    return df.withColumn("gold_timestamp", F.current_timestamp()) if stamp else df


def incident_measures() -> dict[str, Column]:
    return {
        "total_incidents": F.count("incident_id"),
        "total_fatalities": F.sum("fatalities"),
        "total_injuries": F.sum("injuries"),
        "total_casualties": F.sum("total_casualties"),
        "avg_vehicles_involved": F.avg("vehicles_involved"),
        "counties_affected": F.countDistinct("county_code"),
        "fatal_incidents": tally(F.col("has_fatality")),
        "weekend_incidents": tally(F.col("is_weekend")),
        "morning_rush_incidents": tally(in_hours("incident_hour", *MORNING)),
        "evening_rush_incidents": tally(in_hours("incident_hour", *EVENING)),
        "overnight_incidents": tally(in_hours("incident_hour", *NIGHT)),
    }


INCIDENT_KEYS = ["state_code", "route_id", "incident_year", "incident_month", "incident_type", "severity"]


def incident_summary(silver: DataFrame, stamp: bool = True) -> DataFrame:
    """P5."""
    mart = rollup_by(silver, INCIDENT_KEYS, incident_measures()).withColumns({
        "fatality_rate": rounded_total(ratio("total_fatalities", "total_incidents"), 4),
        "injury_rate": rounded_total(ratio("total_injuries", "total_incidents"), 4),
    })
    return _stamped(mart, stamp)


CORRIDOR_KEYS = ["state_code", "route_id", "county_code"]


def corridor_measures() -> dict[str, Column]:
    return {
        "incident_count": F.count("incident_id"),
        "total_fatalities": F.sum("fatalities"),
        "total_injuries": F.sum("injuries"),
        "incident_type_diversity": F.countDistinct("incident_type"),
        "avg_severity_score": F.avg("severity_score"),
        "most_recent_incident": F.max("incident_datetime"),
    }


def high_risk_corridors(silver: DataFrame, stamp: bool = True) -> DataFrame:
    """P6. A bare rank: ties share a place, so a tier can hold more rows than its name says.

    The mart is written once and ranked from there: one pass over the incidents.
    """
    mart = rollup_by(silver, CORRIDOR_KEYS, corridor_measures()).withColumn(
        "fatality_concentration", rounded_total(ratio("total_fatalities", "incident_count"), 3)
    )
    ranked = rank_desc(settled(mart, "corridors"), ["state_code"], "total_fatalities", "state_rank")
    return _stamped(ranked.withColumn("risk_tier", banded("state_rank", "<=", CORRIDOR_TIERS, "Standard")), stamp)


BRIDGE_KEYS = ["state_code", "county_code", "bridge_type", "age_category", "priority_tier"]


def bridge_measures(deficient: Column, obsolete: Column) -> dict[str, Column]:
    return {
        "bridge_count": F.count("bridge_id"),
        "avg_sufficiency_rating": F.avg("sufficiency_rating"),
        "min_sufficiency_rating": F.min("sufficiency_rating"),
        "avg_bridge_age": F.avg("bridge_age_years"),
        "avg_daily_traffic": F.avg("avg_daily_traffic"),
        "total_daily_traffic_exposed": F.sum("avg_daily_traffic"),
        "structurally_deficient_count": tally(deficient),
        "functionally_obsolete_count": tally(obsolete),
        "overdue_inspections": tally(F.col("inspection_overdue")),
        "total_estimated_repair_cost_k": F.sum("estimated_repair_cost_k"),
        "avg_risk_score": F.avg("risk_score"),
        "max_risk_score": F.max("risk_score"),
    }


def bridge_health(silver: DataFrame, stamp: bool = True) -> DataFrame:
    """P7."""
    flags = (F.col("structurally_deficient") == "true", F.col("functionally_obsolete") == "true")
    mart = rollup_by(silver, BRIDGE_KEYS, bridge_measures(*flags)).withColumns({
        "deficiency_rate": rounded_total(ratio("structurally_deficient_count", "bridge_count"), 3),
        "total_estimated_repair_cost_m": rounded_total(F.col("total_estimated_repair_cost_k") / 1000, 2),
    })
    return _stamped(mart, stamp)


def fleet_snapshot(silver: DataFrame, stamp: bool = True) -> DataFrame:
    """P8."""
    keys = ["state_code", "vehicle_class", "weight_class", "fuel_type", "model_year"]
    mart = rollup_by(silver, keys, {
        "registered_vehicles": F.count("vin"),
        "avg_vehicle_age": F.avg("vehicle_age"),
        "avg_gvwr_lbs": F.avg("gvwr_lbs"),
        "electric_count": tally(F.col("is_electric")),
        "commercial_count": tally(F.col("is_commercial")),
        "hazmat_count": tally(F.col("hazmat_certified") == "true"),
        "expired_registrations": tally(F.col("is_expired")),
    }).withColumns({
        "electric_share": rounded_total(ratio("electric_count", "registered_vehicles"), 3),
        "commercial_share": rounded_total(ratio("commercial_count", "registered_vehicles"), 3),
    })
    return _stamped(mart, stamp)


def pavement_needs(silver: DataFrame, stamp: bool = True) -> DataFrame:
    """P9. Treatment cost is priced per row, before the group-by."""
    keys = ["state_code", "county_code", "functional_class", "pavement_type", "maintenance_priority", "iri_category"]
    cost = looked_up("maintenance_priority", UNIT_COSTS, 0) * F.col("segment_length_mi")
    mart = rollup_by(silver, keys, {
        "segment_count": F.count("segment_id"),
        "total_lane_miles": F.sum("segment_length_mi"),
        "avg_pcr": F.avg("pcr"),
        "avg_iri": F.avg("iri"),
        "avg_distress_index": F.avg("distress_index"),
        "avg_pavement_age": F.avg("pavement_age"),
        "total_estimated_cost_usd": F.sum(cost),
        "total_aadt": F.sum("aadt"),
    })
    per_aadt = guarded_ratio("total_estimated_cost_usd", "total_aadt", F.lit(0.0))
    return _stamped(mart.withColumn("cost_per_aadt", rounded_total(per_aadt, 2)), stamp)


def percent(part: str, whole: str, scale: int, digits: int) -> Column:
    return rounded_total(ratio(part, whole) * scale, digits)


def executive_scorecard(
    incidents: DataFrame, bridges: DataFrame, pavement: DataFrame, vehicles: DataFrame, stamp: bool = True
) -> DataFrame:
    """P10. Driven from incidents: a state without incidents has no row."""
    by_state = ["state_code"]
    safety = rollup_by(incidents, by_state, {
        "total_incidents": F.count("incident_id"),
        "total_fatalities": F.sum("fatalities"),
        "total_injuries": F.sum("injuries"),
    })
    structures = rollup_by(bridges, by_state, {
        "total_bridges": F.count("bridge_id"),
        "avg_bridge_sufficiency": F.avg("sufficiency_rating"),
        "deficient_bridges": tally(F.col("structurally_deficient") == "true"),
    })
    surface = rollup_by(pavement, by_state, {
        "total_lane_miles": F.sum("segment_length_mi"),
        "avg_pcr": F.avg("pcr"),
        "poor_pavement_miles": sum_where(F.col("condition_rating").isin(*POOR_RATINGS), "segment_length_mi"),
    })
    fleet = rollup_by(vehicles, by_state, {
        "total_registered_vehicles": F.count("vin"),
        "electric_vehicles": tally(F.col("is_electric")),
    })
    card = safety
    for side in (structures, surface, fleet):
        card = card.join(side, "state_code", "left")
    card = card.withColumns({
        "fatality_per_100k_vehicles": percent("total_fatalities", "total_registered_vehicles", 100000, 2),
        "poor_pavement_pct": percent("poor_pavement_miles", "total_lane_miles", 100, 1),
        "bridge_deficiency_pct": percent("deficient_bridges", "total_bridges", 100, 1),
        "ev_adoption_pct": percent("electric_vehicles", "total_registered_vehicles", 100, 1),
    })
    return _stamped(card, stamp)
