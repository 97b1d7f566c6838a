"""Named reports over the marts. Each takes marts and returns an ordered DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carriageway.functions.geometry import (
    METRES_PER_DEGREE, in_box, line_metres, planar_degrees, start_point,
)
from carriageway.functions.rules import banded, change_pct, looked_up, ratio, rounded, rounded_total, tally, trend_arrow
from carriageway.functions.times import DAY_NAMES
from carriageway.operators.measures import rollup_by
from carriageway.operators.ordered import beside, rank_desc
from carriageway.operators.settle import settled
from carriageway.operators.spatial import inside_polygons, uncovered

# Grade cuts, reported tiers, treatment order, report sizes.
SAFETY_GRADES = ([(15, "🔴 High Risk"), (8, "🟡 Moderate Risk")], "🟢 Low Risk")
PAVEMENT_GRADES = ([(25, "🔴 Critical"), (15, "🟡 Fair")], "🟢 Good")
BRIDGE_GRADES = ([(20, "🔴 Critical"), (10, "🟡 Fair")], "🟢 Good")
URGENT_CORRIDORS = ("Top 10 – Critical", "Top 25 – High Risk")
URGENT_BRIDGES = ("Priority 1 – Immediate", "Priority 2 – Near Term")
TREATMENT_ORDER = {"Immediate Rehab": 1, "Preventive Treatment": 2, "Monitor": 3}
I40_MIDPOINT = (35.5, -80.0)
REACH_DEGREES = 0.5
BUSY_CELL = 5


def grouped_digits(value: Column, decimals: int) -> Column:
    """Thousands separators and a fixed number of decimals."""
    return F.format_number(rounded_total(value, decimals), decimals)


def safety_scorecard(card: DataFrame) -> DataFrame:
    """R1."""
    return card.select(
        "state_code", "total_incidents", "total_fatalities", "total_injuries", "total_bridges",
        rounded_total("avg_bridge_sufficiency", 1).alias("avg_bridge_sufficiency"),
        "deficient_bridges", "bridge_deficiency_pct",
        rounded_total("total_lane_miles", 0).alias("total_lane_miles"),
        "poor_pavement_pct", "total_registered_vehicles", "ev_adoption_pct",
        rounded_total("fatality_per_100k_vehicles", 2).alias("fatality_per_100k_vehicles"),
        banded("fatality_per_100k_vehicles", ">", *SAFETY_GRADES).alias("safety_grade"),
        banded("poor_pavement_pct", ">", *PAVEMENT_GRADES).alias("pavement_grade"),
        banded("bridge_deficiency_pct", ">", *BRIDGE_GRADES).alias("bridge_grade"),
    ).orderBy(F.desc("total_fatalities"), "state_code")


def top_corridors(corridors: DataFrame, k: int = 20) -> DataFrame:
    """R2."""
    return (
        corridors.where(F.col("risk_tier").isin(*URGENT_CORRIDORS))
        .select(
            "state_code", "county_code", "route_id", "incident_count", "total_fatalities", "total_injuries",
            rounded_total("fatality_concentration", 3).alias("fatalities_per_incident"),
            rounded_total("avg_severity_score", 2).alias("avg_severity_score"),
            "risk_tier", "state_rank",
            F.date_format("most_recent_incident", "yyyy-MM-dd").alias("last_incident_date"),
            F.col("incident_type_diversity").alias("num_incident_types"),
        )
        .orderBy("state_code", "state_rank", "route_id", "county_code")
        .limit(k)
    )


def yearly_trend(summary: DataFrame, since: int = 2021, lag_rows: int = 12) -> DataFrame:
    """R3. The lag counts rows: it is the prior year only where no month is missing.

    The window runs over one row per state and month, so its groups are bounded
    by the calendar. The year filter follows the lag.
    """
    monthly = rollup_by(summary, ["state_code", "incident_year", "incident_month"], {
        "total_incidents": F.sum("total_incidents"),
        "total_fatalities": F.sum("total_fatalities"),
    })
    months = Window.partitionBy("state_code").orderBy("incident_year", "incident_month")
    lagged = monthly.withColumns({
        "incidents_prior_year": F.lag("total_incidents", lag_rows).over(months),
        "fatalities_prior_year": F.lag("total_fatalities", lag_rows).over(months),
    })
    return lagged.where(F.col("incident_year") >= since).select(
        "state_code",
        F.concat(F.col("incident_year").cast("string"), F.lit("-"),
                 F.lpad(F.col("incident_month").cast("string"), 2, "0")).alias("year_month"),
        "total_incidents", "total_fatalities", "incidents_prior_year", "fatalities_prior_year",
        change_pct("total_incidents", "incidents_prior_year").alias("incident_yoy_pct"),
        change_pct("total_fatalities", "fatalities_prior_year").alias("fatality_yoy_pct"),
        trend_arrow("total_incidents", "incidents_prior_year").alias("incident_trend"),
    ).orderBy("state_code", "year_month")


def bridge_investment(health: DataFrame) -> DataFrame:
    """R4."""
    urgent = settled(health.where(F.col("priority_tier").isin(*URGENT_BRIDGES)), "urgent-bridges")
    ranked = rank_desc(urgent, ["state_code"], "total_estimated_repair_cost_m", "cost_rank")
    return ranked.orderBy(
        "state_code", F.desc("total_estimated_repair_cost_m"), "county_code", "bridge_type", "age_category",
        "priority_tier",
    ).select(
        "state_code", "county_code", "bridge_type", "age_category", "priority_tier", "bridge_count",
        rounded_total("avg_sufficiency_rating", 1).alias("avg_sufficiency"),
        rounded_total("avg_bridge_age", 0).alias("avg_age_years"),
        "structurally_deficient_count", "functionally_obsolete_count", "overdue_inspections",
        grouped_digits(F.col("total_daily_traffic_exposed"), 0).alias("total_daily_traffic"),
        grouped_digits(F.col("total_estimated_repair_cost_m"), 1).alias("estimated_repair_cost_m_usd"),
        rounded_total("avg_risk_score", 1).alias("avg_risk_score"),
        rounded_total(F.col("deficiency_rate") * 100, 1).alias("deficiency_rate_pct"),
        "cost_rank",
    )


def pavement_needs_by_class(needs: DataFrame) -> DataFrame:
    """R5. ``avg_pcr`` is the mean of group means, as published."""
    per_mile = ratio(F.sum("total_estimated_cost_usd"), F.sum("total_lane_miles")) / 1000
    return rollup_by(needs, ["state_code", "functional_class", "maintenance_priority"], {
        "segment_groups": F.count(F.lit(1)),
        "total_lane_miles": rounded_total(F.sum("total_lane_miles"), 1),
        "avg_pcr": rounded_total(F.avg("avg_pcr"), 1),
        "avg_iri": rounded_total(F.avg("avg_iri"), 0),
        "total_cost_million_usd": rounded_total(F.sum("total_estimated_cost_usd") / 1e6, 2),
        "cost_per_lane_mile_k": rounded_total(per_mile, 1),
        "total_aadt_exposed": grouped_digits(F.sum("total_aadt"), 0),
    }).orderBy("state_code", "functional_class", looked_up("maintenance_priority", TREATMENT_ORDER, 4))


def fleet_trend(fleet: DataFrame, since: int = 2015) -> DataFrame:
    """R6."""

    def pct(part: str) -> Column:
        return rounded_total(ratio(F.sum(part), F.sum("registered_vehicles")) * 100, 2)

    return rollup_by(fleet.where(F.col("model_year") >= since), ["state_code", "model_year", "vehicle_class"], {
        "total_vehicles": F.sum("registered_vehicles"),
        "electric_vehicles": F.sum("electric_count"),
        "commercial_vehicles": F.sum("commercial_count"),
        "hazmat_vehicles": F.sum("hazmat_count"),
        "expired_registrations": F.sum("expired_registrations"),
        "ev_share_pct": pct("electric_count"),
        "expiry_rate_pct": pct("expired_registrations"),
    }).orderBy("state_code", F.desc("model_year"), "vehicle_class")


def day_name(number: Column | str) -> Column:
    return looked_up(number, DAY_NAMES, "Saturday")


def hour_weekday_heat(incidents: DataFrame) -> DataFrame:
    """R7."""
    heat = rollup_by(incidents, ["day_of_week", "incident_hour"], {
        "incident_count": F.count(F.lit(1)),
        "total_fatalities": F.sum("fatalities"),
        "avg_severity": rounded_total(F.avg("severity_score"), 2),
    })
    return heat.select(
        "day_of_week", day_name("day_of_week").alias("day_name"), "incident_hour", "incident_count",
        "total_fatalities", "avg_severity",
    ).orderBy("day_of_week", "incident_hour")


def top_hotspots(spots: DataFrame, k: int = 50) -> DataFrame:
    """R8."""
    return (
        spots.where("is_hotspot")
        .orderBy(F.desc("total_fatalities"), F.desc("incident_count"), "h3_index_r8", "state_code")
        .limit(k)
        .select(
            "h3_index_r8", "state_code", "incident_count", "total_fatalities", "total_injuries",
            rounded_total("avg_severity_score", 2).alias("avg_severity"),
            "fatal_incident_count", "night_incident_count", "weekend_incident_count",
            rounded_total("incident_density_per_km2", 2).alias("density_per_km2"),
            rounded_total("z_score", 2).alias("hotspot_z_score"),
            "hotspot_class", "risk_tier",
        )
    )


def corridor_ranking(rates: DataFrame, k: int = 30) -> DataFrame:
    """R9."""
    ranked = rank_desc(
        settled(rates, "corridor-rates"), ["functional_class"], "incidents_per_100m_vmt", "safety_rank_in_class"
    )
    return (
        ranked.orderBy(F.col("incidents_per_100m_vmt").desc_nulls_last(), "seg_route_id", "functional_class", "area_type")
        .limit(k)
        .select(
            F.col("seg_route_id").alias("route_id"), "functional_class", "area_type", "incidents_on_corridor",
            "fatalities_on_corridor", "injuries_on_corridor",
            grouped_digits(F.col("reference_aadt"), 0).alias("reference_aadt"),
            rounded_total("avg_severity", 2).alias("avg_severity_score"),
            rounded_total("incidents_per_100m_vmt", 4).alias("incidents_per_100m_vmt"),
            "safety_rank_in_class",
        )
    )


def bridge_risk_by_zone(placed: DataFrame, k: int = 25, least_bridges: int = 2) -> DataFrame:
    """R10. One row per reported zone and first-priority bridge; a zone without one has a single row with a NULL id."""
    keys = ["taz_id", "zone_type", "state_code"]
    base = settled(placed, "placed-bridges")
    totals = rollup_by(base, keys, {
        "bridge_count": F.count("bridge_id"),
        "poor_condition_bridges": tally(F.col("worst_condition") == "Poor"),
        "avg_risk_score": rounded_total(F.avg("risk_score"), 1),
        "avg_sufficiency": rounded_total(F.avg("sufficiency_rating"), 1),
        "taz_population": F.max("taz_population"),
        "taz_vehicle_trips": F.max("taz_vehicle_trips"),
        "total_pop_at_risk_score": rounded_total(F.sum("population_at_risk_score"), 0),
        "total_bridge_aadt": F.sum("avg_daily_traffic"),
    }).where(F.col("bridge_count") >= least_bridges)
    order = [F.col("total_pop_at_risk_score").desc_nulls_last(), *[F.col(k_) for k_ in keys]]
    top = settled(totals.orderBy(*order).limit(k), "risk-zones")
    urgent = base.where(F.col("priority_tier") == URGENT_BRIDGES[0]).select(*keys, F.col("bridge_id").alias("p1_bridge_id"))
    return beside(top, urgent, keys).orderBy(*order, "p1_bridge_id")


def coarse_rollup(cells: DataFrame) -> DataFrame:
    """R11."""
    high = F.col("risk_tier").like("%Critical%") | F.col("risk_tier").like("%High%")
    distinct_cells = F.countDistinct("h3_index_r8")
    return (
        cells.groupBy(F.col("h3_index_r6").alias("h3_county_cell"), "state_code")
        .agg(
            distinct_cells.alias("sub_cells_count"),
            F.sum("incident_count").alias("total_incidents"),
            F.sum("total_fatalities").alias("total_fatalities"),
            F.sum("fatal_incident_count").alias("fatal_incidents"),
            F.sum("night_incident_count").alias("night_incidents"),
            F.sum("pedestrian_count").alias("pedestrian_incidents"),
            F.sum("dui_count").alias("dui_incidents"),
            rounded_total(ratio(F.sum("incident_count"), distinct_cells), 1).alias("avg_incidents_per_cell"),
            rounded_total(F.avg("avg_severity_score"), 2).alias("avg_severity"),
            tally(high).alias("high_risk_sub_cells"),
        )
        .orderBy(F.desc("total_fatalities"), "h3_county_cell", "state_code")
    )


def work_zone_actions(conflicts: DataFrame) -> DataFrame:
    """R12."""
    action = (
        F.when(F.col("wz_fatalities") >= 1, "Fatal – Immediate Review Required")
        .when(F.col("wz_incident_count") >= 5, "High Frequency – Safety Audit")
        .otherwise("Monitor")
    )
    return conflicts.select(
        "work_zone_id", "zone_type", F.col("wz_route").alias("route_id"), "speed_limit_in_zone",
        "wz_incident_count", "wz_fatalities", "wz_injuries",
        rounded_total("wz_avg_severity", 2).alias("avg_severity"),
        action.alias("recommended_action"),
    ).orderBy(F.desc("wz_fatalities"), F.desc("wz_incident_count"), "work_zone_id")


def sensor_gaps(cells: DataFrame, sensors: DataFrame, k: int | None = 40, busy_from: int = BUSY_CELL) -> DataFrame:
    """R13. Busy cells with and without an active sensor.

    A sensor only matters in a cell that holds incidents; joining busy cells to
    sensor cells settles that without touching the incidents again.
    """
    busy = cells.where(F.col("incident_count") >= busy_from).select(
        "h3_index_r8", "state_code", "incident_count", "total_fatalities", "risk_tier"
    )
    active = sensors.where(F.col("operational_status") == "Active")
    marked = uncovered(busy, active, "h3_index_r8")
    advice = (
        F.when(F.col("is_covered"), "Adequate Coverage")
        .when(F.col("total_fatalities") >= 1, "Priority Sensor Deployment")
        .otherwise("Consider Sensor Deployment")
    )
    if k is not None:
        marked = marked.orderBy(
            F.desc("total_fatalities"), F.desc("incident_count"), "h3_index_r8", "state_code"
        ).limit(k)
    return marked.select(
        "h3_index_r8", "incident_count", "total_fatalities", "risk_tier",
        F.when(F.col("is_covered"), "Covered").otherwise("No Coverage").alias("sensor_coverage"),
        advice.alias("sensor_recommendation"),
    )


def urban_rural(enriched: DataFrame) -> DataFrame:
    """R14."""
    n = F.count(F.lit(1))
    walkers = tally(F.col("incident_type") == "PEDESTRIAN")
    return rollup_by(enriched, ["area_type", "state_code"], {
        "total_incidents": n,
        "total_fatalities": F.sum("fatalities"),
        "total_injuries": F.sum("injuries"),
        "avg_severity": rounded_total(F.avg("severity_score"), 2),
        "pedestrian_incidents": walkers,
        "dui_incidents": tally(F.col("incident_type") == "DUI"),
        "weekend_incidents": tally(F.col("is_weekend")),
        "fatality_rate": rounded_total(ratio(F.sum("fatalities"), n), 4),
        "pedestrian_pct": rounded_total(ratio(walkers * 100, n), 2),
    }).orderBy("state_code", "area_type")


def segment_lengths(segments: DataFrame, k: int | None = 20) -> DataFrame:
    """R15."""
    chosen = segments.orderBy("segment_id")
    if k is not None:
        chosen = chosen.limit(k)
    return chosen.withColumn("_start", start_point("geometry_wkt")).select(
        *[c for c in ("segment_id", "route_id", "functional_class", "aadt", "speed_limit_mph") if c in segments.columns],
        "geometry_wkt",
        line_metres("geometry_wkt").alias("approx_length_m"),
        F.col("_start.x").alias("start_lon"),
        F.col("_start.y").alias("start_lat"),
    )


def incidents_in_zones(enriched: DataFrame, zones: DataFrame, k: int | None = 100) -> DataFrame:
    """R16. ``zones`` carries its outline as a ``corners`` point list."""
    points = enriched.select("incident_id", "incident_type", "severity", "latitude", "longitude")
    areas = zones.select("taz_id", "zone_type", "population", "corners")
    met = inside_polygons(points, areas, "corners", "longitude", "latitude", spread=[F.col("incident_id")]).drop("corners")
    return met.orderBy("incident_id", "taz_id").limit(k) if k is not None else met


def incidents_near_point(enriched: DataFrame, k: int | None = 50) -> DataFrame:
    """R17. The box filter can reach the scan; the exact distance decides."""
    lat0, lon0 = I40_MIDPOINT
    degrees = planar_degrees("latitude", "longitude", lat0, lon0)
    near = enriched.where(in_box("latitude", "longitude", lat0, lon0, REACH_DEGREES)).where(degrees <= REACH_DEGREES)
    shaped = near.select(
        "incident_id", "incident_type", "severity", "latitude", "longitude",
        rounded(degrees * METRES_PER_DEGREE, 3).alias("distance_m_from_i40_mid"),
    )
    return shaped.orderBy("distance_m_from_i40_mid", "incident_id").limit(k) if k is not None else shaped


def scorecard_preview(card: DataFrame, k: int = 15) -> DataFrame:
    """R18."""
    return card.orderBy(F.desc("total_fatalities"), "state_code").limit(k).select(
        "state_code", "total_incidents", "total_fatalities", "total_bridges",
        rounded_total("avg_bridge_sufficiency", 1).alias("avg_bridge_sufficiency"),
        rounded_total("total_lane_miles", 0).alias("total_lane_miles"),
        "poor_pavement_pct", "total_registered_vehicles", "ev_adoption_pct",
    )


def incidents_by_weather(incidents: DataFrame) -> DataFrame:
    """R19: how many incidents per kind of weather."""
    return rollup_by(incidents, ["weather_condition"], {
        "incident_count": F.count(F.lit(1)), "total_fatalities": F.sum("fatalities"),
    }).orderBy(F.desc("incident_count"), "weather_condition")


def bridges_by_type(health: DataFrame) -> DataFrame:
    """R19: bridge inspection figures by bridge type."""
    return rollup_by(health, ["bridge_type"], {
        "bridge_count": F.sum("bridge_count"),
        "deficient_bridges": F.sum("structurally_deficient_count"),
        "overdue_inspections": F.sum("overdue_inspections"),
        "min_sufficiency_rating": F.min("min_sufficiency_rating"),
    }).orderBy(F.desc("bridge_count"), "bridge_type")


def worst_pavement_counties(needs: DataFrame) -> DataFrame:
    """R19: all counties, worst pavement first, by mean rating weighted by segments."""
    return rollup_by(needs, ["state_code", "county_code"], {
        "segments": F.sum("segment_count"),
        "avg_pcr": rounded_total(ratio(F.sum(F.col("avg_pcr") * F.col("segment_count")), F.sum("segment_count")), 4),
        "total_cost_usd": rounded_total(F.sum("total_estimated_cost_usd"), 2),
    }).orderBy("avg_pcr", "state_code", "county_code")


def top_fatal_corridors(corridors: DataFrame, k: int = 10) -> DataFrame:
    """R19: the ten highest-risk corridors by fatalities."""
    return corridors.orderBy(F.desc("total_fatalities"), "state_code", "route_id", "county_code").limit(k).select(
        "state_code", "route_id", "county_code", "incident_count", "total_fatalities", "risk_tier")


def state_scorecard(card: DataFrame, state: str = "NC") -> DataFrame:
    """R19: the executive scorecard of one state."""
    return scorecard_preview(card.where(F.col("state_code") == state))


def electric_count(fleet: DataFrame) -> DataFrame:
    """R19: electric and hybrid vehicles on the register."""
    return fleet.agg(
        F.sum("electric_count").alias("electric_vehicles"),
        F.sum("registered_vehicles").alias("registered_vehicles"),
    )


def extreme_hotspots(spots: DataFrame, z: float = 3.0) -> DataFrame:
    """R19: hotspot cells with a z-score above 3."""
    return spots.where(F.col("z_score") > z).select(
        "h3_index_r8", "state_code", "incident_count", "total_fatalities", "z_score", "hotspot_class"
    ).orderBy(F.desc("z_score"), "h3_index_r8", "state_code")


def dui_against_collision(incidents: DataFrame) -> DataFrame:
    """R19: DUI and collision counts by county."""
    return rollup_by(incidents, ["state_code", "county_code"], {
        "dui_incidents": tally(F.col("incident_type") == "DUI"),
        "collision_incidents": tally(F.col("incident_type") == "COLLISION"),
    }).orderBy("state_code", "county_code")
