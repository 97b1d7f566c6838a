"""Named datasets P1 to P25 and P36, P37, and the map layers made of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from carriageway.operators.masking import EMPLOYEE_POLICY, apply_masks
from carriageway.plans import geo, gold, maps, modelled, silver
from carriageway.functions.geometry import parse_wkt
from carriageway.functions.rules import rounded
from carriageway.registry.check_sql import (
    BRIDGE_KEYS, CORRIDOR_MEASURES, INCIDENT_KEYS, INCIDENT_MEASURES, bands, block, bridge_measures, cols, div,
    haversine, rnd, silver_bridges, silver_incidents, using, with_cell,
)
from carriageway.registry.core import Inputs, add, query, steady
from carriageway.session import shared_dir
from carriageway.sources.sinks import overwrite

INCIDENT_COLS = (
    "incident_id incident_type severity incident_datetime state_code county_code route_id *milepost *latitude *longitude "
    "road_condition weather_condition fatalities injuries vehicles_involved status incident_year incident_month "
    "incident_hour day_of_week is_weekend has_fatality total_casualties severity_score"
)
BRIDGE_COLS = (
    "bridge_id state_code county_code route_id *latitude *longitude bridge_type material_type owner_type year_built "
    "*span_length_ft *deck_width_ft avg_daily_traffic last_inspection_date deck_condition superstructure_condition "
    "substructure_condition *sufficiency_rating structurally_deficient functionally_obsolete *estimated_repair_cost_k "
    "bridge_age_years age_category worst_condition *risk_score days_since_inspection priority_tier inspection_overdue"
)
SUMMARY_COLS = (
    "state_code route_id incident_year incident_month incident_type severity total_incidents total_fatalities "
    "total_injuries total_casualties *avg_vehicles_involved counties_affected fatal_incidents weekend_incidents "
    "morning_rush_incidents evening_rush_incidents overnight_incidents *fatality_rate *injury_rate"
)
CORRIDOR_COLS = (
    "state_code route_id county_code incident_count total_fatalities total_injuries incident_type_diversity "
    "*avg_severity_score most_recent_incident *fatality_concentration state_rank risk_tier"
)
HEALTH_COLS = (
    "state_code county_code bridge_type age_category priority_tier bridge_count *avg_sufficiency_rating "
    "*min_sufficiency_rating *avg_bridge_age *avg_daily_traffic total_daily_traffic_exposed structurally_deficient_count "
    "functionally_obsolete_count overdue_inspections *total_estimated_repair_cost_k *avg_risk_score *max_risk_score "
    "*deficiency_rate *total_estimated_repair_cost_m"
)

block("silver_incidents_twice", "fx_incidents_twice",
      silver_incidents("(SELECT DISTINCT * FROM fx_incidents_twice)"))
block("silver_bridges_twice", "fx_bridges_twice", silver_bridges("(SELECT DISTINCT * FROM fx_bridges_twice)"))


def twice(i: Inputs, name: str, column: str, value: str):
    """A domain view with some records delivered twice, as exact copies."""
    base = i.fx(name)
    return base.unionByName(base.where(F.col(column) == value))


@query("p01_silver_incidents", using("silver_incidents_twice", f"SELECT {cols(INCIDENT_COLS)} FROM silver_incidents_twice"))
def _(i):
    return steady(silver.silver_incidents(twice(i, "incidents", "status", "Closed"), stamp=False))


@query("p02_silver_bridges", using("silver_bridges_twice", f"SELECT {cols(BRIDGE_COLS)} FROM silver_bridges_twice"))
def _(i):
    return steady(silver.silver_bridges(twice(i, "bridges", "owner_type", "Federal"), stamp=False))


add("p03_silver_vehicles", lambda i: steady(i.vehicles), using("silver_vehicles", "SELECT " + cols(
    "vin state_code vehicle_class model_year fuel_type *gvwr_lbs registration_date expiration_date commercial_vehicle "
    "hazmat_certified vehicle_age weight_class is_electric is_commercial is_expired reg_year") + " FROM silver_vehicles"))
add("p04_silver_pavement", lambda i: steady(i.pavement), using("silver_pavement", "SELECT " + cols(
    "segment_id state_code county_code *segment_length_mi functional_class pavement_type year_constructed iri *psi *pcr "
    "*cracking_percent *rutting_in condition_rating aadt truck_percent pavement_age iri_category *distress_index "
    "traffic_category maintenance_priority") + " FROM silver_pavement"))
add("p05_incident_summary", lambda i: steady(i.summary),
    using("gold_summary", f"SELECT {cols(SUMMARY_COLS)} FROM gold_summary"))
add("p06_high_risk_corridors", lambda i: steady(i.corridors),
    using("gold_corridors", f"SELECT {cols(CORRIDOR_COLS)} FROM gold_corridors"))
add("p07_bridge_health", lambda i: steady(i.health), using("gold_health", f"SELECT {cols(HEALTH_COLS)} FROM gold_health"))
add("p08_fleet_snapshot", lambda i: steady(i.fleet), using("gold_fleet", "SELECT " + cols(
    "state_code vehicle_class weight_class fuel_type model_year registered_vehicles *avg_vehicle_age *avg_gvwr_lbs "
    "electric_count commercial_count hazmat_count expired_registrations *electric_share *commercial_share")
    + " FROM gold_fleet"))
add("p09_pavement_needs", lambda i: steady(i.needs), using("gold_needs", "SELECT " + cols(
    "state_code county_code functional_class pavement_type maintenance_priority iri_category segment_count "
    "*total_lane_miles *avg_pcr *avg_iri *avg_distress_index *avg_pavement_age *total_estimated_cost_usd total_aadt "
    "*cost_per_aadt") + " FROM gold_needs"))
add("p10_executive_scorecard", lambda i: steady(i.scorecard), using("gold_scorecard", "SELECT " + cols(
    "state_code total_incidents total_fatalities total_injuries total_bridges *avg_bridge_sufficiency deficient_bridges "
    "*total_lane_miles *avg_pcr *poor_pavement_miles total_registered_vehicles electric_vehicles "
    "*fatality_per_100k_vehicles *poor_pavement_pct *bridge_deficiency_pct *ev_adoption_pct") + " FROM gold_scorecard"))
add("p11_geo_incidents", lambda i: steady(i.located), using("geo_incidents", "SELECT " + cols(
    INCIDENT_COLS + " h3_index_r6 h3_index_r7 h3_index_r8 geometry_wkt *bearing_from_charlotte *urban_proximity_score "
    "area_type") + " FROM geo_incidents"))
CELL_COLS = (
    "h3_index_r8 h3_index_r6 state_code incident_count total_fatalities total_injuries *avg_severity_score "
    "fatal_incident_count collision_count dui_count pedestrian_count weekend_incident_count night_incident_count "
    "routes_in_cell first_incident latest_incident *incident_density_per_km2 *severity_density risk_tier"
)
add("p12_cell_density", lambda i: steady(i.cells), using("geo_cells", f"SELECT {cols(CELL_COLS)} FROM geo_cells"))
add("p13_corridor_safety", lambda i: steady(i.rates), using("geo_rates", "SELECT " + cols(
    "seg_route_id functional_class area_type incidents_on_corridor fatalities_on_corridor injuries_on_corridor "
    "*avg_severity fatal_incidents *reference_aadt *incidents_per_100m_vmt") + " FROM geo_rates"))
block("geo_pairs_once", "geo_pairs",
      "SELECT DISTINCT incident_id, fatalities, injuries, severity_score, has_fatality, seg_route_id, functional_class, area_type FROM geo_pairs")
add("p13_corridor_safety_once_per_incident",
    lambda i: steady(geo.corridor_safety(i.located, i.segments, each_incident_once=True, stamp=False)
                     .drop("reference_aadt", "incidents_per_100m_vmt")),
    using("geo_pairs_once", "SELECT seg_route_id, functional_class, area_type, count(*) AS incidents_on_corridor, "
          "cast(sum(fatalities) AS bigint) AS fatalities_on_corridor, cast(sum(injuries) AS bigint) AS injuries_on_corridor, "
          f"{rnd('avg(severity_score)', 6)} AS avg_severity, "
          "count(*) FILTER (WHERE has_fatality) AS fatal_incidents FROM geo_pairs_once GROUP BY 1, 2, 3"))
add("p14_hotspots", lambda i: steady(i.spots), using("geo_spots", "SELECT " + cols(
    CELL_COLS + " *mean_density *stddev_density *z_score is_hotspot is_cold_spot hotspot_class") + " FROM geo_spots"))
PLACED_BRIDGES = using("geo_bridges", "SELECT " + cols(
    "bridge_id state_code bridge_type age_category worst_condition *risk_score priority_tier *sufficiency_rating "
    "avg_daily_traffic *latitude *longitude geometry_wkt h3_index_r7 taz_id zone_type taz_population taz_employment "
    "taz_vehicle_trips *population_at_risk_score") + " FROM geo_bridges")
add("p15_bridges_with_zone", lambda i: steady(i.placed_bridges), PLACED_BRIDGES)


@query("p15_bridges_from_silver", PLACED_BRIDGES)
def _(i):
    """The same overlay as a job: there is no verified table, so it falls back to the written silver one."""
    folder = shared_dir(i.spark, "bridges")
    overwrite(i.bridges, f"{folder}/silver", ["state_code"])
    source = geo.bridge_source(i.spark, f"{folder}/verified", f"{folder}/silver")
    return steady(geo.bridges_with_zone(source, i.fx("zones"), stamp=False))


SPOT_SQL = "h3_index_r8 incident_count total_fatalities *avg_severity_score hotspot_class"
add("map01_hot_cells", lambda i: steady(maps.hot_cells(i.spots)), using("geo_spots", f"SELECT {cols(SPOT_SQL + ' risk_tier')} FROM geo_spots WHERE is_hotspot"))
add("map02_hot_cell_scores", lambda i: steady(maps.hot_cells(i.spots, maps.SPOT_SCORES)), using("geo_spots", f"SELECT {cols(SPOT_SQL + ' *z_score')} FROM geo_spots WHERE is_hotspot"))
add("map03_fatal_markers", lambda i: steady(maps.fatal_markers(i.located)), using("geo_incidents", "SELECT " + cols(
    "incident_id *latitude *longitude incident_type severity fatalities injuries incident_datetime") + " FROM geo_incidents WHERE has_fatality"))
add("map04_cell_density", lambda i: steady(maps.layer(i.cells, maps.DENSITY_COLUMNS)), using("geo_cells", "SELECT " + cols(
    "h3_index_r8 incident_count total_fatalities *avg_severity_score risk_tier") + " FROM geo_cells"))
add("map05_sensors", lambda i: steady(maps.layer(i.fx("sensors"), maps.SENSOR_COLUMNS)), using("fx_sensors", "SELECT " + cols(
    "sensor_id *latitude *longitude operational_status *uptime_pct") + " FROM fx_sensors"))
add("map06_active_work_zones", lambda i: maps.active_work_zones(i.work_zones), using("wz_cells", "SELECT work_zone_id, zone_type, status FROM wz_cells WHERE status = 'Active'"))
add("p16_work_zone_conflicts", lambda i: steady(i.conflicts), using("geo_conflicts", "SELECT " + cols(
    "work_zone_id zone_type wz_route speed_limit_in_zone wz_incident_count wz_fatalities wz_injuries *wz_avg_severity")
    + " FROM geo_conflicts"))

add("p21_model_incidents", lambda i: steady(i.model_incidents),
    using("model_incidents", f"SELECT {cols(INCIDENT_COLS)} FROM model_incidents"))
add("p22_model_bridges", lambda i: steady(i.model_bridges),
    using("model_bridges", f"SELECT {cols(BRIDGE_COLS)} FROM model_bridges"))


block("model_summary", "model_incidents", (
    f"SELECT *, {div('total_fatalities', 'total_incidents')} AS fatality_rate, "
    f"{div('total_injuries', 'total_incidents')} AS injury_rate FROM ("
    f"SELECT {INCIDENT_KEYS}, {INCIDENT_MEASURES} FROM model_incidents GROUP BY {INCIDENT_KEYS})"
))
block("model_corridors", "model_incidents", (
    "SELECT *, " + bands("state_rank", "<=", [(10, "Top 10 - Critical"), (25, "Top 25 - High Risk"),
                                              (50, "Top 50 - Elevated")], "Standard") + " AS risk_tier FROM ("
    f"SELECT *, {div('total_fatalities', 'incident_count')} AS fatality_concentration, "
    "cast(rank() OVER (PARTITION BY state_code ORDER BY total_fatalities DESC, incident_count DESC, route_id) AS int) "
    f"AS state_rank FROM (SELECT state_code, route_id, county_code, {CORRIDOR_MEASURES} FROM model_incidents GROUP BY 1, 2, 3))"
))
block("model_health", "model_bridges", (
    f"SELECT *, {div('structurally_deficient_count', 'bridge_count')} AS deficiency_rate, "
    "total_estimated_repair_cost_k / 1000.0e0 AS total_estimated_repair_cost_m FROM ("
    f"SELECT {BRIDGE_KEYS}, {bridge_measures('structurally_deficient', 'functionally_obsolete')} "
    f"FROM model_bridges GROUP BY {BRIDGE_KEYS})"
))
add("p23_model_incident_summary", lambda i: steady(modelled.model_incident_summary(i.model_incidents, stamp=False)),
    using("model_summary", f"SELECT {cols(SUMMARY_COLS)} FROM model_summary"))
add("p24_model_corridors", lambda i: steady(modelled.model_corridors(i.model_incidents, stamp=False)),
    using("model_corridors", f"SELECT {cols(CORRIDOR_COLS)} FROM model_corridors"))
add("p25_model_bridge_health", lambda i: steady(modelled.model_bridge_health(i.model_bridges, stamp=False)),
    using("model_health", f"SELECT {cols(HEALTH_COLS)} FROM model_health"))


# Geo base tables from the generic tables.
@query("p32_intersections", (
    "SELECT concat('INT-', p_partkey) AS intersection_id, "
    "CASE WHEN p_size % 4 > 0 THEN 'True' ELSE 'False' END AS has_crash_history, "
    "CASE WHEN p_partkey % 3 = 0 THEN 'True' ELSE 'False' END AS is_signalised, "
    "CASE WHEN (p_partkey * 977) % 80000 > 50000 THEN 'High' WHEN (p_partkey * 977) % 80000 > 20000 THEN 'Moderate' "
    "ELSE 'Low' END AS congestion_level FROM part"))
def _(i):
    raw = i.table("part").select(
        F.concat(F.lit("INT-"), F.col("p_partkey").cast("string")).alias("intersection_id"),
        (F.col("p_size") % 4).alias("crash_count_5yr"),
        F.when(F.col("p_partkey") % 3 == 0, "Traffic Signal").otherwise("Stop Sign").alias("control_type"),
        (F.col("p_partkey") * 977 % 80000).alias("entering_volume_daily"),
    )
    return geo.intersections(raw).select("intersection_id", "has_crash_history", "is_signalised", "congestion_level")




def corners_text(n: int, turn: str = "i", digits: int = 6) -> str:
    """Corner k of a regular polygon as rounded text, in SQL."""
    return (
        f"concat({rnd(f'centroid_lon + radius_deg * cos(({turn} % {n}) * {2 * 3.141592653589793 / n!r})', digits)}, ' ', "
        f"{rnd(f'centroid_lat + radius_deg * sin(({turn} % {n}) * {2 * 3.141592653589793 / n!r})', digits)})"
    )


def rounded_outline(points, digits: int = 6):
    """Outline text with rounded corners: trigonometry may differ in the last bit."""
    return F.array_join(
        F.transform(points, lambda p: F.concat(rounded(p["x"], digits).cast("string"), F.lit(" "),
                                               rounded(p["y"], digits).cast("string"))), ", ")


block("sized_zones", "fx_zones", (
    "SELECT *, sqrt(area_sq_miles) * 0.0145e0 AS radius_deg, cast(floor(vehicle_trips_daily * 0.08e0) AS int) AS transit_trips_daily "
    "FROM (SELECT * EXCLUDE (radius_deg), 4.0e0 + population / 1000 AS area_sq_miles FROM fx_zones)"
))


@query("p33_analysis_zones", using("sized_zones", (
    f"SELECT taz_id, {rnd('radius_deg', 6)} AS radius_deg, transit_trips_daily, "
    f"array_to_string([{corners_text(6)} for i in range(7)], ', ') AS outline FROM sized_zones")))
def _(i):
    raw = i.fx("zones").drop("radius_deg").withColumn("area_sq_miles", F.lit(4.0) + F.col("population") / 1000)
    return geo.analysis_zones(raw).select(
        "taz_id", rounded("radius_deg", 6).alias("radius_deg"), "transit_trips_daily",
        rounded_outline(parse_wkt("geometry_wkt")).alias("outline"),
    )


block("long_work_zones", "wz_status", (
    "SELECT *, greatest(0.005e0, zone_length_miles * 0.0145e0 / 2) AS radius_deg FROM ("
    "SELECT *, cast(cast(split_part(work_zone_id, '-', 2) AS bigint) * 3 % 40 AS double) / 10 AS zone_length_miles FROM wz_status)"
))
block("celled_work_zones", "long_work_zones",
      with_cell("long_work_zones", "centroid_lat", "centroid_lon", 8, "h3_index_r8"))


@query("p34_work_zones", using("celled_work_zones", (
    f"SELECT work_zone_id, status, h3_index_r8, {rnd('radius_deg', 6)} AS radius_deg, "
    f"array_to_string([{corners_text(5)} for i in range(6)], ', ') AS outline FROM celled_work_zones")))
def _(i):
    number = F.split_part("work_zone_id", F.lit("-"), F.lit(2)).cast("long")
    raw = i.fx("work_zones").withColumn("zone_length_miles", (number * 3 % 40).cast("double") / 10)
    return geo.work_zones(raw).select(
        "work_zone_id", "status", "h3_index_r8", rounded("radius_deg", 6).alias("radius_deg"),
        rounded_outline(parse_wkt("geometry_wkt")).alias("outline"),
    )



WAYPOINTS = [
    "concat('ROUTE_', cast(o_custkey % 7 AS string)) AS route_id",
    "o_orderkey AS seq",
    "35.0 + cast((o_orderkey * 7919) % 1000 AS double) / 1000 AS latitude",
    "-81.0 + cast((o_orderkey * 104729) % 2000 AS double) / 1000 AS longitude",
    "cast(3000 + (o_orderkey * 977) % 107001 AS int) AS aadt",
]
block("fx_waypoints", "", f"SELECT {', '.join(WAYPOINTS)} FROM orders")
block("legs", "fx_waypoints", (
    f"SELECT *, {haversine('latitude', 'longitude', 'end_lat', 'end_lon')} AS miles FROM ("
    "SELECT *, lead(latitude) OVER w AS end_lat, lead(longitude) OVER w AS end_lon FROM fx_waypoints "
    "WINDOW w AS (PARTITION BY route_id ORDER BY seq)) WHERE end_lat IS NOT NULL"
))
block("placed_legs", "legs", (
    "SELECT *, coalesce(sum(miles) OVER (PARTITION BY route_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    "AS begun FROM legs"
))
SEGMENT_SQL = using("placed_legs", (
    f"SELECT route_id, seq, {rnd('begun', 2)} AS begin_milepost, {rnd('begun + miles', 2)} AS end_milepost, "
    f"{rnd('miles', 3)} AS length_miles, {rnd('(latitude + end_lat) / 2', 6)} AS midpoint_lat, "
    f"{rnd('(longitude + end_lon) / 2', 6)} AS midpoint_lon, "
    + bands("aadt", ">", [(60000, "Urban"), (20000, "Suburban")], "Rural") + " AS area_type FROM placed_legs"
))


def waypoints(i: Inputs):
    return i.table("orders").selectExpr(*WAYPOINTS)


@query("p35_road_segments", SEGMENT_SQL)
def _(i):
    return geo.segment_route(waypoints(i)).select(
        "route_id", "seq", "begin_milepost", "end_milepost", "length_miles", "midpoint_lat", "midpoint_lon", "area_type")


@query("p36_bridge_flags", using("fx_bridges", (
    "SELECT bridge_id, CASE WHEN structurally_deficient = 'true' AND sufficiency_rating < 50 THEN 'P - Poor' "
    "WHEN sufficiency_rating < 70 THEN 'F - Fair' ELSE 'G - Good' END AS deck_condition, "
    "CASE WHEN structurally_deficient = 'true' THEN 'True' ELSE 'False' END AS structurally_deficient, "
    "CASE WHEN sufficiency_rating < 60 THEN 'True' ELSE 'False' END AS functionally_obsolete FROM fx_bridges")))
def _(i):
    raw = i.fx("bridges").withColumn("is_deficient", F.col("structurally_deficient") == "true")
    return geo.bridge_flags_from_rating(raw).select(
        "bridge_id", "deck_condition", "structurally_deficient", "functionally_obsolete")


@query("p37_employees_masked", using("fx_employees", (
    "SELECT employee_id, name, DATE '1900-01-01' AS birth_date, '***-**-****' AS ssn, department, "
    "'REDACTED' AS salary FROM fx_employees")))
def _(i):
    return apply_masks(i.fx("employees"), EMPLOYEE_POLICY)
