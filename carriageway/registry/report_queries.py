"""Reports R1 to R20."""

from __future__ import annotations

from pyspark.sql import functions as F

from carriageway.functions.cells import hex_cell
from carriageway.functions.geometry import line_wkt, ring_points
from carriageway.plans import reports
from carriageway.registry.check_sql import bands, big, block, cnt, cols, div, rnd, using, with_cell
from carriageway.registry.core import add, query, steady
from carriageway.session import shared_dir
from carriageway.sources.sinks import export_json

add("r01_safety_scorecard", lambda i: reports.safety_scorecard(i.scorecard), using("gold_scorecard", (
    "SELECT state_code, total_incidents, total_fatalities, total_injuries, total_bridges, "
    f"{rnd('avg_bridge_sufficiency', 1)} AS avg_bridge_sufficiency, deficient_bridges, bridge_deficiency_pct, "
    f"{rnd('total_lane_miles', 0)} AS total_lane_miles, poor_pavement_pct, total_registered_vehicles, ev_adoption_pct, "
    f"{rnd('fatality_per_100k_vehicles', 2)} AS fatality_per_100k_vehicles, "
    + bands("fatality_per_100k_vehicles", ">", [(15, "🔴 High Risk"), (8, "🟡 Moderate Risk")], "🟢 Low Risk") + " AS safety_grade, "
    + bands("poor_pavement_pct", ">", [(25, "🔴 Critical"), (15, "🟡 Fair")], "🟢 Good") + " AS pavement_grade, "
    + bands("bridge_deficiency_pct", ">", [(20, "🔴 Critical"), (10, "🟡 Fair")], "🟢 Good") + " AS bridge_grade "
    "FROM gold_scorecard")))
add("r02_top_corridors", lambda i: reports.top_corridors(i.corridors), using("gold_corridors", (
    f"SELECT state_code, county_code, route_id, incident_count, total_fatalities, total_injuries, "
    f"{rnd('fatality_concentration', 3)} AS fatalities_per_incident, {rnd('avg_severity_score', 2)} AS avg_severity_score, "
    "risk_tier, state_rank, strftime(most_recent_incident, '%Y-%m-%d') AS last_incident_date, "
    "incident_type_diversity AS num_incident_types FROM gold_corridors "
    "WHERE risk_tier IN ('Top 10 – Critical', 'Top 25 – High Risk') "
    "ORDER BY state_code, state_rank, route_id, county_code LIMIT 20")))


def yoy(now: str, before: str) -> str:
    return rnd(f"(cast({now} - {before} AS double) / nullif({before}, 0)) * 100", 1)


add("r03_yoy_trend", lambda i: reports.yearly_trend(i.summary), using("gold_summary", (
    ", monthly AS (SELECT state_code, incident_year, incident_month, "
    f"{big('total_incidents')} AS total_incidents, {big('total_fatalities')} AS total_fatalities "
    "FROM gold_summary GROUP BY 1, 2, 3), "
    "lagged AS (SELECT *, lag(total_incidents, 12) OVER w AS incidents_prior_year, "
    "lag(total_fatalities, 12) OVER w AS fatalities_prior_year FROM monthly "
    "WINDOW w AS (PARTITION BY state_code ORDER BY incident_year, incident_month)) "
    "SELECT state_code, concat(incident_year, '-', lpad(cast(incident_month AS varchar), 2, '0')) AS year_month, "
    "total_incidents, total_fatalities, incidents_prior_year, fatalities_prior_year, "
    f"{yoy('total_incidents', 'incidents_prior_year')} AS incident_yoy_pct, "
    f"{yoy('total_fatalities', 'fatalities_prior_year')} AS fatality_yoy_pct, "
    "CASE WHEN total_incidents > incidents_prior_year THEN '▲' ELSE '▼' END AS incident_trend "
    "FROM lagged WHERE incident_year >= 2021")))
add("r04_bridge_investment", lambda i: reports.bridge_investment(i.health), using("gold_health", (
    "SELECT state_code, county_code, bridge_type, age_category, priority_tier, bridge_count, "
    f"{rnd('avg_sufficiency_rating', 1)} AS avg_sufficiency, {rnd('avg_bridge_age', 0)} AS avg_age_years, "
    "structurally_deficient_count, functionally_obsolete_count, overdue_inspections, "
    "format('{:,}', total_daily_traffic_exposed) AS total_daily_traffic, "
    "format('{:,.1f}', " + rnd("total_estimated_repair_cost_m", 1) + ") AS estimated_repair_cost_m_usd, "
    f"{rnd('avg_risk_score', 1)} AS avg_risk_score, {rnd('deficiency_rate * 100', 1)} AS deficiency_rate_pct, "
    "cast(rank() OVER (PARTITION BY state_code ORDER BY total_estimated_repair_cost_m DESC) AS int) AS cost_rank "
    "FROM gold_health WHERE priority_tier IN ('Priority 1 – Immediate', 'Priority 2 – Near Term')")))
add("r05_pavement_needs_by_class", lambda i: reports.pavement_needs_by_class(i.needs), using("gold_needs", (
    "SELECT state_code, functional_class, maintenance_priority, count(*) AS segment_groups, "
    f"{rnd('sum(total_lane_miles)', 1)} AS total_lane_miles, {rnd('avg(avg_pcr)', 1)} AS avg_pcr, "
    f"{rnd('avg(avg_iri)', 0)} AS avg_iri, {rnd('sum(total_estimated_cost_usd) / 1e6', 2)} AS total_cost_million_usd, "
    f"{rnd(div('sum(total_estimated_cost_usd)', 'sum(total_lane_miles)') + ' / 1000', 1)} AS cost_per_lane_mile_k, "
    "format('{:,}', cast(sum(total_aadt) AS bigint)) AS total_aadt_exposed FROM gold_needs GROUP BY 1, 2, 3")))
add("r06_fleet_trend", lambda i: reports.fleet_trend(i.fleet), using("gold_fleet", (
    f"SELECT state_code, model_year, vehicle_class, {big('registered_vehicles')} AS total_vehicles, "
    f"{big('electric_count')} AS electric_vehicles, {big('commercial_count')} AS commercial_vehicles, "
    f"{big('hazmat_count')} AS hazmat_vehicles, {big('expired_registrations')} AS expired_registrations, "
    f"{rnd(div('sum(electric_count)', 'sum(registered_vehicles)') + ' * 100', 2)} AS ev_share_pct, "
    f"{rnd(div('sum(expired_registrations)', 'sum(registered_vehicles)') + ' * 100', 2)} AS expiry_rate_pct "
    "FROM gold_fleet WHERE model_year >= 2015 GROUP BY 1, 2, 3")))
DAY_CASE = (
    "CASE day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday' WHEN 4 THEN 'Wednesday' "
    "WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' ELSE 'Saturday' END"
)
add("r07_hour_weekday_heat", lambda i: reports.hour_weekday_heat(i.incidents), using("silver_incidents", (
    f"SELECT day_of_week, {DAY_CASE} AS day_name, incident_hour, count(*) AS incident_count, "
    f"{big('fatalities')} AS total_fatalities, {rnd('avg(severity_score)', 2)} AS avg_severity "
    "FROM silver_incidents GROUP BY 1, 2, 3")))
add("r08_top_hotspots", lambda i: reports.top_hotspots(i.spots), using("geo_spots", (
    "SELECT h3_index_r8, state_code, incident_count, total_fatalities, total_injuries, "
    f"{rnd('avg_severity_score', 2)} AS avg_severity, fatal_incident_count, night_incident_count, weekend_incident_count, "
    f"{rnd('incident_density_per_km2', 2)} AS density_per_km2, {rnd('z_score', 2)} AS hotspot_z_score, hotspot_class, risk_tier "
    "FROM geo_spots WHERE is_hotspot ORDER BY total_fatalities DESC, incident_count DESC, h3_index_r8, state_code LIMIT 50")))
add("r09_corridor_ranking", lambda i: reports.corridor_ranking(i.rates), using("geo_rates", (
    "SELECT seg_route_id AS route_id, functional_class, area_type, incidents_on_corridor, fatalities_on_corridor, "
    "injuries_on_corridor, format('{:,}', cast(" + rnd("reference_aadt", 0) + " AS bigint)) AS reference_aadt, "
    f"{rnd('avg_severity', 2)} AS avg_severity_score, {rnd('incidents_per_100m_vmt', 4)} AS incidents_per_100m_vmt, "
    "cast(rank() OVER (PARTITION BY functional_class ORDER BY incidents_per_100m_vmt DESC NULLS LAST) AS int) "
    "AS safety_rank_in_class FROM geo_rates "
    "ORDER BY geo_rates.incidents_per_100m_vmt DESC NULLS LAST, seg_route_id, functional_class, area_type LIMIT 30")))
add("r10_bridge_risk_by_zone", lambda i: reports.bridge_risk_by_zone(i.placed_bridges), using("geo_bridges", (
    ", top AS (SELECT taz_id, zone_type, state_code, count(bridge_id) AS bridge_count, "
    + cnt("worst_condition = 'Poor'") + f" AS poor_condition_bridges, {rnd('avg(risk_score)', 1)} AS avg_risk_score, "
    f"{rnd('avg(sufficiency_rating)', 1)} AS avg_sufficiency, max(taz_population) AS taz_population, "
    f"max(taz_vehicle_trips) AS taz_vehicle_trips, {rnd('sum(population_at_risk_score)', 0)} AS total_pop_at_risk_score, "
    f"{big('avg_daily_traffic')} AS total_bridge_aadt "
    "FROM geo_bridges GROUP BY 1, 2, 3 HAVING count(bridge_id) >= 2 "
    "ORDER BY total_pop_at_risk_score DESC NULLS LAST, taz_id, zone_type, state_code LIMIT 25) "
    "SELECT top.*, b.bridge_id AS p1_bridge_id FROM top LEFT JOIN geo_bridges b ON b.priority_tier = 'Priority 1 – Immediate' "
    "AND b.taz_id IS NOT DISTINCT FROM top.taz_id AND b.zone_type IS NOT DISTINCT FROM top.zone_type "
    "AND b.state_code IS NOT DISTINCT FROM top.state_code")))
add("r11_coarse_rollup", lambda i: reports.coarse_rollup(i.cells), using("geo_cells", (
    "SELECT h3_index_r6 AS h3_county_cell, state_code, count(DISTINCT h3_index_r8) AS sub_cells_count, "
    f"{big('incident_count')} AS total_incidents, {big('total_fatalities')} AS total_fatalities, "
    f"{big('fatal_incident_count')} AS fatal_incidents, {big('night_incident_count')} AS night_incidents, "
    f"{big('pedestrian_count')} AS pedestrian_incidents, {big('dui_count')} AS dui_incidents, "
    f"{rnd(div('sum(incident_count)', 'count(DISTINCT h3_index_r8)'), 1)} AS avg_incidents_per_cell, "
    f"{rnd('avg(avg_severity_score)', 2)} AS avg_severity, "
    + cnt("risk_tier LIKE '%Critical%' OR risk_tier LIKE '%High%'") + " AS high_risk_sub_cells "
    "FROM geo_cells GROUP BY 1, 2")))
add("r12_work_zone_actions", lambda i: reports.work_zone_actions(i.conflicts), using("geo_conflicts", (
    "SELECT work_zone_id, zone_type, wz_route AS route_id, speed_limit_in_zone, wz_incident_count, wz_fatalities, "
    f"wz_injuries, {rnd('wz_avg_severity', 2)} AS avg_severity, "
    "CASE WHEN wz_fatalities >= 1 THEN 'Fatal – Immediate Review Required' "
    "WHEN wz_incident_count >= 5 THEN 'High Frequency – Safety Audit' ELSE 'Monitor' END AS recommended_action "
    "FROM geo_conflicts")))
block("sensor_cells", "fx_sensors", with_cell("fx_sensors", "latitude", "longitude", 8, "sensor_cell"))
block("sensor_here", "sensor_cells geo_incidents", (
    "SELECT DISTINCT h3_index_r8 AS h3_sensor FROM geo_incidents i "
    "JOIN (SELECT sensor_cell FROM sensor_cells WHERE operational_status = 'Active') s ON i.h3_index_r8 = s.sensor_cell"
))
add("r13_sensor_gaps",
    lambda i: reports.sensor_gaps(
        i.cells, i.fx("sensors").withColumn("h3_index_r8", hex_cell("latitude", "longitude", 8))),
    using("geo_cells sensor_here", (
        "SELECT c.h3_index_r8, c.incident_count, c.total_fatalities, c.risk_tier, "
        "CASE WHEN s.h3_sensor IS NULL THEN 'No Coverage' ELSE 'Covered' END AS sensor_coverage, "
        "CASE WHEN s.h3_sensor IS NULL AND c.total_fatalities >= 1 THEN 'Priority Sensor Deployment' "
        "WHEN s.h3_sensor IS NULL THEN 'Consider Sensor Deployment' ELSE 'Adequate Coverage' END AS sensor_recommendation "
        "FROM geo_cells c LEFT JOIN sensor_here s ON c.h3_index_r8 = s.h3_sensor WHERE c.incident_count >= 5 "
        "ORDER BY c.total_fatalities DESC, c.incident_count DESC, c.h3_index_r8, c.state_code LIMIT 40")))
add("g22_coverage_gap",
    lambda i: reports.sensor_gaps(
        i.cells, i.fx("sensors").withColumn("h3_index_r8", hex_cell("latitude", "longitude", 8)), None, 2),
    using("geo_cells sensor_here", (
        "SELECT c.h3_index_r8, c.incident_count, c.total_fatalities, c.risk_tier, "
        "CASE WHEN s.h3_sensor IS NULL THEN 'No Coverage' ELSE 'Covered' END AS sensor_coverage, "
        "CASE WHEN s.h3_sensor IS NULL AND c.total_fatalities >= 1 THEN 'Priority Sensor Deployment' "
        "WHEN s.h3_sensor IS NULL THEN 'Consider Sensor Deployment' ELSE 'Adequate Coverage' END AS sensor_recommendation "
        "FROM geo_cells c LEFT JOIN sensor_here s ON c.h3_index_r8 = s.h3_sensor WHERE c.incident_count >= 2")))
WALKERS = cnt("incident_type = 'PEDESTRIAN'")
add("r14_urban_rural", lambda i: reports.urban_rural(i.located), using("geo_incidents", (
    f"SELECT area_type, state_code, count(*) AS total_incidents, {big('fatalities')} AS total_fatalities, "
    f"{big('injuries')} AS total_injuries, {rnd('avg(severity_score)', 2)} AS avg_severity, "
    f"{WALKERS} AS pedestrian_incidents, " + cnt("incident_type = 'DUI'") + f" AS dui_incidents, "
    f"{cnt('is_weekend')} AS weekend_incidents, {rnd(div('sum(fatalities)', 'count(*)'), 4)} AS fatality_rate, "
    f"{rnd(div(WALKERS + ' * 100', 'count(*)'), 2)} AS pedestrian_pct FROM geo_incidents GROUP BY 1, 2")))


def drawn_segments(i):
    mid_lon, mid_lat = (F.col("start_lon") + F.col("end_lon")) / 2, (F.col("start_lat") + F.col("end_lat")) / 2
    return i.segments.withColumn("geometry_wkt", line_wkt(
        (F.col("start_lon"), F.col("start_lat")), (mid_lon, mid_lat), (F.col("end_lon"), F.col("end_lat"))))


block("drawn_segments", "segments", (
    "SELECT *, sqrt(pow(mid_lon - start_lon, 2) + pow(mid_lat - start_lat, 2)) + "
    "sqrt(pow(end_lon - mid_lon, 2) + pow(end_lat - mid_lat, 2)) AS degrees, "
    "concat('LINESTRING (', start_lon, ' ', start_lat, ', ', mid_lon, ' ', mid_lat, ', ', end_lon, ' ', end_lat, ')') "
    "AS geometry_wkt FROM segments"
))
SEGMENT_LENGTH = (
    f"SELECT segment_id, route_id, functional_class, aadt, speed_limit_mph, geometry_wkt, "
    f"{rnd('degrees * 111139', 0)} AS approx_length_m, start_lon, start_lat FROM drawn_segments"
)
add("r15_segment_lengths", lambda i: reports.segment_lengths(drawn_segments(i)),
    using("drawn_segments", SEGMENT_LENGTH + " ORDER BY segment_id LIMIT 20"))
add("g13_line_length_all_segments", lambda i: reports.segment_lengths(drawn_segments(i), None),
    using("drawn_segments", SEGMENT_LENGTH))


def outlined_zones(i):
    return i.fx("zones").withColumn("corners", ring_points("centroid_lat", "centroid_lon", "radius_deg", 6))


TURN = repr(2 * 3.141592653589793 / 6)
block("zone_edges", "fx_zones", (
    "SELECT taz_id, zone_type, population, "
    f"centroid_lon + radius_deg * cos((i % 6) * {TURN}) AS x1, centroid_lat + radius_deg * sin((i % 6) * {TURN}) AS y1, "
    f"centroid_lon + radius_deg * cos(((i + 1) % 6) * {TURN}) AS x2, centroid_lat + radius_deg * sin(((i + 1) % 6) * {TURN}) AS y2 "
    "FROM fx_zones, range(6) AS r(i)"
))
INSIDE = using("silver_incidents zone_edges", (
    "SELECT incident_id, incident_type, severity, latitude, longitude, taz_id, zone_type, population "
    "FROM silver_incidents, zone_edges WHERE (y1 > latitude) != (y2 > latitude) "
    "AND longitude < x1 + (x2 - x1) * ((latitude - y1) / (y2 - y1)) "
    "GROUP BY ALL HAVING count(*) % 2 = 1"))
add("r16_incidents_in_zones", lambda i: reports.incidents_in_zones(i.located, outlined_zones(i)),
    INSIDE + " ORDER BY incident_id, taz_id LIMIT 100")
add("g11_point_in_polygon", lambda i: reports.incidents_in_zones(i.located, outlined_zones(i), None), INSIDE)
NEAR = using("silver_incidents", (
    "SELECT incident_id, incident_type, severity, latitude, longitude, "
    + rnd("sqrt(pow(longitude - (-80.0e0), 2) + pow(latitude - 35.5e0, 2)) * 111139", 3) + " AS distance_m_from_i40_mid "
    "FROM silver_incidents WHERE sqrt(pow(longitude - (-80.0e0), 2) + pow(latitude - 35.5e0, 2)) <= 0.5"))
add("r17_incidents_near_point", lambda i: reports.incidents_near_point(i.incidents),
    NEAR + " ORDER BY distance_m_from_i40_mid, incident_id LIMIT 50")
add("g15_planar_distance_within", lambda i: reports.incidents_near_point(i.incidents, None), NEAR)
add("r18_scorecard_preview", lambda i: reports.scorecard_preview(i.scorecard), using("gold_scorecard", (
    f"SELECT state_code, total_incidents, total_fatalities, total_bridges, {rnd('avg_bridge_sufficiency', 1)} AS avg_bridge_sufficiency, "
    f"{rnd('total_lane_miles', 0)} AS total_lane_miles, poor_pavement_pct, total_registered_vehicles, ev_adoption_pct "
    "FROM gold_scorecard ORDER BY total_fatalities DESC, state_code LIMIT 15")))
add("r19_incidents_by_weather", lambda i: reports.incidents_by_weather(i.incidents), using("silver_incidents", (
    f"SELECT weather_condition, count(*) AS incident_count, {big('fatalities')} AS total_fatalities "
    "FROM silver_incidents GROUP BY 1")))
add("r19_bridges_by_type", lambda i: reports.bridges_by_type(i.health), using("silver_bridges", (
    "SELECT bridge_type, count(*) AS bridge_count, " + cnt("structurally_deficient = 'true'") + " AS deficient_bridges, "
    f"{cnt('inspection_overdue')} AS overdue_inspections, min(sufficiency_rating) AS min_sufficiency_rating "
    "FROM silver_bridges GROUP BY 1")))
add("r19_worst_pavement_counties", lambda i: reports.worst_pavement_counties(i.needs), using("gold_needs", (
    f"SELECT state_code, county_code, {big('segment_count')} AS segments, "
    f"{rnd(div('sum(avg_pcr * segment_count)', 'sum(segment_count)'), 4)} AS avg_pcr, "
    f"{rnd('sum(total_estimated_cost_usd)', 2)} AS total_cost_usd FROM gold_needs GROUP BY 1, 2")))
add("r19_top_fatal_corridors", lambda i: reports.top_fatal_corridors(i.corridors), using("gold_corridors", (
    "SELECT state_code, route_id, county_code, incident_count, total_fatalities, risk_tier FROM gold_corridors "
    "ORDER BY total_fatalities DESC, state_code, route_id, county_code LIMIT 10")))
add("r19_state_scorecard", lambda i: reports.state_scorecard(i.scorecard), using("gold_scorecard", (
    f"SELECT state_code, total_incidents, total_fatalities, total_bridges, {rnd('avg_bridge_sufficiency', 1)} AS avg_bridge_sufficiency, "
    f"{rnd('total_lane_miles', 0)} AS total_lane_miles, poor_pavement_pct, total_registered_vehicles, ev_adoption_pct "
    "FROM gold_scorecard WHERE state_code = 'NC'")))
add("r19_electric_count", lambda i: reports.electric_count(i.fleet), using("silver_vehicles", (
    f"SELECT {cnt('is_electric')} AS electric_vehicles, count(*) AS registered_vehicles FROM silver_vehicles")))
add("r19_extreme_hotspots", lambda i: steady(reports.extreme_hotspots(i.spots)), using("geo_spots", (
    "SELECT h3_index_r8, state_code, incident_count, total_fatalities, z_score, hotspot_class FROM geo_spots WHERE z_score > 3")))
add("r19_dui_against_collision", lambda i: reports.dui_against_collision(i.incidents), using("silver_incidents", (
    "SELECT state_code, county_code, " + cnt("incident_type = 'DUI'") + " AS dui_incidents, "
    + cnt("incident_type = 'COLLISION'") + " AS collision_incidents FROM silver_incidents GROUP BY 1, 2")))


def reread_json(df, purpose: str):
    """Write JSON records to the shared folder and read them with the same schema."""
    path = shared_dir(df.sparkSession, purpose)
    export_json(df, path)
    return df.sparkSession.read.schema(df.schema).json(path)


@query("r20_export_hotspots", using("geo_spots", (
    "SELECT " + cols("h3_index_r8 state_code incident_count total_fatalities *z_score hotspot_class risk_tier")
    + " FROM geo_spots WHERE incident_count > 0")))
def _(i):
    feed = i.spots.where("incident_count > 0").select(
        "h3_index_r8", "state_code", "incident_count", "total_fatalities", "z_score", "hotspot_class", "risk_tier")
    return steady(reread_json(feed, "hotspot-feed"))


@query("r20_export_bridges", using("silver_bridges", (
    "SELECT " + cols("bridge_id state_code bridge_type *latitude *longitude *risk_score priority_tier") + " FROM silver_bridges")))
def _(i):
    return steady(reread_json(i.bridges.select(
        "bridge_id", "state_code", "bridge_type", "latitude", "longitude", "risk_score", "priority_tier"), "bridge-feed"))
