"""Building blocks of the check queries, in plain SQL over the test tables.

Each block is a named subquery with the blocks it needs; ``using`` puts the
needed ones in front of a query. They restate the rules on their own and share
nothing with the Spark code but the fixture views.
"""

from __future__ import annotations

import math

from carriageway.sources.domain import VIEWS, view_sql

BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {name: ((), view_sql(name)) for name in VIEWS}


def block(name: str, needs: str, sql: str) -> None:
    BLOCKS[name] = (tuple(needs.split()), sql)


def using(names: str, body: str) -> str:
    """``WITH`` every named block and what it needs, then ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in BLOCKS[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        visit(name)
    return "WITH " + ", ".join(f"{n} AS ({BLOCKS[n][1]})" for n in ordered) + " " + body


def rnd(expr: str, digits: int) -> str:
    """Half-up rounding of a double, as ``functions.rules`` does it."""
    return f"cast(round(cast({expr} AS decimal(38,{6 if digits <= 4 else 10})), {digits}) AS double)"


def cols(spec: str) -> str:
    """Column list; ``*name`` is a double rounded to six digits."""
    out = []
    for item in spec.replace(",", " ").split():
        out.append(f"{rnd(item[1:], 6)} AS {item[1:]}" if item.startswith("*") else item)
    return ", ".join(out)


def big(expr: str) -> str:
    """Integer sum in the 64-bit type Spark uses."""
    return f"cast(sum({expr}) AS bigint)"


def cnt(predicate: str) -> str:
    return f"count(*) FILTER (WHERE {predicate})"


def div(a: str, b: str) -> str:
    return f"(cast({a} AS double) / nullif(cast({b} AS double), 0))"


def cell(lat: str, lon: str, res: int, into: str) -> str:
    """Scalar subquery-free cell expression: needs the ``{into}_`` columns of ``cell_parts``."""
    return (
        f"concat('{res}:', "
        f"CASE WHEN {into}_dq > {into}_ds AND {into}_dq > {into}_dr THEN -{into}_ns - {into}_nr ELSE {into}_nq END, ':', "
        f"CASE WHEN ({into}_dq > {into}_ds AND {into}_dq > {into}_dr) OR {into}_ds > {into}_dr "
        f"THEN {into}_nr ELSE -{into}_nq - {into}_ns END)"
    )


def with_cell(source: str, lat: str, lon: str, res: int, name: str) -> str:
    """SELECT adding the hex cell ``name`` of (lat, lon) to ``source``."""
    edge = 0.53275 * math.sqrt(7.0) ** (8 - res)
    klon = 111.320 * math.cos(math.radians(35.5))
    x, y = f"(({lon}) - (-79.5)) * {klon!r}", f"(({lat}) - 35.5) * 110.574"
    q = f"({math.sqrt(3) / 3!r} * ({x}) - ({y}) / 3.0e0) / {edge!r}"
    r = f"({2.0 / 3.0!r} * ({y})) / {edge!r}"
    p = name
    level1 = f"SELECT *, {q} AS {p}_q, {r} AS {p}_r FROM {source}"
    level2 = (
        f"SELECT *, cast(floor({p}_q + 0.5) AS bigint) AS {p}_nq, cast(floor({p}_r + 0.5) AS bigint) AS {p}_nr, "
        f"cast(floor(-{p}_q - {p}_r + 0.5) AS bigint) AS {p}_ns FROM ({level1})"
    )
    level3 = (
        f"SELECT *, abs({p}_nq - {p}_q) AS {p}_dq, abs({p}_nr - {p}_r) AS {p}_dr, "
        f"abs({p}_ns - (-{p}_q - {p}_r)) AS {p}_ds FROM ({level2})"
    )
    parts = ", ".join(f"{p}_{t}" for t in "q r nq nr ns dq dr ds".split())
    return (
        f"SELECT * EXCLUDE ({parts}), CASE WHEN {lat} IS NULL OR {lon} IS NULL THEN NULL ELSE "
        f"{cell(lat, lon, res, p)} END AS {p} FROM ({level3})"
    )


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(sin(radians(({lat2}) - ({lat1})) / 2) * sin(radians(({lat2}) - ({lat1})) / 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * sin(radians(({lon2}) - ({lon1})) / 2) * sin(radians(({lon2}) - ({lon1})) / 2))"
    )
    return f"(7917.6e0 * atan2(sqrt({a}), sqrt(1 - {a})))"


def bands(value: str, op: str, cuts, otherwise: str) -> str:
    whens = " ".join(f"WHEN {value} {op} {cut} THEN '{label}'" for cut, label in cuts)
    return f"CASE {whens} ELSE '{otherwise}' END"


SEVERITY_CASE = (
    "CASE severity WHEN 'Fatal' THEN 5 WHEN 'Serious Injury' THEN 4 WHEN 'Minor Injury' THEN 3 "
    "WHEN 'Property Damage Only' THEN 2 ELSE 1 END"
)
TIER_CUTS = [(70, "Priority 1 – Immediate"), (45, "Priority 2 – Near Term"), (20, "Priority 3 – Planned")]


def worst() -> str:
    parts = ("deck_condition", "superstructure_condition", "substructure_condition")
    poor = " OR ".join(f"{p} LIKE 'P%'" for p in parts)
    fair = " OR ".join(f"{p} LIKE 'F%'" for p in parts)
    return f"CASE WHEN {poor} THEN 'Poor' WHEN {fair} THEN 'Fair' ELSE 'Good' END"


AGE_CASE = bands(
    "2024 - year_built", "<",
    [(20, "New (<20 yrs)"), (40, "Mature (20-40 yrs)"), (60, "Aging (40-60 yrs)")], "Old (60+ yrs)",
)
DAYS_SINCE = "cast(date_diff('day', cast(last_inspection_date AS date), DATE '2024-12-31') AS int)"
CLOCK = (
    "cast(year(incident_datetime) AS int) AS incident_year, cast(month(incident_datetime) AS int) AS incident_month, "
    "cast(hour(incident_datetime) AS int) AS incident_hour, cast(dayofweek(incident_datetime) + 1 AS int) AS day_of_week, "
    "dayofweek(incident_datetime) IN (0, 6) AS is_weekend"
)

# Records delivered twice, as exact copies.
block("fx_incidents_twice", "fx_incidents",
      "SELECT * FROM fx_incidents UNION ALL SELECT * FROM fx_incidents WHERE status = 'Closed'")
block("fx_bridges_twice", "fx_bridges",
      "SELECT * FROM fx_bridges UNION ALL SELECT * FROM fx_bridges WHERE owner_type = 'Federal'")


def silver_incidents(source: str) -> str:
    return (
        "SELECT incident_id, upper(trim(incident_type)) AS incident_type, trim(severity) AS severity, incident_datetime, "
        "upper(state_code) AS state_code, county_code, route_id, milepost, latitude, longitude, road_condition, "
        "weather_condition, fatalities, injuries, vehicles_involved, status, "
        f"{CLOCK}, fatalities > 0 AS has_fatality, fatalities + injuries AS total_casualties, "
        f"{SEVERITY_CASE} AS severity_score FROM {source} "
        "WHERE incident_id IS NOT NULL AND incident_datetime IS NOT NULL"
    )


def silver_bridges(source: str) -> str:
    base = (
        f"SELECT * REPLACE (upper(state_code) AS state_code), 2024 - year_built AS bridge_age_years, "
        f"{AGE_CASE} AS age_category, {worst()} AS worst_condition, "
        + rnd("(100 - sufficiency_rating) * 0.5 + cast(2024 - year_built AS double) * 0.3 + "
              "CASE WHEN structurally_deficient = 'true' THEN 20 ELSE 0 END", 1)
        + f" AS risk_score, {DAYS_SINCE} AS days_since_inspection FROM {source}"
    )
    return (
        f"SELECT *, {bands('risk_score', '>=', TIER_CUTS, 'Priority 4 – Monitor')} AS priority_tier, "
        f"days_since_inspection > 730 AS inspection_overdue FROM ({base})"
    )


block("silver_incidents", "fx_incidents", silver_incidents("fx_incidents"))
block("silver_bridges", "fx_bridges", silver_bridges("fx_bridges"))
block("silver_vehicles", "fx_vehicles", (
    "SELECT DISTINCT * REPLACE (upper(state_code) AS state_code), 2024 - model_year AS vehicle_age, "
    + bands("gvwr_lbs", "<=", [(6000, "Class 1-2 – Light Duty"), (10000, "Class 3"), (14000, "Class 4"),
                               (19500, "Class 5"), (26000, "Class 6"), (33000, "Class 7")], "Class 8 – Heavy Duty")
    + " AS weight_class, fuel_type IN ('Electric', 'Hybrid') AS is_electric, commercial_vehicle = 'true' AS is_commercial, "
    "expiration_date < TIMESTAMP '2024-12-31 00:00:00' AS is_expired, cast(year(registration_date) AS int) AS reg_year "
    "FROM fx_vehicles"
))
block("silver_pavement", "fx_pavement", (
    "SELECT *, " + bands("distress_index", ">=", [(60, "Immediate Rehab"), (40, "Preventive Treatment"), (20, "Monitor")],
                         "No Action") + " AS maintenance_priority FROM ("
    "SELECT DISTINCT * REPLACE (upper(state_code) AS state_code), 2024 - year_constructed AS pavement_age, "
    + bands("iri", "<=", [(60, "Very Good"), (95, "Good"), (170, "Fair"), (220, "Mediocre")], "Poor")
    + " AS iri_category, " + rnd("cracking_percent * 0.4 + rutting_in * 5 + (100 - pcr) * 0.6", 1) + " AS distress_index, "
    + bands("aadt", ">=", [(50000, "High Volume"), (10000, "Medium Volume")], "Low Volume")
    + " AS traffic_category FROM fx_pavement)"
))

INCIDENT_KEYS = "state_code, route_id, incident_year, incident_month, incident_type, severity"
INCIDENT_MEASURES = (
    f"count(incident_id) AS total_incidents, {big('fatalities')} AS total_fatalities, {big('injuries')} AS total_injuries, "
    f"{big('total_casualties')} AS total_casualties, avg(vehicles_involved) AS avg_vehicles_involved, "
    f"count(DISTINCT county_code) AS counties_affected, {cnt('has_fatality')} AS fatal_incidents, "
    f"{cnt('is_weekend')} AS weekend_incidents, {cnt('incident_hour BETWEEN 6 AND 9')} AS morning_rush_incidents, "
    f"{cnt('incident_hour BETWEEN 15 AND 19')} AS evening_rush_incidents, "
    f"{cnt('incident_hour >= 22 OR incident_hour <= 5')} AS overnight_incidents"
)
CORRIDOR_MEASURES = (
    f"count(incident_id) AS incident_count, {big('fatalities')} AS total_fatalities, {big('injuries')} AS total_injuries, "
    "count(DISTINCT incident_type) AS incident_type_diversity, avg(severity_score) AS avg_severity_score, "
    "max(incident_datetime) AS most_recent_incident"
)


def bridge_measures(deficient: str, obsolete: str) -> str:
    return (
        "count(bridge_id) AS bridge_count, avg(sufficiency_rating) AS avg_sufficiency_rating, "
        "min(sufficiency_rating) AS min_sufficiency_rating, avg(bridge_age_years) AS avg_bridge_age, "
        f"avg(avg_daily_traffic) AS avg_daily_traffic, {big('avg_daily_traffic')} AS total_daily_traffic_exposed, "
        f"{cnt(deficient)} AS structurally_deficient_count, {cnt(obsolete)} AS functionally_obsolete_count, "
        f"{cnt('inspection_overdue')} AS overdue_inspections, sum(estimated_repair_cost_k) AS total_estimated_repair_cost_k, "
        "avg(risk_score) AS avg_risk_score, max(risk_score) AS max_risk_score"
    )


block("gold_summary", "silver_incidents", (
    f"SELECT *, {rnd(div('total_fatalities', 'total_incidents'), 4)} AS fatality_rate, "
    f"{rnd(div('total_injuries', 'total_incidents'), 4)} AS injury_rate FROM ("
    f"SELECT {INCIDENT_KEYS}, {INCIDENT_MEASURES} FROM silver_incidents GROUP BY {INCIDENT_KEYS})"
))
CORRIDOR_TIERS = [(10, "Top 10 – Critical"), (25, "Top 25 – High Risk"), (50, "Top 50 – Elevated")]
block("gold_corridors", "silver_incidents", (
    f"SELECT *, {bands('state_rank', '<=', CORRIDOR_TIERS, 'Standard')} AS risk_tier FROM ("
    f"SELECT *, {rnd(div('total_fatalities', 'incident_count'), 3)} AS fatality_concentration, "
    "cast(rank() OVER (PARTITION BY state_code ORDER BY total_fatalities DESC) AS int) AS state_rank FROM ("
    f"SELECT state_code, route_id, county_code, {CORRIDOR_MEASURES} FROM silver_incidents "
    "GROUP BY state_code, route_id, county_code))"
))
BRIDGE_KEYS = "state_code, county_code, bridge_type, age_category, priority_tier"
block("gold_health", "silver_bridges", (
    f"SELECT *, {rnd(div('structurally_deficient_count', 'bridge_count'), 3)} AS deficiency_rate, "
    f"{rnd('total_estimated_repair_cost_k / 1000', 2)} AS total_estimated_repair_cost_m FROM ("
    f"SELECT {BRIDGE_KEYS}, " + bridge_measures("structurally_deficient = 'true'", "functionally_obsolete = 'true'")
    + f" FROM silver_bridges GROUP BY {BRIDGE_KEYS})"
))
FLEET_KEYS = "state_code, vehicle_class, weight_class, fuel_type, model_year"
block("gold_fleet", "silver_vehicles", (
    f"SELECT *, {rnd(div('electric_count', 'registered_vehicles'), 3)} AS electric_share, "
    f"{rnd(div('commercial_count', 'registered_vehicles'), 3)} AS commercial_share FROM ("
    f"SELECT {FLEET_KEYS}, count(vin) AS registered_vehicles, avg(vehicle_age) AS avg_vehicle_age, "
    f"avg(gvwr_lbs) AS avg_gvwr_lbs, {cnt('is_electric')} AS electric_count, {cnt('is_commercial')} AS commercial_count, "
    + cnt("hazmat_certified = 'true'") + f" AS hazmat_count, {cnt('is_expired')} AS expired_registrations "
    f"FROM silver_vehicles GROUP BY {FLEET_KEYS})"
))
NEEDS_KEYS = "state_code, county_code, functional_class, pavement_type, maintenance_priority, iri_category"
UNIT_COST = (
    "CASE maintenance_priority WHEN 'Immediate Rehab' THEN 800000 WHEN 'Preventive Treatment' THEN 250000 "
    "WHEN 'Monitor' THEN 10000 ELSE 0 END"
)
block("gold_needs", "silver_pavement", (
    "SELECT *, CASE WHEN total_aadt > 0 THEN " + rnd("total_estimated_cost_usd / total_aadt", 2)
    + " ELSE 0e0 END AS cost_per_aadt FROM ("
    f"SELECT {NEEDS_KEYS}, count(segment_id) AS segment_count, sum(segment_length_mi) AS total_lane_miles, "
    "avg(pcr) AS avg_pcr, avg(iri) AS avg_iri, avg(distress_index) AS avg_distress_index, "
    f"avg(pavement_age) AS avg_pavement_age, sum({UNIT_COST} * segment_length_mi) AS total_estimated_cost_usd, "
    f"{big('aadt')} AS total_aadt FROM silver_pavement GROUP BY {NEEDS_KEYS})"
))
block("gold_scorecard", "silver_incidents silver_bridges silver_pavement silver_vehicles", (
    f"SELECT *, {rnd(div('total_fatalities', 'total_registered_vehicles') + ' * 100000', 2)} AS fatality_per_100k_vehicles, "
    f"{rnd(div('poor_pavement_miles', 'total_lane_miles') + ' * 100', 1)} AS poor_pavement_pct, "
    f"{rnd(div('deficient_bridges', 'total_bridges') + ' * 100', 1)} AS bridge_deficiency_pct, "
    f"{rnd(div('electric_vehicles', 'total_registered_vehicles') + ' * 100', 1)} AS ev_adoption_pct FROM "
    f"(SELECT state_code, count(incident_id) AS total_incidents, {big('fatalities')} AS total_fatalities, "
    f"{big('injuries')} AS total_injuries FROM silver_incidents GROUP BY state_code) "
    "LEFT JOIN (SELECT state_code, count(bridge_id) AS total_bridges, avg(sufficiency_rating) AS avg_bridge_sufficiency, "
    + cnt("structurally_deficient = 'true'") + " AS deficient_bridges FROM silver_bridges GROUP BY state_code) USING (state_code) "
    "LEFT JOIN (SELECT state_code, sum(segment_length_mi) AS total_lane_miles, avg(pcr) AS avg_pcr, "
    "sum(CASE WHEN condition_rating IN ('Poor', 'Very Poor') THEN segment_length_mi ELSE 0 END) AS poor_pavement_miles "
    "FROM silver_pavement GROUP BY state_code) USING (state_code) "
    f"LEFT JOIN (SELECT state_code, count(vin) AS total_registered_vehicles, {cnt('is_electric')} AS electric_vehicles "
    "FROM silver_vehicles GROUP BY state_code) USING (state_code)"
))

# Second variants.
block("model_incidents", "fx_incidents", (
    "SELECT incident_id, upper(trim(incident_type)) AS incident_type, trim(severity) AS severity, incident_datetime, "
    "upper(trim(state_code)) AS state_code, upper(trim(county_code)) AS county_code, upper(trim(route_id)) AS route_id, "
    "milepost, latitude, longitude, trim(road_condition) AS road_condition, trim(weather_condition) AS weather_condition, "
    "fatalities, injuries, vehicles_involved, trim(status) AS status, "
    f"{CLOCK}, fatalities > 0 AS has_fatality, coalesce(fatalities, 0) + coalesce(injuries, 0) AS total_casualties, "
    f"{SEVERITY_CASE} AS severity_score FROM fx_incidents WHERE incident_id IS NOT NULL AND incident_datetime IS NOT NULL"
))
MODEL_TIERS = [(70, "Priority 1 - Immediate"), (45, "Priority 2 - Near Term"), (20, "Priority 3 - Planned")]
block("model_bridges", "fx_bridges", (
    f"SELECT *, {bands('risk_score', '>=', MODEL_TIERS, 'Priority 4 - Monitor')} AS priority_tier, "
    "days_since_inspection > 730 AS inspection_overdue FROM ("
    f"SELECT *, 2024 - year_built AS bridge_age_years, {AGE_CASE} AS age_category, {worst()} AS worst_condition, "
    + rnd("(100 - sufficiency_rating) * 0.5 + (2024 - year_built) * 0.3e0 + CASE WHEN structurally_deficient THEN 20 ELSE 0 END", 1)
    + f" AS risk_score, {DAYS_SINCE} AS days_since_inspection FROM ("
    "SELECT * REPLACE (upper(trim(state_code)) AS state_code, upper(trim(county_code)) AS county_code, "
    "upper(trim(route_id)) AS route_id, trim(bridge_type) AS bridge_type, trim(material_type) AS material_type, "
    "trim(owner_type) AS owner_type, "
    "lower(trim(structurally_deficient)) IN ('true', 't', '1', 'yes', 'y') AS structurally_deficient, "
    "lower(trim(functionally_obsolete)) IN ('true', 't', '1', 'yes', 'y') AS functionally_obsolete) "
    "FROM fx_bridges WHERE bridge_id IS NOT NULL AND year_built BETWEEN 1800 AND 2025))"
))

# Geo marts.
block("cells_8", "silver_incidents", with_cell("silver_incidents", "latitude", "longitude", 8, "h3_index_r8"))
block("cells_87", "cells_8", with_cell("cells_8", "latitude", "longitude", 7, "h3_index_r7"))
block("cells_876", "cells_87", with_cell("cells_87", "latitude", "longitude", 6, "h3_index_r6"))
CITY_MILES = ", ".join(
    rnd(haversine("latitude", "longitude", la, lo), 4)
    for la, lo in (("35.2271e0", "-80.8431e0"), ("35.7796e0", "-78.6382e0"), ("36.0726e0", "-79.7920e0"))
)
block("geo_incidents", "cells_876", (
    f"SELECT *, {bands('urban_proximity_score', '<=', [(10, 'Urban'), (30, 'Suburban')], 'Rural')} AS area_type FROM ("
    "SELECT *, concat('POINT (', longitude, ' ', latitude, ')') AS geometry_wkt, "
    "degrees(atan2(longitude - (-80.8431e0), latitude - 35.2271e0)) AS bearing_from_charlotte, "
    f"least({CITY_MILES}) AS urban_proximity_score FROM cells_876)"
))
block("geo_cells", "geo_incidents", (
    f"SELECT *, {rnd('incident_count / 0.7374e0', 2)} AS incident_density_per_km2, "
    f"{rnd('avg_severity_score * incident_count', 2)} AS severity_density, "
    "CASE WHEN total_fatalities >= 5 THEN 'Critical – 5+ fatalities' WHEN total_fatalities >= 2 THEN 'High – 2-4 fatalities' "
    "WHEN incident_count >= 20 THEN 'Elevated – high volume' WHEN incident_count >= 10 THEN 'Moderate' ELSE 'Low' END AS risk_tier "
    f"FROM (SELECT h3_index_r8, h3_index_r6, state_code, count(incident_id) AS incident_count, "
    f"{big('fatalities')} AS total_fatalities, {big('injuries')} AS total_injuries, avg(severity_score) AS avg_severity_score, "
    f"{cnt('has_fatality')} AS fatal_incident_count, " + cnt("incident_type = 'COLLISION'") + " AS collision_count, "
    + cnt("incident_type = 'DUI'") + " AS dui_count, " + cnt("incident_type = 'PEDESTRIAN'") + " AS pedestrian_count, "
    f"{cnt('is_weekend')} AS weekend_incident_count, {cnt('incident_hour >= 22 OR incident_hour <= 5')} AS night_incident_count, "
    "count(DISTINCT route_id) AS routes_in_cell, min(incident_datetime) AS first_incident, "
    "max(incident_datetime) AS latest_incident FROM geo_incidents WHERE h3_index_r8 IS NOT NULL "
    "GROUP BY h3_index_r8, h3_index_r6, state_code)"
))
block("geo_spots", "geo_cells", (
    "SELECT *, z_score >= 1.5 AS is_hotspot, z_score <= -1.5 AS is_cold_spot, "
    "CASE WHEN z_score >= 3.0 THEN 'Hot Spot 99% Confidence' WHEN z_score >= 2.0 THEN 'Hot Spot 95% Confidence' "
    "WHEN z_score >= 1.5 THEN 'Hot Spot 90% Confidence' WHEN z_score <= -1.5 THEN 'Cold Spot (low activity)' "
    "ELSE 'Not Significant' END AS hotspot_class FROM ("
    "SELECT *, CASE WHEN stddev_density > 0 THEN " + rnd("(incident_density_per_km2 - mean_density) / stddev_density", 3)
    + " ELSE 0e0 END AS z_score FROM ("
    "SELECT *, avg(incident_density_per_km2) OVER (PARTITION BY state_code) AS mean_density, "
    "stddev_samp(incident_density_per_km2) OVER (PARTITION BY state_code) AS stddev_density FROM geo_cells))"
))
block("road_mids", "fx_roads", (
    "SELECT *, (start_lat + end_lat) / 2 AS mid_lat, (start_lon + end_lon) / 2 AS mid_lon, "
    + bands("aadt", ">", [(60000, "Urban"), (20000, "Suburban")], "Rural") + " AS area_type FROM fx_roads"
))
block("segments", "road_mids", with_cell("road_mids", "mid_lat", "mid_lon", 8, "h3_index_r8"))
RING2 = ", ".join(
    f"({dq}, {dr})" for dq in range(-2, 3) for dr in range(-2, 3) if abs(dq + dr) <= 2
)
# The ring is walked from the incident here, from the segment in the Spark job.
block("incident_rings", "geo_incidents", (
    "SELECT g.*, concat('8:', cast(split_part(h3_index_r8, ':', 2) AS int) + o.dq, ':', "
    "cast(split_part(h3_index_r8, ':', 3) AS int) + o.dr) AS h3_neighbor "
    f"FROM geo_incidents g, (VALUES {RING2}) AS o(dq, dr)"
))
block("geo_pairs", "incident_rings segments", (
    "SELECT i.incident_id, i.fatalities, i.injuries, i.severity_score, i.has_fatality, s.route_id AS seg_route_id, "
    "s.functional_class, s.area_type, s.aadt FROM incident_rings i JOIN segments s ON i.h3_neighbor = s.h3_index_r8"
))
block("geo_rates", "geo_pairs", (
    "SELECT *, CASE WHEN reference_aadt > 0 THEN "
    + rnd("incidents_on_corridor / (reference_aadt * 365 / 1e8)", 4) + " END AS incidents_per_100m_vmt FROM ("
    "SELECT seg_route_id, functional_class, area_type, count(DISTINCT incident_id) AS incidents_on_corridor, "
    f"{big('fatalities')} AS fatalities_on_corridor, {big('injuries')} AS injuries_on_corridor, "
    f"avg(severity_score) AS avg_severity, {cnt('has_fatality')} AS fatal_incidents, avg(aadt) AS reference_aadt "
    "FROM geo_pairs GROUP BY seg_route_id, functional_class, area_type)"
))
block("zone_cells", "fx_zones", with_cell("fx_zones", "centroid_lat", "centroid_lon", 7, "zone_cell"))
block("bridge_cells", "silver_bridges", with_cell("silver_bridges", "latitude", "longitude", 7, "h3_index_r7"))
block("geo_bridges", "bridge_cells zone_cells", (
    "SELECT b.bridge_id, b.state_code, b.bridge_type, b.age_category, b.worst_condition, b.risk_score, b.priority_tier, "
    "b.sufficiency_rating, b.avg_daily_traffic, b.latitude, b.longitude, "
    "concat('POINT (', b.longitude, ' ', b.latitude, ')') AS geometry_wkt, b.h3_index_r7, z.taz_id, z.zone_type, "
    "z.population AS taz_population, z.employment AS taz_employment, z.vehicle_trips_daily AS taz_vehicle_trips, "
    + rnd("z.population * (b.risk_score / 100)", 0) + " AS population_at_risk_score "
    "FROM bridge_cells b LEFT JOIN zone_cells z ON b.h3_index_r7 = z.zone_cell"
))
block("wz_status", "fx_work_zones", (
    "SELECT *, CASE WHEN start_date > TIMESTAMP '2024-12-31 00:00:00' THEN 'Planned' "
    "WHEN end_date < TIMESTAMP '2024-12-31 00:00:00' THEN 'Completed' ELSE 'Active' END AS status FROM fx_work_zones"
))
block("wz_open", "fx_work_zones", (
    "SELECT *, CASE WHEN start_date > TIMESTAMP '2023-12-31 00:00:00' THEN 'Planned' "
    "WHEN end_date < TIMESTAMP '2023-12-31 00:00:00' THEN 'Completed' ELSE 'Active' END AS status FROM fx_work_zones"
))
block("wz_cells", "wz_open", with_cell("wz_open", "centroid_lat", "centroid_lon", 8, "zone_cell"))
block("geo_conflicts", "geo_incidents wz_cells", (
    "SELECT w.work_zone_id, w.zone_type, w.route_id AS wz_route, w.speed_limit_in_zone, "
    f"count(i.incident_id) AS wz_incident_count, {big('i.fatalities')} AS wz_fatalities, "
    f"{big('i.injuries')} AS wz_injuries, avg(i.severity_score) AS wz_avg_severity "
    "FROM geo_incidents i JOIN wz_cells w ON i.h3_index_r8 = w.zone_cell AND w.status = 'Active' "
    "AND i.incident_datetime >= w.start_date AND i.incident_datetime <= w.end_date "
    "GROUP BY w.work_zone_id, w.zone_type, w.route_id, w.speed_limit_in_zone"
))
