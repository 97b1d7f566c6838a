"""Declared schemas of the bronze tables, applied on read."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of each table. The first column and the
# ingestion time are never null.
_TEXT = {
    "traffic_incidents": (
        "incident_id string, incident_type string, severity string, incident_datetime timestamp, state_code string, "
        "county_code string, route_id string, milepost double, latitude double, longitude double, "
        "road_condition string, weather_condition string, fatalities int, injuries int, vehicles_involved int, "
        "status string, ingestion_timestamp timestamp"
    ),
    "bridge_inspections": (
        "bridge_id string, bridge_name string, state_code string, county_code string, route_id string, "
        "milepost double, latitude double, longitude double, bridge_type string, material_type string, "
        "owner_type string, year_built int, span_length_ft double, deck_width_ft double, "
        "vertical_clearance_ft double, avg_daily_traffic int, last_inspection_date timestamp, "
        "deck_condition string, superstructure_condition string, substructure_condition string, "
        "sufficiency_rating double, structurally_deficient string, functionally_obsolete string, "
        "estimated_repair_cost_k double, ingestion_timestamp timestamp"
    ),
    "vehicle_registrations": (
        "vin string, state_code string, county_code string, vehicle_class string, make string, model_year int, "
        "fuel_type string, gvwr_lbs double, horsepower double, registration_date timestamp, "
        "expiration_date timestamp, registration_status string, commercial_vehicle string, "
        "hazmat_certified string, ingestion_timestamp timestamp"
    ),
    "pavement_conditions": (
        "segment_id string, state_code string, county_code string, route_id string, begin_milepost double, "
        "segment_length_mi double, functional_class string, pavement_type string, year_constructed int, iri int, "
        "psi double, pcr double, cracking_percent double, rutting_in double, condition_rating string, aadt int, "
        "truck_percent int, inspection_date timestamp, ingestion_timestamp timestamp"
    ),
    "road_segments": (
        "segment_id string, route_id string, route_name string, state_code string, functional_class string, "
        "lanes int, sequence_num int, begin_milepost double, end_milepost double, length_miles double, "
        "start_lat double, start_lon double, end_lat double, end_lon double, midpoint_lat double, "
        "midpoint_lon double, geometry_wkt string, h3_index_r8 string, h3_index_r6 string, speed_limit_mph int, "
        "surface_type string, pavement_condition string, aadt int, truck_pct int, area_type string, "
        "ingestion_timestamp timestamp"
    ),
    "intersections": (
        "intersection_id string, nearest_city string, state_code string, latitude double, longitude double, "
        "geometry_wkt string, h3_index_r8 string, h3_index_r6 string, cross_streets string, "
        "intersection_type string, control_type string, num_approaches int, has_turn_lane string, "
        "has_pedestrian_signal string, entering_volume_daily int, crash_count_5yr int, fatal_crash_count_5yr int, "
        "congestion_level string, ingestion_timestamp timestamp"
    ),
    "traffic_analysis_zones": (
        "taz_id string, city string, state_code string, county string, centroid_lat double, centroid_lon double, "
        "geometry_wkt string, h3_index_r7 string, zone_type string, area_sq_miles double, population int, "
        "employment int, households int, vehicle_trips_daily int, transit_trips_daily int, "
        "avg_trip_length_miles double, pct_zero_car_households double, ingestion_timestamp timestamp"
    ),
    "sensor_locations": (
        "sensor_id string, segment_id string, route_id string, state_code string, latitude double, "
        "longitude double, geometry_wkt string, h3_index_r8 string, sensor_type string, "
        "operational_status string, install_year int, num_lanes_monitored int, bidirectional string, "
        "uptime_pct double, reference_aadt int, data_interval_sec int, comms_type string, "
        "ingestion_timestamp timestamp"
    ),
    "work_zones": (
        "work_zone_id string, state_code string, county string, route_id string, project_name string, "
        "centroid_lat double, centroid_lon double, geometry_wkt string, h3_index_r8 string, zone_type string, "
        "status string, start_date timestamp, end_date timestamp, lanes_closed int, zone_length_miles double, "
        "speed_limit_in_zone int, flagging_required string, project_cost_usd double, responsible_agency string, "
        "ingestion_timestamp timestamp"
    ),
    "employee": (
        "employee_id string, name string, sex string, birth_date date, hire_date date, ssn string, "
        "department string, job_title string, salary double, email string, phone_number string"
    ),
}

# Partition columns of each table.
PARTITIONS = {
    "traffic_incidents": ["state_code", "incident_type"],
    "bridge_inspections": ["state_code"],
    "vehicle_registrations": ["state_code", "vehicle_class"],
    "pavement_conditions": ["state_code", "functional_class"],
    "road_segments": ["state_code", "functional_class"],
    "intersections": ["state_code"],
    "traffic_analysis_zones": ["state_code"],
    "sensor_locations": ["state_code", "sensor_type"],
    "work_zones": ["state_code"],
}


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "timestamp": T.TimestampType(), "date": T.DateType(),
}


def declared(table: str) -> T.StructType:
    fields = []
    for i, column in enumerate(_TEXT[table].split(", ")):
        name, kind = column.split(" ")
        required = i == 0 or name == "ingestion_timestamp" or table == "employee"
        fields.append(T.StructField(name, _TYPES[kind], not required))
    return T.StructType(fields)


TABLES = tuple(_TEXT)
