"""Domain views over the generic test tables.

Every expression is spelled alike in Spark SQL and in other SQL engines, so
``view_sql`` can serve as the prefix of an independent check. Column values are
arithmetic on keys: no randomness and no clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The code lists of the domain, in rule order.
INCIDENT_TYPES = "Collision,Pedestrian,Bicycle,Weather,Road Hazard,DUI,Hit-and-Run,Work Zone"
SEVERITIES = "Fatal,Serious Injury,Minor Injury,Property Damage Only,Unknown"
ROAD_CONDITIONS = "Dry,Wet,Snow/Ice,Fog,Construction,Flooded"
WEATHER = "Clear,Rain,Snow,Fog,Wind,Hail"
STATUSES = "Reported,Under Review,Closed"
STATES = "nc,VA,SC,TN,GA"
BRIDGE_TYPES = "Girder,Truss,Arch,Suspension,Cable-Stayed,Culvert,Box Beam,Moveable"
MATERIALS = "Concrete,Steel,Prestressed Concrete,Timber,Masonry,Aluminum"
OWNERS = "State DOT,Federal,County,City/Municipality,Railroad,Other"
CONDITIONS = "N - Not Applicable,G - Good,F - Fair,P - Poor,C - Critical"
VEHICLE_CLASSES = "Passenger Car,Light Truck,Medium Truck,Heavy Truck,Bus,Motorcycle,Trailer,Special Equipment"
FUELS = "Gasoline,Diesel,Electric,Hybrid,CNG,Hydrogen,LPG"
ROAD_CLASSES = "Interstate,US Route,State Route,County Road,Local Road,Ramp"
PAVEMENTS = "Asphalt,Concrete,Composite,Gravel,Chip Seal"
RATINGS = "Good,Fair,Poor,Very Poor"
ZONE_TYPES = "CBD,Urban Residential,Suburban Residential,Commercial,Industrial,University,Mixed Use"
WORK_ZONE_TYPES = "Lane Reduction,Road Closure,Shoulder Closure"


def _pick(values: str, index: str) -> str:
    size = values.count(",") + 1
    return f"split_part('{values}', ',', cast(1 + ({index}) % {size} AS int))"


def _lat(key: str, factor: int, base: str = "35.0", shift: int = 0) -> str:
    return f"{base} + cast(({key} * {factor} + {shift}) % 1000 AS double) / 1000"


def _lon(key: str, factor: int, base: str = "-81.0", shift: int = 0) -> str:
    return f"{base} + cast(({key} * {factor} + {shift}) % 2000 AS double) / 1000"


def _days(base: str, count: str) -> str:
    return f"{base} + INTERVAL '1' DAY * cast({count} AS int)"


VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "fx_incidents": ("events", {
        "incident_id": "CASE WHEN event_id % 997 = 0 THEN NULL ELSE concat('INC-', cast(event_id AS string)) END",
        "incident_type": f"concat(CASE WHEN event_id % 3 = 0 THEN ' ' ELSE '' END, {_pick(INCIDENT_TYPES, 'event_id')})",
        "severity": _pick(SEVERITIES, "event_id * 7 + user_id"),
        "incident_datetime": "ts - INTERVAL '1' DAY * cast((event_id * 11) % 1461 AS int)",
        "state_code": _pick(STATES, "user_id"),
        "county_code": "concat('COUNTY_', lpad(cast(event_id % 30 AS string), 3, '0'))",
        "route_id": "concat('ROUTE_', cast((event_id * 31) % 50 AS string))",
        "milepost": "cast((event_id * 37) % 10000 AS double) / 100",
        "latitude": _lat("event_id", 7919),
        "longitude": _lon("event_id", 104729),
        "road_condition": _pick(ROAD_CONDITIONS, "event_id * 5"),
        "weather_condition": _pick(WEATHER, "event_id + user_id"),
        "fatalities": "cast((event_id * 13) % 7 AS int)",
        "injuries": "CASE WHEN event_id % 101 = 0 THEN NULL ELSE cast((event_id * 17) % 16 AS int) END",
        "vehicles_involved": "cast(1 + (event_id * 19) % 8 AS int)",
        "status": _pick(STATUSES, "event_id"),
    }),
    "fx_bridges": ("orders", {
        "bridge_id": "concat('BRG-', lpad(cast(o_orderkey AS string), 7, '0'))",
        "state_code": _pick(STATES, "o_custkey"),
        "county_code": "concat('COUNTY_', lpad(cast(o_orderkey % 20 AS string), 3, '0'))",
        "route_id": "concat('ROUTE_', cast((o_orderkey * 31) % 50 AS string))",
        "latitude": _lat("o_orderkey", 6151),
        "longitude": _lon("o_orderkey", 98317),
        "bridge_type": _pick(BRIDGE_TYPES, "o_orderkey"),
        "material_type": _pick(MATERIALS, "o_orderkey * 5 + o_custkey"),
        "owner_type": _pick(OWNERS, "o_custkey"),
        "year_built": "cast(1930 + (o_orderkey * 13 + o_custkey) % 91 AS int)",
        "span_length_ft": "cast(200 + (o_orderkey * 41) % 5801 AS double) / 10",
        "deck_width_ft": "cast(100 + (o_orderkey * 43) % 701 AS double) / 10",
        "avg_daily_traffic": "cast(500 + (o_orderkey * 47) % 79501 AS int)",
        "last_inspection_date": "o_orderdate + INTERVAL '1' DAY * 8401",
        "deck_condition": _pick(CONDITIONS, "o_orderkey"),
        "superstructure_condition": _pick(CONDITIONS, "o_orderkey * 3 + o_custkey"),
        "substructure_condition": _pick(CONDITIONS, "o_custkey"),
        "sufficiency_rating": "cast((o_orderkey * 37 + o_custkey * 11) % 1001 AS double) / 10",
        "structurally_deficient": "CASE WHEN (o_orderkey + o_custkey) % 2 = 0 THEN 'true' ELSE 'false' END",
        "functionally_obsolete": "CASE WHEN (o_orderkey * 3 + o_custkey) % 4 = 0 THEN 'True' ELSE 'False' END",
        "estimated_repair_cost_k": "cast((o_orderkey * 3) % 501 AS double)",
    }),
    "fx_vehicles": ("lineitem", {
        "vin": "concat('VIN', cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', "
               "cast(l_partkey AS string), '-', cast(l_suppkey AS string))",
        "state_code": _pick(STATES, "l_suppkey"),
        "vehicle_class": _pick(VEHICLE_CLASSES, "l_partkey"),
        "model_year": "cast(2000 + (l_partkey * 7 + l_orderkey) % 25 AS int)",
        "fuel_type": _pick(FUELS, "l_orderkey + l_linenumber"),
        "gvwr_lbs": "cast(4000 + (l_partkey * 131 + l_orderkey * 17) % 36001 AS double)",
        "registration_date": _days("TIMESTAMP '2015-01-01 00:00:00'", "(l_orderkey * 23 + l_partkey) % 3653"),
        "expiration_date": _days("TIMESTAMP '2016-01-01 00:00:00'", "(l_orderkey * 23 + l_partkey) % 3653"),
        "commercial_vehicle": "CASE WHEN l_orderkey % 3 = 0 THEN 'true' ELSE 'false' END",
        "hazmat_certified": "CASE WHEN l_partkey % 5 = 0 THEN 'true' ELSE 'false' END",
    }),
    "fx_pavement": ("lineitem", {
        "segment_id": "concat('SEG-', cast(l_orderkey AS string), '-', cast(l_linenumber AS string))",
        "state_code": _pick(STATES, "l_orderkey"),
        "county_code": "concat('COUNTY_', lpad(cast(l_orderkey % 20 AS string), 3, '0'))",
        "segment_length_mi": "cast((l_orderkey * 29 + l_linenumber * 7) % 501 AS double) / 100",
        "functional_class": _pick(ROAD_CLASSES, "l_linenumber"),
        "pavement_type": _pick(PAVEMENTS, "l_orderkey * 3 + l_linenumber"),
        "year_constructed": "cast(1960 + (l_orderkey * 13 + l_linenumber) % 64 AS int)",
        "iri": "cast((l_orderkey * 17 + l_linenumber * 5) % 301 AS int)",
        "psi": "cast((l_orderkey * 19) % 51 AS double) / 10",
        "pcr": "cast((l_orderkey * 23 + l_linenumber * 3) % 1001 AS double) / 10",
        "cracking_percent": "cast((l_orderkey * 31 + l_linenumber) % 301 AS double) / 10",
        "rutting_in": "cast((l_orderkey * 41 + l_linenumber) % 201 AS double) / 100",
        "condition_rating": _pick(RATINGS, "l_orderkey + l_linenumber"),
        "aadt": "cast(500 + (l_orderkey * 43 + l_linenumber) % 119501 AS int)",
        "truck_percent": "cast((l_orderkey + l_linenumber * 11) % 51 AS int)",
    }),
    "fx_roads": ("supplier", {
        "segment_id": "concat('RD-', cast(s_suppkey AS string))",
        "route_id": "concat('ROUTE_', cast(s_suppkey % 12 AS string))",
        "functional_class": _pick("Interstate,US Route,State Route", "s_suppkey"),
        "start_lat": _lat("s_suppkey", 7919),
        "start_lon": _lon("s_suppkey", 104729),
        "end_lat": _lat("s_suppkey", 7919, "35.02"),
        "end_lon": _lon("s_suppkey", 104729, "-80.97"),
        "aadt": "cast(3000 + (s_suppkey * 977) % 107001 AS int)",
        "speed_limit_mph": "cast(45 + 5 * (s_suppkey % 6) AS int)",
    }),
    "fx_zones": ("nation", {
        "taz_id": "concat('TAZ-', lpad(cast(n_nationkey AS string), 4, '0'))",
        "zone_type": _pick(ZONE_TYPES, "n_nationkey"),
        "centroid_lat": "35.1 + cast(n_nationkey % 5 AS double) * 0.2",
        "centroid_lon": "-80.9 + cast(floor(n_nationkey / 5) AS double) * 0.4",
        "radius_deg": "0.08 + cast(n_nationkey % 3 AS double) * 0.02",
        "population": "cast(1200 + (n_nationkey * 3571) % 37000 AS int)",
        "employment": "cast(2800 + (n_nationkey * 2903) % 49000 AS int)",
        "vehicle_trips_daily": "cast(14000 + (n_nationkey * 4001) % 84000 AS int)",
    }),
    "fx_sensors": ("customer", {
        "sensor_id": "concat('SEN-', cast(c_custkey AS string))",
        "latitude": _lat("c_custkey", 7919, shift=13),
        "longitude": _lon("c_custkey", 104729, shift=29),
        "operational_status": _pick("Active,Active,Maintenance,Offline", "c_custkey"),
        "uptime_pct": "cast(700 + (c_custkey * 7) % 300 AS double) / 1000",
    }),
    "fx_work_zones": ("part", {
        "work_zone_id": "concat('WZ-', cast(p_partkey AS string))",
        "route_id": "concat('ROUTE_', cast(p_partkey % 50 AS string))",
        "centroid_lat": _lat("p_partkey", 7919),
        "centroid_lon": _lon("p_partkey", 104729),
        "zone_type": _pick(WORK_ZONE_TYPES, "p_partkey"),
        "start_date": _days("TIMESTAMP '2021-01-01 00:00:00'", "(p_partkey * 17) % 2000"),
        "end_date": _days("TIMESTAMP '2022-01-01 00:00:00'", "(p_partkey * 17) % 2000"),
        "speed_limit_in_zone": "cast(35 + 5 * (p_partkey % 7) AS int)",
    }),
    "fx_employees": ("customer", {
        "employee_id": "concat('EMP-', lpad(cast(c_custkey AS string), 6, '0'))",
        "name": "c_name",
        "birth_date": "DATE '1960-01-01' + cast((c_custkey * 31) % 15705 AS int)",
        "ssn": "concat(lpad(cast(100 + c_custkey % 800 AS string), 3, '0'), '-', "
               "lpad(cast(c_custkey % 99 AS string), 2, '0'), '-', lpad(cast((c_custkey * 7) % 9999 AS string), 4, '0'))",
        "department": "c_mktsegment",
        "salary": "cast(38000 + (c_custkey * 379) % 162001 AS double)",
    }),
}


def view_sql(name: str) -> str:
    base, columns = VIEWS[name]
    return "SELECT " + ", ".join(f"{expr} AS {col}" for col, expr in columns.items()) + f" FROM {base}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, columns = VIEWS[name]
    source = spark.read.parquet(f"{sf_dir}/{base}.parquet")
    return source.selectExpr(*[f"{expr} AS {col}" for col, expr in columns.items()])
