"""Geospatial marts: enriched incidents, cell density, corridors, hotspots, zones."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carriageway.functions.cells import AREA_KM2_R8, hex_cell, with_cells
from carriageway.functions.geometry import (
    area_type, line_wkt, miles_between, nearest_city_miles, planar_bearing, point_wkt, polygon_wkt, ring_points,
)
from carriageway.functions.rules import banded, ratio, rounded, rounded_total, tally
from carriageway.functions.times import AS_OF, at_midnight, in_hours
from carriageway.operators.measures import rollup_by
from carriageway.operators.ordered import next_values, running_totals, spread_scores
from carriageway.operators.settle import settled
from carriageway.operators.spatial import hotspot_class, near_cells
from carriageway.plans.gold import NIGHT
from carriageway.sources.tables import first_available

# Cell risk tiers, ring reach, zone radius factor, traffic bands.
VOLUME_TIERS = [(20, "Elevated – high volume"), (10, "Moderate")]
DEATH_TIERS = [(5, "Critical – 5+ fatalities"), (2, "High – 2-4 fatalities")]
RING_STEPS = 2
RADIUS_PER_ROOT_MILE = 0.0145
SMALLEST_RADIUS = 0.005
TRANSIT_SHARE = 0.08
SEGMENT_AREA_CUTS = [(60000, "Urban"), (20000, "Suburban")]
CONGESTION_CUTS = [(50000, "High"), (20000, "Moderate")]
ROWS_PER_SLICE = 100000


def _stamped(df: DataFrame, stamp: bool) -> DataFrame:
    return df.withColumn("gold_timestamp", F.current_timestamp()) if stamp else df


def enriched_incidents(silver: DataFrame) -> DataFrame:
    """P11. Cells, point text, bearing and nearest-city distance beside each incident."""
    located = with_cells(silver).withColumns({
        "geometry_wkt": point_wkt("longitude", "latitude"),
        "bearing_from_charlotte": planar_bearing("latitude", "longitude"),
        "urban_proximity_score": nearest_city_miles("latitude", "longitude"),
    })
    return located.withColumn("area_type", area_type("urban_proximity_score"))


def type_tally(kind: str) -> Column:
    return tally(F.col("incident_type") == kind)


def cell_risk_tier() -> Column:
    volume = banded("incident_count", ">=", VOLUME_TIERS, "Low")
    deaths = F.coalesce(F.col("total_fatalities"), F.lit(0))
    return F.when(deaths >= DEATH_TIERS[-1][0], banded(deaths, ">=", DEATH_TIERS, "Low")).otherwise(volume)


def placed_only(df: DataFrame) -> DataFrame:
    """Rows that have a cell. Asked of the coordinates, not of the cell id: the test then
    reaches the scan and the id is computed once."""
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def cell_density(enriched: DataFrame, stamp: bool = True) -> DataFrame:
    """P12."""
    cells = rollup_by(
        placed_only(enriched), ["h3_index_r8", "h3_index_r6", "state_code"], {
            "incident_count": F.count("incident_id"),
            "total_fatalities": F.sum("fatalities"),
            "total_injuries": F.sum("injuries"),
            "avg_severity_score": F.avg("severity_score"),
            "fatal_incident_count": tally(F.col("has_fatality")),
            "collision_count": type_tally("COLLISION"),
            "dui_count": type_tally("DUI"),
            "pedestrian_count": type_tally("PEDESTRIAN"),
            "weekend_incident_count": tally(F.col("is_weekend")),
            "night_incident_count": tally(in_hours("incident_hour", *NIGHT)),
            "routes_in_cell": F.countDistinct("route_id"),
            "first_incident": F.min("incident_datetime"),
            "latest_incident": F.max("incident_datetime"),
        },
    ).withColumns({
        "incident_density_per_km2": rounded_total(F.col("incident_count") / F.lit(AREA_KM2_R8), 2),
        "severity_density": rounded_total(F.col("avg_severity_score") * F.col("incident_count"), 2),
        "risk_tier": cell_risk_tier(),
    })
    return _stamped(cells, stamp)


def located_segments(roads: DataFrame) -> DataFrame:
    """Segments with the cell of their midpoint and the traffic-based area type."""
    mid_lat = (F.col("start_lat") + F.col("end_lat")) / 2
    mid_lon = (F.col("start_lon") + F.col("end_lon")) / 2
    return roads.withColumns({
        "h3_index_r8": hex_cell(mid_lat, mid_lon, 8),
        "area_type": banded("aadt", ">", SEGMENT_AREA_CUTS, "Rural"),
    })


def corridor_safety(
    enriched: DataFrame, segments: DataFrame, k: int = RING_STEPS, each_incident_once: bool = False,
    stamp: bool = True,
) -> DataFrame:
    """P13. Incidents within k cells of a corridor, per 100 million vehicle-miles.

    An incident near several segments of a corridor adds to the sums once per
    segment, while the distinct count holds it once. With
    ``each_incident_once`` the sums, too, take it once per corridor.

    Incidents have one cell each, so they are totalled per cell first; the join
    sees cells, never incidents.
    """
    by_cell = rollup_by(placed_only(enriched), ["h3_index_r8"], {
        "_n": F.count("incident_id"),
        "_dead": F.sum("fatalities"),
        "_hurt": F.sum("injuries"),
        "_severity": F.sum("severity_score"),
        "_fatal": tally(F.col("has_fatality")),
    }).withColumnRenamed("h3_index_r8", "_cell")
    corridor = ["seg_route_id", "functional_class", "area_type"]
    segs = segments.select(
        F.col("route_id").alias("seg_route_id"), "functional_class", "area_type", "aadt", "h3_index_r8"
    )
    pairs = near_cells(by_cell, "_cell", segs, "h3_index_r8", k)
    weight = F.lit(1) if each_incident_once else F.col("_segments")
    cells = pairs.groupBy(*corridor, "_cell").agg(
        F.count(F.lit(1)).alias("_segments"),
        F.count("aadt").alias("_counted"),
        F.sum(F.col("aadt").cast("double")).alias("_aadt"),
        *[F.max(c).alias(c) for c in ("_n", "_dead", "_hurt", "_severity", "_fatal")],
    )
    mart = cells.groupBy(*corridor).agg(
        F.sum("_n").alias("incidents_on_corridor"),
        F.sum(F.col("_dead") * weight).alias("fatalities_on_corridor"),
        F.sum(F.col("_hurt") * weight).alias("injuries_on_corridor"),
        ratio(F.sum(F.col("_severity") * weight), F.sum(F.col("_n") * weight)).alias("avg_severity"),
        F.sum(F.col("_fatal") * weight).alias("fatal_incidents"),
        ratio(F.sum(F.col("_aadt") * F.col("_n")), F.sum(F.col("_counted") * F.col("_n"))).alias("reference_aadt"),
    )
    rate = F.when(
        F.col("reference_aadt") > 0,
        rounded_total(F.col("incidents_on_corridor") / (F.col("reference_aadt") * 365 / 1e8), 4),
    )
    return _stamped(mart.withColumn("incidents_per_100m_vmt", rate), stamp)


def hotspots(cells: DataFrame, stamp: bool = True, settle: bool = True) -> DataFrame:
    """P14. z-score of a cell's density among the cells of its state."""
    base = settled(cells, "cells") if settle else cells
    scored = spread_scores(base, ["state_code"], "incident_density_per_km2", "mean_density", "stddev_density")
    z = F.when(
        F.col("stddev_density") > 0,
        rounded((F.col("incident_density_per_km2") - F.col("mean_density")) / F.col("stddev_density"), 3),
    ).otherwise(F.lit(0.0))
    return _stamped(
        scored.withColumn("z_score", z).withColumns({
            "is_hotspot": F.col("z_score") >= 1.5,
            "is_cold_spot": F.col("z_score") <= -1.5,
            "hotspot_class": hotspot_class("z_score"),
        }),
        stamp,
    )


def column_or(df: DataFrame, name: str, fallback: Column) -> Column:
    """The column where the table has it, else the fallback under the same name."""
    return F.col(name) if name in df.columns else fallback.alias(name)


def bridges_with_zone(bridges: DataFrame, zones: DataFrame, stamp: bool = True) -> DataFrame:
    """P15. Bridges assigned to the analysis zone whose centre shares their r7 cell."""
    text = F.lit(None).cast("string")
    have = set(bridges.columns)
    adds = {}
    if "h3_index_r7" not in have:
        adds["h3_index_r7"] = hex_cell("latitude", "longitude", 7)
    if "geometry_wkt" not in have:
        adds["geometry_wkt"] = point_wkt("longitude", "latitude")
    located = bridges.withColumns(adds) if adds else bridges
    centre = zones.select(
        hex_cell("centroid_lat", "centroid_lon", 7).alias("_zone_cell"), "taz_id", "zone_type",
        F.col("population").alias("taz_population"),
        F.col("employment").alias("taz_employment"),
        F.col("vehicle_trips_daily").alias("taz_vehicle_trips"),
    )
    traffic = F.col("aadt") if "aadt" in have else F.lit(None).cast("int")
    shaped = located.select(
        "bridge_id", "state_code", "bridge_type",
        column_or(located, "age_category", text),
        column_or(located, "worst_condition", text),
        column_or(located, "risk_score", F.lit(0.0)),
        column_or(located, "priority_tier", text),
        "sufficiency_rating",
        column_or(located, "avg_daily_traffic", traffic),
        "latitude", "longitude", "geometry_wkt", "h3_index_r7",
    )
    # Bridges without a cell match nothing and stay out of the join, where they would be one hot key.
    placed = shaped.where(F.col("h3_index_r7").isNotNull()).join(centre, F.col("h3_index_r7") == F.col("_zone_cell"), "left").drop("_zone_cell")
    joined = placed.unionByName(shaped.where(F.col("h3_index_r7").isNull()), allowMissingColumns=True)
    at_risk = rounded(F.col("taz_population") * (F.col("risk_score") / 100), 0)
    return _stamped(joined.withColumn("population_at_risk_score", at_risk), stamp)


def bridge_source(spark: SparkSession, verified: str, silver: str) -> DataFrame:
    """Bridges for the overlay: the verified geo table where it exists, else the silver table, which lacks cell and point."""
    return first_available(spark, [verified, silver])


def work_zone_status(as_of: date = AS_OF) -> Column:
    now = at_midnight(as_of)
    return (
        F.when(F.col("start_date") > now, "Planned").when(F.col("end_date") < now, "Completed").otherwise("Active")
    )


def work_zone_conflicts(enriched: DataFrame, work_zones: DataFrame, stamp: bool = True) -> DataFrame:
    """P16. Incidents in the cell of an active work zone while it is open.

    Whole days inside a zone's time are read from totals per cell and day, so
    the join grows with days, not incidents; only the first and the last day
    of a zone are compared by incident.
    """
    zone = ["work_zone_id", "zone_type", "wz_route", "speed_limit_in_zone"]
    active = work_zones.where(F.col("status") == "Active").select(
        "work_zone_id", "zone_type", F.col("route_id").alias("wz_route"), "speed_limit_in_zone",
        F.col("h3_index_r8").alias("_zone_cell"), "start_date", "end_date",
        F.to_date("start_date").alias("_first"), F.to_date("end_date").alias("_last"),
    )
    points = enriched.where(F.col("h3_index_r8").isNotNull()).select(
        "h3_index_r8", "incident_datetime", F.to_date("incident_datetime").alias("_day"),
        F.col("incident_id").isNotNull().cast("long").alias("_n"), F.col("fatalities").cast("long").alias("_dead"),
        F.col("injuries").cast("long").alias("_hurt"), F.col("severity_score").alias("_severity"),
        F.col("severity_score").isNotNull().cast("long").alias("_rated"),
    )
    sums = ["_n", "_dead", "_hurt", "_severity", "_rated"]
    daily = points.groupBy("h3_index_r8", "_day").agg(*[F.sum(c).alias(c) for c in sums])
    same_cell = F.col("h3_index_r8") == F.col("_zone_cell")
    inside = daily.join(active, same_cell & (F.col("_day") > F.col("_first")) & (F.col("_day") < F.col("_last")))
    edges = active.withColumn("_edge", F.explode(F.array_distinct(F.array("_first", "_last"))))
    border = points.join(edges, same_cell & (F.col("_day") == F.col("_edge"))
                         & F.col("incident_datetime").between(F.col("start_date"), F.col("end_date")))
    parts = inside.select(*zone, *sums).unionByName(border.select(*zone, *sums))
    mart = rollup_by(parts, zone, {
        "wz_incident_count": F.sum("_n"),
        "wz_fatalities": F.sum("_dead"),
        "wz_injuries": F.sum("_hurt"),
        "wz_avg_severity": ratio(F.sum("_severity"), F.sum("_rated")),
    })
    return _stamped(mart, stamp)


def intersections(df: DataFrame) -> DataFrame:
    """P32. Derived flags of an intersection; flags are text, as in the other geo tables."""
    yes_no = {True: "True", False: "False"}

    def flag(predicate: Column) -> Column:
        return F.when(predicate, yes_no[True]).otherwise(yes_no[False])

    return df.withColumns({
        "has_crash_history": flag(F.col("crash_count_5yr") > 0),
        "is_signalised": flag(F.col("control_type") == "Traffic Signal"),
        "congestion_level": banded("entering_volume_daily", ">", CONGESTION_CUTS, "Low"),
    })


def analysis_zones(df: DataFrame) -> DataFrame:
    """P33. Radius from area, six-sided outline, transit share of the trips."""
    sized = df.withColumn("radius_deg", F.sqrt("area_sq_miles") * RADIUS_PER_ROOT_MILE)
    return sized.withColumns({
        "geometry_wkt": polygon_wkt(ring_points("centroid_lat", "centroid_lon", "radius_deg", 6)),
        "h3_index_r7": hex_cell("centroid_lat", "centroid_lon", 7),
        "transit_trips_daily": F.floor(F.col("vehicle_trips_daily") * TRANSIT_SHARE).cast("int"),
    })


def work_zones(df: DataFrame, as_of: date = AS_OF) -> DataFrame:
    """P34. Five-sided outline, cell and status at the reference date."""
    radius = F.greatest(F.lit(SMALLEST_RADIUS), F.col("zone_length_miles") * RADIUS_PER_ROOT_MILE / 2)
    return df.withColumn("radius_deg", radius).withColumns({
        "geometry_wkt": polygon_wkt(ring_points("centroid_lat", "centroid_lon", "radius_deg", 5)),
        "h3_index_r8": hex_cell("centroid_lat", "centroid_lon", 8),
        "status": work_zone_status(as_of),
    })


def segment_route(waypoints: DataFrame, route: str = "route_id", seq: str = "seq") -> DataFrame:
    """P35. Consecutive waypoints of a route as segments with running mileposts.

    Routes of any length: the order is sliced on the sequence number.
    """
    slice_by = F.floor(F.col(seq) / ROWS_PER_SLICE)
    paired = next_values(waypoints, [route], seq, slice_by, {"end_lat": "latitude", "end_lon": "longitude"})
    legs = paired.where(F.col("end_lat").isNotNull()).withColumn(
        "_miles", miles_between(F.col("latitude"), F.col("longitude"), F.col("end_lat"), F.col("end_lon"), None)
    )
    legs = settled(legs, "legs")
    placed = running_totals(legs, [route], [F.col(seq)], slice_by, {"_begin": F.col("_miles")}, inclusive=False)
    mid_lat, mid_lon = (F.col("latitude") + F.col("end_lat")) / 2, (F.col("longitude") + F.col("end_lon")) / 2
    return placed.withColumns({
        "begin_milepost": rounded(F.col("_begin"), 2),
        "end_milepost": rounded(F.col("_begin") + F.col("_miles"), 2),
        "length_miles": rounded(F.col("_miles"), 3),
        "midpoint_lat": rounded(mid_lat, 6),
        "midpoint_lon": rounded(mid_lon, 6),
        "geometry_wkt": line_wkt(
            (F.col("longitude"), F.col("latitude")), (mid_lon, mid_lat), (F.col("end_lon"), F.col("end_lat"))
        ),
        "area_type": banded("aadt", ">", SEGMENT_AREA_CUTS, "Rural"),
    }).withColumnsRenamed({"latitude": "start_lat", "longitude": "start_lon"}).drop("_miles", "_begin")


def bridge_flags_from_rating(df: DataFrame) -> DataFrame:
    """P36. Condition codes and text flags derived from the sufficiency rating."""
    rating = F.col("sufficiency_rating")
    code = (
        F.when(F.col("is_deficient") & (rating < 50), "P - Poor").when(rating < 70, "F - Fair").otherwise("G - Good")
    )
    return df.withColumns({
        "deck_condition": code,
        "superstructure_condition": code,
        "substructure_condition": code,
        "structurally_deficient": F.initcap(F.col("is_deficient").cast("string")),
        "functionally_obsolete": F.initcap((rating < 60).cast("string")),
    })
