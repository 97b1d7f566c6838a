"""Geospatial operators G1 to G25."""

from __future__ import annotations

from pyspark.sql import functions as F

from carriageway.functions.cells import cell_boundary, explode_ring, hex_cell, with_cells
from carriageway.functions.geometry import (
    area_type, compass_bearing, destination, line_wkt, miles_between, nearest_city_miles, parse_wkt, planar_bearing,
    point_wkt, polygon_wkt, ring_points, start_point,
)
from carriageway.functions.rules import rounded
from carriageway.operators.ordered import spread_scores
from carriageway.operators.spatial import hotspot_class, near_cells
from carriageway.plans import geo, reports
from carriageway.registry.check_sql import CITY_MILES, RING2, bands, big, block, haversine, rnd, using, with_cell
from carriageway.registry.core import add, query
from carriageway.registry.datasets import SEGMENT_SQL, corners_text, rounded_outline, waypoints

C = F.col
add("g01_great_circle_miles", lambda i: i.fx("roads").select("segment_id", miles_between(
        C("start_lat"), C("start_lon"), C("end_lat"), C("end_lon")).alias("miles")),
    using("fx_roads", f"SELECT segment_id, {rnd(haversine('start_lat', 'start_lon', 'end_lat', 'end_lon'), 4)} AS miles FROM fx_roads"))
add("g02_planar_bearing", lambda i: i.incidents.select("incident_id", rounded(planar_bearing("latitude", "longitude"), 6).alias("bearing")),
    using("silver_incidents", f"SELECT incident_id, {rnd('degrees(atan2(longitude - (-80.8431e0), latitude - 35.2271e0))', 6)} AS bearing FROM silver_incidents"))
block("some_nowhere", "silver_incidents",
      "SELECT incident_id, CASE WHEN injuries IS NULL THEN NULL ELSE latitude END AS lat, longitude AS lon FROM silver_incidents")
block("nowhere_cells", "some_nowhere", with_cell("some_nowhere", "lat", "lon", 8, "cell"))
add("g03_hex_cell", lambda i: i.incidents.select(
        "incident_id", hex_cell(F.when(C("injuries").isNotNull(), C("latitude")), "longitude", 8).alias("cell")),
    using("nowhere_cells", "SELECT incident_id, cell FROM nowhere_cells"))
add("g04_cells_at_three_sizes", lambda i: with_cells(i.incidents.select("incident_id", "latitude", "longitude")).drop("latitude", "longitude"),
    using("cells_876", "SELECT incident_id, h3_index_r6, h3_index_r7, h3_index_r8 FROM cells_876"))
add("g05_ring_of_cells", lambda i: explode_ring(i.segments, "h3_index_r8", 2).select("segment_id", "h3_neighbor"),
    using("segments", "SELECT segment_id, concat('8:', cast(split_part(h3_index_r8, ':', 2) AS int) + o.dq, ':', "
          f"cast(split_part(h3_index_r8, ':', 3) AS int) + o.dr) AS h3_neighbor FROM segments, (VALUES {RING2}) AS o(dq, dr)"))
add("g06_cell_density", lambda i: i.cells.select("h3_index_r8", "h3_index_r6", "state_code", "incident_count", "routes_in_cell"),
    using("geo_cells", "SELECT h3_index_r8, h3_index_r6, state_code, incident_count, routes_in_cell FROM geo_cells"))
add("g07_density_per_km2", lambda i: i.cells.select("h3_index_r8", "state_code", "incident_density_per_km2"),
    using("geo_cells", "SELECT h3_index_r8, state_code, incident_density_per_km2 FROM geo_cells"))

ORIGIN_X, ORIGIN_Y = -79.5, 35.5


def boundary_sql() -> str:
    import math

    klon = 111.320 * math.cos(math.radians(35.5))
    q, r = "cast(split_part(h3_index_r8, ':', 2) AS int)", "cast(split_part(h3_index_r8, ':', 3) AS int)"
    x = f"0.53275e0 * ({math.sqrt(3.0)!r}e0 * {q} + {math.sqrt(3.0) / 2.0!r}e0 * {r})"
    y = f"0.53275e0 * 1.5e0 * {r}"
    turn = "radians(60.0e0 * (i % 6) - 30.0e0)"
    corner_x = rnd(f"{ORIGIN_X}e0 + ({x} + 0.53275e0 * cos({turn})) / {klon!r}", 6)
    corner_y = rnd(f"{ORIGIN_Y}e0 + ({y} + 0.53275e0 * sin({turn})) / 110.574e0", 6)
    return f"array_to_string([concat({corner_x}, ' ', {corner_y}) for i in range(7)], ', ')"


add("g08_cell_boundary", lambda i: i.cells.select("h3_index_r8", "state_code", rounded_outline(cell_boundary("h3_index_r8")).alias("outline")),
    using("geo_cells", f"SELECT h3_index_r8, state_code, {boundary_sql()} AS outline FROM geo_cells"))
add("g09_point_wkt", lambda i: i.fx("sensors").select("sensor_id", point_wkt("longitude", "latitude").alias("wkt")),
    using("fx_sensors", "SELECT sensor_id, concat('POINT (', longitude, ' ', latitude, ')') AS wkt FROM fx_sensors"))


def drawn(i):
    return i.fx("roads").withColumn("wkt", line_wkt((C("start_lon"), C("start_lat")), (C("end_lon"), C("end_lat"))))


LINE_SQL = "concat('LINESTRING (', start_lon, ' ', start_lat, ', ', end_lon, ' ', end_lat, ')')"
add("g10_line_wkt", lambda i: drawn(i).select("segment_id", "wkt"), using("fx_roads", f"SELECT segment_id, {LINE_SQL} AS wkt FROM fx_roads"))
add("g10_polygon_wkt", lambda i: i.fx("zones").select("taz_id", rounded_outline(parse_wkt(polygon_wkt(
        ring_points("centroid_lat", "centroid_lon", "radius_deg", 6)))).alias("outline")),
    using("fx_zones", f"SELECT taz_id, array_to_string([{corners_text(6)} for i in range(7)], ', ') AS outline FROM fx_zones"))
add("g12_parse_wkt", lambda i: drawn(i).select("segment_id", F.posexplode(parse_wkt("wkt")).alias("pos", "p")).select("segment_id", "pos", "p.x", "p.y"),
    using("fx_roads", "SELECT segment_id, 0 AS pos, start_lon AS x, start_lat AS y FROM fx_roads UNION ALL "
          "SELECT segment_id, 1, end_lon, end_lat FROM fx_roads"))
add("g14_start_point", lambda i: drawn(i).withColumn("p", start_point("wkt")).select("segment_id", C("p.x").alias("x"), C("p.y").alias("y")),
    using("fx_roads", "SELECT segment_id, start_lon AS x, start_lat AS y FROM fx_roads"))
add("g16_urban_proximity", lambda i: i.fx("sensors").withColumn("miles", nearest_city_miles("latitude", "longitude"))
    .select("sensor_id", "miles", area_type("miles").alias("area_type")),
    using("fx_sensors", "SELECT sensor_id, miles, " + bands("miles", "<=", [(10, "Urban"), (30, "Suburban")], "Rural")
          + f" AS area_type FROM (SELECT sensor_id, least({CITY_MILES}) AS miles FROM fx_sensors)"))


@query("g17_near_join", using("geo_pairs", (
    f"SELECT seg_route_id, count(*) AS pairs, {big('fatalities')} AS fatalities FROM geo_pairs GROUP BY 1")))
def _(i):
    totals = i.located.groupBy(C("h3_index_r8").alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("fatalities").alias("dead"))
    pairs = near_cells(totals, "cell", i.segments.select("segment_id", "route_id", "h3_index_r8"), "h3_index_r8", 2)
    return pairs.groupBy(C("route_id").alias("seg_route_id")).agg(F.sum("n").alias("pairs"), F.sum("dead").alias("fatalities"))


add("g18_zone_assignment", lambda i: i.placed_bridges.select("bridge_id", "h3_index_r7", "taz_id"),
    using("geo_bridges", "SELECT bridge_id, h3_index_r7, taz_id FROM geo_bridges"))


@query("g20_hot_and_cold_spots", using("road_at", (
    "SELECT cell6, area, n, z, CASE WHEN z >= 3.0 THEN 'Hot Spot 99% Confidence' WHEN z >= 2.0 THEN 'Hot Spot 95% Confidence' "
    "WHEN z >= 1.5 THEN 'Hot Spot 90% Confidence' WHEN z <= -1.5 THEN 'Cold Spot (low activity)' ELSE 'Not Significant' END AS hotspot_class "
    "FROM (SELECT cell6, area, n, CASE WHEN sd > 0 THEN " + rnd("(n - mean) / sd", 3) + " ELSE 0e0 END AS z FROM ("
    "SELECT *, avg(n) OVER (PARTITION BY area) AS mean, stddev_samp(n) OVER (PARTITION BY area) AS sd FROM ("
    "SELECT cell6, functional_class AS area, count(*) AS n FROM road_at GROUP BY 1, 2)))")))
def _(i):
    counts = i.fx("roads").groupBy(hex_cell("start_lat", "start_lon", 6).alias("cell6"), C("functional_class").alias("area")).agg(
        F.count(F.lit(1)).alias("n"))
    z = F.when(C("sd") > 0, rounded((C("n") - C("mean")) / C("sd"), 3)).otherwise(F.lit(0.0))
    return spread_scores(counts, ["area"], "n", "mean", "sd").withColumn("z", z).select(
        "cell6", "area", "n", "z", hotspot_class("z").alias("hotspot_class"))


add("g21_cell_rollup", lambda i: reports.coarse_rollup(i.cells).select("h3_county_cell", "state_code", "sub_cells_count", "total_incidents"),
    using("geo_cells", "SELECT h3_index_r6 AS h3_county_cell, state_code, count(DISTINCT h3_index_r8) AS sub_cells_count, "
          f"{big('incident_count')} AS total_incidents FROM geo_cells GROUP BY 1, 2"))
add("g23_compass_bearing", lambda i: i.fx("roads").select("segment_id", rounded(compass_bearing(
        C("start_lat"), C("start_lon"), C("end_lat"), C("end_lon")), 6).alias("course")),
    using("fx_roads", "SELECT segment_id, " + rnd(
        "CASE WHEN a < 0 THEN a + 360 ELSE a END", 6) + " AS course FROM (SELECT segment_id, degrees(atan2("
        "sin(radians(end_lon - start_lon)) * cos(radians(end_lat)), cos(radians(start_lat)) * sin(radians(end_lat)) - "
        "sin(radians(start_lat)) * cos(radians(end_lat)) * cos(radians(end_lon - start_lon)))) AS a FROM fx_roads)"))


@query("g24_destination", using("fx_sensors", (
    f"SELECT sensor_id, {rnd('degrees(phi2)', 6)} AS lat, {rnd('degrees(radians(longitude) + atan2(sin(b) * sin(d) * cos(phi), cos(d) - sin(phi) * sin(phi2)))', 6)} AS lon FROM ("
    "SELECT *, asin(sin(phi) * cos(d) + cos(phi) * sin(d) * cos(b)) AS phi2 FROM ("
    "SELECT sensor_id, longitude, radians(latitude) AS phi, radians(uptime_pct * 360) AS b, 12.5e0 / 3958.8e0 AS d FROM fx_sensors))")))
def _(i):
    end = destination(C("latitude"), C("longitude"), C("uptime_pct") * 360, F.lit(12.5))
    return i.fx("sensors").withColumn("end", end).select(
        "sensor_id", rounded("end.lat", 6).alias("lat"), rounded("end.lon", 6).alias("lon"))


add("g25_route_segmentation", lambda i: geo.segment_route(waypoints(i)).select(
        "route_id", "seq", "begin_milepost", "end_milepost", "length_miles", "midpoint_lat", "midpoint_lon", "area_type"), SEGMENT_SQL)
