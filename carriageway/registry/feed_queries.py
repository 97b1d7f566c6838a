"""Live feeds P26 to P31 over payloads built from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from carriageway.plans import feeds
from carriageway.registry.check_sql import big, block, using
from carriageway.registry.core import add, query
from carriageway.registry.relational_queries import ROAD_NAME, road_list
from carriageway.session import shared_dir
from carriageway.sources import sinks

C = F.col
ASKED = "split_part('US-74,I-95,NC-12,I-77,I-85,I-40', ',', cast(1 + event_id % 6 AS int))"
LAT, LON = "35.0 + cast((event_id * 7919) % 1000 AS double) / 1000", "-81.0 + cast((event_id * 104729) % 2000 AS double) / 1000"


def item(key: str, reason: str) -> str:
    """One incident object; the severity is missing from every third answer."""
    return (
        f"concat('{{\"id\":', {key}, ',\"road\":\"', {ASKED}, '\",\"reason\":\"{reason}\",\"incidentType\":\"', event_type, '\"', "
        f"CASE WHEN event_id % 3 = 0 THEN '' ELSE concat(',\"severity\":', user_id % 5) END, "
        f"',\"latitude\":', {LAT}, ',\"longitude\":', {LON}, ',\"start\":\"2024-01-01T00:00:00\",\"condition\":\"lane ', user_id % 4, "
        f"'\",\"direction\":\"N\",\"countyName\":\"County ', event_id % 30, '\"}}')"
    )


# An answer holds the event itself and a repeat of the one before it, so most ids come twice.
POLL = f"concat('[', {item('event_id', 'own')}, ',', {item('event_id - 1', 'repeat')}, ']')"


def polls(i):
    return i.table("events").selectExpr("event_id AS poll_id", f"{ASKED} AS road", f"{POLL} AS payload")


def poll_items(key: str, reason: str) -> str:
    return (
        f"SELECT event_id AS poll_id, {ASKED} AS road, {key} AS id, '{reason}' AS reason, event_type, "
        f"cast(CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id % 5 END AS int) AS severity, {LAT} AS lat, {LON} AS lon, "
        "concat('lane ', user_id % 4) AS lanes, concat('County ', event_id % 30) AS county FROM events"
    )


block("poll_items", "", poll_items("event_id", "own") + " UNION ALL " + poll_items("event_id - 1", "repeat"))
LIVE_SQL = using("poll_items", (
    "SELECT id AS incident_id, road AS road_name, reason AS description, event_type AS incident_type, severity, lat AS latitude, "
    "lon AS longitude, '2024-01-01T00:00:00' AS start_time, lanes AS lanes_affected, 'N' AS direction, county, true AS is_active FROM ("
    "SELECT *, row_number() OVER (PARTITION BY id ORDER BY list_position(['I-40', 'I-85', 'I-77', 'I-95', 'US-74'], road), poll_id) AS spot "
    "FROM poll_items WHERE road <> 'NC-12') WHERE spot = 1"))
add("p26_live_incidents", lambda i: feeds.live_incidents(polls(i)), LIVE_SQL)

CAMERA = (
    "concat('{\"id\":', c_custkey, ',\"roadId\":', c_custkey % 7, ',\"status\":\"', CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'DOWN' ELSE 'OK' END, "
    "'\",\"imageURL\":\"', CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat('http://cam/', c_custkey, '.jpg') END, "
    "'\",\"locationName\":\"', c_name, '\",\"mileMarker\":', cast(c_custkey % 300 AS double) / 10, ',\"latitude\":35.5,\"longitude\":-80.5', "
    "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE ',\"isDOTCamera\":true' END, '}')"
)


def registry(i):
    answers = i.table("customer").selectExpr(
        f"{CAMERA} AS payload", "cast(CASE WHEN c_custkey % 5 = 0 THEN 404 ELSE 200 END AS int) AS http_status",
        "cast((c_custkey * 37) % 3000 AS int) AS fetched_bytes")
    return feeds.camera_registry(answers, road_list(i))


OK = "c_custkey % 11 <> 0 AND c_custkey % 5 <> 0 AND (c_custkey * 37) % 3000 > 500"
block("registry", "", (
    f"SELECT c_custkey AS camera_id, c_name AS location_name, {ROAD_NAME} AS road, cast(c_custkey % 300 AS double) / 10 AS mile_marker, "
    "35.5e0 AS latitude, -80.5e0 AS longitude, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat('http://cam/', c_custkey, '.jpg') END AS image_url, "
    f"cast(CASE WHEN {OK} THEN (c_custkey * 37) % 3000 ELSE 0 END AS int) AS image_bytes, c_custkey % 4 <> 0 AS is_dot_camera, {OK} AS image_ok "
    "FROM customer JOIN region ON c_custkey % 7 = r_regionkey WHERE c_mktsegment <> 'HOUSEHOLD'"
))
add("p27_camera_registry", registry, using("registry", "SELECT * FROM registry"))
add("p27_new_cameras", lambda i: feeds.new_cameras(registry(i), i.table("supplier").select(C("s_suppkey").alias("camera_id"))).select(
        "camera_id", "road", "image_bytes"),
    using("registry", "SELECT camera_id, road, image_bytes FROM registry WHERE image_ok AND camera_id NOT IN (SELECT s_suppkey FROM supplier)"))


@query("p28_camera_poll_log", "SELECT page_id AS camera_id, url AS image_url, cast(octet_length(encode(html)) AS bigint) AS image_bytes, true AS fetch_success FROM pages")
def _(i):
    picture = C("html").cast("binary")
    answers = i.table("pages").select(
        C("page_id").alias("camera_id"), C("url").alias("image_url"), F.base64(picture).alias("image_base64"),
        F.octet_length(picture).cast("long").alias("image_bytes"), F.lit(True).alias("fetch_success"))
    path = shared_dir(i.spark, "poll-log")
    sinks.overwrite(feeds.poll_log(answers), path)
    return i.spark.read.parquet(path)


# Second-state feed: HTML fragments around values of the test tables.
CAM_LAT, CAM_LON = "cast(41000 + page_id % 5000 AS double) / 1000", "cast(-84000 + page_id % 3000 AS double) / 1000"
HTML_CAMERA = {
    "county": f"concat('Wayne ', page_id % 83, ' <a href=\"map?', CASE WHEN page_id % 7 = 0 THEN 'none' ELSE concat('lat=', {CAM_LAT}, '&lon=', {CAM_LON}) END, "
              "'&zoom=9&id=', page_id, '\">Map</a>')",
    "image": "CASE WHEN page_id % 9 = 0 THEN '<img alt=\"x\">' ELSE concat('<img src=\"', url, '\" alt=\"x\">') END",
    "location": "CASE WHEN page_id % 5 = 0 THEN NULL ELSE concat(' Exit ', page_id % 100, ' ') END",
    "route": "concat('I-', page_id % 100)",
    "direction": "CASE WHEN page_id % 2 = 0 THEN 'Eastbound' END",
}
add("p29_html_cameras", lambda i: feeds.html_cameras(i.table("pages").selectExpr(*[f"{e} AS {n}" for n, e in HTML_CAMERA.items()])), (
    "SELECT CASE WHEN page_id % 5 = 0 THEN '' ELSE concat('Exit ', page_id % 100) END AS label, concat('I-', page_id % 100) AS route, "
    f"{CAM_LAT} AS lat, {CAM_LON} AS lon, url AS image_url, concat('Wayne ', page_id % 83) AS county, "
    "CASE WHEN page_id % 2 = 0 THEN 'Eastbound' ELSE '' END AS direction, cast(page_id AS varchar) AS id "
    "FROM pages WHERE page_id % 7 <> 0 AND page_id % 9 <> 0"))
HTML_INCIDENT = {
    "incidentText": (
        "concat('<strong>Location: </strong> Mile ', doc_id, '<br>', "
        "CASE WHEN doc_id % 6 = 0 THEN '' ELSE concat('<strong>Event Type: </strong> ', source, ' <br>') END, "
        "CASE WHEN doc_id % 4 = 0 THEN '<strong>Lanes Blocked: </strong> All Lanes<br>' WHEN doc_id % 4 = 1 THEN '<strong>Lanes Blocked: </strong> Left<br>' ELSE '' END, "
        "'<strong>County: </strong> ', lang, '<br><strong>Event Message:</strong> ', n_chars, ' feet<br>')"
    ),
    "iconURL": "concat('icons/', split_part('red,yellow,orange,green', ',', cast(1 + doc_id % 4 AS int)), '.png')",
    "incidentTitle": "concat(split_part('I-94 at,M-10 near,US-23 by,Main St', ',', cast(1 + doc_id % 4 AS int)), ' ', doc_id)",
    "latitude": "42.3e0", "longitude": "-83.1e0",
}


def html_incidents(i):
    return feeds.html_incidents(i.table("documents").selectExpr(
        *[f"{e.replace('e0', '') if n in ('latitude', 'longitude') else e} AS {n}" for n, e in HTML_INCIDENT.items()])
        .withColumns({"latitude": C("latitude").cast("double"), "longitude": C("longitude").cast("double")}))


INCIDENT_SQL = (
    "SELECT split_part('I-94,M-10,US-23,', ',', cast(1 + doc_id % 4 AS int)) AS road, CASE WHEN doc_id % 6 = 0 THEN 'Incident' ELSE source END AS type, "
    "CASE doc_id % 4 WHEN 0 THEN 'All Lanes' WHEN 1 THEN 'Left' ELSE 'Unknown' END AS condition, concat('Mile ', doc_id) AS location, "
    "concat(n_chars, ' feet') AS reason, lang AS county, cast(CASE doc_id % 4 WHEN 0 THEN 4 WHEN 3 THEN 1 ELSE 2 END AS int) AS severity, "
    "42.3e0 AS lat, -83.1e0 AS lon FROM documents"
)
add("p30_html_incidents", html_incidents, INCIDENT_SQL)
WORK_LAT = "cast(42000 + s_suppkey AS double) / 1000"
HTML_WORK = {
    "description": f"CASE WHEN s_suppkey % 8 = 0 THEN 'No map' ELSE concat(s_name, ' closure <a href=\"map?lat=', {WORK_LAT}, '&lon=-83.5\">Map</a>') END",
    "route": "concat(split_part('EB ,WB ,', ',', cast(1 + s_suppkey % 3 AS int)), 'I-', s_suppkey)",
    "type": "split_part('lane-closure,road-work,', ',', cast(1 + s_suppkey % 3 AS int))",
    "county": "CASE WHEN s_suppkey % 2 = 0 THEN ' Kent ' END",
}


def html_construction(i):
    return feeds.html_construction(i.table("supplier").selectExpr(*[f"{e} AS {n}" for n, e in HTML_WORK.items()]))


WORK_SQL = (
    "SELECT concat('I-', s_suppkey) AS road, 'Construction' AS type, split_part('Lane Closure,Road Work,Work Zone', ',', cast(1 + s_suppkey % 3 AS int)) AS condition, "
    f"concat(s_name, ' closure') AS location, '' AS reason, CASE WHEN s_suppkey % 2 = 0 THEN 'Kent' ELSE '' END AS county, 2 AS severity, {WORK_LAT} AS lat, -83.5e0 AS lon "
    "FROM supplier WHERE s_suppkey % 8 <> 0"
)
add("p31_html_construction", html_construction, WORK_SQL)
add("p31_road_events", lambda i: feeds.road_events(html_incidents(i), html_construction(i)), f"{INCIDENT_SQL} UNION ALL {WORK_SQL}")
add("d03_first_road_wins", lambda i: feeds.live_incidents(polls(i)).groupBy("road_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("severity").alias("severity")),
    "SELECT road_name, count(*) AS n, " + big("severity") + f" AS severity FROM ({LIVE_SQL}) GROUP BY 1")
