"""Live traffic feeds: payload parsing, camera registry, second-state HTML fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.functions.rules import as_col, truthy
from carriageway.functions.text import captured, has_text, numeric, stripped, text_or, title_words
from carriageway.operators.keys import top_rows_per_key, unseen
from carriageway.sources.tables import flatten

# Roads followed, payload fields, HTML patterns, severity words.
TARGET_ROADS = ["I-40", "I-85", "I-77", "I-95", "US-74"]
INCIDENT_ITEM = (
    "id bigint, road string, reason string, incidentType string, severity int, latitude double, longitude double, "
    "start string, condition string, direction string, countyName string, location string"
)
INCIDENT_FIELDS = {
    "incident_id": "id", "road_name": "road", "description": "reason", "incident_type": "incidentType",
    "severity": "severity", "latitude": "latitude", "longitude": "longitude", "start_time": "start",
    "lanes_affected": "condition", "direction": "direction", "county": "countyName",
}
CAMERA_ITEM = (
    "id bigint, roadId int, status string, imageURL string, locationName string, mileMarker double, "
    "latitude double, longitude double, isDOTCamera boolean"
)
POINT_AND_ID = r"lat=([\d.-]+)&lon=([\d.-]+).*?id=(\d+)"
POINT_ONLY = r"lat=([\d.-]+)&lon=([\d.-]+)"
IMAGE_SOURCE = r'src="([^"]+)"'
AFTER_TAG = r"\s*<.*"
AFTER_ANCHOR = r"\s*<a\b.*"
DIRECTION_PREFIX = r"^(EB|WB|NB|SB)\s+"
LABELLED = {
    "location": r"Location:\s*</strong>([^<]+)",
    "event_type": r"Event Type:\s*</strong>\s*([^<]+)",
    "lanes": r"Lanes Blocked:\s*</strong>\s*([^<]+)",
    "county": r"County:\s*</strong>\s*([^<]+)",
    "message": r"Event Message:</strong>\s*([^<]+)",
}
ROAD_CODE = r"(I-\d+|M-\d+|US-\d+)"
USABLE_IMAGE_BYTES = 500


def live_incidents(
    polls: DataFrame, payload: str = "payload", road: str = "road", poll_key: str = "poll_id",
    roads: Sequence[str] = TARGET_ROADS,
) -> DataFrame:
    """P26. One row per incident over the followed roads; the road listed first wins.

    ``polls`` holds one response per row: the road asked for and a JSON array.
    """
    place = F.array_position(F.array(*[F.lit(r) for r in roads]), F.col(road))
    asked = polls.where(F.col(road).isin(*roads)).withColumn("_feed", place)
    items = flatten(asked, payload, f"array<struct<{_typed(INCIDENT_ITEM)}>>", INCIDENT_FIELDS, keep=["_feed", poll_key])
    first = top_rows_per_key(items, ["incident_id"], [F.col("_feed"), F.col(poll_key)])
    return first.drop("_feed", poll_key).withColumn("is_active", F.lit(True))


def _typed(fields: str) -> str:
    """``name type, …`` as the body of a struct type."""
    return ", ".join(f"{name}: {kind}" for name, kind in (f.split(" ") for f in fields.split(", ")))


def usable_image(
    url: Column | str = "image_url", status: Column | str = "http_status", size: Column | str = "image_bytes"
) -> Column:
    """A picture counts when the fetch answered 200 with more than 500 bytes."""
    return truthy(has_text(url) & (as_col(status) == 200) & (as_col(size) > USABLE_IMAGE_BYTES))


def camera_registry(polls: DataFrame, roads: DataFrame, payload: str = "payload") -> DataFrame:
    """P27. Cameras on followed roads whose status is OK, with the image test.

    ``roads`` maps ``road_id`` to ``road``; the fetch outcome columns
    ``http_status`` and ``fetched_bytes`` come with the poll.
    """
    items = polls.select(
        F.from_json(F.col(payload), CAMERA_ITEM).alias("cam"), "http_status", "fetched_bytes"
    ).where(F.col("cam.status") == "OK")
    named = items.join(roads, F.col("cam.roadId") == F.col("road_id"), "inner").where(
        F.col("road").isin(*TARGET_ROADS)
    )
    shaped = named.select(
        F.col("cam.id").alias("camera_id"),
        F.coalesce("cam.locationName", F.lit("")).alias("location_name"),
        "road",
        F.col("cam.mileMarker").alias("mile_marker"),
        F.col("cam.latitude").alias("latitude"),
        F.col("cam.longitude").alias("longitude"),
        F.coalesce("cam.imageURL", F.lit("")).alias("image_url"),
        "http_status",
        F.col("fetched_bytes").alias("image_bytes"),
        F.coalesce("cam.isDOTCamera", F.lit(False)).alias("is_dot_camera"),
    )
    ok = usable_image()
    return shaped.withColumns({
        "image_ok": ok,
        "image_bytes": F.when(ok, F.col("image_bytes")).otherwise(F.lit(0)),
    }).drop("http_status")


def new_cameras(registry: DataFrame, known: DataFrame) -> DataFrame:
    """Usable cameras not listed yet."""
    return unseen(registry, known, "camera_id", F.col("image_ok"))


def poll_log(polls: DataFrame) -> DataFrame:
    """P28. The log keeps sizes and outcomes; picture bytes are dropped before writing."""
    return polls.drop("image_base64")


def html_cameras(raw: DataFrame) -> DataFrame:
    """P29. Cameras hidden in HTML fragments; no point or no picture, no row."""
    return (
        raw.where(F.regexp_like("county", F.lit(POINT_AND_ID)) & F.regexp_like("image", F.lit(IMAGE_SOURCE)))
        .select(
            text_or("location", "").alias("label"),
            text_or("route", "").alias("route"),
            numeric(F.regexp_extract("county", POINT_AND_ID, 1)).alias("lat"),
            numeric(F.regexp_extract("county", POINT_AND_ID, 2)).alias("lon"),
            F.regexp_extract("image", IMAGE_SOURCE, 1).alias("image_url"),
            stripped("county", AFTER_TAG).alias("county"),
            text_or("direction", "").alias("direction"),
            F.regexp_extract("county", POINT_AND_ID, 3).alias("id"),
        )
    )


def icon_severity(lanes: Column, icon: Column) -> Column:
    """4 all lanes, 3 red, 2 yellow or orange, else 1."""
    return (
        F.when(truthy(F.contains(lanes, F.lit("All Lanes"))), 4)
        .when(truthy(F.contains(icon, F.lit("red"))), 3)
        .when(truthy(F.contains(icon, F.lit("yellow")) | F.contains(icon, F.lit("orange"))), 2)
        .otherwise(1)
    )


def html_incidents(raw: DataFrame) -> DataFrame:
    """P30. Labelled fields of an incident text."""

    def field(name: str) -> Column:
        return F.trim(captured("incidentText", LABELLED[name]))

    parsed = raw.withColumns({f"_{name}": field(name) for name in LABELLED})
    lanes = F.coalesce("_lanes", F.lit(""))
    return parsed.select(
        F.coalesce(captured("incidentTitle", ROAD_CODE), F.lit("")).alias("road"),
        F.coalesce("_event_type", F.lit("Incident")).alias("type"),
        F.coalesce(F.nullif(lanes, F.lit("")), F.lit("Unknown")).alias("condition"),
        F.coalesce("_location", "incidentTitle").alias("location"),
        F.coalesce("_message", F.lit("")).alias("reason"),
        F.coalesce("_county", F.lit("")).alias("county"),
        icon_severity(lanes, F.col("iconURL")).alias("severity"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
    )


def html_construction(raw: DataFrame) -> DataFrame:
    """P31. Construction rows in the shape of the incidents, always moderate."""
    return raw.where(F.regexp_like("description", F.lit(POINT_ONLY))).select(
        stripped(F.coalesce("route", F.lit("")), DIRECTION_PREFIX).alias("road"),
        F.lit("Construction").alias("type"),
        title_words(F.coalesce(F.nullif("type", F.lit("")), F.lit("work zone"))).alias("condition"),
        stripped("description", AFTER_ANCHOR).alias("location"),
        F.lit("").alias("reason"),
        text_or("county", "").alias("county"),
        F.lit(2).alias("severity"),
        numeric(F.regexp_extract("description", POINT_ONLY, 1)).alias("lat"),
        numeric(F.regexp_extract("description", POINT_ONLY, 2)).alias("lon"),
    )


def road_events(incidents: DataFrame, construction: DataFrame) -> DataFrame:
    return incidents.unionByName(construction)
