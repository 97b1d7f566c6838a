"""Map layers: the rows and columns that a map draws, whole; a viewer sets its own limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns of the published layers; the geometry, where there is one, comes last.
SPOT_COLUMNS = ["h3_index_r8", "incident_count", "total_fatalities", "avg_severity_score", "hotspot_class", "risk_tier"]
SPOT_SCORES = [*SPOT_COLUMNS[:5], "z_score"]
MARKER_COLUMNS = ["incident_id", "latitude", "longitude", "incident_type", "severity", "fatalities", "injuries", "incident_datetime"]
DENSITY_COLUMNS = ["h3_index_r8", "incident_count", "total_fatalities", "avg_severity_score", "risk_tier"]
ROAD_COLUMNS = ["segment_id", "route_name", "functional_class", "lanes", "aadt", "pavement_condition", "area_type", "geometry_wkt"]
SENSOR_COLUMNS = ["sensor_id", "sensor_type", "latitude", "longitude", "operational_status", "uptime_pct"]
ZONE_COLUMNS = ["taz_id", "city", "zone_type", "population", "employment", "vehicle_trips_daily", "geometry_wkt"]
WORK_ZONE_COLUMNS = ["work_zone_id", "project_name", "zone_type", "status", "lanes_closed", "zone_length_miles", "project_cost_usd", "geometry_wkt"]


def layer(df: DataFrame, columns: Sequence[str], shown: Column | None = None) -> DataFrame:
    """The shown rows with those of the layer's columns that the table has: a map draws what is there."""
    rows = df if shown is None else df.where(shown)
    return rows.select(*[c for c in columns if c in df.columns])


def hot_cells(hotspots: DataFrame, columns: Sequence[str] = SPOT_COLUMNS) -> DataFrame:
    return layer(hotspots, columns, F.col("is_hotspot"))


def fatal_markers(enriched: DataFrame) -> DataFrame:
    return layer(enriched, MARKER_COLUMNS, F.col("has_fatality"))


def active_work_zones(work_zones: DataFrame) -> DataFrame:
    return layer(work_zones, WORK_ZONE_COLUMNS, F.col("status") == "Active")
