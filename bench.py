"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from carriageway import build_session  # noqa: E402
from carriageway.registry import QUERIES  # noqa: E402

HEADLINE = [
    "p01_silver_incidents", "p02_silver_bridges", "p03_silver_vehicles", "p04_silver_pavement", "p05_incident_summary",
    "p06_high_risk_corridors", "p07_bridge_health", "p08_fleet_snapshot", "p09_pavement_needs", "p10_executive_scorecard",
    "p11_geo_incidents", "p12_cell_density", "p13_corridor_safety", "p14_hotspots", "p15_bridges_with_zone",
    "p16_work_zone_conflicts", "p35_road_segments", "r03_yoy_trend", "r04_bridge_investment", "r05_pavement_needs_by_class",
    "r10_bridge_risk_by_zone", "r13_sensor_gaps", "g11_point_in_polygon", "q04_vehicle_checks", "q12_profile",
    "w08_sequence_number", "p26_live_incidents", "p30_html_incidents", "t10_tumbling_window", "p18_stream_silver_incidents",
    "l18_roc_auc", "l12_wear_forest", "q13_numeric_drift", "j04_cell_join", "snk01_partitioned_overwrite",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query warms the JVM, as a long-lived session would be.
    QUERIES["a01_group_by"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
