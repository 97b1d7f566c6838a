"""The batch jobs: each query runs the layers up to its own and reads the written tables back."""

from __future__ import annotations

from pyspark.sql import functions as F

from carriageway.plans import medallion
from carriageway.registry.check_sql import cols, using
from carriageway.registry.core import Inputs, query, steady
from carriageway.registry.datasets import CORRIDOR_COLS
from carriageway.registry.table_queries import own_database

RAW = {"traffic_incidents": "incidents", "bridge_inspections": "bridges", "vehicle_registrations": "vehicles", "pavement_conditions": "pavement"}


def run_layers(i: Inputs, layers: int) -> str:
    """Name of a new database that holds the first ``layers`` of bronze, silver, gold and geo."""
    db = own_database(i)
    medallion.bronze_tables(i.spark, db, {name: i.fx(view) for name, view in RAW.items()})
    for step in (medallion.silver_tables, medallion.gold_tables, medallion.geo_tables)[:layers - 1]:
        step(i.spark, db)
    return db


@query("job01_silver_tables", using("silver_incidents silver_bridges silver_vehicles silver_pavement", (
    "SELECT 'traffic_incidents' AS name, state_code, count(*) AS n FROM silver_incidents GROUP BY 2 UNION ALL "
    "SELECT 'bridge_inspections', state_code, count(*) FROM silver_bridges GROUP BY 2 UNION ALL "
    "SELECT 'vehicle_registrations', state_code, count(*) FROM silver_vehicles GROUP BY 2 UNION ALL "
    "SELECT 'pavement_conditions', state_code, count(*) FROM silver_pavement GROUP BY 2 UNION ALL SELECT 'check_log', NULL, 16")))
def _(i):
    db = run_layers(i, 2)
    parts = [i.spark.table(f"{db}.silver_{name}").groupBy("state_code").agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(name).alias("name"), "state_code", "n") for name in RAW]
    log = i.spark.table(f"{db}.check_log").agg(F.lit("check_log").alias("name"), F.lit(None).cast("string").alias("state_code"), F.count(F.lit(1)).alias("n"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(log)


@query("job02_gold_tables", using("gold_corridors", f"SELECT {cols(CORRIDOR_COLS)} FROM gold_corridors"))
def _(i):
    db = run_layers(i, 3)
    return steady(i.spark.table(f"{db}.gold_high_risk_corridors").drop("gold_timestamp")).select(
        *[c.lstrip("*") for c in CORRIDOR_COLS.split()])


@query("job03_geo_tables", using("geo_spots", (
    "SELECT " + cols("h3_index_r8 state_code incident_count total_fatalities *z_score hotspot_class risk_tier") + " FROM geo_spots")))
def _(i):
    db = run_layers(i, 2)
    medallion.geo_tables(i.spark, db)
    return steady(i.spark.table(f"{db}.geo_hotspots").select(
        "h3_index_r8", "state_code", "incident_count", "total_fatalities", "z_score", "hotspot_class", "risk_tier"))
