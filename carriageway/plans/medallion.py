"""Batch jobs: bronze files to silver, gold and geo tables of one database.

Plain functions in order, no scheduler: ``bronze_tables`` lands raw frames with
their declared columns, ``silver_tables`` checks, derives and writes them,
``gold_tables`` and ``geo_tables`` read what silver wrote. Every table is
partitioned and registered; a rerun replaces it. Whole rows are shuffled only
where they must move: bronze tables have a few dozen partitions and are written
as scanned, so each of their files holds one partition; silver tables of the
same partitions, and those cut from gathered ones, need not be gathered again.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carriageway.functions.times import AS_OF
from carriageway.operators import quality
from carriageway.operators.keys import one_row_per_stored_key
from carriageway.plans import geo, gold, silver
from carriageway.sources import schemas, sinks

# Partition columns of the published tables.
SILVER_PARTS = {
    "traffic_incidents": ["state_code", "incident_year", "incident_month"],
    "bridge_inspections": ["state_code"],
    "vehicle_registrations": ["state_code", "vehicle_class"],
    "pavement_conditions": ["state_code", "functional_class"],
}
#: Written smaller than by the default codec; the tables are read several times.
CODEC = "zstd"
GOLD_PARTS = {
    "incident_summary": ["state_code", "incident_year"],
    "high_risk_corridors": ["state_code"],
    "bridge_health": ["state_code"],
    "fleet_snapshot": ["state_code", "vehicle_class"],
    "pavement_needs": ["state_code", "functional_class"],
    "executive_scorecard": [],
}
GEO_PARTS = {"incidents_enriched": ["state_code", "incident_year"], "cell_density": ["state_code"], "hotspots": ["state_code"]}


def bronze_tables(spark: SparkSession, db: str, raw: Mapping[str, DataFrame]) -> None:
    """Land raw frames: declared columns in declared types, those a source lacks as NULL, partitioned."""
    sinks.ensure_database(spark, db)
    for name, df in raw.items():
        columns = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.declared(name).fields if f.name != "ingestion_timestamp"
        ]
        landed = df.select(*columns, F.current_timestamp().alias("ingestion_timestamp"))
        sinks.save_table(landed, f"{db}.bronze_{name}", schemas.PARTITIONS[name], gather=False, codec=CODEC)


def silver_tables(spark: SparkSession, db: str, as_of: date = AS_OF) -> None:
    """Check log and silver tables from the bronze tables."""
    read = {name: spark.table(f"{db}.bronze_{name}") for name in SILVER_PARTS}
    suites = {
        "traffic_incidents": quality.incident_checks(as_of), "bridge_inspections": quality.BRIDGE_CHECKS,
        "vehicle_registrations": quality.VEHICLE_CHECKS, "pavement_conditions": quality.PAVEMENT_CHECKS,
    }
    made = {
        "traffic_incidents": silver.enriched_incidents,
        "bridge_inspections": lambda single: silver.enriched_bridges(single, as_of),
        "vehicle_registrations": lambda single: silver.enriched_vehicles(single, as_of),
        "pavement_conditions": silver.enriched_pavement,
    }
    log = None
    for name, checks in suites.items():
        rows = quality.run_checks(read[name], name, checks)
        log = rows if log is None else log.unionByName(rows)
    sinks.save_table(log, f"{db}.check_log")
    for name, enriched in made.items():
        rows = silver.timed_incidents(read[name]) if name == "traffic_incidents" else read[name]
        single, dealt = one_row_per_stored_key(rows, [schemas.declared(name).fieldNames()[0]])
        as_landed = set(SILVER_PARTS[name]) == set(schemas.PARTITIONS[name])
        if dealt and as_landed:  # gathered before columns are added: fewer bytes move
            single = single.hint("rebalance", *SILVER_PARTS[name])
        sinks.save_table(enriched(single), f"{db}.silver_{name}", SILVER_PARTS[name], gather=not as_landed, codec=CODEC)


def gold_tables(spark: SparkSession, db: str) -> None:
    """Marts from the written silver tables."""
    incidents, bridges, vehicles, pavement = (spark.table(f"{db}.silver_{name}") for name in SILVER_PARTS)
    made = {
        "incident_summary": gold.incident_summary(incidents),
        "high_risk_corridors": gold.high_risk_corridors(incidents),
        "bridge_health": gold.bridge_health(bridges),
        "fleet_snapshot": gold.fleet_snapshot(vehicles),
        "pavement_needs": gold.pavement_needs(pavement),
        "executive_scorecard": gold.executive_scorecard(incidents, bridges, pavement, vehicles),
    }
    for name, df in made.items():
        sinks.save_table(df, f"{db}.gold_{name}", GOLD_PARTS[name])


def geo_tables(spark: SparkSession, db: str) -> None:
    """Cell marts; each is read back for the next."""
    sinks.save_table(geo.enriched_incidents(spark.table(f"{db}.silver_traffic_incidents")), f"{db}.geo_incidents_enriched", GEO_PARTS["incidents_enriched"],
                     gather=not set(GEO_PARTS["incidents_enriched"]) <= set(SILVER_PARTS["traffic_incidents"]), codec=CODEC)
    sinks.save_table(geo.cell_density(spark.table(f"{db}.geo_incidents_enriched")), f"{db}.geo_cell_density", GEO_PARTS["cell_density"])
    sinks.save_table(geo.hotspots(spark.table(f"{db}.geo_cell_density"), settle=False), f"{db}.geo_hotspots", GEO_PARTS["hotspots"])
