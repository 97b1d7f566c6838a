"""Streaming operators T1 to T14 and datasets P17 to P20.

Each runs its stream over all files there are, writes to the shared folder and
returns what was written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carriageway.functions.times import wall_clock
from carriageway.registry.check_sql import bands, big, block, cnt, cols, rnd, using
from carriageway.registry.core import Inputs, add, query, steady
from carriageway.registry.table_queries import event_stream
from carriageway.session import shared_dir
from carriageway.sources.domain import VIEWS
from carriageway.sources.sinks import export_json
from carriageway.streaming import evolving, jobs

C = F.col


def stream(i: Inputs, view: str) -> DataFrame:
    """A domain view over a streamed base table."""
    base, columns = VIEWS[f"fx_{view}"]
    raw = jobs.file_stream(i.spark, i.stream_path(base), i.table(base).schema)
    return raw.selectExpr(*[f"{expr} AS {col}" for col, expr in columns.items()])


MUST = "incident_id IS NOT NULL AND incident_datetime IS NOT NULL AND longitude BETWEEN -180 AND 180"
STREAM_SILVER = (
    "SELECT incident_id, upper(trim(incident_type)) AS incident_type, severity, incident_datetime, upper(state_code) AS state_code, "
    "route_id, fatalities, injuries, vehicles_involved, cast(year(incident_datetime) AS int) AS incident_year, "
    "cast(month(incident_datetime) AS int) AS incident_month, cast(hour(incident_datetime) AS int) AS incident_hour, "
    "dayofweek(incident_datetime) IN (0, 6) AS is_weekend, fatalities > 0 AS has_fatality, "
    f"fatalities + injuries AS total_casualties FROM fx_incidents WHERE {MUST}"
)
SILVER_KEEP = [
    "incident_id", "incident_type", "severity", "incident_datetime", "state_code", "route_id", "fatalities", "injuries",
    "vehicles_involved", "incident_year", "incident_month", "incident_hour", "is_weekend", "has_fatality", "total_casualties",
]
block("stream_silver", "fx_incidents", STREAM_SILVER)

add("t01_bronze_ingest", lambda i: jobs.drain(jobs.bronze(event_stream(i)), "bronze").select(
        "event_id", "event_type", C("_ingest_time").isNotNull().alias("is_stamped")),
    "SELECT event_id, event_type, true AS is_stamped FROM events")


@query("t02_expectation_warn", using("fx_incidents", (
    "SELECT count(*) FILTER (WHERE NOT coalesce(severity IN ('Fatal', 'Serious Injury', 'Minor Injury', 'Property Damage Only', 'Unknown'), false)) AS valid_severity, "
    "count(*) FILTER (WHERE NOT coalesce(latitude BETWEEN -90 AND 90, false)) AS valid_lat, "
    "count(*) FILTER (WHERE incident_id IS NULL) AS has_id FROM fx_incidents")))
def _(i):
    rules = {**jobs.INCIDENT_SHOULD, "has_id": "incident_id IS NOT NULL"}
    return jobs.drain_with_totals(stream(i, "incidents"), rules, lambda batch: batch, "warn")[1]


add("t03_expectation_drop", lambda i: jobs.drain(
        jobs.keep_expected(stream(i, "incidents"), {**jobs.INCIDENT_MUST, "known_injuries": "injuries >= 0"}), "drop").select("incident_id", "injuries"),
    using("fx_incidents", f"SELECT incident_id, injuries FROM fx_incidents WHERE {MUST} AND injuries >= 0"))
add("t04_row_enrichment", lambda i: jobs.drain(jobs.enriched_incidents(stream(i, "incidents")), "enrich").select(
        "incident_id", "incident_type", "incident_year", "is_weekend", "has_fatality", "milepost"),
    using("fx_incidents", "SELECT incident_id, upper(trim(incident_type)) AS incident_type, cast(year(incident_datetime) AS int) AS incident_year, "
          "dayofweek(incident_datetime) IN (0, 6) AS is_weekend, fatalities > 0 AS has_fatality, milepost FROM fx_incidents"))
add("t05_stream_dedupe", lambda i: jobs.drain_silver(
        stream(i, "pavement"), "segment_id", {"has_id": "segment_id IS NOT NULL"}, {}, lambda df: df, "dedupe")[0].select("segment_id", "iri"),
    using("fx_pavement", "SELECT DISTINCT segment_id, iri FROM fx_pavement"))
add("t05_stream_dedupe_bounded", lambda i: jobs.drain(jobs.deduplicated(
        jobs.bronze(event_stream(i)).withColumn("half", F.floor(C("event_id") / 2)), "half"), "dedupe-bounded").select("half"),
    "SELECT DISTINCT cast(floor(event_id / 2) AS bigint) AS half FROM events")
GOLD_SQL = using("stream_silver", (
    f"SELECT state_code, incident_year, incident_month, incident_type, count(incident_id) AS total_incidents, "
    f"{big('fatalities')} AS total_fatalities, {big('injuries')} AS total_injuries, {cnt('has_fatality')} AS fatal_count, "
    f"{rnd('avg(vehicles_involved)', 6)} AS avg_vehicles FROM stream_silver GROUP BY 1, 2, 3, 4"))


add("t06_gold_from_stream", lambda i: steady(jobs.incident_tables(jobs.bronze(stream(i, "incidents")), "t06")[1]), GOLD_SQL)
add("t07_available_now_trigger", lambda i: jobs.drain(event_stream(i).select("event_id", "value"), "now"), "SELECT event_id, value FROM events")


@query("t07_processing_time_restart", "SELECT event_id, value FROM events")
def _(i):
    """Four files, one a batch: a timed query is stopped after its first batches and goes on from its checkpoint."""
    source, base = shared_dir(i.spark, "timed-source"), shared_dir(i.spark, "timed")
    rows = i.table("events").select("event_id", "value")
    rows.repartition(4).write.parquet(source)

    def write(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{base}/out/{jobs.BATCH}={epoch}")

    files = jobs.file_stream(i.spark, source, rows.schema, files_per_batch=1)
    timed = jobs.start_batches(files, write, f"{base}/checkpoint", {"processingTime": "100 milliseconds"})
    jobs.stop_after(timed, 2)
    jobs.run_batches(files, write, f"{base}/checkpoint")
    return i.spark.read.parquet(f"{base}/out").drop(jobs.BATCH)


@query("t08_table_chain", using("stream_silver", (
    "SELECT 'bronze' AS layer, count(*) AS n FROM events UNION ALL SELECT 'silver', count(*) FROM stream_silver UNION ALL "
    "SELECT 'gold', count(*) FROM (SELECT DISTINCT state_code, incident_year, incident_month, incident_type FROM stream_silver)")))
def _(i):
    path, stamped = shared_dir(i.spark, "chain-bronze"), jobs.bronze(stream(i, "incidents"))
    jobs.start(stamped, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    bronze = i.spark.read.schema(stamped.schema).parquet(f"{path}/out")
    files = jobs.file_stream(i.spark, f"{path}/out", stamped.schema)
    silver, gold = jobs.incident_tables(files, "t08")
    layers = {"bronze": bronze, "silver": silver, "gold": gold}
    counts = [df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("n")) for name, df in layers.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


READINGS = (
    "SELECT event_id, ts, event_type AS sensor_group, value AS speed_mph, cast(json_extract_string(props, '$.k') AS double) AS occupancy_pct FROM events"
)
block("readings", "", READINGS)
# The last windows stay open until the watermark, ten minutes behind the newest event, passes them.
block("closed_windows", "readings", (
    "SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, sensor_group, avg(speed_mph) AS avg_speed, count(*) AS volume "
    "FROM readings GROUP BY 1, 2 HAVING time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' <= "
    "(SELECT max(ts) - INTERVAL '10 minutes' FROM readings)"
))
BANDS = [(15, "Severe"), (30, "Heavy"), (45, "Moderate")]


def windows(i: Inputs) -> DataFrame:
    out = jobs.drain(jobs.traffic_windows(jobs.sensor_readings(event_stream(i))), "windows")
    return steady(out.withColumn("window_start", wall_clock("window_start")))


add("t10_tumbling_window", lambda i: windows(i).drop("congestion_level"), using(
    "closed_windows", f"SELECT window_start, sensor_group, {rnd('avg_speed', 6)} AS avg_speed, volume FROM closed_windows"))
add("t11_watermark", lambda i: windows(i).groupBy("window_start").agg(F.sum("volume").alias("volume")), using(
    "closed_windows", f"SELECT window_start, {big('volume')} AS volume FROM closed_windows GROUP BY 1"))
add("t12_congestion_level", lambda i: windows(i).select("window_start", "sensor_group", "congestion_level"), using(
    "closed_windows", "SELECT window_start, sensor_group, " + bands("avg_speed", "<", BANDS, "Free Flow") + " AS congestion_level FROM closed_windows"))
add("t13_anomaly_flag", lambda i: jobs.drain(jobs.anomalies(jobs.sensor_readings(event_stream(i))), "anomalies").select(
        "event_id", "sensor_group", "speed_mph", "occupancy_pct"),
    using("readings", "SELECT event_id, sensor_group, speed_mph, occupancy_pct FROM readings WHERE speed_mph < 10 OR occupancy_pct > 95"))


@query("t09_json_stream_with_origin", "SELECT event_id, value, true AS has_origin FROM events")
def _(i):
    rows = i.table("events").select("event_id", "value")
    path = shared_dir(i.spark, "json-files")
    export_json(rows, path)
    out = jobs.drain(jobs.file_stream(i.spark, path, rows.schema, "json", files_per_batch=100, with_origin=True), "json-stream")
    return out.select("event_id", "value", C("_source_file").contains("json-files").alias("has_origin"))


@query("t14_raw_beside_aggregate", (
    "SELECT 'raw' AS sink, count(*) AS n FROM events UNION ALL SELECT 'totals', count(DISTINCT event_type) FROM events"))
def _(i):
    totals, _log, raw = jobs.drain_with_totals(
        event_stream(i).select("event_id", "event_type"), {"has_id": "event_id IS NOT NULL"},
        lambda batch: batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "totals", beside=lambda batch: batch)
    by_type = totals.groupBy("event_type").agg(F.sum("n").alias("n"))
    return raw.agg(F.lit("raw").alias("sink"), F.count(F.lit(1)).alias("n")).unionByName(
        by_type.agg(F.lit("totals").alias("sink"), F.count(F.lit(1)).alias("n")))


add("p17_stream_bronze_incidents", lambda i: steady(jobs.drain(jobs.bronze(stream(i, "incidents")), "p17").drop("_ingest_time")),
    using("fx_incidents", "SELECT " + cols(
        "incident_id incident_type severity incident_datetime state_code county_code route_id *milepost *latitude *longitude "
        "road_condition weather_condition fatalities injuries vehicles_involved status") + " FROM fx_incidents"))
add("p17_stream_bronze_bridges", lambda i: jobs.drain(jobs.bronze(stream(i, "bridges")), "p17b").select("bridge_id", "state_code", "year_built"),
    using("fx_bridges", "SELECT bridge_id, state_code, year_built FROM fx_bridges"))


def silver_run(i: Inputs) -> tuple[DataFrame, DataFrame]:
    return jobs.drain_silver(jobs.bronze(stream(i, "incidents")), "incident_id", jobs.INCIDENT_MUST, jobs.INCIDENT_SHOULD, jobs.enriched_incidents, "p18")


def bridge_run(i: Inputs) -> tuple[DataFrame, DataFrame]:
    return jobs.drain_silver(jobs.bronze(stream(i, "bridges")), "bridge_id", jobs.BRIDGE_MUST, jobs.BRIDGE_SHOULD, jobs.enriched_bridges, "p19")


def broken(rules: dict[str, str], where: str = "true") -> str:
    return ", ".join(f"count(*) FILTER (WHERE ({where}) AND NOT coalesce({rule}, false)) AS {name}" for name, rule in rules.items())


add("p18_stream_silver_incidents", lambda i: silver_run(i)[0].select(*SILVER_KEEP), using("stream_silver", "SELECT * FROM stream_silver"))
add("p18_stream_silver_counts", lambda i: silver_run(i)[1],
    using("fx_incidents", f"SELECT {broken(jobs.INCIDENT_MUST)}, {broken(jobs.INCIDENT_SHOULD, MUST)} FROM fx_incidents"))
add("p19_stream_silver_counts", lambda i: bridge_run(i)[1],
    using("fx_bridges", f"SELECT {broken(jobs.BRIDGE_MUST)}, {broken(jobs.BRIDGE_SHOULD, 'bridge_id IS NOT NULL')} FROM fx_bridges"))
add("t03_dropped_rows", lambda i: jobs.drain_silver(
        stream(i, "incidents"), "incident_id", {"known_injuries": "injuries > 3"}, {}, lambda df: df, "dropped")[1],
    using("fx_incidents", f"SELECT {broken({'known_injuries': 'injuries > 3'})} FROM fx_incidents"))
add("p19_stream_silver_bridges", lambda i: steady(bridge_run(i)[0].select(
        "bridge_id", "state_code", "bridge_age_years", "days_since_inspection", "inspection_overdue", "risk_score")),
    using("fx_bridges", "SELECT bridge_id, state_code, 2024 - year_built AS bridge_age_years, "
          "cast(date_diff('day', cast(last_inspection_date AS date), DATE '2024-12-31') AS int) AS days_since_inspection, "
          "date_diff('day', cast(last_inspection_date AS date), DATE '2024-12-31') > 730 AS inspection_overdue, "
          + rnd("(100 - sufficiency_rating) * 0.5 + cast(2024 - year_built AS double) * 0.3", 1) + " AS risk_score FROM fx_bridges"))
add("p20_stream_monthly_rollup", lambda i: steady(jobs.incident_tables(jobs.bronze(stream(i, "incidents")), "p20")[1]), GOLD_SQL)


@query("src07_evolving_json", (
    "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 3 = 0 THEN event_type END AS kind, "
    "event_id % 5 = 0 AS has_rescued, false AS in_quarantine FROM events WHERE event_id % 7 <> 0 "
    "UNION ALL SELECT NULL, NULL, NULL, false, true FROM events WHERE event_id % 7 = 0"))
def _(i):
    """Every fifth user id is text, every third record has a field the schema lacks, every seventh line is cut short."""
    path = shared_dir(i.spark, "evolving-source")
    kind = F.when(C("event_id") % 3 == 0, C("event_type")).alias("kind")
    record = F.when(C("event_id") % 5 == 0, F.to_json(F.struct("event_id", F.concat(F.lit("u"), "user_id").alias("user_id"), kind))).otherwise(
        F.to_json(F.struct("event_id", "user_id", kind)))
    cut = F.when(C("event_id") % 7 == 0, F.substring(record, 1, 9)).otherwise(record)
    i.table("events").select(cut.alias("value")).write.text(path)
    known = i.table("events").select("event_id", "user_id").schema
    first, _broken, _base = evolving.ingest(evolving.text_lines(i.spark, path), known)
    # A second run with the schema that the first one's rescued fields widen.
    wide = evolving.widened(known, first)
    table, quarantine, _base = evolving.ingest(evolving.text_lines(i.spark, path), wide)
    kept = table.select("event_id", "user_id", "kind", C(evolving.RESCUED).isNotNull().alias("has_rescued"), F.lit(False).alias("in_quarantine"))
    return kept.unionByName(quarantine.select(F.lit(None).cast("long").alias("event_id"), F.lit(None).cast(known["user_id"].dataType).alias("user_id"),
                                              F.lit(None).cast("string").alias("kind"), F.lit(False).alias("has_rescued"), F.lit(True).alias("in_quarantine")))
