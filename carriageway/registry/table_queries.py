"""Sources and sinks: every sink is written in the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carriageway.functions.geometry import line_wkt
from carriageway.functions.times import AS_OF, at_midnight
from carriageway.operators.settle import settled
from carriageway.plans.feeds import INCIDENT_ITEM
from carriageway.registry.check_sql import using
from carriageway.registry.core import Inputs, add, query
from carriageway.session import shared_dir
from carriageway.sources import sinks, tables
from carriageway.streaming import jobs

C = F.col
ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


def orders(i: Inputs) -> DataFrame:
    return i.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def own_database(i: Inputs) -> str:
    """A new database whose files lie in the shared folder."""
    name = f"marts_{uuid.uuid4().hex[:12]}"
    sinks.ensure_database(i.spark, name, shared_dir(i.spark, name))
    return name


add("src01_scan", lambda i: tables.scan(i.spark, i.path("orders")).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), ORDERS)
add("src02_scan_filter_columns", lambda i: tables.scan(
        i.spark, i.path("lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"], C("l_quantity") > 40),
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 40")


@query("src03_catalog_table", ORDERS)
def _(i):
    name = f"{own_database(i)}.orders"
    sinks.register_files(i.spark, name, i.path("orders"))
    return tables.scan_table(i.spark, name).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


add("src04_path_in_sql", lambda i: tables.scan_in_sql(i.spark, i.path("supplier"), "SELECT s_suppkey, s_name FROM {source} WHERE s_acctbal > 0"),
    "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")


def event_stream(i: Inputs) -> DataFrame:
    return jobs.file_stream(i.spark, i.stream_path("events"), i.table("events").schema)


add("src05_stream_scan", lambda i: jobs.drain(event_stream(i).select("event_id", "user_id", "event_type"), "scan"),
    "SELECT event_id, user_id, event_type FROM events")


@query("src06_stream_from_table", "SELECT event_id, upper(event_type) AS kind FROM events WHERE user_id IS NOT NULL")
def _(i):
    chain = jobs.table_chain(event_stream(i), {
        "bronze": lambda df: df.select("event_id", "user_id", "event_type"),
        "silver": lambda df: df.where(C("user_id").isNotNull()).select("event_id", F.upper("event_type").alias("kind")),
    })
    return chain["silver"]


@query("src07_json_files_stream", "SELECT event_id, user_id, event_type, true AS has_origin FROM events")
def _(i):
    rows = i.table("events").select("event_id", "user_id", "event_type")
    path = shared_dir(i.spark, "raw-json")
    sinks.export_json(rows, path)
    stream = jobs.file_stream(i.spark, path, rows.schema, "json", with_origin=True)
    out = jobs.drain(stream, "json")
    return out.select("event_id", "user_id", "event_type", C("_source_file").contains("raw-json").alias("has_origin"))


@query("src08_literal_rows", (
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'pending' END AS meaning FROM orders"))
def _(i):
    codes = i.spark.createDataFrame(
        [("F", "finished"), ("O", "open"), ("P", "pending")], "o_orderstatus string, meaning string")
    return i.table("orders").join(codes, "o_orderstatus", "left").select("o_orderkey", "meaning")


# One JSON answer per event: an object with some keys missing.
PAYLOAD = (
    "concat('{\"id\":', event_id, ',\"road\":\"I-', user_id % 90, '\"', "
    "CASE WHEN event_id % 3 = 0 THEN '' ELSE concat(',\"severity\":', user_id % 5) END, "
    "',\"location\":\"mile ', event_id % 100, '\"}')"
)


@query("src09_flatten_json", (
    "SELECT event_id AS incident_id, concat('I-', user_id % 90) AS road, "
    "cast(CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id % 5 END AS int) AS severity, "
    "cast(NULL AS varchar) AS county, concat('mile ', event_id % 100) AS location FROM events"))
def _(i):
    polls = i.table("events").selectExpr(f"{PAYLOAD} AS payload")
    return tables.flatten(polls, "payload", INCIDENT_ITEM, {
        "incident_id": "id", "road": "road", "severity": "severity", "county": "countyName", "location": "location",
    }, defaults={"severity": 1})


add("src10_fallback_source", lambda i: tables.first_available(
        i.spark, [f"{i.dir}/no_such_table.parquet", i.path("supplier")]).select("s_suppkey", "s_name"),
    "SELECT s_suppkey, s_name FROM supplier")


@query("src11_run_history", "SELECT event_id AS run_id, event_type AS run_name, ts AS start_time FROM events")
def _(i):
    path = shared_dir(i.spark, "runs")
    sinks.overwrite(i.table("events").select(
        C("event_id").alias("run_id"), C("event_type").alias("run_name"), C("ts").alias("start_time")), path)
    return tables.run_history(i.spark, path)


# ---- sinks -----------------------------------------------------------------
@query("snk01_partitioned_overwrite", ORDERS)
def _(i):
    path = shared_dir(i.spark, "orders")
    sinks.overwrite(orders(i).withColumn("o_totalprice", F.lit(0.0)), path, ["o_orderstatus"])
    sinks.overwrite(orders(i), path, ["o_orderstatus"])
    return i.spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("snk02_overwrite", ORDERS)
def _(i):
    path = shared_dir(i.spark, "orders")
    sinks.overwrite(orders(i), path)
    return i.spark.read.parquet(path)


@query("snk03_append", "SELECT s_suppkey AS id FROM supplier UNION ALL SELECT c_custkey FROM customer")
def _(i):
    path = shared_dir(i.spark, "ids")
    sinks.append(i.table("supplier").select(C("s_suppkey").alias("id")), path)
    sinks.append(i.table("customer").select(C("c_custkey").alias("id")), path)
    return i.spark.read.parquet(path)


@query("snk04_save_as_table", ORDERS)
def _(i):
    name = f"{own_database(i)}.orders"
    sinks.save_table(orders(i), name, ["o_orderstatus"])
    return i.spark.table(name)


@query("snk05_create_or_replace", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(i):
    name = f"{own_database(i)}.status_counts"
    counts = i.table("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    sinks.save_table(counts.withColumn("n", C("n") * 0), name)
    sinks.save_table(counts, name)
    return i.spark.table(name)


@query("snk06_create_database", "SELECT count(*) AS n_orders, true AS exists_now FROM orders")
def _(i):
    name = own_database(i)
    sinks.ensure_database(i.spark, name)
    return i.table("orders").agg(F.count(F.lit(1)).alias("n_orders")).withColumn(
        "exists_now", F.lit(i.spark.catalog.databaseExists(name)))


@query("snk07_external_table", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def _(i):
    name = f"{own_database(i)}.customer"
    sinks.register_files(i.spark, name, i.path("customer"))
    return i.spark.table(name).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("snk08_stream_table", "SELECT event_id, event_type, 'Events as they arrive' AS table_comment, 'bronze' AS quality FROM events")
def _(i):
    db = own_database(i)
    stream = event_stream(i).select("event_id", "event_type")
    jobs.start_table(
        stream, f"{db}.bronze_events", shared_dir(i.spark, "checkpoint"), "Events as they arrive", "bronze",
    ).awaitTermination()
    name = f"{db}.bronze_events"
    quality = i.spark.sql(f"SHOW TBLPROPERTIES {name} ('quality')").first()["value"]
    return i.spark.table(name).select(
        "event_id", "event_type", F.lit(i.spark.catalog.getTable(name).description).alias("table_comment"), F.lit(quality).alias("quality"))


def drawn_roads(i: Inputs) -> DataFrame:
    return i.fx("roads").select("segment_id", "route_id", "aadt", line_wkt(
        (C("start_lon"), C("start_lat")), (C("end_lon"), C("end_lat"))).alias("geometry_wkt"))


@query("snk09_geojson", using("fx_roads", (
    "SELECT segment_id, route_id, aadt, 'LineString' AS kind, start_lon AS x, start_lat AS y, 2 AS n_points FROM fx_roads")))
def _(i):
    path = shared_dir(i.spark, "geojson")
    blank = drawn_roads(i).withColumn("geometry_wkt", F.lit(""))
    sinks.export_geojson(drawn_roads(i).unionByName(blank), "geometry_wkt", path)
    item = (
        "type string, geometry struct<type:string,coordinates:array<array<double>>>, "
        "properties struct<segment_id:string,route_id:string,aadt:int>"
    )
    f = i.spark.read.text(path).select(F.from_json("value", item).alias("f"))
    return f.select(
        "f.properties.segment_id", "f.properties.route_id", "f.properties.aadt", C("f.geometry.type").alias("kind"),
        C("f.geometry.coordinates")[0][0].alias("x"), C("f.geometry.coordinates")[0][1].alias("y"),
        F.size("f.geometry.coordinates").alias("n_points"))


@query("snk10_geoparquet", using("fx_roads", (
    "SELECT segment_id, least(start_lon, end_lon) AS xmin, least(start_lat, end_lat) AS ymin, "
    "greatest(start_lon, end_lon) AS xmax, greatest(start_lat, end_lat) AS ymax FROM fx_roads")))
def _(i):
    path = shared_dir(i.spark, "geoparquet")
    sinks.export_geoparquet(drawn_roads(i), "geometry_wkt", path)
    return i.spark.read.parquet(path).select("segment_id", "xmin", "ymin", "xmax", "ymax")


@query("snk11_cells_as_polygons", using("geo_cells", (
    "SELECT h3_index_r8, state_code, incident_count, 7 AS n_points FROM geo_cells")))
def _(i):
    path = shared_dir(i.spark, "cells")
    cells = settled(i.cells.select("h3_index_r8", "state_code", "incident_count"), "cells")
    bad = i.table("region").select(F.lit("no cell").alias("h3_index_r8"), C("r_name").alias("state_code"), F.lit(1).cast("long").alias("incident_count"))
    sinks.export_geojson(sinks.cells_as_polygons(cells.unionByName(bad), "h3_index_r8"), "geometry_wkt", path)
    item = (
        "geometry struct<coordinates:array<array<array<double>>>>, "
        "properties struct<h3_index_r8:string,state_code:string,incident_count:bigint>"
    )
    f = i.spark.read.text(path).select(F.from_json("value", item).alias("f"))
    return f.select("f.properties.*", F.size(C("f.geometry.coordinates")[0]).alias("n_points"))


@query("snk12_json_records", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(i):
    rows = i.table("supplier").select("s_suppkey", "s_name", "s_acctbal")
    path = shared_dir(i.spark, "json")
    sinks.export_json(rows, path)
    return i.spark.read.schema(rows.schema).json(path)


@query("snk13_feed_bundle", (
    "SELECT 'cameras' AS kind, cast(to_json({'id': s_suppkey, 'label': s_name}) AS varchar) AS record, '2024-12-31 00:00 UTC' AS stamp "
    "FROM supplier UNION ALL SELECT 'incidents', cast(to_json({'id': n_nationkey, 'road': n_name}) AS varchar), '2024-12-31 00:00 UTC' FROM nation"))
def _(i):
    return sinks.feed_bundle({
        "cameras": i.table("supplier").select(C("s_suppkey").alias("id"), C("s_name").alias("label")),
        "incidents": i.table("nation").select(C("n_nationkey").alias("id"), C("n_name").alias("road")),
    }, F.date_format(at_midnight(AS_OF), "yyyy-MM-dd HH:mm 'UTC'"))


@query("snk14_descriptions", (
    "SELECT count(*) AS n_rows, 'Suppliers on the register' AS table_comment, 'Natural key' AS column_comment FROM supplier"))
def _(i):
    name = f"{own_database(i)}.suppliers"
    sinks.save_table(i.table("supplier"), name)
    sinks.describe(i.spark, name, "Suppliers on the register", {"s_suppkey": "Natural key"})
    comment = next(c.description for c in i.spark.catalog.listColumns(name) if c.name == "s_suppkey")
    return i.spark.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(i.spark.catalog.getTable(name).description).alias("table_comment"), F.lit(comment).alias("column_comment"))


STATISTICS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, " + (f"cast(min({c}) AS double) AS least, cast(max({c}) AS double) AS greatest" if number else "cast(NULL AS double) AS least, cast(NULL AS double) AS greatest")
    + f", count(*) - count({c}) AS n_null FROM orders"
    for c, number in (("o_orderkey", True), ("o_custkey", True), ("o_orderstatus", False), ("o_totalprice", True)))


def analyzed(i: Inputs) -> DataFrame:
    name = f"{own_database(i)}.orders"
    sinks.save_table(orders(i), name)
    sinks.analyze(i.spark, name)
    return sinks.column_statistics(i.spark, name)


add("snk15_column_statistics", lambda i: analyzed(i).drop("n_distinct"), STATISTICS)
# The catalog's distinct counts are sketches; a test holds them against exact ones.
add("snk15_distinct_counts", lambda i: analyzed(i).select("column_name", "n_distinct"))


@query("snk16_cluster_files", ORDERS)
def _(i):
    path = shared_dir(i.spark, "clustered")
    sinks.overwrite(sinks.clustered_by_all(orders(i), ["o_custkey", "o_totalprice"], 16), path)
    return i.spark.read.parquet(path)


@query("snk16_files_to_read")
def _(i):
    """Files that a narrow filter on the first and on the second column has to read, by order of the rows."""
    least, greatest = orders(i).agg(F.min("o_totalprice"), F.max("o_totalprice")).first()
    first, last = orders(i).agg(F.min("o_custkey"), F.max("o_custkey")).first()
    out = None
    for order, df in (("linear", orders(i).repartitionByRange(16, "o_custkey", "o_totalprice")), ("interleaved", sinks.clustered_by_all(orders(i), ["o_custkey", "o_totalprice"], 16))):
        path = shared_dir(i.spark, f"clustered-{order}")
        df.write.parquet(path)
        for column, low, high in (("o_custkey", first, last), ("o_totalprice", least, greatest)):
            part = sinks.files_met(i.spark, path, column, low, low + (high - low) / 20).select(F.lit(order).alias("order"), F.lit(column).alias("column"), "files", "met")
            out = part if out is None else out.unionByName(part)
    return out


@query("snk17_write_history", (
    "SELECT 'WRITE' AS operation, count(*) AS rows_written, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice' AS \"columns\", "
    "TIMESTAMP '2024-12-31 00:00:00' AS logged_at FROM orders"))
def _(i):
    path, log = shared_dir(i.spark, "orders"), shared_dir(i.spark, "history")
    row = sinks.write_logged(orders(i), path, "WRITE", at_midnight(AS_OF), sinks.overwrite)
    sinks.append(row, log)
    return i.spark.read.parquet(log)

