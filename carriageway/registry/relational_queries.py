"""Projections, filters, joins, aggregates, windows, sorts, set operations (PRJ, FLT, J, A, W, S, D)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from carriageway.functions.cells import hex_cell
from carriageway.functions.geometry import ring_points
from carriageway.functions.rules import ratio, rounded, rounded_total, tally
from carriageway.functions.text import has_text
from carriageway.operators.keys import (
    first_feed_wins, latest_per_key, one_row_per_key, split_by, unseen,
)
from carriageway.operators.measures import rollup_by, share_where, sum_where
from carriageway.operators.ordered import next_values, rank_by, rank_desc, row_numbers, running_totals, spread_scores
from carriageway.operators.runlog import first_to_last
from carriageway.operators.spatial import inside_polygons, same_cell_during
from carriageway.plans.feeds import TARGET_ROADS, usable_image
from carriageway.plans.geo import column_or
from carriageway.registry.check_sql import big, block, cnt, div, rnd, using, with_cell
from carriageway.registry.core import add, query, steady

C = F.col
LINE = "lineitem"

# ---- projections -----------------------------------------------------------
add("prj01_select", lambda i: i.table(LINE).select("l_orderkey", "l_linenumber", "l_quantity"),
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
add("prj02_add_or_replace", lambda i: i.table("customer").withColumns({
        "c_name": F.upper("c_name"), "in_debt": C("c_acctbal") < 0}),
    "SELECT * REPLACE (upper(c_name) AS c_name), c_acctbal < 0 AS in_debt FROM customer")
add("prj03_rename", lambda i: i.table("supplier").withColumnRenamed("s_suppkey", "supplier_id"),
    "SELECT s_suppkey AS supplier_id, s_name, s_nationkey, s_acctbal FROM supplier")
add("prj04_sql_aliases", lambda i: i.table("orders").selectExpr("o_orderkey AS id", "upper(o_orderstatus) AS state"),
    "SELECT o_orderkey AS id, upper(o_orderstatus) AS state FROM orders")
add("prj05_star_plus", lambda i: i.table("orders").select("*", F.year("o_orderdate").alias("o_year")),
    "SELECT *, cast(year(o_orderdate) AS int) AS o_year FROM orders")
add("prj06_lateral_alias", lambda i: steady(i.table(LINE).selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice * (1 - l_discount) AS net", "net * (1 + l_tax) AS gross")),
    f"SELECT l_orderkey, l_linenumber, {rnd('l_extendedprice * (1 - l_discount)', 6)} AS net, "
    f"{rnd('l_extendedprice * (1 - l_discount) * (1 + l_tax)', 6)} AS gross FROM lineitem")
add("prj07_literal", lambda i: i.table("nation").select("n_nationkey", F.lit(2024).alias("ref_year"), F.lit(True).alias("is_active")),
    "SELECT n_nationkey, 2024 AS ref_year, true AS is_active FROM nation")
add("prj08_column_or_default", lambda i: (lambda df: df.select(
        "bridge_id", column_or(df, "bridge_type", F.lit("none")), column_or(df, "risk_score", F.lit(0.0)),
        column_or(df, "aadt", C("avg_daily_traffic"))))(i.fx("bridges")),
    using("fx_bridges", "SELECT bridge_id, bridge_type, 0.0e0 AS risk_score, avg_daily_traffic AS aadt FROM fx_bridges"))
add("prj09_drop", lambda i: i.table("events").drop("props", "value"), "SELECT event_id, ts, user_id, event_type FROM events")
add("prj10_named_subqueries", lambda i: (lambda big_orders: big_orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n")))(i.table("orders").where(C("o_totalprice") > 100000)),
    "WITH big_orders AS (SELECT * FROM orders WHERE o_totalprice > 100000) "
    "SELECT o_orderstatus, count(*) AS n FROM big_orders GROUP BY 1")
add("prj11_derived_table", lambda i: i.table("nation").join(
        i.table("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers")),
        C("n_nationkey") == C("c_nationkey")).select("n_name", "customers"),
    "SELECT n_name, customers FROM nation JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) "
    "ON n_nationkey = c_nationkey")

# ---- filters ---------------------------------------------------------------
for name, table, cols_, spark_filter, sql_filter in [
    ("flt01_comparison", LINE, "l_orderkey l_linenumber", lambda: C("l_quantity") >= 45, "l_quantity >= 45"),
    ("flt03_between", "orders", "o_orderkey", lambda: C("o_totalprice").between(50000, 90000), "o_totalprice BETWEEN 50000 AND 90000"),
    ("flt04_in_list", "customer", "c_custkey", lambda: C("c_mktsegment").isin("BUILDING", "MACHINERY"), "c_mktsegment IN ('BUILDING', 'MACHINERY')"),
    ("flt06_and_or", LINE, "l_orderkey l_linenumber",
     lambda: (C("l_returnflag") == "R") | ((C("l_discount") > 0.08) & (C("l_tax") < 0.02)),
     "l_returnflag = 'R' OR (l_discount > 0.08 AND l_tax < 0.02)"),
    ("flt07_like", "part", "p_partkey p_type", lambda: C("p_type").like("%A%") | C("p_type").like("P%"), "p_type LIKE '%A%' OR p_type LIKE 'P%'"),
    ("flt08_prefix", "part", "p_partkey p_brand", lambda: F.startswith(C("p_brand"), F.lit("Brand#1")), "starts_with(p_brand, 'Brand#1')"),
    ("flt10_sql_text", "orders", "o_orderkey", lambda: F.expr("o_orderstatus = 'F' AND o_totalprice > 1000"), "o_orderstatus = 'F' AND o_totalprice > 1000"),
]:
    add(name, lambda i, t=table, k=cols_, p=spark_filter: i.table(t).where(p()).select(*k.split()),
        f"SELECT {', '.join(cols_.split())} FROM {table} WHERE {sql_filter}")
add("flt02_null_tests", lambda i: i.fx("incidents").where(C("incident_id").isNull() | C("injuries").isNull()).select(
        "incident_id", "injuries", C("incident_id").isNotNull().alias("has_id"), "milepost"),
    using("fx_incidents", "SELECT incident_id, injuries, incident_id IS NOT NULL AS has_id, milepost FROM fx_incidents "
          "WHERE incident_id IS NULL OR injuries IS NULL"))
add("flt05_not_in_list", lambda i: i.fx("incidents").where(~C("severity").isin("Fatal", "Unknown")).select("incident_id", "severity"),
    using("fx_incidents", "SELECT incident_id, severity FROM fx_incidents WHERE severity NOT IN ('Fatal', 'Unknown')"))
add("flt09_boolean_column", lambda i: i.incidents.where("has_fatality").select("incident_id"),
    using("silver_incidents", "SELECT incident_id FROM silver_incidents WHERE has_fatality"))
add("flt11_drop_null_rows", lambda i: i.fx("incidents").na.drop("any", subset=["incident_id", "injuries"]).select("incident_id", "injuries"),
    using("fx_incidents", "SELECT incident_id, injuries FROM fx_incidents WHERE incident_id IS NOT NULL AND injuries IS NOT NULL"))
add("flt12_group_filter", lambda i: i.table(LINE).groupBy("l_orderkey").agg(F.count("l_linenumber").alias("n")).where("n >= 2"),
    "SELECT l_orderkey, count(l_linenumber) AS n FROM lineitem GROUP BY 1 HAVING count(l_linenumber) >= 2")
add("flt13_non_empty_text", lambda i: i.table("pages").where(has_text("url")).select("page_id", "url"),
    "SELECT page_id, url FROM pages WHERE url IS NOT NULL AND url <> ''")

ROAD_NAME = "split_part('I-40,I-85,I-77,I-95,US-74', ',', cast(1 + r_regionkey AS int))"


def road_list(i):
    """Road ids and names: a lookup of one row per region."""
    return i.table("region").selectExpr("r_regionkey AS road_id", f"{ROAD_NAME} AS road")


add("flt14_allow_list", lambda i: i.table("customer").withColumn("road_id", (C("c_custkey") % 7).cast("int"))
    .where(C("c_mktsegment") != "HOUSEHOLD").join(road_list(i), "road_id").where(C("road").isin(*TARGET_ROADS))
    .select("c_custkey", "road"),
    f"SELECT c_custkey, {ROAD_NAME} AS road FROM customer JOIN region ON c_custkey % 7 = r_regionkey "
    "WHERE c_mktsegment <> 'HOUSEHOLD'")
add("flt15_usable_image", lambda i: i.table("pages").select(
        "page_id", usable_image("url", F.when(C("page_id") % 5 == 0, 404).otherwise(200), F.length("html"))
        .alias("image_ok")),
    "SELECT page_id, url IS NOT NULL AND url <> '' AND page_id % 5 <> 0 AND length(html) > 500 AS image_ok FROM pages")

# ---- joins -----------------------------------------------------------------
add("j01_left_chain", lambda i: steady(
    i.table("customer").groupBy(C("c_nationkey").alias("k")).agg(F.sum("c_acctbal").alias("customers_balance"))
    .join(i.table("supplier").groupBy(C("s_nationkey").alias("k")).agg(F.sum("s_acctbal").alias("suppliers_balance")), "k", "left")
    .join(i.table("nation").select(C("n_nationkey").alias("k"), "n_name"), "k", "left")
    .join(i.table("nation").select(C("n_nationkey").alias("k"), "n_regionkey"), "k", "left")),
    f"SELECT c_nationkey AS k, {rnd('customers_balance', 6)} AS customers_balance, {rnd('suppliers_balance', 6)} AS suppliers_balance, "
    "n_name, n_regionkey FROM (SELECT c_nationkey, sum(c_acctbal) AS customers_balance FROM customer GROUP BY 1) "
    "LEFT JOIN (SELECT s_nationkey, sum(s_acctbal) AS suppliers_balance FROM supplier GROUP BY 1) ON c_nationkey = s_nationkey "
    "LEFT JOIN nation ON c_nationkey = n_nationkey")
add("j02_left_differing_names", lambda i: i.table("documents").join(
        i.table("labels").withColumnRenamed("doc_id", "label_doc"), C("doc_id") == C("label_doc"), "left")
    .select("doc_id", "quality", "toxic"),
    "SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
add("j03_inner", lambda i: i.table("orders").join(i.table(LINE), C("o_orderkey") == C("l_orderkey"), "inner")
    .select("o_orderkey", "o_orderstatus", "l_linenumber", "l_quantity"),
    "SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
block("sensor_at", "fx_sensors", with_cell("fx_sensors", "latitude", "longitude", 6, "cell6"))
block("road_at", "fx_roads", with_cell("fx_roads", "start_lat", "start_lon", 6, "cell6"))
# Sensors are totalled per cell first: the join then grows with roads, not with pairs.
add("j04_cell_join", lambda i: i.fx("roads").withColumn("cell6", hex_cell("start_lat", "start_lon", 6)).join(
        i.fx("sensors").groupBy(hex_cell("latitude", "longitude", 6).alias("cell6")).agg(F.count(F.lit(1)).alias("sensors")), "cell6")
    .select("segment_id", "cell6", "sensors"),
    using("sensor_at road_at", "SELECT segment_id, cell6, sensors FROM road_at JOIN (SELECT cell6, count(*) AS sensors FROM sensor_at GROUP BY 1) USING (cell6)"))


def zone_hits(i):
    zones = i.work_zones.where("status = 'Active'").select(
        "work_zone_id", C("h3_index_r8").alias("zone_cell"), "start_date", "end_date")
    return same_cell_during(
        i.located.select("incident_id", "h3_index_r8", "incident_datetime"), zones, "h3_index_r8", "zone_cell",
        "incident_datetime", "start_date", "end_date", [C("incident_id")])


HIT_SQL = using("geo_incidents wz_cells", (
    "SELECT i.incident_id, w.work_zone_id FROM geo_incidents i JOIN wz_cells w ON i.h3_index_r8 = w.zone_cell "
    "AND w.status = 'Active' AND i.incident_datetime BETWEEN w.start_date AND w.end_date"))
add("j05_cell_and_time_range", lambda i: zone_hits(i).select("incident_id", "work_zone_id"), HIT_SQL)
add("g19_zone_conflicts", lambda i: zone_hits(i).select("incident_id", "work_zone_id"), HIT_SQL)
add("j06_semi_distinct", lambda i: i.table("customer").join(
        i.table("orders").where("o_orderstatus = 'F'"), C("c_custkey") == C("o_custkey"), "left_semi")
    .select("c_nationkey").distinct(),
    "SELECT DISTINCT c_nationkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
add("j07_left_null_label", lambda i: i.table("customer").join(
        i.table("orders").select("o_custkey").distinct(), C("c_custkey") == C("o_custkey"), "left")
    .select("c_custkey", F.when(C("o_custkey").isNull(), "No Orders").otherwise("Ordered").alias("coverage")),
    "SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'Ordered' ELSE 'No Orders' END AS coverage FROM customer")


@query("j08_polygon_join", using("fx_sensors zone_edges", (
    "SELECT sensor_id, taz_id FROM fx_sensors, zone_edges WHERE (y1 > latitude) != (y2 > latitude) "
    "AND longitude < x1 + (x2 - x1) * ((latitude - y1) / (y2 - y1)) GROUP BY ALL HAVING count(*) % 2 = 1")))
def _(i):
    zones = i.fx("zones").select("taz_id", ring_points("centroid_lat", "centroid_lon", "radius_deg", 6).alias("corners"))
    return inside_polygons(
        i.fx("sensors").select("sensor_id", "latitude", "longitude"), zones, "corners", "longitude", "latitude"
    ).select("sensor_id", "taz_id")


add("j09_index_as_column", lambda i: i.fx("sensors").select("sensor_id", hex_cell("latitude", "longitude", 6).alias("cell6")),
    using("sensor_at", "SELECT sensor_id, cell6 FROM sensor_at"))
add("j10_dictionary_lookup", lambda i: i.table("customer").select("c_custkey", (C("c_custkey") % 7).cast("int").alias("road_id"))
    .join(road_list(i), "road_id", "left").select("c_custkey", F.coalesce("road", F.lit("")).alias("road")),
    f"SELECT c_custkey, CASE WHEN r_regionkey IS NULL THEN '' ELSE {ROAD_NAME} END AS road "
    "FROM customer LEFT JOIN region ON c_custkey % 7 = r_regionkey")

# ---- aggregates ------------------------------------------------------------
add("a01_group_by", lambda i: rollup_by(i.table(LINE), ["l_returnflag", "l_linestatus"], {"n": F.count(F.lit(1)), "max_quantity": F.max("l_quantity")}),
    "SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_quantity) AS max_quantity FROM lineitem GROUP BY 1, 2")


@query("a02_group_by_ordinal", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def _(i):
    return i.spark.sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {o} GROUP BY 1, 2", o=i.table("orders"))


add("a03_count_column", lambda i: i.fx("incidents").groupBy("state_code").agg(F.count("injuries").alias("n_known"), F.count("incident_id").alias("n_ids")),
    using("fx_incidents", "SELECT state_code, count(injuries) AS n_known, count(incident_id) AS n_ids FROM fx_incidents GROUP BY 1"))
add("a04_count_star", lambda i: i.table("events").groupBy("event_type").agg(F.count("*").alias("n")),
    "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
add("a05_table_count", lambda i: i.table(LINE).agg(F.count(F.lit(1)).alias("n_rows")), "SELECT count(*) AS n_rows FROM lineitem")
add("a06_sum", lambda i: steady(i.table(LINE).groupBy("l_returnflag").agg(F.sum("l_quantity").alias("q"), F.sum("l_linenumber").alias("l")), 4),
    f"SELECT l_returnflag, {rnd('sum(l_quantity)', 4)} AS q, {big('l_linenumber')} AS l FROM lineitem GROUP BY 1")
add("a07_average", lambda i: steady(i.table("orders").groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("mean_price")), 4),
    f"SELECT o_orderpriority, {rnd('avg(o_totalprice)', 4)} AS mean_price FROM orders GROUP BY 1")
add("a08_min_max", lambda i: i.table("orders").groupBy("o_orderstatus").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"), F.max("o_totalprice").alias("top")),
    'SELECT o_orderstatus, min(o_orderdate) AS "first", max(o_orderdate) AS "last", max(o_totalprice) AS top FROM orders GROUP BY 1')
add("a09_count_distinct", lambda i: i.table(LINE).groupBy("l_returnflag").agg(
        F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_partkey").alias("parts")),
    "SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
add("a10_conditional_count", lambda i: i.table(LINE).groupBy("l_linestatus").agg(
        tally(C("l_quantity") > 25).alias("large"), tally(C("l_discount") == 0).alias("full_price")),
    "SELECT l_linestatus, " + cnt("l_quantity > 25") + " AS large, " + cnt("l_discount = 0") + " AS full_price FROM lineitem GROUP BY 1")
add("a11_conditional_sum", lambda i: steady(i.table(LINE).groupBy("l_linestatus").agg(
        sum_where(C("l_returnflag").isin("A", "R"), "l_quantity").alias("returned")), 4),
    f"SELECT l_linestatus, {rnd("sum(CASE WHEN l_returnflag IN ('A', 'R') THEN l_quantity ELSE 0 END)", 4)} AS returned FROM lineitem GROUP BY 1")
# A list of ids is rows, numbered in order: no key's list has to fit into one task.
add("a12_collect_ids", lambda i: row_numbers(
        i.table("orders").where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey"), ["o_custkey"], [C("o_orderkey")],
        F.floor(C("o_orderkey") / 100_000), "place"),
    "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM orders WHERE o_orderstatus = 'F'")
add("a13_ratio_of_aggregates", lambda i: i.table(LINE).groupBy("l_returnflag").agg(
        rounded_total(ratio(F.sum("l_extendedprice"), F.sum("l_quantity")), 4).alias("unit_price"),
        rounded_total(ratio(F.count(F.lit(1)), F.countDistinct("l_orderkey")), 4).alias("lines_per_order")),
    f"SELECT l_returnflag, {rnd(div('sum(l_extendedprice)', 'sum(l_quantity)'), 4)} AS unit_price, "
    f"{rnd(div('count(*)', 'count(DISTINCT l_orderkey)'), 4)} AS lines_per_order FROM lineitem GROUP BY 1")
add("a14_reaggregate", lambda i: i.table("orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    .groupBy("y").agg(F.sum("n").alias("orders"), rounded_total(F.avg("n"), 4).alias("per_customer")),
    f"SELECT y, {big('n')} AS orders, {rnd('avg(n)', 4)} AS per_customer FROM (SELECT o_custkey, cast(year(o_orderdate) AS int) AS y, "
    "count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1")
add("a15_group_count_ordered", lambda i: i.fx("pavement").groupBy("condition_rating").count().orderBy("condition_rating"),
    using("fx_pavement", 'SELECT condition_rating, count(*) AS "count" FROM fx_pavement GROUP BY 1'))
add("a16_distinct_values", lambda i: i.table("events").agg(F.countDistinct("event_type").alias("n_types")),
    "SELECT count(DISTINCT event_type) AS n_types FROM events")
add("a17_share_above", lambda i: i.bridges.agg(rounded_total(share_where(C("risk_score") >= 70), 6).alias("share_high")),
    using("silver_bridges", f"SELECT {rnd('avg(CASE WHEN risk_score >= 70 THEN 1e0 ELSE 0e0 END)', 6)} AS share_high FROM silver_bridges"))
add("a18_sample_deviation", lambda i: steady(i.table("orders").groupBy("o_orderstatus").agg(F.stddev_samp("o_totalprice").alias("sd")), 4),
    f"SELECT o_orderstatus, {rnd('stddev_samp(o_totalprice)', 4)} AS sd FROM orders GROUP BY 1")

# ---- windows ---------------------------------------------------------------
add("w01_rank", lambda i: rank_desc(i.table("customer").select("c_custkey", "c_nationkey", F.floor("c_acctbal").alias("b")), ["c_nationkey"], "b", "place"),
    "SELECT c_custkey, c_nationkey, cast(floor(c_acctbal) AS bigint) AS b, "
    "cast(rank() OVER (PARTITION BY c_nationkey ORDER BY floor(c_acctbal) DESC) AS int) AS place FROM customer")
add("w02_rank_tie_breakers", lambda i: rank_by(
        i.table("part").select("p_partkey", "p_brand", "p_size", "p_type"), ["p_brand"], ["p_size", "p_type"],
        [C("p_size").desc_nulls_last(), C("p_type")], "place"),
    "SELECT p_partkey, p_brand, p_size, p_type, cast(rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_type) AS int) AS place FROM part")
add("w03_rank_in_report", lambda i: rank_desc(
        i.table("orders").groupBy("o_orderpriority", "o_custkey").agg(F.count(F.lit(1)).alias("n")), ["o_orderpriority"], "n", "place"),
    "SELECT o_orderpriority, o_custkey, count(*) AS n, cast(rank() OVER (PARTITION BY o_orderpriority ORDER BY count(*) DESC) AS int) AS place "
    "FROM orders GROUP BY 1, 2")
# One row per status and month reaches the window: its groups are bounded by the calendar.
add("w04_lag_twelve", lambda i: i.table("orders").groupBy("o_orderstatus", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    .agg(F.count(F.lit(1)).alias("n"))
    .withColumn("n_before", F.lag("n", 12).over(Window.partitionBy("o_orderstatus").orderBy("y", "m"))),
    "SELECT *, lag(n, 12) OVER (PARTITION BY o_orderstatus ORDER BY y, m) AS n_before FROM (SELECT o_orderstatus, "
    "cast(year(o_orderdate) AS int) AS y, cast(month(o_orderdate) AS int) AS m, count(*) AS n FROM orders GROUP BY 1, 2, 3)")


def spread(i):
    return spread_scores(i.table("supplier").select("s_suppkey", "s_nationkey", "s_acctbal"), ["s_nationkey"], "s_acctbal", "mean", "sd")


SPREAD = (
    "(SELECT s_suppkey, s_nationkey, s_acctbal, avg(s_acctbal) OVER (PARTITION BY s_nationkey) AS mean, "
    "stddev_samp(s_acctbal) OVER (PARTITION BY s_nationkey) AS sd FROM supplier)"
)
add("w05_group_mean_and_spread", lambda i: steady(spread(i), 4),
    f"SELECT s_suppkey, s_nationkey, {rnd('s_acctbal', 4)} AS s_acctbal, {rnd('mean', 4)} AS mean, {rnd('sd', 4)} AS sd FROM {SPREAD}")
add("w06_z_score", lambda i: spread(i).select("s_suppkey", F.when(
        C("sd") > 0, rounded((C("s_acctbal") - C("mean")) / C("sd"), 3)).otherwise(F.lit(0.0)).alias("z")),
    f"SELECT s_suppkey, CASE WHEN sd > 0 THEN {rnd('(s_acctbal - mean) / sd', 3)} ELSE 0e0 END AS z FROM {SPREAD}")
add("w07_latest_per_key", lambda i: latest_per_key(i.table("events"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "ts"),
    "SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS spot FROM events) WHERE spot = 1")
add("w08_sequence_number", lambda i: row_numbers(
        i.table("events").select("event_id", "event_type", "ts"), ["event_type"], [C("ts"), C("event_id")], F.date_trunc("minute", "ts"), "run_number"),
    "SELECT event_id, event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS run_number FROM events")


@query("w09_first_to_last", (
    f"SELECT user_id, n_runs, {rnd('first_value', 6)} AS first_value, {rnd('last_value', 6)} AS last_value, "
    f"{rnd('last_value - first_value', 6)} AS delta, "
    f"{rnd('coalesce((last_value - first_value) / nullif(first_value, 0) * 100, 0)', 6)} AS delta_pct FROM ("
    "SELECT user_id, count(*) AS n_runs, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value "
    "FROM events GROUP BY 1)"))
def _(i):
    return steady(first_to_last(i.table("events"), ["user_id"], "value", ["ts", "event_id"]))


add("w10_running_total", lambda i: steady(running_totals(
        one_row_per_key(i.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), ["o_orderkey"]), ["o_orderstatus"],
        [C("o_orderkey")], F.floor(C("o_orderkey") / 10000), {"so_far": C("o_totalprice")}, inclusive=False), 2),
    f"SELECT o_orderkey, o_orderstatus, {rnd('o_totalprice', 2)} AS o_totalprice, {rnd('coalesce(sum(o_totalprice) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)', 2)} AS so_far FROM orders")
add("w11_next_row", lambda i: next_values(
        i.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), ["o_orderstatus"], "o_orderkey",
        F.floor(C("o_orderkey") / 10000), {"next_key": "o_orderkey", "next_price": "o_totalprice"}),
    "SELECT o_orderkey, o_orderstatus, o_totalprice, lead(o_orderkey) OVER w AS next_key, lead(o_totalprice) OVER w AS next_price "
    "FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey)")

# ---- sorts, limits, top-k --------------------------------------------------
add("s01_order_by", lambda i: i.table("nation").orderBy("n_regionkey", F.desc("n_name")), "SELECT * FROM nation ORDER BY n_regionkey, n_name DESC")
add("s02_order_by_ordinal", lambda i: i.spark.sql("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM {o} GROUP BY 1, 2 ORDER BY 1, 2", o=i.table("orders")),
    "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, 2")
add("s03_order_by_case_rank", lambda i: i.table("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    .orderBy(F.when(C("o_orderstatus") == "F", 1).when(C("o_orderstatus") == "O", 2).otherwise(3)),
    "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
add("s04_order_by_alias", lambda i: i.table("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")).orderBy(F.desc("n_orders"), "o_custkey"),
    "SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1")
add("s05_top_k", lambda i: i.table("orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50).select("o_orderkey", "o_totalprice"),
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
# A sample without an order: any rows do, so only their number is comparable.
add("s06_limit_sample", lambda i: i.table("events").limit(200).agg(F.count(F.lit(1)).alias("n")),
    "SELECT count(*) AS n FROM (SELECT * FROM events LIMIT 200)")
add("s07_n_largest", lambda i: steady(i.bridges.orderBy(F.desc("risk_score"), "bridge_id").limit(20).select("bridge_id", "risk_score")),
    using("silver_bridges", "SELECT bridge_id, risk_score FROM silver_bridges ORDER BY risk_score DESC, bridge_id LIMIT 20"))

# ---- de-duplication and sets -----------------------------------------------
add("d01_drop_duplicates", lambda i: one_row_per_key(i.fx("pavement"), ["segment_id"]).select("segment_id", "iri", "condition_rating"),
    using("fx_pavement", "SELECT DISTINCT segment_id, iri, condition_rating FROM fx_pavement"))
add("d02_distinct", lambda i: i.table(LINE).select("l_returnflag", "l_linestatus", "l_linenumber").distinct(),
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
FEED_SQL = (
    "SELECT id, origin FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY place) AS spot FROM ("
    "SELECT s_suppkey AS id, 'supplier' AS origin, 1 AS place FROM supplier UNION ALL "
    "SELECT c_custkey, 'customer', 2 FROM customer UNION ALL SELECT p_partkey, 'part', 3 FROM part)) WHERE spot = 1"
)
add("d03_first_feed_wins", lambda i: first_feed_wins([
        i.table(t).select(C(k).alias("id"), F.lit(t).alias("origin"))
        for t, k in (("supplier", "s_suppkey"), ("customer", "c_custkey"), ("part", "p_partkey"))], "id"), FEED_SQL)
add("d04_concatenate", lambda i: i.table("customer").select(C("c_custkey").alias("id"), C("c_acctbal").alias("balance")).unionByName(
        i.table("supplier").select(C("s_acctbal").alias("balance"), C("s_suppkey").alias("id"))),
    "SELECT c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")


@query("d05_split_by_predicate", (
    "SELECT CASE WHEN injuries > 5 THEN 'many' ELSE 'rest' END AS part, count(*) AS n, count(injuries) AS n_known "
    "FROM (" + using("fx_incidents", "SELECT injuries FROM fx_incidents") + ") GROUP BY 1"))
def _(i):
    many, rest = split_by(i.fx("incidents"), C("injuries") > 5)

    def sizes(df, name):
        return df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.count("injuries").alias("n_known"))

    return sizes(many, "many").unionByName(sizes(rest, "rest"))


add("d06_new_keys", lambda i: unseen(
        i.table("customer").select("c_custkey", "c_acctbal"), i.table("orders").where("o_orderstatus = 'P'").select(C("o_custkey").alias("c_custkey")),
        "c_custkey", C("c_acctbal") > 0),
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
