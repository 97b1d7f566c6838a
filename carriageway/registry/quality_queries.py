"""Data quality, monitoring and governance: Q1 to Q14, M1 to M5, U1 and U2."""

from __future__ import annotations

from pyspark.sql import functions as F

from carriageway.functions.times import AS_OF, at_midnight
from carriageway.operators import masking, quality, snapshots
from carriageway.operators.profiling import category_drift, numeric_drift, profile
from carriageway.operators.settle import settled
from carriageway.registry.check_sql import block, rnd, using
from carriageway.registry.core import add, query, steady
from carriageway.registry.table_queries import own_database
from carriageway.session import shared_dir
from carriageway.sources.sinks import append, save_table

C = F.col
SQL_RULES = {
    "traffic_incidents": ("fx_incidents", [
        ("incident_id not null", "incident_id IS NULL", 0.0), ("incident_datetime not null", "incident_datetime IS NULL", 0.0),
        ("severity is valid", "severity NOT IN ('Fatal', 'Serious Injury', 'Minor Injury', 'Property Damage Only', 'Unknown')", 0.01),
        ("latitude in valid range", "latitude < -90 OR latitude > 90", 0.0), ("fatalities non-negative", "fatalities < 0", 0.0),
        ("no future incidents", "incident_datetime > TIMESTAMP '2024-12-31 00:00:00'", 0.0)]),
    "bridge_inspections": ("fx_bridges", [
        ("bridge_id not null", "bridge_id IS NULL", 0.0), ("year_built plausible", "year_built < 1800 OR year_built > 2025", 0.01),
        ("sufficiency_rating 0-100", "sufficiency_rating < 0 OR sufficiency_rating > 100", 0.01),
        ("avg_daily_traffic non-negative", "avg_daily_traffic < 0", 0.0)]),
    "vehicle_registrations": ("fx_vehicles", [
        ("vin not null", "vin IS NULL", 0.0), ("model_year plausible", "model_year < 1900 OR model_year > 2025", 0.01),
        ("gvwr positive", "gvwr_lbs <= 0", 0.01)]),
    "pavement_conditions": ("fx_pavement", [
        ("segment_id not null", "segment_id IS NULL", 0.0), ("iri non-negative", "iri < 0", 0.0),
        ("cracking_percent 0-100", "cracking_percent < 0 OR cracking_percent > 100", 0.01)]),
}


def suite_sql(domain: str) -> str:
    view, rules = SQL_RULES[domain]
    parts = [
        f"SELECT '{domain}' AS domain, '{name}' AS check_name, count(*) FILTER (WHERE {bad}) AS bad_rows, count(*) AS total_rows, "
        f"cast({limit} AS double) AS threshold FROM {view}" for name, bad, limit in rules
    ]
    return using(view, (
        f"SELECT domain, check_name, bad_rows, total_rows, {rnd('rate', 6)} AS bad_rate, threshold, "
        "CASE WHEN rate <= threshold THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
        "SELECT *, CASE WHEN total_rows = 0 THEN 0e0 ELSE bad_rows / total_rows END AS rate FROM (" + " UNION ALL ".join(parts) + "))"))


SUITES = {
    "q02_incident_checks": ("traffic_incidents", "incidents", lambda: quality.incident_checks(AS_OF)),
    "q03_bridge_checks": ("bridge_inspections", "bridges", lambda: quality.BRIDGE_CHECKS),
    "q04_vehicle_checks": ("vehicle_registrations", "vehicles", lambda: quality.VEHICLE_CHECKS),
    "q05_pavement_checks": ("pavement_conditions", "pavement", lambda: quality.PAVEMENT_CHECKS),
}
for key, (domain, view, checks) in SUITES.items():
    add(key, lambda i, d=domain, v=view, c=checks: steady(quality.run_checks(i.fx(v), d, c())), suite_sql(domain))

# The general form, with rules of our own over a plain table: one fails, one passes, one has NULL results.
Q1_RULES = [("price positive", "o_totalprice <= 0", 0.0), ("not too dear", "o_totalprice > 100000", 0.05),
            ("known status", "nullif(o_orderstatus, 'P') NOT IN ('F', 'O')", 0.0)]
add("q01_check_suite", lambda i: steady(quality.run_checks(i.table("orders"), "orders", [quality.Check(*r) for r in Q1_RULES])), (
    f"SELECT domain, check_name, bad_rows, total_rows, {rnd('bad_rows / total_rows', 6)} AS bad_rate, threshold, "
    "CASE WHEN bad_rows / total_rows <= threshold THEN 'PASS' ELSE 'FAIL' END AS status FROM (" + " UNION ALL ".join(
        f"SELECT 'orders' AS domain, '{n}' AS check_name, count(*) FILTER (WHERE {bad}) AS bad_rows, count(*) AS total_rows, "
        f"cast({t} AS double) AS threshold FROM orders" for n, bad, t in Q1_RULES) + ")"))
add("q06_not_null_test", lambda i: quality.null_rows(i.fx("incidents"), "incident_id").select("incident_id", "route_id", "milepost"),
    using("fx_incidents", "SELECT incident_id, route_id, milepost FROM fx_incidents WHERE incident_id IS NULL"))
add("q07_unique_test", lambda i: quality.repeated_keys(i.fx("pavement"), "segment_id"),
    using("fx_pavement", "SELECT segment_id, count(*) AS n_rows FROM fx_pavement WHERE segment_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"))
add("q08_non_negative_test", lambda i: quality.negative_rows(i.table("customer"), "c_acctbal").select("c_custkey", "c_acctbal"),
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
add("q09_no_future_test", lambda i: quality.future_rows(i.table("orders"), "o_orderdate", at_midnight(AS_OF.replace(year=2000)))
    .select("o_orderkey", "o_orderdate"),
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2000-12-31 00:00:00'")
add("q10_code_list_test", lambda i: quality.orphan_rows(i.table("documents"), i.table("labels"), "doc_id", "doc_id").select("doc_id", "lang"),
    "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")


@query("q11_result_log", " UNION ALL ".join(f"({suite_sql(d)})" for d in ("bridge_inspections", "vehicle_registrations")))
def _(i):
    path = shared_dir(i.spark, "dq-log")
    append(steady(quality.run_checks(i.fx("bridges"), "bridge_inspections", quality.BRIDGE_CHECKS)), path)
    append(steady(quality.run_checks(i.fx("vehicles"), "vehicle_registrations", quality.VEHICLE_CHECKS)), path)
    return i.spark.read.parquet(path)


PROFILE_NUMBERS = ["bridge_count", "avg_sufficiency_rating", "avg_risk_score", "total_estimated_repair_cost_m", "deficiency_rate"]
PROFILE_TEXTS = ["state_code", "priority_tier"]


def profile_sql(source: str) -> str:
    def r(e):
        return rnd(e, 4)

    numbers = [
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count, "
        f"{r(f'min({c})')} AS min_value, {r(f'max({c})')} AS max_value, {r(f'avg({c})')} AS mean_value, "
        f"{r(f'stddev_samp({c})')} AS stddev_value, {r(f'quantile_disc({c}, 0.5)')} AS median_value FROM {source}" for c in PROFILE_NUMBERS
    ]
    texts = [
        f"SELECT '{c}', count(*), count(*) - count({c}), count(DISTINCT {c}), NULL, NULL, NULL, NULL, NULL FROM {source}" for c in PROFILE_TEXTS
    ]
    return " UNION ALL ".join(numbers + texts)


block("steady_health", "gold_health", "SELECT * REPLACE (" + ", ".join(
    f"{rnd(c, 6)} AS {c}" for c in ("avg_sufficiency_rating", "avg_risk_score", "total_estimated_repair_cost_m", "deficiency_rate"))
    + ") FROM gold_health")
add("q12_profile", lambda i: steady(profile(
        steady(i.health), PROFILE_NUMBERS + PROFILE_TEXTS, exact_distinct=True, accuracy=1000000), 4),
    using("steady_health", profile_sql("steady_health")))


def two_snapshots(i):
    lines = i.table("lineitem").select("l_shipdate", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return lines.where(C("l_shipdate") < cut), lines.where(C("l_shipdate") >= cut)


def drift_sql(c: str) -> str:
    b, a = "FILTER (WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00')", "FILTER (WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00')"
    return (
        f"SELECT '{c}' AS column_name, {rnd(f'avg({c}) {b}', 6)} AS baseline_mean, 0e0 AS baseline_null_rate, "
        f"{rnd(f'avg({c}) {a}', 6)} AS current_mean, 0e0 AS current_null_rate, "
        f"{rnd(f'(avg({c}) {a}) - (avg({c}) {b})', 6)} AS mean_shift, 0e0 AS null_rate_shift FROM lineitem"
    )


add("q13_numeric_drift", lambda i: steady(numeric_drift(*two_snapshots(i), ["l_quantity", "l_discount"])),
    " UNION ALL ".join(drift_sql(c) for c in ("l_quantity", "l_discount")))


TV = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {rnd('sum(gap) / 2', 6)} AS tv_distance, count(*) AS categories FROM ("
    "SELECT abs(b / sum(b) OVER () - a / sum(a) OVER ()) AS gap FROM ("
    f"SELECT {c}, count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00') AS b, "
    f"count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00') AS a FROM lineitem GROUP BY 1))"
    for c in ("l_returnflag", "l_linestatus"))
add("q13_category_drift", lambda i: steady(category_drift(*two_snapshots(i), ["l_returnflag", "l_linestatus"])), TV)
# ---- metrics stored by day, merged to years --------------------------------
LINE_NUMBERS, LINE_TEXTS = ["l_quantity", "l_discount", "l_tax"], ["l_returnflag"]


def lines_by_day(i):
    """Metrics and buckets of the order lines, stored once per ship date."""
    lines = i.table("lineitem").select(F.to_date("l_shipdate").alias("day"), *LINE_NUMBERS, *LINE_TEXTS)
    return (settled(snapshots.metrics(lines, ["day"], LINE_NUMBERS + LINE_TEXTS), "metrics-by-day"),
            settled(snapshots.buckets(lines, ["day"], LINE_NUMBERS), "buckets-by-day"))


def bucket_sql(value: str) -> str:
    size = f"(ceil(ln(abs({value})) / ln({snapshots.GROWTH})) + {snapshots.SHIFT})"
    return f"cast(CASE WHEN {value} = 0 THEN 0 ELSE sign({value}) * {size} END AS bigint)"


def yearly_sql(c: str) -> str:
    stands = f"pow({snapshots.GROWTH}, least_bucket - {snapshots.SHIFT}) * {2 / (1 + snapshots.GROWTH)!r}"
    stands = f"CASE WHEN least_bucket = 0 THEN 0 ELSE {stands} END"
    held = f"greatest(min_value, least(max_value, {stands}))"
    return (
        f"SELECT year, '{c}' AS column_name, row_count, null_count, distinct_count, {rnd('min_value', 6)} AS min_value, {rnd('max_value', 6)} AS max_value, "
        f"{rnd('mean_value', 6)} AS mean_value, {rnd('stddev_value', 6)} AS stddev_value, {rnd(held, 6)} AS median_value FROM ("
        f"SELECT year(l_shipdate) AS year, count(*) AS row_count, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count, "
        f"min({c}) AS min_value, max({c}) AS max_value, avg({c}) AS mean_value, stddev_samp({c}) AS stddev_value, "
        f"quantile_disc({bucket_sql(c)}, 0.5) AS least_bucket FROM lineitem GROUP BY 1)")


@query("q12_merged_profile", " UNION ALL ".join([yearly_sql(c) for c in LINE_NUMBERS] + [
    f"SELECT year(l_shipdate), '{c}', count(*), count(*) - count({c}), count(DISTINCT {c}), NULL, NULL, NULL, NULL, NULL FROM lineitem GROUP BY 1" for c in LINE_TEXTS]))
def _(i):
    """Profile per year out of the metrics of its days."""
    metrics, buckets = (df.withColumn("year", F.year("day")) for df in lines_by_day(i))
    return steady(snapshots.stored_profile(metrics, buckets, ["year"]).drop("q1_value", "q3_value"))


STORED_DRIFT = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, cast(max(all_b) AS bigint) AS baseline_values, cast(max(all_c) AS bigint) AS current_values, "
    f"{rnd('max(abs(upto_b / all_b - upto_c / all_c))', 6)} AS ks_distance, {rnd('sum(abs(b / all_b - c / all_c)) / 2', 6)} AS tv_distance, count(*) AS ranges FROM ("
    "SELECT *, sum(b) OVER () AS all_b, sum(c) OVER () AS all_c, sum(b) OVER (ORDER BY bucket) AS upto_b, sum(c) OVER (ORDER BY bucket) AS upto_c FROM ("
    f"SELECT {bucket_sql(c)} AS bucket, count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00') AS b, "
    f"count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00') AS c FROM lineitem WHERE {c} IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1))"
    for c in LINE_NUMBERS)


@query("q13_stored_drift", STORED_DRIFT)
def _(i):
    """Distances of the distributions before and from 1998 on, out of the buckets of days."""
    cut = F.lit("1998-01-01").cast("date")
    return steady(snapshots.stored_drift(lines_by_day(i)[1], C("day") < cut, C("day") >= cut))


add("q14_row_counts", lambda i: i.corridors.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("high_risk_corridors").alias("table_name"), "n_rows"),
    using("gold_corridors", "SELECT 'high_risk_corridors' AS table_name, count(*) AS n_rows FROM gold_corridors"))

# ---- masks -----------------------------------------------------------------
EMP = "SELECT employee_id, name, birth_date, ssn, department, salary FROM fx_employees"


def masked(*replaced: str) -> str:
    return using("fx_employees", "SELECT * REPLACE (" + ", ".join(replaced) + ") FROM fx_employees")


DATE_MASK, SSN_MASK, PAY_MASK = "DATE '1900-01-01' AS birth_date", "'***-**-****' AS ssn", "'REDACTED' AS salary"
add("m01_date_mask", lambda i: masking.apply_masks(i.fx("employees"), {"birth_date": masking.date_mask}), masked(DATE_MASK))
add("m02_text_mask", lambda i: masking.apply_masks(i.fx("employees"), {"ssn": masking.ssn_mask}), masked(SSN_MASK))
add("m03_redact", lambda i: masking.apply_masks(i.fx("employees"), {"salary": masking.redact}), masked(PAY_MASK))


@query("m04_attach_and_detach", masked(SSN_MASK, PAY_MASK))
def _(i):
    """Three masks are stored with the table, one is taken off again; the view that readers know shows the rest."""
    database = own_database(i)
    table, view = f"{database}.employees_held", f"{database}.employees"
    save_table(i.fx("employees"), table)
    for column, expression in masking.EMPLOYEE_SQL.items():
        masking.attach_mask(i.spark, table, view, column, expression)
    masking.detach_mask(i.spark, table, view, "birth_date")
    return i.spark.table(view)


add("m05_raw_read", lambda i: i.fx("employees"), using("fx_employees", EMP))


# ---- SQL functions ---------------------------------------------------------
@query("u01_sql_function", masked(DATE_MASK, SSN_MASK))
def _(i):
    i.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION hide_date(d DATE) RETURNS DATE RETURN DATE '1900-01-01'")
    i.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION hide_ssn(s STRING) RETURNS STRING RETURN '***-**-****'")
    return i.fx("employees").withColumns({"birth_date": F.expr("hide_date(birth_date)"), "ssn": F.expr("hide_ssn(ssn)")})


@query("u02_drop_function", "SELECT count(*) AS n, false AS still_there FROM customer")
def _(i):
    i.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION hide_text(s STRING) RETURNS STRING RETURN 'REDACTED'")
    i.spark.sql("DROP TEMPORARY FUNCTION IF EXISTS hide_text")
    return i.table("customer").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "still_there", F.lit(i.spark.catalog.functionExists("hide_text")))


add("u04_cells_without_row_apply", lambda i: i.located.select("incident_id", "h3_index_r8"),
    using("cells_8", "SELECT incident_id, h3_index_r8 FROM cells_8"))
