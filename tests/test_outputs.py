"""Column tests over our own marts, plans, metrics, sources."""

import datetime
import random
import uuid

import pytest
from compare import DATA
from pyspark.sql import functions as F

from carriageway.functions.times import AS_OF, at_midnight
from carriageway.operators import masking, metrics, quality
from carriageway.operators.profiling import category_drift, profile
from carriageway.registry import QUERIES
from carriageway.registry.core import Inputs
from carriageway.session import shared_dir
from carriageway.sources import schemas, sinks, tables


@pytest.fixture(scope="module")
def i(spark):
    return Inputs(spark, DATA)


@pytest.mark.parametrize("table, key", [("incidents", "incident_id"), ("bridges", "bridge_id"), ("vehicles", "vin"), ("pavement", "segment_id")])
def test_silver_keys(i, table, key):
    df = getattr(i, table)
    assert quality.null_rows(df, key).count() == 0
    assert quality.repeated_keys(df, key).count() == 0


@pytest.mark.parametrize("mart, columns", [
    ("summary", ["total_incidents", "total_fatalities", "fatality_rate"]), ("corridors", ["incident_count", "state_rank"]),
    ("health", ["bridge_count", "deficiency_rate"]), ("needs", ["segment_count", "cost_per_aadt"]), ("cells", ["incident_count"]),
])
def test_gold_measures_present_and_not_negative(i, mart, columns):
    for column in columns:
        assert quality.null_rows(getattr(i, mart), column).count() == 0
        assert quality.negative_rows(getattr(i, mart), column).count() == 0


def test_no_future_incidents(i):
    assert quality.future_rows(i.incidents, "incident_datetime", at_midnight(AS_OF)).count() == 0


PLANNED = [n for n in QUERIES if n[0] in "pgrjw" and not n.startswith(("p17", "p18", "p19", "p20", "p28"))]


@pytest.mark.parametrize("name", PLANNED)
def test_no_nested_loop_no_python(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Python" not in plan and "ArrowEval" not in plan
    # Only a one-row scalar could be looped over, and no query needs one.
    assert "BroadcastNestedLoopJoin" not in plan


def test_filter_and_columns_reach_the_scan(spark):
    plan = QUERIES["src02_scan_filter_columns"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity" in plan and "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan.replace("l_orderkey:bigint,l_linenumber:int,l_quantity:double", "l_orderkey:bigint,l_linenumber:int,l_quantity:double")


def test_masked_columns_are_not_read(i):
    plan = masking.apply_masks(i.table("customer"), {"c_acctbal": masking.redact})._jdf.queryExecution().executedPlan().toString()
    assert "c_acctbal:double" not in plan


def test_auc_and_precision_against_pairs(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), rng.choice([0.1, 0.25, 0.5, 0.5001, rng.random()])) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score double")
    pos, neg = [s for l, s in rows if l], [s for l, s in rows if not l]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(df, "label", "score").first()[0] == pytest.approx(won)
    precision, seen_pos = 0.0, 0
    for s in sorted({s for _, s in rows}, reverse=True):
        hit = sum(1 for l, v in rows if v == s and l)
        seen = sum(1 for _, v in rows if v >= s)
        seen_pos += hit
        precision += hit / len(pos) * seen_pos / seen
    assert metrics.average_precision(df, "label", "score").first()[0] == pytest.approx(precision)


def test_check_rate_of_an_empty_table(spark):
    out = quality.run_checks(spark.createDataFrame([], "a int"), "d", [quality.Check("c", "a < 0")]).first()
    assert (out["total_rows"], out["bad_rate"], out["status"]) == (0, 0.0, "PASS")


def test_drift_of_equal_snapshots_is_zero(i):
    nation = i.table("nation")
    out = category_drift(nation, nation, ["n_regionkey"]).first()
    assert out["tv_distance"] == 0 and out["categories"] == 5


def test_profile_sketch_form(i):
    rows = {r["column_name"]: r for r in profile(i.table("orders"), ["o_totalprice", "o_orderstatus"]).collect()}
    assert rows["o_orderstatus"]["distinct_count"] == 3 and rows["o_orderstatus"]["mean_value"] is None
    assert rows["o_totalprice"]["min_value"] <= rows["o_totalprice"]["median_value"] <= rows["o_totalprice"]["max_value"]


def test_declared_schemas():
    for name in schemas.TABLES:
        schema = schemas.declared(name)
        assert not schema.fields[0].nullable
        assert all(p in schema.fieldNames() for p in schemas.PARTITIONS.get(name, []))
    assert len(schemas.declared("bridge_inspections").fields) == 25


def test_partition_pruning(spark, i):
    path = shared_dir(spark, "parts")
    sinks.overwrite(i.table("orders"), path, ["o_orderstatus"])
    plan = tables.scan(spark, path, ["o_orderkey"], F.col("o_orderstatus") == "F")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan


def test_missing_sources_are_reported(spark):
    with pytest.raises(FileNotFoundError):
        tables.first_available(spark, ["/nowhere/a", "/nowhere/b"])


def test_bridge_overlay_takes_the_verified_table_first(spark, i):
    from pyspark.sql import functions as F

    from carriageway.functions.cells import hex_cell
    from carriageway.plans import geo

    folder, zones = shared_dir(spark, "overlay"), i.fx("zones")
    silver = i.bridges.limit(50)
    sinks.overwrite(silver, f"{folder}/silver")
    sinks.overwrite(silver.limit(20).withColumns({"h3_index_r7": hex_cell("latitude", "longitude", 7), "geometry_wkt": F.lit("POINT (0 0)")}), f"{folder}/verified")
    made = [geo.bridges_with_zone(geo.bridge_source(spark, f"{folder}/{first}", f"{folder}/silver"), zones, stamp=False) for first in ("verified", "missing")]
    assert [df.select("bridge_id").distinct().count() for df in made] == [20, 50]
    assert {r[0] for r in made[0].select("geometry_wkt").collect()} == {"POINT (0 0)"}
    assert made[1].where("geometry_wkt IS NULL OR geometry_wkt = 'POINT (0 0)'").count() == 0


def test_geojson_skips_blank_geometry_and_keeps_properties(spark):
    df = spark.createDataFrame([(1, "POINT (1 2)"), (2, ""), (3, None), (4, "POLYGON ((0 0, 1 0, 1 1, 0 0))")], "id int, w string")
    rows = [r["value"] for r in sinks.features(df, "w").collect()]
    assert rows[0] == '{"type":"Feature","geometry":{"type":"Point","coordinates":[1.0,2.0]},"properties":{"id":1}}'
    assert len(rows) == 2 and '"coordinates":[[[0.0,0.0],' in rows[1]


def test_a_write_is_counted_by_its_own_files(spark):
    from pyspark.sql import functions as F

    path = shared_dir(spark, "logged")
    for _ in range(2):
        row = sinks.write_logged(spark.range(7).withColumnRenamed("id", "k"), path, "APPEND", F.lit("now"), sinks.append).first()
        assert tuple(row) == ("APPEND", 7, "k", "now")
    assert spark.read.parquet(path).count() == 14


def test_comments_may_hold_quotes(spark):
    name = "t_" + shared_dir(spark, "x").rpartition("-")[2]
    sinks.save_table(spark.range(3), name)
    sinks.describe(spark, name, "it's a \\ table", {"id": "the key's"})
    assert spark.catalog.getTable(name).description == "it's a \\ table"
    spark.sql(f"DROP TABLE {name}")


def test_rate_counts_only_segments_with_traffic(spark):
    from carriageway.functions.cells import hex_cell
    from carriageway.plans import geo

    placed = spark.createDataFrame([("i1", 35.5, -79.0, 0, 0, 1.0, False)], "incident_id string, latitude double, longitude double, fatalities int, injuries int, severity_score double, has_fatality boolean")
    enriched = placed.withColumn("h3_index_r8", hex_cell("latitude", "longitude", 8))
    segs = spark.createDataFrame([("r", "f", "a", 1000, 35.5, -79.0), ("r", "f", "a", None, 35.5, -79.0)], "route_id string, functional_class string, area_type string, aadt int, lat double, lon double")
    out = geo.corridor_safety(enriched, segs.withColumn("h3_index_r8", hex_cell("lat", "lon", 8)), stamp=False).first()
    assert out["reference_aadt"] == 1000


def test_silver_table_is_pruned_by_partition(i):
    from carriageway.registry.job_queries import run_layers

    table = i.spark.table(f"{run_layers(i, 2)}.silver_traffic_incidents")
    plan = table.where("state_code = 'NC' AND incident_year = 2023").select("incident_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state_code" in plan and "incident_year" in plan.split("PartitionFilters")[1]


def test_statistics_come_from_the_catalog(spark, i):
    got = {r["column_name"]: r for r in QUERIES["snk15_distinct_counts"](spark, DATA).collect()}
    exact = i.table("orders").agg(*[F.countDistinct(c).alias(c) for c in got]).first()
    assert all(abs(got[c]["n_distinct"] - exact[c]) <= 0.1 * exact[c] for c in got)
    name = f"marts_{uuid.uuid4().hex[:12]}"
    sinks.ensure_database(spark, name, shared_dir(spark, name))
    sinks.save_table(spark.range(10).withColumn("v", F.when(F.col("id") > 6, F.col("id"))), f"{name}.t")
    assert {r["n_null"] for r in sinks.column_statistics(spark, f"{name}.t").collect()} == {None}  # nothing is known before
    sinks.analyze(spark, f"{name}.t")
    assert sorted(map(tuple, sinks.column_statistics(spark, f"{name}.t").collect())) == [("id", 0.0, 9.0, 0, 10), ("v", 7.0, 9.0, 7, 3)]


def test_interleaved_files_are_skipped_by_the_second_column(spark):
    got = {(r["order"], r["column"]): r["met"] for r in QUERIES["snk16_files_to_read"](spark, DATA).collect()}
    assert got["interleaved", "o_totalprice"] < got["linear", "o_totalprice"] / 2
    assert got["interleaved", "o_custkey"] <= 8
    texts = spark.createDataFrame([(f"{chr(97 + k % 26)}{k}", datetime.date(2024, 1, 1 + k % 28)) for k in range(500)] + [(None, None)], "a string, b date")
    assert sinks.clustered_by_all(texts, ["a", "b"], 4).count() == 501


def test_masks_stay_with_the_table(spark):
    database = f"marts_{uuid.uuid4().hex[:12]}"
    sinks.ensure_database(spark, database, shared_dir(spark, database))
    table, view = f"{database}.held", f"{database}.people"
    sinks.save_table(spark.createDataFrame([(1, "123-45-6789", 'say "hi"')], "id int, ssn string, note string"), table)
    masking.attach_mask(spark, table, view, "ssn", masking.EMPLOYEE_SQL["ssn"])
    masking.attach_mask(spark, table, view, "note", "concat('it''s ', \"masked\")")
    reader = spark.newSession()  # knows the view by name only
    assert tuple(reader.table(view).first()) == (1, "***-**-****", "it's masked")
    assert masking.policy_of(reader, table).keys() == {"ssn", "note"}
    masking.detach_mask(reader, table, view, "ssn")
    assert tuple(spark.table(view).first()) == (1, "123-45-6789", "it's masked")
    with pytest.raises(ValueError):
        masking.attach_mask(spark, table, view, "none", "1")
