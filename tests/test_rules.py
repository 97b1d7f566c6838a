"""Edges of the business rules: band limits, NULLs, zero denominators, copies."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from carriageway.functions import rules, text, times
from carriageway.plans import gold, modelled, silver


def one(spark, column, **values):
    schema = ", ".join(f"{k} {v[0]}" for k, v in values.items())
    df = spark.createDataFrame([tuple(v[1] for v in values.values())], schema)
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("score, tier", [
    (70.0, "Priority 1 – Immediate"), (69.9, "Priority 2 – Near Term"), (45.0, "Priority 2 – Near Term"),
    (44.9, "Priority 3 – Planned"), (20.0, "Priority 3 – Planned"), (19.9, "Priority 4 – Monitor"), (None, "Priority 4 – Monitor"),
])
def test_priority_edges(spark, score, tier):
    assert one(spark, silver.priority_tier("s"), s=("double", score)) == tier


@pytest.mark.parametrize("iri, band", [(60, "Very Good"), (61, "Good"), (95, "Good"), (96, "Fair"), (170, "Fair"),
                                       (171, "Mediocre"), (220, "Mediocre"), (221, "Poor"), (None, "Poor")])
def test_roughness_edges(spark, iri, band):
    assert one(spark, rules.banded("x", "<=", silver.ROUGHNESS_BANDS, "Poor"), x=("int", iri)) == band


def test_three_critical_parts_are_good(spark):
    df = spark.createDataFrame(
        [("C - Critical",) * 3, ("G - Good", "F - Fair", None), ("P - Poor", "F - Fair", "G - Good"), (None, None, None)],
        "deck_condition string, superstructure_condition string, substructure_condition string")
    assert [r[0] for r in df.select(silver.worst_condition()).collect()] == ["Good", "Fair", "Poor", "Good"]


def test_rounding_is_half_up_on_decimal_text(spark):
    assert one(spark, rules.rounded("x", 2), x=("double", 1.005)) == 1.01
    assert one(spark, rules.rounded("x", 1), x=("double", -0.25)) == -0.3
    assert one(spark, rules.rounded_total("x", 2), x=("double", 1e15 + 0.125)) == pytest.approx(1e15 + 0.13, abs=0.01)


def test_zero_and_null_denominators(spark):
    assert one(spark, rules.ratio("a", "b"), a=("int", 3), b=("int", 0)) is None
    assert one(spark, rules.ratio("a", "b"), a=("int", 3), b=("int", None)) is None
    assert one(spark, rules.guarded_ratio("a", "b", F.lit(0.0)), a=("int", 3), b=("int", 0)) == 0
    assert one(spark, rules.change_pct("a", "b"), a=("int", 3), b=("int", 0)) is None
    assert one(spark, rules.trend_arrow("a", "b"), a=("int", 3), b=("int", None)) == "▼"


@pytest.mark.parametrize("word, flag", [("TRUE", True), (" yes ", True), ("1", True), ("t", True), ("no", False), (None, False)])
def test_text_flags(spark, word, flag):
    assert one(spark, text.means_true("w"), w=("string", word)) is flag


def test_capture_without_match_is_null(spark):
    assert one(spark, text.captured("w", r"(\d+)"), w=("string", "none")) is None
    assert one(spark, text.numeric("w"), w=("string", "12.5x")) is None


def test_overdue_starts_after_730_days(spark):
    assert one(spark, times.days_since("d"), d=("timestamp_ntz", datetime(2023, 1, 1, 5))) == 730
    assert one(spark, times.is_weekend("d"), d=("date", date(2024, 12, 29))) is True


INCIDENT = (
    "incident_id string, incident_type string, severity string, incident_datetime timestamp_ntz, state_code string, "
    "county_code string, route_id string, road_condition string, weather_condition string, fatalities int, injuries int, "
    "vehicles_involved int, status string, latitude double, longitude double"
)


def incident(key, when=datetime(2024, 1, 6, 23, 0), dead=0, hurt=1, severity=" Fatal "):
    return (key, " dui", severity, when, "nc", "C1", "R1", "Dry", "Rain", dead, hurt, 2, "Closed", 35.2, -80.8)


def test_silver_drops_nulls_and_copies(spark):
    raw = spark.createDataFrame(
        [incident("a"), incident("a"), incident(None), incident("b", when=None), incident("c", dead=None)], INCIDENT)
    rows = {r["incident_id"]: r for r in silver.silver_incidents(raw).collect()}
    assert set(rows) == {"a", "c"}
    a, c = rows["a"], rows["c"]
    assert (a["incident_type"], a["severity"], a["severity_score"], a["is_weekend"]) == ("DUI", "Fatal", 5, True)
    assert c["has_fatality"] is False and c["total_casualties"] is None
    assert a["silver_timestamp"] is not None


def test_second_variant_counts_unknown_as_zero_and_keeps_copies(spark):
    raw = spark.createDataFrame([incident("a"), incident("a"), incident("c", dead=None)], INCIDENT)
    rows = modelled.model_incidents(raw).collect()
    assert len(rows) == 3
    assert [r["total_casualties"] for r in rows if r["incident_id"] == "c"] == [1]
    again = modelled.model_incidents(modelled.model_incidents(raw, stamp=False), stamp=False)
    assert sorted(again.collect()) == sorted(modelled.model_incidents(raw, stamp=False).collect())


def test_rank_shares_places(spark):
    rows = [incident(str(k), dead=d, severity="Fatal")[:5] + (f"C{k}",) + incident(str(k), dead=d)[6:] for k, d in enumerate([5, 5, 3, 0])]
    ranked = gold.high_risk_corridors(silver.silver_incidents(spark.createDataFrame(rows, INCIDENT)))
    assert sorted(r["state_rank"] for r in ranked.collect()) == [1, 1, 3, 4]


def test_scorecard_is_driven_from_incidents(spark):
    inc = silver.silver_incidents(spark.createDataFrame([incident("a", dead=2)], INCIDENT))
    brg = spark.createDataFrame([("b1", "VA", 50.0, "true")], "bridge_id string, state_code string, sufficiency_rating double, structurally_deficient string")
    pav = spark.createDataFrame([("s1", "NC", 0.0, 80.0, "Poor")], "segment_id string, state_code string, segment_length_mi double, pcr double, condition_rating string")
    veh = spark.createDataFrame([("v", "NC", True)], "vin string, state_code string, is_electric boolean")
    card = gold.executive_scorecard(inc, brg, pav, veh).collect()
    assert [r["state_code"] for r in card] == ["NC"]
    assert card[0]["total_bridges"] is None and card[0]["poor_pavement_pct"] is None
    assert card[0]["fatality_per_100k_vehicles"] == 200000.0
