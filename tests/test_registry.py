"""Every registered query against its check SQL, at the smallest scale."""

import pytest
from compare import DATA, differences

from carriageway.registry import ORACLES, QUERIES

# Nothing to find in so few rows; both engines must then agree on nothing.
MAY_BE_EMPTY = {"p16_work_zone_conflicts", "r12_work_zone_actions", "r13_sensor_gaps", "j05_cell_and_time_range",
                "g19_zone_conflicts", "r19_extreme_hotspots", "d06_new_keys", "q09_no_future_test", "g22_coverage_gap"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_check_sql(spark, oracle, name):
    problems = differences(spark, oracle, QUERIES[name], ORACLES[name])
    if name in MAY_BE_EMPTY:
        problems = [p for p in problems if p != "no rows at all"]
    assert not problems


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


# Boosted models of full size; ``test_models`` holds the same functions against fixtures.
LONG = {"l09_cross_validation", "l11_risk_regressor", "l13_wear_boosted"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES and n not in LONG])
def test_rows_only(spark, name):
    df = QUERIES[name](spark, DATA)
    assert df.count() > 0


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert entry.queries().keys() >= QUERIES.keys()
    assert entry.oracle_sql().keys() >= ORACLES.keys()
