"""Every query of the core catalogue against its SQL twin on the smallest data set."""

import pytest

import __spark_entry__ as driver
import compare
from scanweave.plans.catalogue import all_queries
from scanweave.plans.oracles import all_oracles

FOLDER = "/root/testdata/sf0.001"
QUERIES = all_queries()
ORACLES = all_oracles()


def test_driver_registers_the_catalogue():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    ours = compare.spark_rows(QUERIES[name](spark, FOLDER))
    theirs = compare.duckdb_rows(ORACLES[name], FOLDER)
    assert ours == theirs


def test_entry_gives_twelve_groups(spark):
    assert driver.entry(spark).count() == 12


@pytest.mark.parametrize(
    "name, rows",
    [
        ("contract_valid_baggage", 910 - 375),
        ("dedupe_baggage", 447),
        ("dedupe_passenger", 309),
        ("silver_tracking", 72),
        ("check_relationship_silver", 5),
    ],
)
def test_known_counts(spark, name, rows):
    if name == "contract_valid_baggage":
        both = QUERIES[name](spark, FOLDER).count() + QUERIES["contract_valid_passenger"](
            spark, FOLDER
        ).count()
        assert both == 910
    else:
        assert QUERIES[name](spark, FOLDER).count() == rows


def test_valid_and_dead_make_up_the_input(spark):
    counts = [
        QUERIES[f"contract_{side}_{kind}"](spark, FOLDER).count()
        for side in ("valid", "dead_letter")
        for kind in ("baggage", "passenger")
    ]
    assert sum(counts) == 1200


def test_intervals_lie_within_the_join_bounds(spark):
    low, high = (
        QUERIES["silver_tracking"](spark, FOLDER)
        .selectExpr("min(scan_to_board_interval_minutes)", "max(scan_to_board_interval_minutes)")
        .first()
    )
    assert -180 <= low and high <= 60
