import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scanweave.constants import BAGGAGE
from scanweave.operators.contract import STRICT_CONTRACT, Contract, split_by_contract
from scanweave.operators.tables import with_date_parts
from scanweave.schemas import dead_letter_schema, event_schema
from scanweave.sources.messages import decode_events
from scanweave.sources.tables import read_declared, write_partitioned
from scanweave.streaming.tracking import ingest

TIME = "2026-05-20T12:00:00.123456+00:00"


def bag(**changes):
    fields = {
        "event_id": "e1",
        "airline_code": "AC",
        "bag_tag_number": "0014000001",
        "pnr_locator": "ABC123",
        "flight_number": "AC800",
        "event_timestamp": TIME,
        "location_id": "L",
        "vendor_system_id": "undeclared",
    }
    return json.dumps(fields | changes)


CASES = {
    "spaces": (bag(pnr_locator=" ABC123 "), "ABC123", True),
    "null": (bag(pnr_locator=None), None, False),
    "empty": (bag(pnr_locator=""), "", False),
    "upper placeholder": (bag(pnr_locator="UNKNOWN"), "UNKNOWN", False),
    "lower placeholder": (bag(pnr_locator="unknown"), "unknown", False),
    "bad time": (bag(event_timestamp="garbage"), "ABC123", True),
    "legacy": ('{"raw_legacy_bhs_message": "BPM|AC|1|X", "system_timestamp": "t"}', None, False),
    "not json": ("not json", None, False),
    "null value": (None, None, False),
    "number": (bag(pnr_locator=123456), "123456", True),
    "tab": (bag(pnr_locator="\tABC12"), "\tABC12", True),
    "lower case": (bag(pnr_locator="abc123"), "abc123", True),
    "array": (f"[{bag()}]", None, False),
}


@pytest.fixture(scope="module")
def messages(spark):
    rows = [(name, value and value.encode()) for name, (value, _, _) in CASES.items()]
    return spark.createDataFrame(rows, "name string, value binary").repartition(1)


def test_contract_truth_table(messages):
    split = ingest(messages, BAGGAGE, keep_raw=True)
    valid = {row.raw_value: row.pnr_locator for row in split.valid.collect()}
    dead = {row.raw_value: row for row in split.dead.collect()}
    for name, (value, locator, passes) in CASES.items():
        assert (value in valid) == passes, name
        assert (value in dead) != passes, name
        assert (valid[value] if passes else dead[value].pnr_locator) == locator, name
    assert {row.error_reason for row in dead.values()} == {"FAILED_PNR_CONTRACT"}


def test_decoding_keeps_declared_columns_only(messages):
    decoded = decode_events(messages, BAGGAGE)
    assert decoded.columns == event_schema(BAGGAGE).names
    assert decoded.count() == len(CASES)
    times = decoded.filter("pnr_locator = 'ABC123'").selectExpr(
        "cast(event_timestamp as string) t", "location_id"
    )
    assert {tuple(row) for row in times.collect()} == {("2026-05-20 12:00:00.123456", "L"), (None, "L")}


def test_bad_field_nulls_that_field_only(messages):
    row = decode_events(messages, BAGGAGE, keep_raw=True).filter("raw_value like '%garbage%'").first()
    assert row.event_timestamp is None and row.location_id == "L" and row.flight_number == "AC800"


def test_strict_contract_quarantines_missing_times(messages):
    split = ingest(messages, BAGGAGE, contract=STRICT_CONTRACT, keep_raw=True)
    reasons = {row.raw_value: row.error_reason for row in split.dead.collect()}
    assert reasons[CASES["bad time"][0]] == "MISSING_EVENT_TIME"
    assert reasons[CASES["null"][0]] == "FAILED_PNR_CONTRACT"
    assert split.valid.filter("event_timestamp is null").count() == 0
    assert split.valid.count() + split.dead.count() == len(CASES)


def test_contract_on_another_column(spark):
    df = spark.createDataFrame([("A1",), ("n/a",), ("N/A",), (None,)], "code string")
    contract = Contract(column="code", length=3, placeholders=("n/a",), reason="CODE")
    assert [row.code for row in split_by_contract(df, contract).valid.collect()] == ["N/A"]
    split = split_by_contract(df, replace(contract, ignore_case=True))
    assert split.valid.count() == 0 and split.dead.count() == 4


def test_unknown_kind_is_an_error(messages):
    with pytest.raises(ValueError, match="unknown stream kind"):
        decode_events(messages, "CARGO")


def test_each_message_is_parsed_once(messages):
    plan = ingest(messages, BAGGAGE).valid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_dead_letters_without_time_land_in_the_default_partition(spark, messages, tmp_path):
    dead = with_date_parts(ingest(messages, BAGGAGE).dead, "event_timestamp")
    path = str(tmp_path / "dead")
    write_partitioned(dead, path)
    assert (tmp_path / "dead/year=__HIVE_DEFAULT_PARTITION__/month=__HIVE_DEFAULT_PARTITION__").exists()
    back = read_declared(spark, path, dead_letter_schema(BAGGAGE))
    assert back.count() == dead.count()
    assert back.filter(F.col("year").isNull()).count() == dead.filter("event_timestamp is null").count()
