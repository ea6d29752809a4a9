"""Dedupe and interval join against brute force, with hot keys and hot copies."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from scanweave.operators.dedupe import drop_repeats, drop_repeats_within_batches
from scanweave.operators.interval_join import (
    _deal_hot_keys,
    hot_keys,
    interval_join,
    match_scans,
)
from scanweave.session import session_conf

START = datetime(2026, 5, 20)
BEFORE, AFTER = timedelta(hours=3), timedelta(hours=1)


def rows(count, seed, hot_share=1 / 3, days=3):
    """(key, id, time): a third of the rows share one key."""
    dice = random.Random(seed)
    return [
        (
            "hot" if dice.random() < hot_share else f"k{dice.randrange(40)}",
            number,
            START + timedelta(minutes=15 * dice.randrange(days * 96)),
        )
        for number in range(count)
    ]


def brute_force(left, right):
    pairs = Counter()
    for key, left_id, left_time in left:
        for other, right_id, right_time in right:
            if key == other and right_time - BEFORE <= left_time <= right_time + AFTER:
                pairs[(key, left_id, right_id)] += 1
    return pairs


@pytest.fixture(scope="module")
def sides():
    return rows(900, seed=1), rows(400, seed=2)


def joined(spark, sides, **options):
    left = spark.createDataFrame(sides[0], "key string, left_id long, left_time timestamp")
    right = spark.createDataFrame(sides[1], "key string, right_id long, right_time timestamp")
    if options.pop("deal", False):
        options |= {"hot": hot_keys(left, ["key"], 0.1), "spread": 5}
    return interval_join(left, right, ["key"], "left_time", "right_time", BEFORE, AFTER, **options)


def pairs(df):
    return Counter((row.key, row.left_id, row.right_id) for row in df.collect())


@pytest.mark.parametrize(
    "options",
    [{}, {"cell": timedelta(minutes=45)}, {"cell": timedelta(days=2)}, {"deal": True}],
    ids=["default", "narrow cells", "wide cells", "hot key dealt"],
)
def test_join_equals_brute_force(spark, sides, options):
    assert pairs(joined(spark, sides, **options)) == brute_force(*sides)


def test_join_equals_brute_force_when_aqe_splits_a_hot_cell(spark):
    # Every row in one hour, a third under one key: the cell itself is hot.
    sides = rows(6000, seed=3, days=1), rows(60, seed=4, days=1)
    sides = tuple([(k, i, START + (t - START) / 24) for k, i, t in side] for side in sides)
    with session_conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2.0",
    ):
        left = spark.createDataFrame(sides[0], "key string, left_id long, left_time timestamp")
        right = spark.createDataFrame(sides[1], "key string, right_id long, right_time timestamp")
        result = interval_join(
            left.repartition(8), right, ["key"], "left_time", "right_time", BEFORE, AFTER
        )
        assert pairs(result) == brute_force(*sides)
        plan = result._jdf.queryExecution().executedPlan().toString()
    assert "skewed" in plan


minutes = st.integers(-300, 300).map(lambda n: timedelta(minutes=n))
side = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), minutes)), max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(side, side, st.integers(-60, 120), st.integers(60, 180), st.sampled_from([None, 7, 60, 5000]))
def test_join_equals_brute_force_on_any_input(spark, left, right, before, after, cell):
    epoch = datetime(1970, 1, 1)
    before, after = timedelta(minutes=before), timedelta(minutes=after)
    left, right = (
        [(key, number, shift if shift is None else epoch + shift) for number, (key, shift) in enumerate(rows)]
        for rows in (left, right)
    )
    expected = Counter(
        (key, i, j)
        for key, i, at in left
        for other, j, then in right
        if key is not None and key == other and None not in (at, then) and then - before <= at <= then + after
    )
    result = interval_join(
        spark.createDataFrame(left, "key string, left_id long, left_time timestamp_ntz"),
        spark.createDataFrame(right, "key string, right_id long, right_time timestamp_ntz"),
        ["key"],
        "left_time",
        "right_time",
        before,
        after,
        cell=cell and timedelta(minutes=cell),
    )
    assert pairs(result) == expected


def test_zero_interval_matches_equal_times(spark):
    left = spark.createDataFrame([("k", 1, START), ("k", 2, START + AFTER)], "key string, left_id long, left_time timestamp")
    right = spark.createDataFrame([("k", 1, START)], "key string, right_id long, right_time timestamp")
    none = timedelta(0)
    assert pairs(interval_join(left, right, ["key"], "left_time", "right_time", none, none)) == {("k", 1, 1): 1}


def test_both_ends_are_inclusive(spark):
    boarding = datetime(2026, 5, 20, 12, 30)
    micro = timedelta(microseconds=1)
    times = [boarding - BEFORE - micro, boarding - BEFORE, boarding + AFTER, boarding + AFTER + micro]
    left = [("k", number, time) for number, time in enumerate(times)]
    assert pairs(joined(spark, (left, [("k", 0, boarding)]))) == {("k", 1, 0): 1, ("k", 2, 0): 1}


def test_rows_without_time_or_key_do_not_match(spark):
    left = [("k", 1, None), (None, 2, START)]
    assert joined(spark, (left, [("k", 1, START), (None, 2, START), ("k", 3, None)])).count() == 0


def test_hot_keys_hold_more_than_their_share(spark, sides):
    left = spark.createDataFrame(sides[0], "key string, left_id long, left_time timestamp")
    assert [row.key for row in hot_keys(left, ["key"], 0.1)] == ["hot"]
    counts = Counter(key for key, _, _ in sides[0])
    expected = {key for key, count in counts.items() if count > 0.02 * len(sides[0])}
    assert {row.key for row in hot_keys(left, ["key"], 0.02)} == expected
    assert hot_keys(left.limit(0), ["key"]) == []


def test_equal_scans_of_a_hot_key_are_dealt_over_lanes(spark):
    scans = spark.createDataFrame([("k", number, START) for number in range(200)], "key string, id long, t timestamp")
    right = spark.createDataFrame([("k", START)], "key string, right_time timestamp")
    dealt, repeated = _deal_hot_keys(scans, right, ["key"], [("k",)], 8)
    lanes = Counter(row._lane for row in dealt.collect())
    assert sorted(lanes) == list(range(8)) and max(lanes.values()) < 60
    assert sorted(row._lane for row in repeated.collect()) == list(range(8))


def test_a_key_heavy_on_both_sides_is_dealt_over_a_grid(spark):
    scans = spark.createDataFrame([("k", number, START) for number in range(200)], "key string, id long, t timestamp")
    right = spark.createDataFrame([("k", number, START) for number in range(90)], "key string, other long, u timestamp")
    options = {"hot": [("k",)], "spread": 4, "spread_right": 3}
    dealt, repeated = _deal_hot_keys(scans, right, ["key"], options["hot"], 4, 3)
    lanes = Counter(row._lane for row in dealt.collect()), Counter(row._lane for row in repeated.collect())
    assert all(sorted(side) == list(range(12)) for side in lanes)
    assert max(lanes[0].values()) < 80 and max(lanes[1].values()) < 50
    joined = interval_join(scans, right, ["key"], "t", "u", BEFORE, AFTER, **options)
    assert joined.count() == joined.select("id", "other").distinct().count() == 200 * 90


def test_hot_keys_are_bounded(spark, sides):
    left = spark.createDataFrame(sides[0], "key string, left_id long, left_time timestamp")
    with pytest.raises(ValueError, match="share"):
        hot_keys(left, ["key"], 0.0)
    with pytest.raises(ValueError, match="hot keys"):
        interval_join(
            left, left, ["key"], "left_time", "left_time", BEFORE, AFTER, hot=[("k",)] * 10_001
        )


EVENT = "event_id string, event_timestamp timestamp, pnr_locator string"


def test_dedupe_keeps_one_row_per_key(spark):
    later = START + timedelta(seconds=1)
    events = (
        [("a", START, "P")] * 300  # a group of copies larger than everything else
        + [("a", later, "P"), ("b", START, None), ("b", START, "Q"), (None, None, "R"), (None, None, "R")]
    )
    df = spark.createDataFrame(events, EVENT).repartition(4)
    kept = drop_repeats(df)
    assert kept.columns == df.columns
    assert {tuple(row) for row in kept.collect()} == {
        ("a", START, "P"), ("a", later, "P"), ("b", START, "Q"), (None, None, "R")
    }


def test_dedupe_shrinks_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", START, "P")], EVENT)
    plan = drop_repeats(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_dedupe_of_key_columns_alone(spark):
    df = spark.createDataFrame([("a", START), ("a", START)], "event_id string, event_timestamp timestamp")
    assert drop_repeats(df).count() == 1


def test_thinning_is_exact_within_batches(spark):
    events = [("a", START, "P")] * 50 + [("b", None, "Q")] * 2 + [(None, START, "R")] * 2
    df = spark.createDataFrame(events, EVENT).coalesce(1)
    thinned = drop_repeats_within_batches(df, ["event_id", "event_timestamp"])
    assert thinned.schema == df.schema
    assert sorted(row.pnr_locator for row in thinned.collect()) == ["P", "Q", "R"]


def test_matching_is_many_to_many(spark):
    def at(hours):
        return START + timedelta(hours=hours)

    bags = spark.createDataFrame(
        [(f"b{n}", at(n), "P00001", "AC1", "T1", "B", "AC") for n in range(2)],
        "event_id string, event_timestamp timestamp, pnr_locator string, flight_number string, "
        "bag_tag_number string, location_id string, airline_code string",
    )
    boardings = spark.createDataFrame(
        [(f"p{n}", at(1 + n / 2), "P00001", "AC1", "G") for n in range(2)],
        "event_id string, event_timestamp timestamp, pnr_locator string, flight_number string, gate_id string",
    )
    matched = match_scans(bags, boardings)
    assert matched.count() == 4
    assert matched.columns == [
        "pnr_locator", "flight_number", "bag_tag_number", "baggage_location", "passenger_gate",
        "baggage_time", "passenger_time",
    ]


def test_unused_columns_are_not_shuffled(spark):
    bags = spark.createDataFrame(
        [], "event_id string, event_timestamp timestamp, pnr_locator string, flight_number string, "
        "bag_tag_number string, location_id string, airline_code string"
    )
    boardings = spark.createDataFrame(
        [], "event_id string, event_timestamp timestamp, pnr_locator string, flight_number string, "
        "gate_id string, airline_code string"
    )
    plan = match_scans(bags, boardings).groupBy("flight_number").agg(F.count("*"))
    steps = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    holders = [step for step in steps if "airline_code" in step]
    assert holders and all("LogicalRDD" in step or "LocalRelation" in step for step in holders)
