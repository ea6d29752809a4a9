from decimal import Decimal

from pyspark.sql import functions as F

from scanweave.functions import conform_text, minutes_from_seconds, seconds_between, time_cell
from scanweave.operators.tables import performance, ranked, tracking, with_date_parts, with_lateness
from datetime import timedelta


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def stamp(text):
    return F.lit(text).cast("timestamp")


def test_seconds_count_boundaries(spark):
    seconds = seconds_between(stamp("2026-01-01 00:00:00.9"), stamp("2026-01-01 00:01:01.1"))
    assert one(spark, seconds) == 61


def test_seconds_are_negative_when_the_scan_came_first(spark):
    seconds = seconds_between(stamp("2026-01-01 00:01:00"), stamp("2026-01-01 00:00:59.5"))
    assert one(spark, seconds) == -1


def test_minutes_have_six_places(spark):
    assert one(spark, minutes_from_seconds(F.lit(100))) == Decimal("1.666667")


def test_rounding_is_half_away_from_zero(spark):
    assert one(spark, F.round(F.lit(Decimal("0.125")), 2)) == Decimal("0.13")


def test_trim_keeps_tabs(spark):
    assert one(spark, conform_text(F.lit(" \tab "))) == "\tAB"


def test_cells_cover_both_ends_of_an_interval(spark):
    width = timedelta(hours=4)
    times = spark.createDataFrame(
        [("1969-12-31 23:00:00",), ("1970-01-01 00:00:00",), ("1970-01-01 04:00:00",)], "t string"
    )
    cells = [row[0] for row in times.select(time_cell(F.col("t").cast("timestamp"), width)).collect()]
    assert cells == [-1, 0, 1]


def silver_rows(spark, rows):
    names = "pnr_locator flight_number bag_tag_number baggage_location passenger_gate".split()
    schema = ", ".join(f"{n} string" for n in names) + ", bt string, pt string"
    df = spark.createDataFrame(rows, schema)
    times = {"baggage_time": F.col("bt").cast("timestamp"), "passenger_time": F.col("pt").cast("timestamp")}
    return tracking(with_date_parts(df.withColumns(times).drop("bt", "pt"), "baggage_time"))


def test_late_flag_boundaries(spark):
    df = spark.createDataFrame(
        [(60, "00:01:00"), (61, "00:01:01"), (None, None)], "k int, t string"
    ).select(
        "k",
        stamp("2026-01-01 00:00:00").alias("passenger_time"),
        F.concat(F.lit("2026-01-01 "), "t").cast("timestamp").alias("baggage_time"),
    )
    flags = {row.k: row.is_late_baggage_scan for row in with_lateness(df).collect()}
    assert flags == {60: False, 61: True, None: False}


def test_tracking_drops_rows_without_locator_or_tag_and_conforms(spark):
    t = "2026-01-01 10:00:00"
    silver = silver_rows(
        spark,
        [
            (" abc123 ", "ac1 ", "t1", "belt", None, t, t),
            (None, "AC1", "T2", "B", "G", t, t),
            ("ABC123", "AC1", None, "B", "G", t, t),
        ],
    )
    row = silver.first()
    assert silver.count() == 1
    assert (row.pnr_locator, row.flight_number, row.bag_tag_number) == ("ABC123", "AC1", "T1")
    assert row.passenger_gate is None and (row.year, row.month, row.day) == (2026, 1, 1)
    assert dict(silver.dtypes)["baggage_time"] == "timestamp_ntz"


def test_rate_may_exceed_one_hundred_and_null_gates_group(spark):
    rows = [
        ("P00001", "AC1", tag, "B", None, f"2026-01-01 10:0{m}:00", "2026-01-01 10:00:00")
        for tag, m in (("T1", 2), ("T1", 3), ("T2", 4))
    ]
    gold = performance(silver_rows(spark, rows))
    row = gold.first()
    assert gold.count() == 1 and row.passenger_gate is None
    assert (row.total_bags_tracked, row.total_late_bags) == (2, 3)
    assert row.baggage_mishandle_rate_percentage == Decimal("150.00")
    assert row.avg_bag_scan_to_boarding_duration == 3.0
    assert row.max_bag_scan_delay == Decimal("4.000000")


def test_performance_without_times(spark):
    row = performance(silver_rows(spark, [("P00001", "AC1", "T1", "B", "G", None, None)])).first()
    assert row.avg_bag_scan_to_boarding_duration is None and row.max_bag_scan_delay is None
    assert row.total_late_bags == 0 and row.baggage_mishandle_rate_percentage == 0


def test_rate_is_zero_without_bags(spark):
    silver = silver_rows(
        spark, [("P00001", "AC1", "T1", "B", "G", "2026-01-01 10:05:00", "2026-01-01 10:00:00")]
    )
    untagged = silver.withColumn("bag_tag_number", F.lit(None).cast("string"))
    row = performance(untagged).first()
    assert (row.total_bags_tracked, row.total_late_bags) == (0, 1)
    assert row.baggage_mishandle_rate_percentage == 0


def test_ranking_breaks_ties_by_key(spark):
    rows = [("P00001", f, "T1", "B", g, "2026-01-01 10:00:00", "2026-01-01 10:00:00") for f, g in
            (("AC2", "G1"), ("AC1", "G2"), ("AC1", "G1"))]
    order = [(r.flight_number, r.passenger_gate) for r in ranked(performance(silver_rows(spark, rows))).collect()]
    assert order == [("AC1", "G1"), ("AC1", "G2"), ("AC2", "G1")]
