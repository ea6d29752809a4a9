"""The cleansed tracking table and the performance table."""

from pyspark.sql import DataFrame, functions as F

from scanweave.constants import LATE_AFTER_SECONDS
from scanweave.functions import conform_text, date_parts, minutes_from_seconds, seconds_between

_TEXTS = ("pnr_locator", "flight_number", "bag_tag_number", "baggage_location", "passenger_gate")
_TIMES = ("baggage_time", "passenger_time")


def with_date_parts(df: DataFrame, time_column: str) -> DataFrame:
    """Add the partition columns of `time_column`; all NULL where the time is."""
    return df.withColumns(date_parts(time_column))


def with_lateness(
    df: DataFrame,
    boarded: str = "passenger_time",
    scanned: str = "baggage_time",
    late_after: int = LATE_AFTER_SECONDS,
) -> DataFrame:
    """Minutes from boarding to scan, and whether the scan came too late. Unknown times are not late."""
    seconds = seconds_between(boarded, scanned)
    return df.withColumns(
        {
            "scan_to_board_interval_minutes": minutes_from_seconds(seconds),
            "is_late_baggage_scan": F.coalesce(seconds > late_after, F.lit(False)),
        }
    )


def tracking(bronze: DataFrame, late_after: int = LATE_AFTER_SECONDS) -> DataFrame:
    """Silver: rows with locator and tag, conformed text and times, interval and lateness."""
    conformed = {name: conform_text(name) for name in _TEXTS}
    conformed |= {name: F.col(name).cast("timestamp_ntz") for name in _TIMES}
    kept = bronze.dropna(subset=["pnr_locator", "bag_tag_number"])
    return with_lateness(kept.withColumns(conformed), late_after=late_after)


def performance(silver: DataFrame) -> DataFrame:
    """Gold: one row per flight and gate.

    The mean comes from whole seconds, so it does not depend on summation order. The rate divides
    late rows by distinct bags and may pass 100; the quotient is rounded to six places first.
    """
    seconds = seconds_between("passenger_time", "baggage_time")
    per_gate = silver.groupBy("flight_number", "passenger_gate").agg(
        F.count_distinct("pnr_locator").alias("total_passengers_processed"),
        F.count_distinct("bag_tag_number").alias("total_bags_tracked"),
        (F.sum(seconds) / F.count(seconds) / 60).alias("avg_bag_scan_to_boarding_duration"),
        F.max("scan_to_board_interval_minutes").alias("max_bag_scan_delay"),
        F.count_if("is_late_baggage_scan").alias("total_late_bags"),
        F.max("baggage_time").alias("last_processed_at"),
    )
    return with_rate(per_gate)


def with_rate(per_gate: DataFrame) -> DataFrame:
    """Add the late share of the bags in percent, 0 without bags."""
    bags = F.col("total_bags_tracked")
    quotient = (F.col("total_late_bags") / bags).cast("decimal(18,6)")
    rate = F.when(bags > 0, F.round(quotient * 100, 2)).otherwise(F.lit(0))
    return per_gate.withColumn("baggage_mishandle_rate_percentage", rate.cast("decimal(18,2)"))


def ranked(gold: DataFrame) -> DataFrame:
    """Worst rate first; keys break ties. For results that are shown, not for tables."""
    return gold.orderBy(
        F.desc("baggage_mishandle_rate_percentage"), "flight_number", "passenger_gate"
    )
