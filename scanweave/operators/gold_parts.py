"""Gold from parts per day that merge: sums, counts, maxima, and exact distinct sets as bitmaps over numbered values.

A day that changes is worked out again alone; gold is the merge of all days' parts, which hold a few rows a gate.
"""

from pyspark.sql import DataFrame, Window, functions as F

from scanweave.constants import DATE_PARTS
from scanweave.functions import seconds_between
from scanweave.operators.tables import with_rate

GATE = ("flight_number", "passenger_gate")
# Columns whose distinct values a gate counts, by the column of gold that holds the count.
COUNTED = {"total_passengers_processed": "pnr_locator", "total_bags_tracked": "bag_tag_number"}
_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


def counted_values(silver: DataFrame) -> DataFrame:
    """(day, gate, `of`, `value`) once each: what the distinct counts of a gate count on a day."""
    entries = F.array(*(F.struct(F.lit(of).alias("of"), F.col(column).alias("value")) for of, column in COUNTED.items()))
    values = silver.select(*DATE_PARTS, *GATE, F.explode(entries).alias("entry"))
    return values.select(*DATE_PARTS, *GATE, "entry.of", "entry.value").where("value is not null").distinct()


def new_values(values: DataFrame, numbered: DataFrame | None) -> DataFrame:
    """(`of`, `value`, `place`) of values without a number, with their place in the order of gates.

    Values of a gate get neighbouring numbers, so the bitmaps of its days are few and dense. Write the result
    before it is numbered: places count within tasks.
    """
    fresh = values.groupBy("of", "value").agg(F.min(F.struct(*GATE)).alias("gate"))
    if numbered is not None:
        fresh = fresh.join(numbered, ["of", "value"], "left_anti")
    ordered = fresh.repartitionByRange("of", "gate", "value").sortWithinPartitions("of", "gate", "value")
    return ordered.select("of", "value", F.monotonically_increasing_id().alias("place"))


def number_values(placed: DataFrame, first: int) -> DataFrame:
    """(`of`, `value`, `id`): the written places as consecutive numbers from `first` on.

    One row per task tells how many came before it.
    """
    part = F.shiftright("place", _ROW_BITS).alias("part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    row = F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.withColumn("part", part).join(offsets, "part").select("of", "value", (row + F.col("before") + first).alias("id"))


def day_parts(silver: DataFrame) -> DataFrame:
    """Sums, counts and maxima per day and gate."""
    seconds = seconds_between("passenger_time", "baggage_time")
    return silver.groupBy(*DATE_PARTS, *GATE).agg(
        F.sum(seconds).alias("seconds"),
        F.count(seconds).alias("timed"),
        F.max("scan_to_board_interval_minutes").alias("max_bag_scan_delay"),
        F.count_if("is_late_baggage_scan").alias("total_late_bags"),
        F.max("baggage_time").alias("last_processed_at"),
    )


def day_sets(values: DataFrame, numbered: DataFrame) -> DataFrame:
    """Bitmaps per day, gate and counted column, one per 32,768 numbers."""
    ids = values.join(numbered, ["of", "value"])
    return ids.groupBy(*DATE_PARTS, *GATE, "of", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap")
    )


def merged(parts: DataFrame, sets: DataFrame) -> DataFrame:
    """Gold from the parts and sets of all days; the same rows as `performance` of all their silver rows."""
    both = sets.groupBy(*GATE, "of", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("values"))
    counts = {name: F.sum(F.when(F.col("of") == name, F.col("values"))).alias(name) for name in COUNTED}
    distinct = both.groupBy(*GATE).agg(*counts.values())
    sums = parts.groupBy(*GATE).agg(
        (F.sum("seconds") / F.sum("timed") / 60).alias("avg_bag_scan_to_boarding_duration"),
        F.max("max_bag_scan_delay").alias("max_bag_scan_delay"),
        F.sum("total_late_bags").alias("total_late_bags"),
        F.max("last_processed_at").alias("last_processed_at"),
    )
    same = [sums[name].eqNullSafe(distinct[name]) for name in GATE]
    counted = [F.coalesce(distinct[name], F.lit(0)).alias(name) for name in COUNTED]
    rest = [sums[name] for name in sums.columns if name not in GATE]
    return with_rate(sums.join(distinct, same, "left").select(*(sums[name] for name in GATE), *counted, *rest))
