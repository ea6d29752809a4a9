"""Inner join on equal keys and a bounded time interval, for static and streaming input."""

from collections.abc import Callable, Sequence
from datetime import timedelta
from math import ceil

from pyspark.sql import DataFrame, Observation, Row, functions as F

from scanweave.constants import (
    DATE_PARTS,
    EVENT_TIME,
    LATENESS,
    MATCH_AFTER,
    MATCH_BEFORE,
    MATCH_KEYS,
)
from scanweave.functions import time_cell
from scanweave.operators.blocks import paired
from scanweave.operators.dedupe import drop_repeats

MAX_HOT_KEYS = 10_000
# Blocks span an eighth of a cell: as much longer their rows stay in state.
_BLOCKS_PER_CELL = 8
# Columns of rows dealt beforehand: a left row's lane, and the number of lanes a right row is listed in, from 0 on.
LANE, LANES = "_lane", "_lanes"


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    before: timedelta,
    after: timedelta,
    cell: timedelta | None = None,
    hot: Sequence[Row] = (),
    spread: int = 32,
    spread_right: int = 1,
    dealt: bool = False,
    blocks: bool | None = None,
    deal: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Pairs with equal keys and `right_time - before <= left_time <= right_time + after`.

    The time line is cut into cells of `cell` (default: the whole interval). Each right row is
    listed under every cell its interval touches (two by default), each left row under its own, and
    the cell joins the equality keys. A key with very many rows is thus split over time, and rows
    far apart are never compared. A pair can meet in one cell only, so the result is unchanged.

    Skew left inside a cell: static joins are split at run time by AQE. A streaming join has no
    such step; pass `hot` (see `hot_keys`) to deal the left rows of those keys over `spread` lanes,
    with their right rows repeated in each lane. With `spread_right`, right rows are dealt over so many
    lanes as well and left rows repeated in them: a grid, for keys heavy on both sides. A pair still
    meets once. With `dealt`, rows say themselves which lanes they belong to (`LANE`, `LANES`).

    With `blocks` (default: on streams) rows are packed into blocks, the blocks are joined, and pairs of them are expanded last
    (see `blocks.paired`). `deal` then moves pairs of blocks instead of pairs of rows, of which a hot key
    has as many as the product of its sides, and may add columns to them.

    Other columns must not share names. On streams, both times need watermarks; Spark derives the
    state clean-up from the time condition.
    """
    keys = list(keys)
    cell = cell or (before + after) or timedelta(hours=1)
    meet = [*keys, "_cell"]
    if hot:
        left, right = _deal_hot_keys(left, right, keys, hot, spread, spread_right)
        meet.append(LANE)
    elif dealt:
        right = right.withColumn(LANE, F.explode(F.sequence(F.lit(0), F.col(LANES) - 1))).drop(LANES)
        meet.append(LANE)

    low = F.col(right_time) - F.lit(before)
    high = F.col(right_time) + F.lit(after)
    left = left.withColumn("_cell", time_cell(left_time, cell))
    right = right.withColumn(
        "_cell", F.explode(F.sequence(time_cell(low, cell), time_cell(high, cell)))
    )
    if left.isStreaming if blocks is None else blocks:
        span = cell / _BLOCKS_PER_CELL
        matched = paired(left, right, meet, left_time, right_time, before, after, span, deal)
        return matched.drop("_cell", "_lane")
    matched = left.join(right, meet).filter(F.col(left_time).between(low, high))
    return matched.drop("_cell", "_lane")


def check_hot_keys(hot: Sequence[Row]) -> None:
    if len(hot) > MAX_HOT_KEYS:
        raise ValueError(f"{len(hot)} hot keys; at most {MAX_HOT_KEYS} may be dealt")


def _deal_hot_keys(left, right, keys, hot, spread, spread_right=1):
    check_hot_keys(hot)
    schema = left.select(*keys).schema
    listed = left.sparkSession.createDataFrame(list(hot), schema).distinct()
    marked = F.broadcast(listed.withColumn("_hot", F.lit(True)))
    is_hot = F.coalesce("_hot", F.lit(False))
    row_of = F.pmod(F.xxhash64(*left.columns), F.lit(spread)).cast("int")
    column_of = F.pmod(F.xxhash64(*right.columns), F.lit(spread_right)).cast("int")
    across = F.transform(F.sequence(F.lit(0), F.lit(spread_right - 1)), lambda c: row_of * spread_right + c)
    down = F.transform(F.sequence(F.lit(0), F.lit(spread - 1)), lambda r: r * spread_right + column_of)
    one = F.array(F.lit(0))
    left = left.join(marked, keys, "left").withColumn("_lane", F.explode(F.when(is_hot, across).otherwise(one)))
    right = right.join(marked, keys, "left").withColumn("_lane", F.explode(F.when(is_hot, down).otherwise(one)))
    return left.drop("_hot"), right.drop("_hot")


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> list[Row]:
    """Keys holding more than `share` of all rows.

    There are fewer than `1 / share` of them, whatever the data, so the list fits the driver and a
    broadcast. One counting job over the key columns; only the largest `1 / share` counts return.
    """
    if not 1 / MAX_HOT_KEYS <= share < 1:
        raise ValueError(f"share must be at least {1 / MAX_HOT_KEYS} and below 1")
    all_rows = Observation()
    counted = df.select(*keys).groupBy(*keys).agg(F.count("*").alias("rows"))
    counted = counted.observe(all_rows, F.sum("rows").alias("total"))
    largest = counted.orderBy(F.desc("rows")).limit(ceil(1 / share)).collect()
    total = all_rows.get["total"] or 0
    return [Row(**{key: row[key] for key in keys}) for row in largest if row["rows"] > total * share]


def match_scans(
    baggage: DataFrame,
    passengers: DataFrame,
    lateness: str = LATENESS,
    hot: Sequence[Row] = (),
    spread: int = 32,
    thin: bool = True,
    spread_right: int = 1,
    dealt: bool = False,
    idle_after: timedelta | None = None,
    clocks: tuple[DataFrame, DataFrame] | None = None,
    blocks: bool | None = None,
    deal: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Dedupe both event streams and match every bag scan with the boardings of its passenger.

    Events without a time match nothing. They go before the dedupe, where no watermark would ever remove their keys.

    The input that is behind holds back the watermark of both, and state grows while one is silent. With `idle_after`,
    an input counts as idle once the other is that far ahead in event time: from then on the other's
    events, dated back by it, move its watermark too. Matches of inputs less far apart are unchanged; what an idle input
    sends later from before that watermark is dropped and counted as late. `clocks` gives the streams to
    take the times of scans and boardings from, if not the inputs themselves. `blocks` and `deal`: see `interval_join`.
    """
    baggage, passengers = (events.where(F.col(EVENT_TIME).isNotNull()) for events in (baggage, passengers))
    scan_beats = boarding_beats = None
    if idle_after is not None:
        scan_clock, boarding_clock = clocks or (baggage, passengers)
        scan_beats, boarding_beats = (
            clock.select((F.col(EVENT_TIME) - F.lit(idle_after)).alias(EVENT_TIME)) for clock in (boarding_clock, scan_clock)
        )
    scans = drop_repeats(
        baggage.select(
            *("event_id", EVENT_TIME, *MATCH_KEYS),
            "bag_tag_number",
            F.col("location_id").alias("baggage_location"),
            *([LANE] if dealt else []),
        ),
        lateness=lateness,
        thin=thin,
        beats=scan_beats,
    ).withColumnRenamed(EVENT_TIME, "baggage_time")
    boardings = drop_repeats(
        passengers.select(
            *("event_id", EVENT_TIME, *MATCH_KEYS),
            F.col("gate_id").alias("passenger_gate"),
            *([LANES] if dealt else []),
        ),
        lateness=lateness,
        thin=thin,
        beats=boarding_beats,
    ).withColumnRenamed(EVENT_TIME, "passenger_time")
    # Lanes are dealt by row content; the id keeps otherwise equal scans apart.
    matched = interval_join(
        scans if hot else scans.drop("event_id"),
        boardings.withColumnRenamed("event_id", "_boarding") if hot else boardings.drop("event_id"),
        keys=MATCH_KEYS,
        left_time="baggage_time",
        right_time="passenger_time",
        before=MATCH_BEFORE,
        after=MATCH_AFTER,
        hot=hot,
        spread=spread,
        spread_right=spread_right,
        dealt=dealt,
        blocks=blocks,
        deal=deal,
    )
    return matched.select(
        *MATCH_KEYS,
        "bag_tag_number",
        "baggage_location",
        "passenger_gate",
        "baggage_time",
        "passenger_time",
        *(name for name in DATE_PARTS if name in matched.columns),  # added by `deal`
    )
