"""Removal of repeated events."""

from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scanweave.constants import EVENT_KEYS, EVENT_TIME, LATENESS

_BEAT = "_beat"


def drop_repeats(
    df: DataFrame,
    keys: Sequence[str] = EVENT_KEYS,
    event_time: str = EVENT_TIME,
    lateness: str = LATENESS,
    thin: bool = True,
    beats: DataFrame | None = None,
) -> DataFrame:
    """One row per key.

    Static input: an aggregate with map-side combine, so a group holding a large share of all rows
    shrinks before the shuffle. Which of several differing rows survives is decided by their values,
    so a recomputed task after an executor loss gives the same row.

    Streaming input: first row per key under a watermark. The streaming operator has no map-side
    combine, so with `thin` each input batch drops its own copies before the shuffle. `beats`, a stream with the
    event time alone, moves the watermark as well: its rows pass it and go no further.
    """
    keys = list(keys)
    if df.isStreaming:
        source = drop_repeats_within_batches(df, keys) if thin else df
        if beats is None:
            return source.withWatermark(event_time, lateness).dropDuplicates(keys)
        marked = source.withColumn(_BEAT, F.lit(False)).unionByName(
            beats.select(event_time, F.lit(True).alias(_BEAT)), allowMissingColumns=True
        )
        # As it names the event time, the optimiser leaves this filter behind the watermark.
        event = ~F.col(_BEAT) | (F.col(event_time) < F.lit(datetime(1, 1, 1)))
        return marked.withWatermark(event_time, lateness).where(event).drop(_BEAT).dropDuplicates(keys)
    payload = [name for name in df.columns if name not in keys]
    if not payload:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.max(F.struct(*payload)).alias("kept"))
    fields = [name if name in keys else F.col("kept")[name].alias(name) for name in df.columns]
    return kept.select(*fields)


def drop_repeats_within_batches(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the first row per key of every Arrow batch. No shuffle, no state, exact as a first step."""
    keys = list(keys)

    def first_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeated = batch.select(keys).to_pandas().duplicated().to_numpy()
            yield batch.filter(pa.array(~repeated)) if repeated.any() else batch

    return df.mapInArrow(first_rows, df.schema)
