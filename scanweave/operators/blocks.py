"""Rows packed into blocks, so that a join on a key with very many rows handles blocks and not single rows.

A block holds rows of one join key whose times are less than a span apart. Joined blocks are pairs of arrays: few and small
beside the pairs of rows they stand for, so whatever has to be moved is moved before they are expanded.
"""

from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

MOST_ROWS = 512  # of a block
_BUFFER_ROWS = 1 << 18
_BUFFER_BYTES = 64 << 20
_DAY = timedelta(days=1)
_GROUP = "_group"


def packed(rows: DataFrame, meet: Sequence[str], time: str, span: timedelta, first: str, items: str) -> DataFrame:
    """Blocks of rows that agree in `meet`, lie in one `span` and one day (UTC): `meet`, the latest `time`, the earliest as
    `first`, and the rows' other columns as the array `items`. Rows without a key or a time are left out.

    Rows of a key come together first; a task packs what its buffer holds, so a group may give several blocks.
    `time` keeps its watermark.
    """
    meet = list(meet)
    rows = rows.dropna(subset=[*meet, time])
    payload = [name for name in rows.columns if name not in meet]
    source = rows.schema
    item = StructType([StructField(name, source[name].dataType) for name in payload])
    schema = StructType(
        [source[name] for name in meet]
        + [source[time], StructField(first, source[time].dataType), StructField(items, ArrayType(item))]
    )
    slices = [length // timedelta(microseconds=1) for length in (span, _DAY)]

    def blocks(table: pa.Table) -> Iterator[pa.RecordBatch]:
        micros = table[time].cast(pa.int64()).to_numpy()
        order = np.lexsort((micros, table[_GROUP].to_numpy()))
        table, micros = table.take(pa.array(order)).combine_chunks(), micros[order]
        starts = np.ones(len(micros), dtype=bool)
        starts[1:] = False
        for name in meet:  # two keys may share a group
            column = table[name]
            starts[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy()
        for length in slices:
            starts[1:] |= np.diff(micros // length) != 0
        begin = np.flatnonzero(starts)
        place = np.arange(len(micros)) - np.repeat(begin, np.diff(np.append(begin, len(micros))))
        begin = np.flatnonzero(place % MOST_ROWS == 0)
        end = np.append(begin[1:], len(micros))
        arrays = {name: _whole(table[name]) for name in table.column_names}
        held = pa.StructArray.from_arrays([arrays[name] for name in payload], names=payload)
        offsets = pa.array(np.append(begin, len(micros)), pa.int32())
        at, last = pa.array(begin), pa.array(end - 1)
        columns = [arrays[name].take(at) for name in meet]
        columns += [arrays[time].take(last), arrays[time].take(at), pa.ListArray.from_arrays(offsets, held)]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= _BUFFER_ROWS or sum(b.nbytes for b in waiting) >= _BUFFER_BYTES:
                yield from blocks(pa.Table.from_batches(waiting))
                waiting = []
        if waiting:
            yield from blocks(pa.Table.from_batches(waiting))

    together = rows.withColumn(_GROUP, F.xxhash64(*meet)).repartition(*meet)
    return together.mapInArrow(pack, schema)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks)


def paired(
    left: DataFrame,
    right: DataFrame,
    meet: Sequence[str],
    left_time: str,
    right_time: str,
    before: timedelta,
    after: timedelta,
    span: timedelta,
    deal: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows of both sides that agree in `meet`, for which `right_time - before <= left_time <= right_time + after`.

    Blocks are joined first: the condition on their latest times, wider by the span, is the one Spark derives the state
    clean-up from. `deal` may move the pairs of blocks before they are expanded and add columns, which all rows of a pair
    get; its left rows are all of the day of its `left_time`.
    """
    left = packed(left, meet, left_time, span, "_left_first", "_left")
    right = packed(right, meet, right_time, span, "_right_first", "_right")
    latest, then = F.col(left_time), F.col(right_time)
    near = latest.between(then - F.lit(before + span), then + F.lit(after + span))
    near &= latest >= F.col("_right_first") - F.lit(before)
    near &= F.col("_left_first") <= then + F.lit(after)
    pairs = left.join(right, list(meet)).filter(near)
    known = pairs.columns
    pairs = deal(pairs) if deal else pairs
    added = [name for name in pairs.columns if name not in known]
    rows = pairs.select(*meet, *added, "_right", F.inline("_left"))
    rows = rows.select(*(name for name in rows.columns if name != "_right"), F.inline("_right"))
    # Plain numbers: this is asked of every pair of rows.
    at, then = (F.unix_micros(F.col(name).cast("timestamp")) for name in (left_time, right_time))
    micro = timedelta(microseconds=1)
    return rows.filter(at.between(then - F.lit(before // micro), then + F.lit(after // micro)))
