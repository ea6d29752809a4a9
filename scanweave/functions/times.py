"""Time expressions. All assume the session time zone is pinned (see `session.PINNED`)."""

from datetime import timedelta

from pyspark.sql import Column, functions as F

from scanweave.constants import DATE_PARTS


def _instant(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("timestamp")


def date_parts(column: str) -> dict[str, Column]:
    """The partition columns `year`, `month`, `day` of a time column."""
    parts = (F.year(column), F.month(column), F.dayofmonth(column))
    return dict(zip(DATE_PARTS, parts))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Second boundaries crossed from `start` to `end`; 00:00:00.9 to 00:01:01.1 is 61, not 60."""
    return F.unix_seconds(_instant(end)) - F.unix_seconds(_instant(start))


def minutes_from_seconds(seconds: Column) -> Column:
    """Fractional minutes, six decimal places."""
    return F.round(seconds / F.lit(60.0), 6).cast("decimal(18,6)")


def time_cell(column: str | Column, width: timedelta) -> Column:
    """Number of the `width`-wide cell of the time line a time falls into; never decreases with time."""
    micros = width // timedelta(microseconds=1)
    return F.floor(F.unix_micros(_instant(column)) / F.lit(micros))
