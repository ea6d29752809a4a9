"""Column expressions."""

from scanweave.functions.text import conform_text, is_one_of_ignoring_case, padded
from scanweave.functions.times import (
    date_parts,
    minutes_from_seconds,
    seconds_between,
    time_cell,
)

__all__ = [
    "conform_text",
    "date_parts",
    "is_one_of_ignoring_case",
    "minutes_from_seconds",
    "padded",
    "seconds_between",
    "time_cell",
]
