"""Text expressions."""

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def conform_text(column: str | Column) -> Column:
    """Upper case without outer spaces; tabs and line breaks stay."""
    value = F.col(column) if isinstance(column, str) else column
    return F.upper(F.trim(value))


def padded(number: str | Column, width: int) -> Column:
    """The number with leading zeros up to `width`; a longer number stays whole."""
    digits = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(width) - F.length(digits))), digits)


def is_one_of_ignoring_case(column: str | Column, words: Iterable[str]) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.lower(value).isin([word.lower() for word in words])
