"""Data contracts: which rows may pass, and why the others may not."""

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from scanweave.constants import (
    DATE_PARTS,
    EVENT_TIME,
    LOCATOR_COLUMN,
    LOCATOR_LENGTH,
    LOCATOR_PLACEHOLDERS,
    REASON_EVENT_TIME,
    REASON_LOCATOR,
)
from scanweave.functions import is_one_of_ignoring_case


def _is_one_of(column: str, words: tuple[str, ...]) -> Column:
    return F.col(column).isin(*words)


@dataclass(frozen=True)
class Contract:
    """A text column must be present, have an exact length and be no placeholder.

    Placeholders compare by case unless `ignore_case` is set.
    With `event_time` set, rows lacking that time are rejected too. Without it they pass here and
    vanish in the interval join, which needs a time.
    """

    column: str = LOCATOR_COLUMN
    length: int = LOCATOR_LENGTH
    placeholders: tuple[str, ...] = LOCATOR_PLACEHOLDERS
    reason: str = REASON_LOCATOR
    ignore_case: bool = False
    event_time: str | None = None
    event_time_reason: str = REASON_EVENT_TIME

    def holds(self) -> Column:
        """True or false, never NULL, so that negating it selects every other row."""
        exact = F.length(self.column) == self.length
        same = is_one_of_ignoring_case if self.ignore_case else _is_one_of
        placeholder = same(self.column, self.placeholders)
        return F.coalesce(exact & ~placeholder, F.lit(False))

    def failure(self) -> Column:
        """Reason a row fails, NULL for a valid row."""
        found = F.when(~self.holds(), F.lit(self.reason))
        if self.event_time:
            found = found.when(F.col(self.event_time).isNull(), F.lit(self.event_time_reason))
        return found


LOCATOR_CONTRACT = Contract()
STRICT_CONTRACT = Contract(event_time=EVENT_TIME)


class Split(NamedTuple):
    valid: DataFrame
    dead: DataFrame


def split_by_contract(df: DataFrame, contract: Contract = LOCATOR_CONTRACT) -> Split:
    """Rows that hold the contract, and the rest tagged with `error_reason`. Nothing is lost."""
    failure = contract.failure()
    return Split(
        valid=df.filter(failure.isNull()),
        dead=df.withColumn("error_reason", failure).filter(F.col("error_reason").isNotNull()),
    )


def summarise_dead_letters(dead: DataFrame) -> DataFrame:
    """Dead letters per reason and day."""
    return dead.groupBy("error_reason", *DATE_PARTS).agg(F.count("*").alias("dead_letters"))
