"""Data-quality checks. Each check yields the rows that fail it; the report counts them."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str

    @property
    def name(self) -> str:
        return f"not_null_{self.table}_{self.column}"

    def failing(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return tables[self.table].filter(F.col(self.column).isNull())


@dataclass(frozen=True)
class AcceptedValues:
    """Distinct values outside the accepted ones. NULL is not a value."""

    table: str
    column: str
    accepted: tuple

    @property
    def name(self) -> str:
        return f"accepted_values_{self.table}_{self.column}"

    def outside(self) -> Column:
        return ~F.col(self.column).isin(list(self.accepted))

    def failing(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        rejected = tables[self.table].filter(self.outside())
        return rejected.groupBy(self.column).agg(F.count("*").alias("failing_rows"))


@dataclass(frozen=True)
class Relationship:
    """Child rows whose value is no parent value. `conform` maps parent values first if needed."""

    table: str
    column: str
    parent: str
    parent_column: str
    conform: str | None = None

    @property
    def name(self) -> str:
        return f"relationship_{self.table}_{self.column}_{self.parent}_{self.parent_column}"

    def _parents(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        value = F.expr(self.conform) if self.conform else F.col(self.parent_column)
        return tables[self.parent].select(value.alias(self.column)).distinct()

    def _children(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return tables[self.table].filter(F.col(self.column).isNotNull())

    def failing(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """The failing rows, by one anti join against the different parent values; a value very many
        children share is split at run time."""
        return self._children(tables).join(self._parents(tables), self.column, "left_anti")

    def failing_values(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """The failing values with their row counts: values are counted before they are joined."""
        counted = self._children(tables).groupBy(self.column).agg(F.count("*").alias("failing_rows"))
        return counted.join(self._parents(tables), self.column, "left_anti")


Check = NotNull | AcceptedValues | Relationship


def report(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row `(test, failures)` per check.

    The not-null checks of a table share one scan; each other check takes one. Work per check is a
    pre-aggregated count, so no hot value is shuffled row by row.
    """
    parts = []
    for table in dict.fromkeys(check.table for check in checks):
        own = [check for check in checks if check.table == table]
        nulls = [check for check in own if isinstance(check, NotNull)]
        if nulls:
            parts.append(_null_counts(tables[table], nulls))
        for check in own:
            if isinstance(check, AcceptedValues):
                parts.append(_single(check, check.failing(tables).agg(F.count("*").alias("failures"))))
            elif isinstance(check, Relationship):
                total = F.coalesce(F.sum("failing_rows"), F.lit(0)).alias("failures")
                parts.append(_single(check, check.failing_values(tables).agg(total)))
    return reduce(DataFrame.unionByName, parts)


def _single(check: Check, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(check.name).alias("test"), F.col("failures").cast("long"))


def _null_counts(df: DataFrame, checks: Sequence[NotNull]) -> DataFrame:
    counted = df.agg(
        *(F.count_if(F.col(check.column).isNull()).alias(check.name) for check in checks)
    )
    entries = [
        F.struct(F.lit(check.name).alias("test"), F.col(check.name).alias("failures"))
        for check in checks
    ]
    return counted.select(F.inline(F.array(*entries)))


class QualityGateError(RuntimeError):
    """At least one check found failing rows."""

    def __init__(self, failures: dict[str, int]):
        super().__init__(", ".join(f"{name}: {count}" for name, count in failures.items()))
        self.failures = failures


def enforce(checked: DataFrame) -> None:
    """Raise if any check failed. Collects the report, one short row per check."""
    failures = {row["test"]: row["failures"] for row in checked.collect() if row["failures"]}
    if failures:
        raise QualityGateError(failures)


# How silver cleanses a locator; parents conformed alike have every child's value.
CONFORMED_LOCATOR = "upper(trim(pnr_locator))"


def published_checks(conform: str | None = None) -> tuple[Check, ...]:
    """The checks before publication; `conform` cleanses parent locators before they are compared."""
    return (
        NotNull("silver", "pnr_locator"),
        Relationship("silver", "pnr_locator", "bronze", "pnr_locator", conform),
        NotNull("silver", "bag_tag_number"),
        AcceptedValues("silver", "is_late_baggage_scan", (True, False)),
        NotNull("gold", "flight_number"),
        NotNull("gold", "total_bags_tracked"),
    )


PUBLISHED_CHECKS = published_checks()
