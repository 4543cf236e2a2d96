"""Data-quality checks as rows: (table_name, check_name, observed, expected, passed)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from marketloom.functions.money import valid
from marketloom.functions.parsing import parse
from marketloom.operators.conform import stack_rows
from marketloom.sources.tables import MALFORMED


class QualityError(ValueError):
    """Raised once with every failed check."""


@dataclass(frozen=True)
class MinRows:
    """The table has at least ``least`` rows."""

    table: str
    least: int

    @property
    def name(self) -> str:
        return "min_rows"

    def observed(self) -> Column:
        return F.count(F.lit(1))

    def verdict(self, observed: Column) -> tuple[int, Column]:
        return self.least, observed >= self.least


@dataclass(frozen=True)
class NoNulls:
    """The column has no NULL."""

    table: str
    column: str

    @property
    def name(self) -> str:
        return f"nulls_in_{self.column}"

    def observed(self) -> Column:
        return F.count_if(F.col(self.column).isNull())

    def verdict(self, observed: Column) -> tuple[int, Column]:
        return 0, observed == 0


@dataclass(frozen=True)
class KnownKeys:
    """Every key in the column is a row of the other table."""

    table: str
    column: str
    other: str
    other_column: str

    @property
    def name(self) -> str:
        return f"{self.column}_without_{self.other}"

    def verdict(self, observed: Column) -> tuple[int, Column]:
        return 0, observed == 0


@dataclass(frozen=True)
class Readable:
    """Every raw text in the column that is given is a finite number."""

    table: str
    column: str

    @property
    def name(self) -> str:
        return f"unreadable_{self.column}"

    def observed(self) -> Column:
        amount = valid(parse(F.col(self.column), DoubleType()))
        return F.count_if(F.col(self.column).isNotNull() & amount.isNull())

    def verdict(self, observed: Column) -> tuple[int, Column]:
        return 0, observed == 0


@dataclass(frozen=True)
class WellFormed:
    """Every line of the raw file has as many fields as its header."""

    table: str

    @property
    def name(self) -> str:
        return "malformed_rows"

    def observed(self) -> Column:
        return F.count_if(F.col(MALFORMED).isNotNull())

    def verdict(self, observed: Column) -> tuple[int, Column]:
        return 0, observed == 0


Check = MinRows | NoNulls | KnownKeys | Readable | WellFormed

# The row minima that block publishing, and the checks made after it.
STAGING_MINIMA = {
    "dim_date": 1400,
    "dim_customers": 90000,
    "dim_products": 30000,
    "dim_sellers": 3000,
    "fact_orders": 100000,
    "revenue_by_category": 100,
    "customer_lifetime_value": 90000,
    "seller_performance": 10000,
}
WAREHOUSE_CHECKS: tuple[Check, ...] = (
    MinRows("fact_orders", 100000),
    MinRows("dim_customers", 90000),
    NoNulls("fact_orders", "customer_unique_id"),
    NoNulls("fact_orders", "product_id"),
    MinRows("dim_date", 1400),
    KnownKeys("fact_orders", "order_date_key", "dim_date", "date_key"),
)


#: What a delivery of raw files should hold; cleaning makes NULLs of what does not.
DELIVERY_CHECKS: tuple[Check, ...] = (
    WellFormed("orders"),
    WellFormed("customers"),
    WellFormed("order_items"),
    Readable("order_items", "price"),
    Readable("order_items", "freight_value"),
    WellFormed("products"),
    WellFormed("translation"),
    WellFormed("payments"),
    Readable("payments", "payment_value"),
    WellFormed("sellers"),
)


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Evaluate the checks; those of one table share one pass over it, known keys included."""
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)
    return stack_rows([_check_table(tables, name, group) for name, group in by_table.items()])


def staging_checks(
    tables: Mapping[str, DataFrame], minima: Mapping[str, int] = STAGING_MINIMA
) -> DataFrame:
    """Row minima of all given tables; a table without a minimum needs one row."""
    return run_checks(tables, [MinRows(name, minima.get(name, 1)) for name in tables])


def enforce(results: DataFrame) -> list[str]:
    """Raise one error naming every failed check; else return a line per check."""
    lines, failed = [], []
    for row in results.collect():  # one row per check
        line = (
            f"{row['table_name']} {row['check_name']}:"
            f" observed {row['observed']}, expected {row['expected']}"
        )
        lines.append(line)
        if not row["passed"]:
            failed.append(line)
    if failed:
        raise QualityError("quality checks failed:\n" + "\n".join(failed))
    return lines


def _check_table(
    tables: Mapping[str, DataFrame], name: str, checks: Sequence[Check]
) -> DataFrame:
    """One row per check.  Every check counts rows, so counts by key add up to those of the table."""
    keyed = {n: check for n, check in enumerate(checks) if isinstance(check, KnownKeys)}
    counts = [
        check.observed().alias(f"_{n}") for n, check in enumerate(checks) if n not in keyed
    ]
    if keyed:
        measured = _by_key(tables, name, keyed, counts, len(checks))
    else:
        measured = tables[name].agg(*counts)
    rows = []
    for n, check in enumerate(checks):
        observed = F.col(f"_{n}")
        expected, passed = check.verdict(observed)
        rows.append(
            F.struct(
                F.lit(check.table).alias("table_name"),
                F.lit(check.name).alias("check_name"),
                observed.alias("observed"),
                F.lit(expected).cast("bigint").alias("expected"),
                passed.alias("passed"),
            )
        )
    return measured.select(F.inline(F.array(*rows)))


def _by_key(
    tables: Mapping[str, DataFrame],
    name: str,
    keyed: Mapping[int, KnownKeys],
    counts: Sequence[Column],
    number: int,
) -> DataFrame:
    """All counts of a table in one pass: by its keys first, which then meet the known ones.

    Map tasks combine the rows of a key, so a frequent one is a few rows, and the other
    checks' counts ride along.  A NULL key is not a missing one.
    """
    keys = [F.col(check.column).alias(f"_key_{n}") for n, check in keyed.items()]
    groups = tables[name].groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *counts)
    for n, check in keyed.items():
        known = tables[check.other].select(F.col(check.other_column).alias(f"_key_of_{n}"))
        known = known.distinct().withColumn(f"_known_{n}", F.lit(True))
        groups = groups.join(known, F.col(f"_key_{n}") == F.col(f"_key_of_{n}"), "left")

    def total(n: int) -> Column:
        if n not in keyed:
            return F.sum(f"_{n}")
        missing = F.col(f"_key_{n}").isNotNull() & F.col(f"_known_{n}").isNull()
        return F.sum(F.when(missing, F.col("_rows")))

    return groups.agg(*[F.coalesce(total(n), F.lit(0)).alias(f"_{n}") for n in range(number)])
