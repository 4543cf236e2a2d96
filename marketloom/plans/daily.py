"""The daily run: raw CSV to silver, silver to gold, publish, check."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from marketloom.functions import money
from marketloom.operators import clean, dims, facts, marts, publish, quality
from marketloom.schemas import GOLD, PARTITIONS, RAW, SILVER
from marketloom.sources import manifest
from marketloom.sources.tables import (
    dropping_shuffles,
    one_delivery,
    read_raw_csv,
    read_table,
    shared_path,
    write_table,
)

# The names under which raw files are delivered.
RAW_FILES = {
    "orders": "*_orders_dataset.csv",
    "customers": "*_customers_dataset.csv",
    "order_items": "*_order_items_dataset.csv",
    "products": "*_products_dataset.csv",
    "translation": "product_category_name_translation.csv",
    "payments": "*_order_payments_dataset.csv",
    "sellers": "*_sellers_dataset.csv",
}

# Tables that grow with the orders, or are computed from the fact, which does.
_LARGE = (
    "orders",
    "customers",
    "order_items",
    "payments",
    "paid_orders",
    "fact_orders",
    "revenue_by_category",
    "customer_lifetime_value",
    "seller_performance",
)


@dataclass(frozen=True)
class Report:
    """Rows written per table, and one line per check."""

    silver_rows: dict[str, int]
    gold_rows: dict[str, int]
    checks: list[str]


def run(
    spark: SparkSession,
    raw_root: str,
    lake_root: str,
    run_ts: datetime,
    raw_files: Mapping[str, str] = RAW_FILES,
    minima: Mapping[str, int] = quality.STAGING_MINIMA,
    checks: Sequence[quality.Check] = quality.WAREHOUSE_CHECKS,
    database: str | None = publish.DATABASE,
    first_day: date = dims.FIRST_DAY,
    last_day: date = dims.LAST_DAY,
) -> Report:
    """Run the four steps in order and stop at the first failure.

    The calendar goes from ``first_day`` to ``last_day``, and as far as the purchases go
    beyond.  ``database`` names the catalog's views, which are made only if it is given.
    Each step reads what the step before it wrote, so no lineage is computed twice
    and a lost executor costs at most the tasks of one step.  A scheduler may also
    call the steps one by one.
    """
    # A run repeated after a failure must not meet the version it left behind.
    run_id = f"{run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    with dropping_shuffles(spark):
        silver_rows = to_silver(spark, raw_root, lake_root, run_id, run_ts, raw_files)
        gold_rows = to_gold(spark, lake_root, run_id, run_ts, first_day, last_day)
        lines = load(spark, lake_root, run_id, minima, database)
        return Report(silver_rows, gold_rows, lines + check(spark, lake_root, checks))


def to_silver(
    spark: SparkSession,
    raw_root: str,
    lake_root: str,
    run_id: str,
    run_ts: datetime,
    raw_files: Mapping[str, str] = RAW_FILES,
) -> dict[str, int]:
    """Clean the raw CSV files into a version of the silver tables, and publish it.

    All tables are written before readers are pointed to any of them; a write that fails
    leaves them with the versions they had.
    """
    paths = {name: f"{raw_root.rstrip('/')}/{file}" for name, file in raw_files.items()}
    for path in paths.values():
        one_delivery(spark, path)
    raw = {name: read_raw_csv(spark, path, RAW[name]) for name, path in paths.items()}
    return write_silver(spark, raw, silver_root(lake_root), run_id, run_ts)


def check_delivery(
    spark: SparkSession,
    raw_root: str,
    raw_files: Mapping[str, str] = RAW_FILES,
    checks: Sequence[quality.Check] = quality.DELIVERY_CHECKS,
) -> list[str]:
    """Count malformed lines and unreadable amounts, a scan per file; raises if there are any."""
    root = raw_root.rstrip("/")
    raw = {
        name: read_raw_csv(spark, f"{root}/{file}", RAW[name], malformed=True)
        for name, file in raw_files.items()
    }
    return quality.enforce(quality.run_checks(raw, checks))


def to_gold(
    spark: SparkSession,
    lake_root: str,
    run_id: str,
    run_ts: datetime,
    first_day: date = dims.FIRST_DAY,
    last_day: date = dims.LAST_DAY,
) -> dict[str, int]:
    """Stage a version of every gold table from the silver tables."""
    silver = read_silver(spark, silver_root(lake_root))
    return stage_gold(spark, silver, gold_root(lake_root), run_id, run_ts, first_day, last_day)


def load(
    spark: SparkSession,
    lake_root: str,
    run_id: str,
    minima: Mapping[str, int] = quality.STAGING_MINIMA,
    database: str | None = publish.DATABASE,
) -> list[str]:
    """Validate the staged version of every table, then publish them all at once."""
    root = gold_root(lake_root)
    lines = publish.validate(spark, root, GOLD, run_id, minima)
    publish.announce(spark, root, GOLD, run_id)
    if database:
        publish.make_views(spark, root, GOLD, database)
    return lines


def check(
    spark: SparkSession,
    lake_root: str,
    checks: Sequence[quality.Check] = quality.WAREHOUSE_CHECKS,
) -> list[str]:
    """Check the published tables, which any later session finds through their manifest."""
    root = gold_root(lake_root)
    tables = {table: publish.published(spark, root, table) for table in GOLD}
    return quality.enforce(quality.run_checks(tables, checks))


def clean_all(raw: Mapping[str, DataFrame], run_ts: datetime) -> dict[str, DataFrame]:
    return {
        "orders": clean.clean_orders(raw["orders"], run_ts),
        "customers": clean.clean_customers(raw["customers"], run_ts),
        "order_items": clean.clean_order_items(raw["order_items"], run_ts),
        "products": clean.clean_products(raw["products"], raw["translation"], run_ts),
        "payments": clean.clean_payments(raw["payments"], run_ts),
        "sellers": clean.clean_sellers(raw["sellers"], run_ts),
    }


def write_silver(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    run_id: str,
    run_ts: datetime,
) -> dict[str, int]:
    """Write a version of every silver table, then make all of them the published ones."""

    def write(name: str, df: DataFrame) -> int:
        path = manifest.version_path(root, name, run_id)
        return write_table(df, path, PARTITIONS.get(name, ()), mode="errorifexists")

    rows = _write_together(spark, clean_all(raw, run_ts), write)
    manifest.announce(spark, root, rows, run_id)
    return rows


def read_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The published version of every silver table."""
    current = manifest.versions(spark, root)
    missing = [name for name in SILVER if name not in current]
    if missing:
        raise LookupError(f"{missing} have not been published under {root}")
    return {
        name: read_table(spark, manifest.version_path(root, name, current[name]), schema)
        for name, schema in SILVER.items()
    }


def stage_gold(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    root: str,
    run_id: str,
    run_ts: datetime,
    first_day: date = dims.FIRST_DAY,
    last_day: date = dims.LAST_DAY,
) -> dict[str, int]:
    """Write a version of every gold table; the marts read what was just written.

    The orders with their persons and payments are written to the shared folder before they
    meet the items, so the fact's join holds no shuffle files of theirs.

    Stored amounts are looked up for ones too large for the plain sums, which cost a grouping
    less; with any, all are summed by ``money.grouped``'s general way.
    """
    paid_path = shared_path(spark, "paid_orders")

    def stage(table: str, df: DataFrame) -> int:
        if table == "paid_orders":
            return write_table(df, paid_path, mode="errorifexists")
        return publish.stage(df, root, table, run_id)

    customers, products, sellers = silver["customers"], silver["products"], silver["sellers"]
    payments = silver["payments"]
    first = {
        "dim_date": dims.purchase_calendar(silver["orders"], first_day, last_day),
        "dim_customers": dims.build_dim_customers(customers, run_ts),
        "dim_products": dims.build_dim_products(products, run_ts),
        "dim_sellers": dims.build_dim_sellers(sellers, run_ts),
        "paid_orders": facts.paid_orders(
            silver["orders"],
            payments,
            customers,
            plain=money.no_large(payments, "payment_value"),
        ),
    }
    rows = _write_together(spark, first, stage)
    del rows["paid_orders"]
    paid = read_table(spark, paid_path, first["paid_orders"].schema)
    items = {"fact_orders": facts.items_of_orders(silver["order_items"], paid)}
    rows |= _write_together(spark, items, stage)
    fact = publish.staged(spark, root, "fact_orders", run_id)
    persons = publish.staged(spark, root, "dim_customers", run_id)
    plain = money.no_large(fact, "price", "freight_value", "gross_revenue")
    then = {
        "revenue_by_category": marts.revenue_by_category(fact, products, plain=plain),
        "customer_lifetime_value": marts.customer_lifetime_value(fact, persons, plain=plain),
        "seller_performance": marts.seller_performance(fact, sellers, plain=plain),
    }
    return rows | _write_together(spark, then, stage)


def _write_together(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    write: Callable[[str, DataFrame], int],
) -> dict[str, int]:
    """Write independent tables side by side, of the large ones two at a time.

    One table's last tasks so leave no core idle, and the disks hold the shuffle files of two
    large tables at most, since those of a write go when it ends.
    """
    with (
        dropping_shuffles(spark),
        ThreadPoolExecutor(max_workers=2) as large,
        ThreadPoolExecutor(max_workers=len(tables)) as small,
    ):
        running = {
            name: (large if name in _LARGE else small).submit(write, name, df)
            for name, df in tables.items()
        }
        try:
            return {name: job.result() for name, job in running.items()}
        finally:
            for job in running.values():
                job.cancel()  # after a failure, what has not begun


def silver_root(lake_root: str) -> str:
    return f"{lake_root.rstrip('/')}/silver"


def gold_root(lake_root: str) -> str:
    return f"{lake_root.rstrip('/')}/gold"
