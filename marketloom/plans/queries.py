"""The registered queries: every operator over the raw stand-ins of one data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import money
from marketloom.operators import clean, conform, dims, facts, joins, marts, publish, quality
from marketloom.plans import daily
from marketloom.schemas import BY_MONTH, GOLD, RAW, SILVER
from marketloom.sources.standins import EXTREME, SKEWED, Standins
from marketloom.sources.tables import (
    dropping_shuffles,
    read_raw_csv,
    read_table,
    shared_path,
    write_raw_csv,
    write_table,
)

RUN_TS = datetime(2024, 1, 1)

# Small enough for the test data; the last of each kind is meant to fail there.
MINIMA = {"dim_date": 1400, "dim_customers": 100, "fact_orders": 1000, "dim_sellers": 10_000_000}
DAILY_CHECKS = (
    quality.NoNulls("fact_orders", "product_id"),
    quality.KnownKeys("fact_orders", "order_date_key", "dim_date", "date_key"),
)
CHECKS: tuple[quality.Check, ...] = (
    quality.MinRows("fact_orders", 1000),
    quality.MinRows("dim_customers", 10_000_000),
    quality.NoNulls("fact_orders", "customer_unique_id"),
    quality.NoNulls("fact_orders", "product_id"),
    quality.MinRows("dim_date", 1400),
    quality.KnownKeys("fact_orders", "order_date_key", "dim_date", "date_key"),
)


class Shop:
    """Raw, silver and gold tables of one data folder, each planned when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str, variant: dict[str, str] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.raw = Standins(spark, sf_dir, variant).raw

    @cached_property
    def orders(self) -> DataFrame:
        return clean.clean_orders(self.raw("orders"), RUN_TS)

    @cached_property
    def customers(self) -> DataFrame:
        return clean.clean_customers(self.raw("customers"), RUN_TS)

    @cached_property
    def persons(self) -> DataFrame:
        return dims.build_dim_customers(self.customers, RUN_TS)

    @cached_property
    def items(self) -> DataFrame:
        return clean.clean_order_items(self.raw("order_items"), RUN_TS)

    @cached_property
    def products(self) -> DataFrame:
        return clean.clean_products(self.raw("products"), self.raw("translation"), RUN_TS)

    @cached_property
    def payments(self) -> DataFrame:
        return clean.clean_payments(self.raw("payments"), RUN_TS)

    @cached_property
    def sellers(self) -> DataFrame:
        return clean.clean_sellers(self.raw("sellers"), RUN_TS)

    def fact(self, how: str = "inner") -> DataFrame:
        return facts.build_fact_orders(
            self.items,
            self.orders,
            self.payments,
            self.customers,
            how,
            self.raw("order_items"),
            self.raw("orders"),
        )

    def staged_gold(self) -> str:
        """Root of a version, "run", of all gold tables, staged as the daily run does."""
        root = shared_path(self.spark, "gold")
        raw = {name: self.raw(name) for name in RAW}
        daily.write_silver(self.spark, raw, f"{root}/silver", "run", RUN_TS)
        silver = daily.read_silver(self.spark, f"{root}/silver")
        daily.stage_gold(self.spark, silver, f"{root}/gold", "run", RUN_TS)
        return f"{root}/gold"


def staging_min_rows(shop: Shop) -> DataFrame:
    """Row minima of the staged versions, from what was observed while they were written."""
    return publish.staged_checks(shop.spark, shop.staged_gold(), GOLD, "run", MINIMA)


def revenue_by_category(shop: Shop) -> DataFrame:
    revenue = marts.revenue_by_category(
        shop.fact(), shop.products, raw_items=shop.raw("order_items")
    )
    return marts.by_month_and_revenue(revenue)


def date_as_text(days: DataFrame) -> DataFrame:
    """Hand out the calendar's date as text, which all engines do alike."""
    return days.withColumn("full_date", F.col("full_date").cast("string"))


def money_extremes(shop: Shop) -> DataFrame:
    """Sales per seller where some prices are infinite, no number, too large or very large."""
    items = Shop(shop.spark, shop.sf_dir, EXTREME).items
    price = F.col("price")
    sums = money.grouped(
        items,
        ["seller_id"],
        {"total": "price"},
        {"priced": F.count(price), "unpriced": F.count_if(price.isNull())},
    )
    return sums.select(
        "seller_id",
        money.rounded("total").alias("total_revenue"),
        money.average("total", "priced").alias("avg_item_price"),
        "priced",
        "unpriced",
    )


# The daily run of one data folder, made once in a session; its result is a lake on disk.
_LAKES: dict[tuple[str, str], str] = {}


def daily_lake(shop: Shop) -> str:
    """Root of the gold tables of a whole daily run: raw CSV, silver, staged gold, published."""
    key = (shop.spark.sparkContext.applicationId, shop.sf_dir)
    if key not in _LAKES:
        root = shared_path(shop.spark, "daily")
        with dropping_shuffles(shop.spark):
            for name, file in daily.RAW_FILES.items():
                write_raw_csv(shop.raw(name), f"{root}/raw/{file.replace('*', 'shop')}")
        daily.run(
            shop.spark, f"{root}/raw", root, RUN_TS, minima={}, checks=DAILY_CHECKS, database=None
        )
        _LAKES[key] = daily.gold_root(root)
    return _LAKES[key]


def daily_table(table: str) -> Callable[[Shop], DataFrame]:
    """A table as the daily run published it, found through the manifest."""

    def read(shop: Shop) -> DataFrame:
        df = publish.published(shop.spark, daily_lake(shop), table)
        return date_as_text(df) if table == "dim_date" else whole_as_double(df)

    return read


def skewed(query: Callable[[Shop], DataFrame]) -> Callable[[Shop], DataFrame]:
    """The query where one order, one product and one customer have a third of the rows each."""
    return lambda shop: query(Shop(shop.spark, shop.sf_dir, SKEWED))


def dq_checks(shop: Shop) -> DataFrame:
    tables = {
        "fact_orders": shop.fact(),
        "dim_customers": shop.persons,
        "dim_date": dims.purchase_calendar(shop.orders),
    }
    return quality.run_checks(tables, CHECKS)


def delivery_checks(shop: Shop) -> DataFrame:
    """Unreadable amounts where some prices are infinite or no number."""
    raw = Shop(shop.spark, shop.sf_dir, EXTREME).raw
    checks = [check for check in quality.DELIVERY_CHECKS if isinstance(check, quality.Readable)]
    return quality.run_checks({check.table: raw(check.table) for check in checks}, checks)


def integral_columns(shop: Shop) -> DataFrame:
    tables = {
        "dim_products": dims.build_dim_products(shop.products, RUN_TS),
        "payments": shop.payments,
    }
    return conform.stack_rows(
        [
            conform.integral_columns(df).withColumn("table_name", F.lit(name))
            for name, df in tables.items()
        ]
    )


def nan_to_null(shop: Shop) -> DataFrame:
    weight = F.coalesce("product_weight_g", F.lit(float("nan")))
    return conform.nan_to_null(shop.products.select("product_id", weight.alias("weight")))


def raw_csv_roundtrip(shop: Shop) -> DataFrame:
    path = shared_path(shop.spark, "raw_customers")
    write_raw_csv(shop.raw("customers"), path)
    return read_raw_csv(shop.spark, path, RAW["customers"])


def partitioned_roundtrip(shop: Shop) -> DataFrame:
    path = shared_path(shop.spark, "silver_orders")
    write_table(shop.orders, path, BY_MONTH)
    return whole_as_double(read_table(shop.spark, path, SILVER["orders"]))


def publish_roundtrip(shop: Shop) -> DataFrame:
    root = shared_path(shop.spark, "published")
    publish.publish(shop.spark, {"fact_orders": shop.fact()}, root, "run", MINIMA)
    return whole_as_double(publish.published(shop.spark, root, "fact_orders"))


def narrow_integral(shop: Shop) -> DataFrame:
    """Whole-number doubles as integers; the weight, which has NULLs, is shown as text."""
    path = shared_path(shop.spark, "dim_products")
    publish.stage(dims.build_dim_products(shop.products, RUN_TS), path, "dim_products", "run")
    narrow = publish.narrowed(shop.spark, path, "dim_products", "run")
    return narrow.withColumn("product_weight_g", F.col("product_weight_g").cast("string"))


# Whole numbers that can be NULL in the registered results.
NULLABLE_WHOLE = ("delivery_delay_days", "order_date_key", *BY_MONTH)


def whole_as_double(df: DataFrame) -> DataFrame:
    """Hand out nullable whole numbers as doubles, which all engines do alike.

    Taken out through pandas, a NULL turns Spark's integers into floats but not those
    of other engines.
    """
    names = [name for name in NULLABLE_WHOLE if name in df.columns]
    return df.withColumns({name: F.col(name).cast("double") for name in names})


_QUERIES: dict[str, Callable[[Shop], DataFrame]] = {
    "clean_orders": lambda shop: whole_as_double(shop.orders),
    "clean_customers": lambda shop: shop.customers,
    "clean_order_items": lambda shop: shop.items,
    "clean_products": lambda shop: shop.products,
    "clean_payments": lambda shop: shop.payments,
    "clean_sellers": lambda shop: shop.sellers,
    "dim_date": lambda shop: date_as_text(dims.purchase_calendar(shop.orders)),
    "dim_customers": lambda shop: shop.persons,
    "dim_products": lambda shop: dims.build_dim_products(shop.products, RUN_TS),
    "dim_sellers": lambda shop: dims.build_dim_sellers(shop.sellers, RUN_TS),
    "payments_per_order": lambda shop: facts.payments_per_order(shop.payments),
    "fact_orders": lambda shop: whole_as_double(shop.fact()),
    "fact_orders_left": lambda shop: whole_as_double(shop.fact("left")),
    "fact_orders_skewed": skewed(lambda shop: whole_as_double(shop.fact())),
    "revenue_by_category": revenue_by_category,
    "revenue_by_category_skewed": skewed(revenue_by_category),
    "money_extremes": money_extremes,
    "customer_lifetime_value": lambda shop: marts.customer_lifetime_value(
        shop.fact(), shop.persons
    ),
    "customer_lifetime_value_per_order": lambda shop: marts.customer_lifetime_value(
        shop.fact(), shop.persons, average_per="order", items_as="row_count"
    ),
    "seller_performance": lambda shop: marts.seller_performance(shop.fact(), shop.sellers),
    "customer_repeat_counts": lambda shop: dims.customer_repeat_counts(shop.customers),
    "category_price_totals": lambda shop: marts.category_price_totals(shop.items, shop.products),
    "join_row_loss": lambda shop: joins.join_row_loss(shop.items, shop.orders),
    "orders_required_fields": lambda shop: clean.require(
        shop.raw("orders"), ["order_id", "customer_id", "order_status"]
    ),
    "payments_positive": lambda shop: clean.positive_payments(shop.payments),
    "category_fill_unknown": lambda shop: clean.fill_category(shop.raw("products")),
    "dq_checks": dq_checks,
    "delivery_checks": delivery_checks,
    "staging_min_rows": staging_min_rows,
    "integral_columns": integral_columns,
    "narrow_integral": narrow_integral,
    "nan_to_null": nan_to_null,
    "raw_csv_roundtrip": raw_csv_roundtrip,
    "partitioned_roundtrip": partitioned_roundtrip,
    "publish_roundtrip": publish_roundtrip,
} | {f"daily_{table}": daily_table(table) for table in GOLD}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(plan: Callable[[Shop], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plan(Shop(spark, sf_dir))

    return {name: bind(plan) for name, plan in _QUERIES.items()}
