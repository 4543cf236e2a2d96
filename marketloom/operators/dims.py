"""Dimension tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.buckets import HEAVIEST, WEIGHT_TIERS, at_most
from marketloom.functions.dates import date_key
from marketloom.operators.clean import moment
from marketloom.operators.dedupe import keep_first
from marketloom.schemas import GOLD

# Days that the calendar has whatever the purchases.
FIRST_DAY = date(2016, 1, 1)
LAST_DAY = date(2019, 12, 31)

_SUNDAY, _SATURDAY = 1, 7


def build_dim_date(
    spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY
) -> DataFrame:
    """One row per calendar day from ``first`` to ``last``."""
    span = spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    return calendar(span)


def purchase_calendar(
    orders: DataFrame, first: date = FIRST_DAY, last: date = LAST_DAY
) -> DataFrame:
    """One row per calendar day from ``first`` to ``last``, and as far as purchases go beyond."""
    day = F.to_date("order_purchase_timestamp")
    span = orders.agg(
        F.least(F.lit(first), F.min(day)).alias("first"),
        F.greatest(F.lit(last), F.max(day)).alias("last"),
    )
    return calendar(span)


def calendar(span: DataFrame) -> DataFrame:
    """Expand a one-row (first, last) span into days with their attributes."""
    step = F.expr("interval 1 day")
    days = span.select(F.explode(F.sequence("first", "last", step)).alias("full_date"))
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week"),  # ISO week, beside the calendar year
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(_SUNDAY, _SATURDAY).alias("is_weekend"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    )


def one_row_per_person(customers: DataFrame) -> DataFrame:
    """Customer rows with the greatest ``customer_id`` string of each person."""
    return keep_first(customers, ["customer_unique_id"], [F.desc("customer_id")])


def build_dim_customers(customers: DataFrame, run_ts: datetime) -> DataFrame:
    return _project("dim_customers", one_row_per_person(customers), run_ts)


def build_dim_products(products: DataFrame, run_ts: datetime) -> DataFrame:
    sides = [F.col(f"product_{side}_cm") for side in ("length", "height", "width")]
    measured = products.withColumns(
        {
            "volume_cm3": sides[0] * sides[1] * sides[2],
            "weight_tier": at_most(F.col("product_weight_g"), WEIGHT_TIERS, HEAVIEST),
        }
    )
    return _project("dim_products", measured, run_ts)


def build_dim_sellers(sellers: DataFrame, run_ts: datetime) -> DataFrame:
    return _project("dim_sellers", sellers, run_ts)


def customer_repeat_counts(customers: DataFrame) -> DataFrame:
    """Per-order customer ids against persons; ``customer_id`` is unique in silver."""
    return customers.agg(
        F.count("customer_id").alias("customer_ids"),
        F.count_distinct("customer_unique_id").alias("persons"),
    ).withColumn("repeat_ids", F.col("customer_ids") - F.col("persons"))


def _project(table: str, df: DataFrame, run_ts: datetime) -> DataFrame:
    return df.withColumn("dw_created_at", moment(run_ts)).select(*GOLD[table].fieldNames())
