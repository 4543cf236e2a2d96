"""Cleaners: raw string tables to typed silver tables, one row per key.

Rows without their required ids go first, then duplicates, so a duplicate that lacks
an id can never displace a good row.  Duplicates are compared as raw strings.
Columns a layout does not list pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.money import valid
from marketloom.functions.parsing import parse
from marketloom.functions.text import code_text, or_unknown, title_text
from marketloom.operators.dedupe import keep_first
from marketloom.operators.joins import heavy_keys, lookup_join
from marketloom.schemas import SILVER


AMOUNTS = ("price", "freight_value", "payment_value")


def clean_orders(raw: DataFrame, run_ts: datetime) -> DataFrame:
    typed = _typed("orders", raw, key=["order_id"], required=["order_id", "customer_id"])
    purchased = F.col("order_purchase_timestamp")
    return typed.withColumns(
        {
            "delivery_delay_days": F.datediff(
                "order_delivered_customer_date", "order_estimated_delivery_date"
            ),
            "processed_at": moment(run_ts),
            "purchase_year": F.year(purchased),
            "purchase_month": F.month(purchased),
        }
    )


def clean_customers(raw: DataFrame, run_ts: datetime) -> DataFrame:
    typed = _typed(
        "customers", raw, key=["customer_id"], required=["customer_id", "customer_unique_id"]
    )
    return typed.withColumns(
        {
            "customer_city": title_text(F.col("customer_city")),
            "customer_state": code_text(F.col("customer_state")),
            "processed_at": moment(run_ts),
        }
    )


def clean_order_items(raw: DataFrame, run_ts: datetime) -> DataFrame:
    typed = _typed(
        "order_items", raw, key=["order_id", "order_item_id"], required=["order_id", "product_id"]
    )
    return typed.withColumns(
        {"item_total_value": item_total(), "processed_at": moment(run_ts)}
    )


def clean_products(raw: DataFrame, translation: DataFrame, run_ts: datetime) -> DataFrame:
    """Type the products and add the English category.

    The categories are few and large by nature, so the products of a heavy one are
    spread.  Spark broadcasts the translation when it measures it to be small.
    """
    typed = _typed("products", raw, key=["product_id"], required=["product_id"])
    name, english = "product_category_name", "product_category_name_english"
    # A repeated translation would multiply products.
    words = keep_first(translation.select(name, english).filter(F.col(name).isNotNull()), [name])
    joined = lookup_join(typed, words, name, "left", heavy_keys(raw, name), ["product_id"])
    labelled = joined.withColumns(
        {
            "category_english": or_unknown(F.col(english), F.col(name)),
            "processed_at": moment(run_ts),
        }
    )
    return labelled.select(*typed.columns, "category_english", "processed_at")


def clean_payments(raw: DataFrame, run_ts: datetime) -> DataFrame:
    typed = _typed(
        "payments", raw, key=["order_id", "payment_sequential"], required=["order_id"]
    )
    return typed.withColumn("processed_at", moment(run_ts))


def clean_sellers(raw: DataFrame, run_ts: datetime) -> DataFrame:
    typed = _typed("sellers", raw, key=["seller_id"], required=["seller_id"])
    return typed.withColumns(
        {
            "seller_city": title_text(F.col("seller_city")),
            "seller_state": code_text(F.col("seller_state")),
            "processed_at": moment(run_ts),
        }
    )


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any of the columns is NULL; the filter reaches the scan."""
    return df.filter(reduce(and_, [F.col(name).isNotNull() for name in columns]))


def positive_payments(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("payment_value") > 0)


def fill_category(products: DataFrame) -> DataFrame:
    """Replace a missing raw category name by the ``unknown`` label."""
    name = "product_category_name"
    return products.withColumn(name, or_unknown(F.col(name)))


def item_total() -> Column:
    return F.round(F.col("price") + F.col("freight_value"), 2)


def moment(at: datetime) -> Column:
    """A load time as a literal, so that reruns with the same time agree."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def _typed(
    table: str, raw: DataFrame, key: Sequence[str], required: Sequence[str]
) -> DataFrame:
    rows = keep_first(require(raw, required), key)
    kinds = {f.name: f.dataType for f in SILVER[table].fields if f.name in raw.columns}
    typed = {name: parse(F.col(name), kind) for name, kind in kinds.items()}
    return rows.withColumns({n: valid(c) if n in AMOUNTS else c for n, c in typed.items()})
