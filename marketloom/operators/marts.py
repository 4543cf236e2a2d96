"""Pre-aggregated tables over the order-item fact.

Every aggregate has one distinct count at most, which Spark spreads over (group,
order) before it combines per group: a group with a third of all rows is counted by
many tasks.  All other aggregates combine within map tasks first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.buckets import LOWEST, VALUE_TIERS, at_least
from marketloom.functions.money import average, avg_whole, grouped, ratio, rounded, valid
from marketloom.operators.joins import heavy_keys, lookup_join
from marketloom.schemas import BY_MONTH, GOLD

CANCELLED = ("cancelled",)


def live_rows(fact: DataFrame, excluded: Sequence[str] = CANCELLED) -> DataFrame:
    """Fact rows whose status is known and not excluded."""
    return fact.filter(~F.col("order_status").isin(*excluded))


def revenue_by_category(
    fact: DataFrame,
    products: DataFrame,
    excluded: Sequence[str] = CANCELLED,
    raw_items: DataFrame | None = None,
    plain: bool = False,
) -> DataFrame:
    """Revenue per month and category; the heavy products are spread over tasks.

    They are counted on ``raw_items`` where the fact is no stored table.  ``plain`` as in
    ``money.grouped``, here and below.
    """
    categories = products.select("product_id", "category_english")
    rows = lookup_join(
        live_rows(fact, excluded),
        categories,
        "product_id",
        "left",
        heavy_keys(fact if raw_items is None else raw_items, "product_id"),
        ["order_id", "order_item_id"],
    )
    price = F.col("price")
    months = grouped(
        rows,
        [*BY_MONTH, "category_english"],
        {"gross": "gross_revenue", "freight": "freight_value", "product": "price"},
        {
            "order_count": F.count_distinct("order_id"),
            "item_sold": F.count("order_item_id"),
            "priced": F.count(valid(price)),
        },
        plain=plain,
    )
    return months.withColumns(
        {
            "total_revenue": rounded("gross"),
            "total_freight": rounded("freight"),
            "total_product_revenue": rounded("product", digits=None),
            "avg_item_price": average("product", "priced"),
        }
    ).select(*GOLD["revenue_by_category"].fieldNames())


def by_month_and_revenue(revenue: DataFrame) -> DataFrame:
    """Presentation order: months ascending, best category first."""
    return revenue.orderBy(*BY_MONTH, F.desc("total_revenue"))


def customer_lifetime_value(
    fact: DataFrame,
    persons: DataFrame,
    excluded: Sequence[str] = CANCELLED,
    average_per: str = "item",
    items_as: str = "sequence_sum",
    plain: bool = False,
) -> DataFrame:
    """Value, span and tier of each person; ``persons`` has one row each, as ``dim_customers``.

    By default the average is per item and ``total_items_purchased`` adds up the item
    sequence numbers; ``average_per="order"`` and ``items_as="row_count"`` give the
    average order and the number of items instead.
    """
    gross, item = F.col("gross_revenue"), F.col("order_item_id")
    purchased = {"sequence_sum": F.sum(item), "row_count": F.count(item)}[items_as]
    per = {"item": "items", "order": "total_orders"}[average_per]
    value = grouped(
        live_rows(fact, excluded),
        ["customer_unique_id"],
        {"gross": "gross_revenue", "freight": "freight_value"},
        {
            "total_orders": F.count_distinct("order_id"),
            "items": F.count(valid(gross)),
            "first_order_date": F.min("order_date_key").cast("string"),
            "last_order_date": F.max("order_date_key").cast("string"),
            "total_items_purchased": purchased,
        },
        plain=plain,
    ).withColumns(
        {
            "lifetime_value": rounded("gross"),
            "avg_order_value": average("gross", per),
            "total_freight_paid": rounded("freight"),
        }
    )
    person = persons.select("customer_unique_id", "customer_id", "customer_city", "customer_state")
    return (
        value.join(person, "customer_unique_id", "left")
        .withColumns(
            {
                "customer_tier": at_least(F.col("lifetime_value"), VALUE_TIERS, LOWEST),
                "is_repeat_buyer": F.col("total_orders") > 1,
            }
        )
        .select(*GOLD["customer_lifetime_value"].fieldNames())
    )


def seller_performance(
    fact: DataFrame,
    sellers: DataFrame,
    excluded: Sequence[str] = CANCELLED,
    plain: bool = False,
) -> DataFrame:
    """Sales and punctuality of each seller per month.

    Items not yet delivered count as late, and deliveries count every item.
    The join follows the aggregate, so a seller has one row per month in it.
    """
    price, item = F.col("price"), F.col("order_item_id")
    months = grouped(
        live_rows(fact, excluded),
        ["seller_id", *BY_MONTH],
        {"total": "price"},
        {
            "total_orders": F.count_distinct("order_id"),
            "total_item_sold": F.count(item),
            "priced": F.count(valid(price)),
            "avg_delivery_delay_days": avg_whole("delivery_delay_days", 1),
            "on_time_deliveries": F.count_if("was_delivered_on_time"),
            "total_deliveries": F.count(item),
        },
        plain=plain,
    ).withColumns(
        {
            "total_revenue": rounded("total"),
            "avg_item_price": average("total", "priced"),
        }
    )
    rate = ratio("on_time_deliveries * 100", "total_deliveries", 2)
    rated = months.select(
        "seller_id",
        *BY_MONTH,
        "total_orders",
        "total_item_sold",
        "total_revenue",
        "avg_item_price",
        "avg_delivery_delay_days",
        "on_time_deliveries",
        "total_deliveries",
        rate.alias("on_time_delivery_rate"),
    )
    return rated.join(sellers, "seller_id", "left")


def price_totals(rows: DataFrame) -> DataFrame:
    """Total price per category."""
    totals = grouped(rows, ["category"], {"total": "price"})
    return totals.select("category", rounded("total").alias("total_revenue"))


def category_price_totals(items: DataFrame, products: DataFrame) -> DataFrame:
    """Total item price per English category, summed per product before the join.

    The sums stay exact until the end.
    """
    per_product = grouped(items, ["product_id"], {"total": "price"})
    names = products.select("product_id", F.col("category_english").alias("category"))
    named = per_product.join(names, "product_id", "left")
    totals = grouped(named, ["category"], {"sum": "total"}, sums=True)
    return totals.select("category", rounded("sum").alias("total_revenue"))
