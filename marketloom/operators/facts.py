"""The order-item fact and the payment roll-up it carries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.dates import date_key
from marketloom.functions.money import grouped, rounded
from marketloom.operators.clean import item_total
from marketloom.operators.joins import heavy_keys, lookup_join
from marketloom.schemas import GOLD


def payments_per_order(payments: DataFrame, plain: bool = False) -> DataFrame:
    """One row per order; the primary type is the type of the first payment.

    ``plain`` as in ``money.grouped``.
    """
    sequence = F.col("payment_sequential")
    first = F.struct(sequence.isNull(), sequence, "payment_type")
    orders = grouped(
        payments,
        ["order_id"],
        {"total": "payment_value"},
        {
            "payment_methods_count": F.count_distinct("payment_type"),
            "primary_payment_type": F.min_by("payment_type", first),
            "max_installments": F.max("payment_installments"),
        },
        plain=plain,
    )
    total = rounded("total").alias("total_payment_value")
    return orders.select("order_id", total, *orders.columns[2:])


def build_fact_orders(
    items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    how: str = "inner",
    raw_items: DataFrame | None = None,
    raw_orders: DataFrame | None = None,
    plain: bool = False,
) -> DataFrame:
    """One row per order item; ``how="left"`` also keeps items without an order.

    Persons and payments are attached to the orders first, where each side has one
    row per order, so the items, the largest table, meet a single join.  Both lookups
    spread their heavy keys, since adaptive execution cannot split a join whose other
    side is a join already.  The keys are counted on ``raw_items`` and ``raw_orders``
    where items and orders are no stored tables but computed from these.  The order's
    payment total repeats on each of its items: do not add it up.  ``plain`` is said of the
    payments, as in ``money.grouped``.
    """
    paid = paid_orders(orders, payments, customers, how, raw_orders, plain)
    return items_of_orders(items, paid, how, raw_items)


def paid_orders(
    orders: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    how: str = "inner",
    raw_orders: DataFrame | None = None,
    plain: bool = False,
) -> DataFrame:
    """One row per order with its person and payments, narrowed to what its items take from it.

    For ``how="left"`` there is also one per order that is known by payments only.  The other
    parameters are those of ``build_fact_orders``.
    """
    persons = customers.select("customer_id", "customer_unique_id")
    known = lookup_join(
        orders,
        persons,
        "customer_id",
        "left",
        heavy_keys(orders if raw_orders is None else raw_orders, "customer_id"),
        ["order_id"],
    )
    # An item whose order is missing may still have payments.
    paid_how = "left" if how == "inner" else "full"
    paid = known.join(payments_per_order(payments, plain), "order_id", paid_how)
    on_time = F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")
    taken = paid.withColumns(
        {
            "order_date_key": date_key(F.col("order_purchase_timestamp")),
            "was_delivered_on_time": on_time,
        }
    )
    names = GOLD["fact_orders"].fieldNames()
    return taken.select(*[name for name in names if name in taken.columns])


def items_of_orders(
    items: DataFrame, paid: DataFrame, how: str = "inner", raw_items: DataFrame | None = None
) -> DataFrame:
    """The fact: items joined to ``paid_orders``, as in ``build_fact_orders``."""
    rows = lookup_join(
        items,
        paid,
        "order_id",
        how,
        heavy_keys(items if raw_items is None else raw_items, "order_id"),
        ["order_item_id", "product_id"],
    )
    on_time = F.coalesce("was_delivered_on_time", F.lit(False))
    return rows.withColumns(
        {"gross_revenue": item_total(), "was_delivered_on_time": on_time}
    ).select(*GOLD["fact_orders"].fieldNames())
