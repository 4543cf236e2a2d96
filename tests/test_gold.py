from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from frames import columns, silver
from pyspark.sql import functions as F

from marketloom.functions import money
from marketloom.operators import dims, facts, marts
from marketloom.plans.queries import Shop
from marketloom.schemas import GOLD, stored
from marketloom.sources.tables import read_table, write_table

NOON = datetime(2018, 3, 10, 12)


def layout(df):
    return [(f.name, f.dataType) for f in df.schema.fields]


def declared(table):
    return [(f.name, f.dataType) for f in stored(GOLD[table]).fields]


# dim_date


def test_calendar_covers_every_day(spark):
    days = dims.build_dim_date(spark, date(2024, 2, 27), date(2024, 3, 2))
    assert columns(days, "date_key") == [
        (20240227,), (20240228,), (20240229,), (20240301,), (20240302,),
    ]


def test_calendar_has_the_declared_columns(spark):
    assert layout(dims.build_dim_date(spark, date(2019, 12, 30), date(2020, 1, 1))) == declared("dim_date")


def test_default_calendar(spark):
    days = dims.build_dim_date(spark)
    assert days.agg(F.count("*"), F.min("date_key"), F.max("date_key")).first() == (
        1461,
        20160101,
        20191231,
    )
    first = days.filter("date_key = 20160101").first()
    assert (first["year"], first["week"], first["day_of_week"]) == (2016, 53, 6)
    assert (first["day_name"], first["month_name"], first["is_weekend"]) == ("Friday", "January", False)
    assert first["year_month"] == "2016-01"


def test_calendar_of_the_purchases(spark):
    orders = silver(
        spark,
        "orders",
        {"order_purchase_timestamp": datetime(2018, 2, 27, 23)},
        {"order_purchase_timestamp": datetime(2018, 3, 1, 1)},
        {},
    )
    days = dims.purchase_calendar(orders, date(2018, 2, 28), date(2018, 2, 28))
    assert columns(days, "date_key") == [(20180227,), (20180228,), (20180301,)]
    inside = dims.purchase_calendar(orders, date(2018, 2, 26), date(2018, 3, 2))
    assert inside.count() == 5
    assert dims.purchase_calendar(orders.limit(0)).count() == 1461


# other dimensions


def test_one_customer_row_per_person_with_the_greatest_id(spark, run_ts):
    customers = silver(
        spark,
        "customers",
        {"customer_id": "10", "customer_unique_id": "u1", "customer_city": "A"},
        {"customer_id": "9", "customer_unique_id": "u1", "customer_city": "B"},
        {"customer_id": "1", "customer_unique_id": "u2"},
    )
    built = dims.build_dim_customers(customers, run_ts)
    assert layout(built) == declared("dim_customers")
    assert columns(built, "customer_unique_id", "customer_id") == [("u1", "9"), ("u2", "1")]
    assert tuple(dims.customer_repeat_counts(customers).first()) == (3, 2, 1)


def test_products_get_volume_and_tier(spark, run_ts):
    size = {"product_length_cm": 2.0, "product_height_cm": 3.0, "product_width_cm": 4.0}
    products = silver(
        spark,
        "products",
        {"product_id": "p1", "product_weight_g": 300.0} | size,
        {"product_id": "p2"},
    )
    built = dims.build_dim_products(products, run_ts)
    assert layout(built) == declared("dim_products")
    assert columns(built, "product_id", "volume_cm3", "weight_tier") == [
        ("p1", 24.0, "Light"),
        ("p2", None, "Very Heavy"),
    ]


def test_sellers(spark, run_ts):
    built = dims.build_dim_sellers(silver(spark, "sellers", {"seller_id": "s1"}), run_ts)
    assert layout(built) == declared("dim_sellers")
    assert built.first()["dw_created_at"] == run_ts


# payments and fact


def test_payments_per_order(spark):
    payments = silver(
        spark,
        "payments",
        {"order_id": "o1", "payment_sequential": 2, "payment_type": "boleto", "payment_value": 0.2,
         "payment_installments": 3},
        {"order_id": "o1", "payment_sequential": 1, "payment_type": "voucher", "payment_value": 0.1,
         "payment_installments": 1},
        {"order_id": "o1", "payment_type": "cash"},
        {"order_id": "o2", "payment_type": "cash"},
    )
    assert sorted(map(tuple, facts.payments_per_order(payments).collect())) == [
        ("o1", 0.3, 3, "voucher", 3),
        ("o2", None, 1, "cash", None),
    ]


@pytest.fixture
def shop_frames(spark):
    items = silver(
        spark,
        "order_items",
        {"order_id": "o1", "order_item_id": 1, "product_id": "p1", "seller_id": "s1", "price": 100.0,
         "freight_value": 1.005},
        {"order_id": "o2", "order_item_id": 1, "product_id": "p2", "seller_id": "s1", "price": 50.0},
        {"order_id": "o3", "order_item_id": 1, "product_id": "p3", "seller_id": "s2", "price": 75.0,
         "freight_value": 0.0},
    )
    orders = silver(
        spark,
        "orders",
        {"order_id": "o1", "customer_id": "c1", "order_status": "delivered",
         "order_purchase_timestamp": datetime(2018, 3, 5), "order_delivered_customer_date": NOON,
         "order_estimated_delivery_date": NOON, "delivery_delay_days": 0, "purchase_year": 2018,
         "purchase_month": 3},
        {"order_id": "o2", "customer_id": "c2", "order_status": "shipped"},
    )
    payments = silver(
        spark,
        "payments",
        {"order_id": "o1", "payment_sequential": 1, "payment_type": "voucher", "payment_value": 101.0},
        {"order_id": "o3", "payment_sequential": 1, "payment_type": "boleto", "payment_value": 75.0},
    )
    customers = silver(spark, "customers", {"customer_id": "c1", "customer_unique_id": "u1"})
    return items, orders, payments, customers


@pytest.fixture(params=[False, True])
def raw_rows(request, spark):
    """Rows to count heavy keys on: none of their own, or ones with a heavy key each."""
    if not request.param:
        return {}
    items = spark.createDataFrame([("o1",)] * 20 + [("o3",)] * 9, "order_id string")
    orders = spark.createDataFrame([("c2",)] * 9, "customer_id string")
    return {"raw_items": items, "raw_orders": orders}


def test_left_fact_keeps_every_item(shop_frames, raw_rows):
    fact = facts.build_fact_orders(*shop_frames, how="left", **raw_rows)
    names = ("order_id", "customer_unique_id", "total_payment_value", "order_status")
    assert columns(fact, *names) == [
        ("o1", "u1", 101.0, "delivered"),
        ("o2", None, None, "shipped"),
        ("o3", None, 75.0, None),
    ]


def test_inner_fact_loses_items_without_order(shop_frames, raw_rows):
    fact = facts.build_fact_orders(*shop_frames, **raw_rows)
    assert layout(fact) == declared("fact_orders")
    names = ("order_id", "order_date_key", "gross_revenue", "was_delivered_on_time")
    assert columns(fact, *names) == [
        ("o1", 20180305, 101.01, True),
        ("o2", None, None, False),
    ]


def test_later_on_the_estimated_day_is_late_without_delay(spark, shop_frames):
    items, orders, payments, customers = shop_frames
    later = orders.withColumn(
        "order_delivered_customer_date", F.lit("2018-03-10 12:00:01").cast("timestamp_ntz")
    )
    row = facts.build_fact_orders(items, later, payments, customers).filter("order_id = 'o1'").first()
    assert (row["was_delivered_on_time"], row["delivery_delay_days"]) == (False, 0)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_paid_orders_can_be_stored_before_the_items_join(spark, shop_frames, tmp_path, how):
    items, orders, payments, customers = shop_frames
    paid = facts.paid_orders(orders, payments, customers, how)
    assert "order_estimated_delivery_date" not in paid.columns
    path = str(tmp_path / "paid")
    assert write_table(paid, path) == {"inner": 2, "left": 3}[how]
    fact = facts.items_of_orders(items, read_table(spark, path, paid.schema), how)
    whole = facts.build_fact_orders(*shop_frames, how=how)
    assert layout(fact) == layout(whole)
    assert columns(fact, *fact.columns) == columns(whole, *whole.columns)


# marts


@pytest.fixture
def fact(spark):
    def row(order, item, **more):
        base = {"order_id": order, "order_item_id": item, "product_id": "p1", "seller_id": "s1",
                "customer_unique_id": "u1", "order_date_key": 20180305, "price": 10.0,
                "freight_value": 1.0, "gross_revenue": 11.0, "order_status": "delivered",
                "was_delivered_on_time": True, "delivery_delay_days": -2, "purchase_year": 2018,
                "purchase_month": 3}
        return base | more

    rows = [
        row("o1", 1, product_id="p1"),
        row("o1", 2, product_id="p2", price=20.01, gross_revenue=21.01),
        row("o2", 1, customer_unique_id=None, was_delivered_on_time=False, delivery_delay_days=None),
        row("o3", 1, order_status="cancelled"),
        row("o4", 1, order_status=None),
        row("o5", 1, product_id="p9", purchase_month=4, order_date_key=20180401, gross_revenue=1000.0),
    ]
    names = GOLD["fact_orders"].fieldNames()
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, stored(GOLD["fact_orders"]))


@pytest.mark.parametrize("heavy", [(), ("p1", "p9")])
def test_revenue_by_category(spark, fact, heavy):
    rows = [(product,) for product in heavy for _ in range(9)]
    raw_items = spark.createDataFrame(rows, "product_id string")
    products = silver(
        spark,
        "products",
        {"product_id": "p1", "category_english": "toys"},
        {"product_id": "p2", "category_english": "toys"},
    )
    revenue = marts.revenue_by_category(fact, products, raw_items=raw_items)
    assert layout(revenue) == declared("revenue_by_category")
    assert [tuple(row) for row in marts.by_month_and_revenue(revenue).collect()] == [
        (2018, 3, "toys", 43.01, 3.0, 40.01, 2, 3, 13.34),
        (2018, 4, None, 1000.0, 1.0, 10.0, 1, 1, 10.0),
    ]


def test_lifetime_value(spark, fact, run_ts):
    customers = silver(
        spark,
        "customers",
        {"customer_id": "c1", "customer_unique_id": "u1", "customer_city": "A"},
        {"customer_id": "c2", "customer_unique_id": "u1", "customer_city": "B"},
    )
    persons = dims.build_dim_customers(customers, run_ts)
    value = marts.customer_lifetime_value(fact, persons)
    assert layout(value) == declared("customer_lifetime_value")
    assert sorted(map(tuple, value.collect()), key=repr) == [
        ("u1", 2, 1032.01, 344.0, 3.0, "20180305", "20180401", 4, "c2", "B", None, "Gold", True),
        (None, 1, 11.0, 11.0, 1.0, "20180305", "20180305", 1, None, None, None, "New", False),
    ]
    other = marts.customer_lifetime_value(fact, persons, average_per="order", items_as="row_count")
    assert columns(other, "avg_order_value", "total_items_purchased") == [(11.0, 1), (516.01, 3)]


def test_seller_performance(spark, fact, run_ts):
    sellers = silver(spark, "sellers", {"seller_id": "s1", "seller_city": "A", "processed_at": run_ts})
    performance = marts.seller_performance(fact, sellers)
    assert layout(performance.select(*GOLD["seller_performance"].fieldNames())) == declared(
        "seller_performance"
    )
    assert sorted(map(tuple, performance.collect())) == [
        ("s1", 2018, 3, 2, 3, 40.01, 13.34, -2.0, 2, 3, 66.67, None, "A", None, run_ts),
        ("s1", 2018, 4, 1, 1, 10.0, 10.0, -2.0, 1, 1, 100.0, None, "A", None, run_ts),
    ]


def test_status_set_is_a_parameter(fact):
    assert columns(marts.live_rows(fact, ("delivered",)), "order_id") == [("o3",)]


def test_price_totals(spark):
    rows = [("garden", 0.1), ("garden", 0.2), (None, 7.25), ("tools", None), ("garden", 9e14)]
    totals = marts.price_totals(spark.createDataFrame(rows, "category string, price double"))
    assert columns(totals, "category", "total_revenue") == [
        ("garden", 900000000000000.3),
        ("tools", None),
        (None, 7.25),
    ]


def test_category_totals_keep_every_cent(spark):
    items = silver(
        spark,
        "order_items",
        {"order_id": "o1", "product_id": "p1", "price": 9e14},
        {"order_id": "o1", "product_id": "p2", "price": 0.01},
        {"order_id": "o1", "product_id": "p3", "price": -9e14},
    )
    names = [{"product_id": f"p{n}", "category_english": "toys"} for n in (1, 2, 3)]
    totals = marts.category_price_totals(items, silver(spark, "products", *names))
    assert columns(totals, "category", "total_revenue") == [("toys", 0.01)]


def test_on_time_rate_is_exact(spark):
    """All counts up to 120, and one that doubles round the other way."""
    pairs = [(late, total) for total in range(1, 121) for late in range(total + 1)] + [(23, 160)]
    df = spark.createDataFrame(pairs, "a long, b long")
    rate = money.ratio("a * 100", "b", 2).alias("r")
    for a, b, r in df.select("a", "b", rate).collect():
        exact = (Decimal(a * 100) / b).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert Decimal(repr(r)) == exact, (a, b)


# invariants over the test data


def test_fact_conserves_rows_and_money(spark):
    shop = Shop(spark, "/root/testdata/sf0.001")
    left = shop.fact("left").agg(F.count("*"), F.round(F.sum("price"), 2)).first()
    items = shop.items.agg(F.count("*"), F.round(F.sum("price"), 2)).first()
    assert tuple(left) == tuple(items)
    inner = shop.fact().agg(F.count("*"), F.round(F.sum("price"), 2)).first()
    joined = shop.items.join(shop.orders, "order_id", "left_semi")
    assert tuple(inner) == tuple(joined.agg(F.count("*"), F.round(F.sum("price"), 2)).first())
