import pytest
from frames import columns, raw
from pyspark.sql import functions as F

from marketloom.operators import clean
from marketloom.operators.dedupe import keep_first
from marketloom.schemas import SILVER
from marketloom.sources.standins import Standins


def test_orders_need_their_ids(spark, run_ts):
    df = raw(
        spark,
        "orders",
        {"order_id": "7001", "customer_id": "k9", "order_status": "invoiced"},
        {"order_id": "7002", "customer_id": None, "order_status": "shipped"},
        {"order_id": None, "customer_id": "k4", "order_status": "shipped"},
    )
    assert columns(clean.clean_orders(df, run_ts), "order_id", "order_status") == [
        ("7001", "invoiced")
    ]


def test_required_fields_option_also_needs_a_status(spark):
    df = raw(
        spark,
        "orders",
        {"order_id": "o1", "customer_id": "c1", "order_status": "delivered"},
        {"order_id": "o2", "customer_id": "c2"},
        {"order_id": "o3", "order_status": "delivered"},
    )
    kept = clean.require(df, ["order_id", "customer_id", "order_status"])
    assert columns(kept, "order_id") == [("o1",)]


def test_orders_are_deduplicated(spark, run_ts):
    same = {"order_id": "81", "customer_id": "k1", "order_status": "approved"}
    other = {"order_id": "82", "customer_id": "k1", "order_status": "created"}
    df = raw(spark, "orders", other, same, other, same, same)
    assert columns(clean.clean_orders(df, run_ts), "order_id", "order_status") == [
        ("81", "approved"), ("82", "created"),
    ]


def test_a_duplicate_without_customer_does_not_displace_the_good_row(spark, run_ts):
    df = raw(spark, "orders", {"order_id": "o1"}, {"order_id": "o1", "customer_id": "c1"})
    assert columns(clean.clean_orders(df, run_ts), "order_id", "customer_id") == [("o1", "c1")]


def test_order_dates(spark, run_ts):
    df = raw(
        spark,
        "orders",
        {
            "order_id": "o1",
            "customer_id": "c1",
            "order_purchase_timestamp": "2018-03-05 23:59:59",
            "order_delivered_customer_date": "2018-03-12 00:00:01",
            "order_estimated_delivery_date": "2018-03-10 23:00:00",
        },
        {"order_id": "o2", "customer_id": "c2", "order_purchase_timestamp": "not a date"},
    )
    cleaned = clean.clean_orders(df, run_ts)
    names = ("order_id", "delivery_delay_days", "purchase_year", "purchase_month")
    assert columns(cleaned, *names) == [("o1", 2, 2018, 3), ("o2", None, None, None)]
    assert {row["processed_at"] for row in cleaned.collect()} == {run_ts}


def test_item_key_spans_two_columns_and_bad_numbers_become_null(spark, run_ts):
    item = {"order_id": "o1", "product_id": "p1", "seller_id": "s1"}
    df = raw(
        spark,
        "order_items",
        item | {"order_item_id": "1", "price": "10.10", "freight_value": "0.05"},
        item | {"order_item_id": "1", "price": "10.10", "freight_value": "0.05"},
        item | {"order_item_id": "2", "price": "ten", "freight_value": "1"},
        {"order_id": "o2", "order_item_id": "1", "price": "1"},
    )
    cleaned = clean.clean_order_items(df, run_ts)
    assert columns(cleaned, "order_item_id", "price", "item_total_value") == [
        (1, 10.1, 10.15),
        (2, None, None),
    ]


def test_customers_and_sellers_are_tidied(spark, run_ts):
    customers = raw(
        spark,
        "customers",
        {
            "customer_id": "c1",
            "customer_unique_id": "u1",
            "customer_city": "  rio DE janeiro ",
            "customer_state": " rj ",
        },
        {"customer_id": "c2"},
    )
    sellers = raw(
        spark, "sellers", {"seller_id": "s1", "seller_city": " lins", "seller_state": "sp "}, {}
    )
    tidy = clean.clean_customers(customers, run_ts)
    assert columns(tidy, "customer_city", "customer_state") == [("Rio De Janeiro", "RJ")]
    tidy = clean.clean_sellers(sellers, run_ts)
    assert columns(tidy, "seller_city", "seller_state") == [("Lins", "SP")]


def test_products_get_an_english_category(spark, run_ts):
    products = raw(
        spark,
        "products",
        {"product_id": "p1", "product_category_name": "moveis", "product_photos_qty": "2.0"},
        {"product_id": "p2", "product_category_name": "novo"},
        {"product_id": "p3"},
    )
    translation = raw(
        spark,
        "translation",
        {"product_category_name": "moveis", "product_category_name_english": "furniture"},
        {"product_category_name": "moveis", "product_category_name_english": "furnitures"},
        {"product_category_name": None, "product_category_name_english": "nothing"},
    )
    expected = [
        ("p1", "moveis", "furniture", 2),
        ("p2", "novo", "novo", None),
        ("p3", None, "unknown", None),
    ]
    names = ("product_id", "product_category_name", "category_english", "product_photos_qty")
    cleaned = clean.clean_products(products, translation, run_ts)
    assert columns(cleaned, *names) == expected


def test_a_category_is_spread_over_more_tasks_than_there_are_categories(spark, run_ts):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        products = spark.range(4000).selectExpr(
            "cast(id as string) product_id", "if(id % 4 > 0, 'beds', 'cups') product_category_name",
            "'1' product_weight_g", "'1' product_length_cm", "'1' product_height_cm",
            "'1' product_width_cm", "'1' product_photos_qty",
        )
        translation = raw(
            spark,
            "translation",
            {"product_category_name": "beds", "product_category_name_english": "Beds"},
        )
        cleaned = clean.clean_products(products, translation, run_ts)
        sizes = cleaned.groupBy("category_english", F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(row["count"] for row in sizes) == 4000
    assert len([row for row in sizes if row["category_english"] == "Beds"]) > 4
    assert max(row["count"] for row in sizes) < 1500


def test_amounts_that_are_none_become_null(spark, run_ts):
    texts = ["inf", "NaN", "1e20", "-1e308", "900000000000000", "12.5"]
    df = raw(
        spark,
        "order_items",
        *[
            {"order_id": "o1", "order_item_id": str(n), "product_id": "p", "price": text}
            for n, text in enumerate(texts)
        ],
    )
    cleaned = clean.clean_order_items(df, run_ts)
    prices = [row["price"] for row in cleaned.orderBy("order_item_id").collect()]
    assert prices == [None, None, 1e20, -1e308, 9e14, 12.5]


def test_category_fill_option(spark):
    df = raw(
        spark,
        "products",
        {"product_id": "a7", "product_category_name": "cama"},
        {"product_id": "a8", "product_category_name": ""},
        {"product_id": "a9"},
    )
    filled = columns(clean.fill_category(df), "product_id", "product_category_name")
    assert filled == [("a7", "cama"), ("a8", ""), ("a9", "unknown")]


def test_zero_payments_stay_unless_asked_for(spark, run_ts):
    amounts = {"o1": "0", "o2": "0.01", "o3": "-3", "o4": "77.10", "o5": "x"}
    df = raw(
        spark,
        "payments",
        *[
            {"order_id": o, "payment_sequential": "1", "payment_value": value}
            for o, value in amounts.items()
        ],
    )
    cleaned = clean.clean_payments(df, run_ts)
    assert cleaned.count() == 5
    assert columns(clean.positive_payments(cleaned), "order_id") == [("o2",), ("o4",)]


def test_extra_columns_pass_through(spark, run_ts):
    df = raw(spark, "sellers", {"seller_id": "s1"}).withColumn("rating", F.lit("5"))
    assert clean.clean_sellers(df, run_ts).first()["rating"] == "5"


@pytest.mark.parametrize(
    "table, keys",
    [
        ("orders", ["order_id"]),
        ("customers", ["customer_id"]),
        ("order_items", ["order_id", "order_item_id"]),
        ("payments", ["order_id", "payment_sequential"]),
        ("sellers", ["seller_id"]),
    ],
)
def test_keys_are_unique_and_types_declared(spark, run_ts, table, keys):
    source = Standins(spark, "/root/testdata/sf0.001").raw(table)
    cleaned = getattr(clean, f"clean_{table}")(source, run_ts)
    kinds = {f.name: f.dataType for f in SILVER[table].fields}
    assert {f.name: f.dataType for f in cleaned.schema.fields} == kinds
    assert cleaned.groupBy(*keys).count().filter("count > 1").isEmpty()
    assert cleaned.count() == source.dropna(subset=_required(table)).select(*keys).distinct().count()


def _required(table):
    second = {
        "orders": ["customer_id"],
        "customers": ["customer_unique_id"],
        "order_items": ["product_id"],
    }
    first = {"customers": "customer_id", "sellers": "seller_id"}.get(table, "order_id")
    return [first, *second.get(table, [])]


def test_the_kept_duplicate_does_not_depend_on_partitioning(spark):
    rows = [(k % 7, f"v{(k * 37) % 101}", None if k % 5 else "x") for k in range(500)]
    df = spark.createDataFrame(rows, "k int, v string, w string")
    wanted = {}
    for key, v, w in rows:
        better = (v, w is not None, w or "")
        if key not in wanted or better < wanted[key]:
            wanted[key] = better
    expected = sorted((k, v, w if full else None) for k, (v, full, w) in wanted.items())
    for parts in (1, 3, 16):
        kept = keep_first(df.repartition(parts), ["k"])
        assert sorted(tuple(row) for row in kept.collect()) == expected


def test_duplicates_are_trimmed_before_the_shuffle(spark, capsys):
    keep_first(spark.range(1000).selectExpr("id % 3 AS k", "id AS v"), ["k"]).explain()
    before, after = capsys.readouterr().out.split("Exchange", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
