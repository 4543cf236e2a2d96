"""Column layouts of the raw, silver and gold tables.

Raw columns are always strings, so a raw layout is a tuple of names.  Silver and
gold layouts are ``StructType``s.  Gold strings are declared as ``VarcharType`` to
carry the widths that ``operators.conform`` enforces; Spark stores them as strings.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    VarcharType,
)

TEXT = StringType()
INT = IntegerType()
LONG = LongType()
DOUBLE = DoubleType()
FLAG = BooleanType()
DATE = DateType()
MOMENT = TimestampNTZType()


def layout(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


RAW: dict[str, tuple[str, ...]] = {
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "customers": (
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    "order_items": (
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    "products": (
        "product_id",
        "product_category_name",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_photos_qty",
    ),
    "translation": ("product_category_name", "product_category_name_english"),
    "payments": (
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ),
    "sellers": ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
}

# purchase_year and purchase_month come last: they are partition columns on disk.
SILVER: dict[str, StructType] = {
    "orders": layout(
        order_id=TEXT,
        customer_id=TEXT,
        order_status=TEXT,
        order_purchase_timestamp=MOMENT,
        order_approved_at=MOMENT,
        order_delivered_carrier_date=MOMENT,
        order_delivered_customer_date=MOMENT,
        order_estimated_delivery_date=MOMENT,
        delivery_delay_days=INT,
        processed_at=MOMENT,
        purchase_year=INT,
        purchase_month=INT,
    ),
    "customers": layout(
        customer_id=TEXT,
        customer_unique_id=TEXT,
        customer_zip_code_prefix=TEXT,
        customer_city=TEXT,
        customer_state=TEXT,
        processed_at=MOMENT,
    ),
    "order_items": layout(
        order_id=TEXT,
        order_item_id=INT,
        product_id=TEXT,
        seller_id=TEXT,
        shipping_limit_date=MOMENT,
        price=DOUBLE,
        freight_value=DOUBLE,
        item_total_value=DOUBLE,
        processed_at=MOMENT,
    ),
    "products": layout(
        product_id=TEXT,
        product_category_name=TEXT,
        product_weight_g=DOUBLE,
        product_length_cm=DOUBLE,
        product_height_cm=DOUBLE,
        product_width_cm=DOUBLE,
        product_photos_qty=INT,
        category_english=TEXT,
        processed_at=MOMENT,
    ),
    "payments": layout(
        order_id=TEXT,
        payment_sequential=INT,
        payment_type=TEXT,
        payment_installments=INT,
        payment_value=DOUBLE,
        processed_at=MOMENT,
    ),
    "sellers": layout(
        seller_id=TEXT,
        seller_zip_code_prefix=TEXT,
        seller_city=TEXT,
        seller_state=TEXT,
        processed_at=MOMENT,
    ),
}

GOLD: dict[str, StructType] = {
    "dim_date": layout(
        date_key=INT,
        full_date=DATE,
        year=INT,
        quarter=INT,
        month=INT,
        month_name=VarcharType(20),
        week=INT,
        day_of_month=INT,
        day_of_week=INT,
        day_name=VarcharType(20),
        is_weekend=FLAG,
        fiscal_year=INT,
        fiscal_quarter=INT,
        year_month=VarcharType(10),
    ),
    "dim_customers": layout(
        customer_unique_id=VarcharType(50),
        customer_id=VarcharType(50),
        customer_zip_code_prefix=VarcharType(10),
        customer_city=VarcharType(100),
        customer_state=VarcharType(5),
        dw_created_at=MOMENT,
    ),
    "dim_products": layout(
        product_id=VarcharType(50),
        product_category_name=VarcharType(100),
        category_english=VarcharType(100),
        product_weight_g=DOUBLE,
        product_length_cm=DOUBLE,
        product_height_cm=DOUBLE,
        product_width_cm=DOUBLE,
        product_photos_qty=INT,
        volume_cm3=DOUBLE,
        weight_tier=VarcharType(20),
        dw_created_at=MOMENT,
    ),
    "dim_sellers": layout(
        seller_id=VarcharType(50),
        seller_zip_code_prefix=VarcharType(10),
        seller_city=VarcharType(100),
        seller_state=VarcharType(5),
        dw_created_at=MOMENT,
    ),
    "fact_orders": layout(
        order_id=VarcharType(50),
        order_item_id=INT,
        product_id=VarcharType(50),
        seller_id=VarcharType(50),
        customer_unique_id=VarcharType(50),
        order_date_key=INT,
        price=DOUBLE,
        freight_value=DOUBLE,
        gross_revenue=DOUBLE,
        total_payment_value=DOUBLE,
        max_installments=INT,
        primary_payment_type=VarcharType(30),
        order_status=VarcharType(30),
        was_delivered_on_time=FLAG,
        delivery_delay_days=INT,
        purchase_year=INT,
        purchase_month=INT,
    ),
    "revenue_by_category": layout(
        purchase_year=INT,
        purchase_month=INT,
        category_english=VarcharType(100),
        total_revenue=DOUBLE,
        total_freight=DOUBLE,
        total_product_revenue=DOUBLE,
        order_count=LONG,
        item_sold=LONG,
        avg_item_price=DOUBLE,
    ),
    "customer_lifetime_value": layout(
        customer_unique_id=VarcharType(50),
        total_orders=LONG,
        lifetime_value=DOUBLE,
        avg_order_value=DOUBLE,
        total_freight_paid=DOUBLE,
        first_order_date=VarcharType(10),
        last_order_date=VarcharType(10),
        total_items_purchased=LONG,
        customer_id=VarcharType(50),
        customer_city=VarcharType(100),
        customer_state=VarcharType(5),
        customer_tier=VarcharType(20),
        is_repeat_buyer=FLAG,
    ),
    "seller_performance": layout(
        seller_id=VarcharType(50),
        purchase_year=INT,
        purchase_month=INT,
        total_orders=LONG,
        total_item_sold=LONG,
        total_revenue=DOUBLE,
        avg_item_price=DOUBLE,
        avg_delivery_delay_days=DOUBLE,
        on_time_deliveries=LONG,
        total_deliveries=LONG,
        on_time_delivery_rate=DOUBLE,
        seller_zip_code_prefix=VarcharType(10),
        seller_city=VarcharType(100),
        seller_state=VarcharType(5),
        processed_at=MOMENT,
    ),
}

BY_MONTH = ("purchase_year", "purchase_month")

PARTITIONS: dict[str, tuple[str, ...]] = {
    "orders": BY_MONTH,
    "fact_orders": BY_MONTH,
    "revenue_by_category": BY_MONTH,
    "seller_performance": BY_MONTH,
}


def stored(schema: StructType) -> StructType:
    """The schema as Spark stores it: declared string widths become plain strings."""
    return StructType(
        [
            StructField(f.name, TEXT if isinstance(f.dataType, VarcharType) else f.dataType)
            for f in schema.fields
        ]
    )
