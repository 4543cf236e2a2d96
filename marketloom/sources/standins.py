"""Raw stand-in tables derived from the test data.

The test data has no NULLs, is already typed and has no payments, so each raw table
is derived from it as strings with some dirt added, to give the cleaners real work.
The SQL is understood by Spark and DuckDB alike; ``{orders}`` and so on name the
source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_PRICE = (
    "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3))"
    " AS DECIMAL(12,2))"
)
_FREIGHT = (
    "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3))"
    " * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2))"
)

SQL: dict[str, str] = {
    "orders": """
        SELECT CAST(o_orderkey AS STRING) AS order_id,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    ELSE CAST(o_orderkey AS STRING) END AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                    ELSE 'cancelled' END AS order_status,
               CAST(o_orderdate AS STRING) AS order_purchase_timestamp,
               CAST(o_orderdate + INTERVAL 1 DAY AS STRING) AS order_approved_at,
               CAST(o_orderdate + INTERVAL 2 DAY AS STRING) AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F'
                    THEN CAST(o_orderdate + INTERVAL 1 DAY * CAST(o_orderkey % 60 AS INT) AS STRING)
                    END AS order_delivered_customer_date,
               CAST(o_orderdate + INTERVAL 30 DAY AS STRING) AS order_estimated_delivery_date
        FROM {orders}""",
    "customers": """
        SELECT CAST(o_orderkey AS STRING) AS customer_id,
               CASE WHEN o_orderkey % 89 <> 0 THEN CAST(o_custkey AS STRING) END
                    AS customer_unique_id,
               CAST(c_nationkey AS STRING) AS customer_zip_code_prefix,
               concat('  ', lower(c_mktsegment), ' ', lower(r_name), ' ') AS customer_city,
               concat(' ', lower(substr(r_name, 1, 2)), ' ') AS customer_state
        FROM {orders}
        JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey
        JOIN {region} ON n_regionkey = r_regionkey""",
    "order_items": f"""
        SELECT CAST(l_orderkey AS STRING) AS order_id,
               CAST(l_linenumber AS STRING) AS order_item_id,
               CAST(l_partkey AS STRING) AS product_id,
               CAST(l_suppkey AS STRING) AS seller_id,
               CAST(l_shipdate AS STRING) AS shipping_limit_date,
               CAST({_PRICE} AS STRING) AS price,
               CAST({_FREIGHT} AS STRING) AS freight_value
        FROM {{lineitem}}""",
    "products": """
        SELECT CAST(p_partkey AS STRING) AS product_id,
               CASE WHEN p_partkey % 50 <> 0 THEN lower(p_type) END AS product_category_name,
               CASE WHEN p_partkey % 41 <> 0 THEN CAST(p_size * 250 AS STRING) END
                    AS product_weight_g,
               CAST(p_size + 10 AS STRING) AS product_length_cm,
               CAST(p_partkey % 30 + 2 AS STRING) AS product_height_cm,
               CAST(p_partkey % 20 + 5 AS STRING) AS product_width_cm,
               CAST(p_partkey % 6 AS STRING) AS product_photos_qty
        FROM {part}""",
    # One row per part type that has a translation; 'medium' is left without one.
    "translation": """
        SELECT product_category_name,
               CASE product_category_name
                    WHEN 'economy' THEN 'Economy Class' WHEN 'standard' THEN 'Standard Class'
                    WHEN 'promo' THEN 'Promotional' WHEN 'large' THEN 'Large Size'
                    WHEN 'small' THEN 'Small Size' END AS product_category_name_english
        FROM (SELECT DISTINCT lower(p_type) AS product_category_name FROM {part}) AS types
        WHERE product_category_name IN ('economy', 'standard', 'promo', 'large', 'small')""",
    "payments": f"""
        SELECT CAST(l_orderkey AS STRING) AS order_id,
               CAST(l_linenumber AS STRING) AS payment_sequential,
               CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
                    ELSE 'voucher' END AS payment_type,
               CAST(CAST(l_quantity AS INT) AS STRING) AS payment_installments,
               CASE WHEN l_partkey % 101 = 0 THEN '0.00'
                    ELSE CAST({_PRICE} AS STRING) END AS payment_value
        FROM {{lineitem}}""",
    "sellers": """
        SELECT CAST(s_suppkey AS STRING) AS seller_id,
               CAST(s_nationkey AS STRING) AS seller_zip_code_prefix,
               concat('  ', lower(n_name), ' ', lower(r_name), ' ') AS seller_city,
               concat(' ', lower(substr(r_name, 1, 2)), ' ') AS seller_state
        FROM {supplier}
        JOIN {nation} ON s_nationkey = n_nationkey
        JOIN {region} ON n_regionkey = r_regionkey""",
}

# Keys that a third of the rows gets in the skewed tables; both exist in all test data.
HOT_ORDER, HOT_PRODUCT, HOT_CUSTOMER = "4", "3", "5"

# Variants of raw tables, as SQL over the plain ones.
SKEWED: dict[str, str] = {
    "orders": f"""
        SELECT order_id,
               CASE WHEN customer_id IS NOT NULL AND CAST(order_id AS BIGINT) % 3 = 1
                    THEN '{HOT_CUSTOMER}' ELSE customer_id END AS customer_id,
               order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date,
               order_estimated_delivery_date
        FROM {{plain}}""",
    "order_items": f"""
        SELECT CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN '{HOT_ORDER}' ELSE order_id END
                    AS order_id,
               CASE WHEN CAST(order_id AS BIGINT) % 3 = 0
                    THEN CAST(CAST(order_id AS BIGINT) * 8 + CAST(order_item_id AS BIGINT)
                              AS STRING)
                    ELSE order_item_id END AS order_item_id,
               CASE WHEN CAST(seller_id AS BIGINT) % 3 = 0 THEN '{HOT_PRODUCT}' ELSE product_id END
                    AS product_id,
               seller_id, shipping_limit_date, price, freight_value
        FROM {{plain}}""",
}
EXTREME: dict[str, str] = {
    "order_items": """
        SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
               CASE WHEN CAST(order_id AS BIGINT) % 50 > 0 THEN price
                    WHEN order_item_id = '1' THEN 'inf' WHEN order_item_id = '2' THEN '1e20'
                    WHEN order_item_id = '3' THEN 'NaN' WHEN order_item_id = '4' THEN '-1e300'
                    ELSE '900000000000000' END AS price,
               freight_value
        FROM {plain}""",
}

# The source tables that are read, as declared in the test data.
SOURCES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


class Standins:
    """The raw tables derived from the Parquet files of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, variant: dict[str, str] | None = None):
        self._variant = variant or {}
        self._spark = spark
        self._sf_dir = sf_dir
        self._sources: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """The raw table ``name``."""
        used = [source for source in SOURCES if f"{{{source}}}" in SQL[name]]
        plain = self._spark.sql(SQL[name], **{source: self.source(source) for source in used})
        if name not in self._variant:
            return plain
        return self._spark.sql(self._variant[name], plain=plain)

    def source(self, name: str) -> DataFrame:
        """A source table as declared in the test data."""
        if name not in self._sources:
            reader = self._spark.read.schema(SOURCES[name])
            self._sources[name] = reader.parquet(f"{self._sf_dir}/{name}.parquet")
        return self._sources[name]


def raw_sql(name: str, variant: dict[str, str] | None = None) -> str:
    """The same table as SQL over views named like the source tables."""
    plain = SQL[name].format(**{source: source for source in SOURCES})
    if not variant or name not in variant:
        return plain
    return variant[name].format(plain=f"({plain}) AS plain")
