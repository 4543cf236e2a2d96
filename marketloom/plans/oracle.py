"""SQL counterparts of the registered queries, for DuckDB over the same tables.

Each query is a SELECT over named intermediate tables; ``oracle_sql`` puts the ones
it needs in front as common table expressions.
"""

from __future__ import annotations

import re
from collections.abc import Collection

from marketloom.operators.quality import Check, KnownKeys, NoNulls
from marketloom.plans.queries import CHECKS, MINIMA, NULLABLE_WHOLE, RUN_TS
from marketloom.schemas import BY_MONTH, GOLD, RAW
from marketloom.sources.standins import EXTREME, SKEWED, SQL, raw_sql

_AT = f"TIMESTAMP '{RUN_TS.isoformat(sep=' ')}'"
_TITLE = (
    "array_to_string(list_transform(string_split(lower(trim({0})), ' '),"
    " lambda w: concat(upper(w[1]), w[2:])), ' ')"
)


def _first_per(table: str, *keys: str) -> str:
    """QUALIFY clause: the first row of each key in order of all other columns."""
    rest = ", ".join(f"{c} NULLS FIRST" for c in RAW[table] if c not in keys)
    return f"QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {rest}) = 1"


def _sum(amount: str, digits: int = 2) -> str:
    return f"CAST(round(sum(CAST({amount} AS DECIMAL(18,4))), {digits}) AS DOUBLE)"


def _ratio(total: str, count: str, digits: int) -> str:
    """total / count rounded half away from zero, in whole-number arithmetic."""
    scale = 10**digits
    part = f"CAST(abs({total}) * {scale} AS HUGEINT)"
    whole = f"(2 * {part} + {count}) // nullif(2 * {count}, 0)"
    return f"CAST(sign({total}) * ({whole}) / {scale}.0 AS DOUBLE)"


def _avg(amount: str) -> str:
    return _ratio(f"sum(CAST({amount} AS DECIMAL(18,2)))", f"count({amount})", 2)


_CTES: dict[str, str] = {f"raw_{name}": raw_sql(name) for name in SQL}
_CTES["raw_extreme_items"] = raw_sql("order_items", EXTREME)
_CTES["x_priced"] = f"""
    SELECT seller_id, TRY_CAST(price AS DOUBLE) AS price
    FROM (SELECT * FROM raw_extreme_items WHERE order_id IS NOT NULL AND product_id IS NOT NULL
          {_first_per("order_items", "order_id", "order_item_id")}) AS kept"""
# Whole units of any size: doubles from 2^53 on have no fraction, those here none from 1e12 on.
_CTES["x_sums"] = """
    SELECT seller_id, count(price) FILTER (isfinite(price)) AS priced,
           count(*) - count(price) FILTER (isfinite(price)) AS unpriced,
           CAST(sum(CASE WHEN NOT isfinite(price) THEN NULL WHEN abs(price) < 1e12
                         THEN CAST(CAST(round(price * 10000) AS HUGEINT) AS BIGNUM)
                         ELSE CAST(CAST(CAST(price AS BIGNUM) AS VARCHAR) || '0000' AS BIGNUM)
                    END) AS VARCHAR) AS units
    FROM x_priced GROUP BY seller_id"""
_CTES |= {
    "s_orders": f"""
        SELECT order_id, customer_id, order_status,
               TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
               TRY_CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
               TRY_CAST(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_date,
               TRY_CAST(order_delivered_customer_date AS TIMESTAMP)
                    AS order_delivered_customer_date,
               TRY_CAST(order_estimated_delivery_date AS TIMESTAMP)
                    AS order_estimated_delivery_date,
               CAST(date_diff('day', TRY_CAST(order_estimated_delivery_date AS TIMESTAMP),
                    TRY_CAST(order_delivered_customer_date AS TIMESTAMP)) AS INTEGER)
                    AS delivery_delay_days,
               {_AT} AS processed_at,
               CAST(year(TRY_CAST(order_purchase_timestamp AS TIMESTAMP)) AS INTEGER)
                    AS purchase_year,
               CAST(month(TRY_CAST(order_purchase_timestamp AS TIMESTAMP)) AS INTEGER)
                    AS purchase_month
        FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
        {_first_per("orders", "order_id")}""",
    "s_customers": f"""
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
               {_TITLE.format("customer_city")} AS customer_city,
               upper(trim(customer_state)) AS customer_state, {_AT} AS processed_at
        FROM raw_customers WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL
        {_first_per("customers", "customer_id")}""",
    "s_items": f"""
        SELECT order_id, TRY_CAST(order_item_id AS INTEGER) AS order_item_id, product_id, seller_id,
               TRY_CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date,
               TRY_CAST(price AS DOUBLE) AS price,
               TRY_CAST(freight_value AS DOUBLE) AS freight_value,
               CAST(TRY_CAST(price AS DECIMAL(18,2)) + TRY_CAST(freight_value AS DECIMAL(18,2))
                    AS DOUBLE) AS item_total_value,
               {_AT} AS processed_at
        FROM raw_order_items WHERE order_id IS NOT NULL AND product_id IS NOT NULL
        {_first_per("order_items", "order_id", "order_item_id")}""",
    "s_products": f"""
        WITH kept AS (SELECT * FROM raw_products WHERE product_id IS NOT NULL
                      {_first_per("products", "product_id")})
        SELECT product_id, k.product_category_name,
               TRY_CAST(product_weight_g AS DOUBLE) AS product_weight_g,
               TRY_CAST(product_length_cm AS DOUBLE) AS product_length_cm,
               TRY_CAST(product_height_cm AS DOUBLE) AS product_height_cm,
               TRY_CAST(product_width_cm AS DOUBLE) AS product_width_cm,
               TRY_CAST(product_photos_qty AS INTEGER) AS product_photos_qty,
               coalesce(t.product_category_name_english, k.product_category_name, 'unknown')
                    AS category_english,
               {_AT} AS processed_at
        FROM kept k LEFT JOIN raw_translation t
          ON k.product_category_name = t.product_category_name""",
    "s_payments": f"""
        SELECT order_id, TRY_CAST(payment_sequential AS INTEGER) AS payment_sequential,
               payment_type,
               TRY_CAST(payment_installments AS INTEGER) AS payment_installments,
               TRY_CAST(payment_value AS DOUBLE) AS payment_value, {_AT} AS processed_at
        FROM raw_payments WHERE order_id IS NOT NULL
        {_first_per("payments", "order_id", "payment_sequential")}""",
    "s_sellers": f"""
        SELECT seller_id, seller_zip_code_prefix, {_TITLE.format("seller_city")} AS seller_city,
               upper(trim(seller_state)) AS seller_state, {_AT} AS processed_at
        FROM raw_sellers WHERE seller_id IS NOT NULL {_first_per("sellers", "seller_id")}""",
    "g_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
               CAST(week(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day_of_month,
               CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
               dayofweek(d) IN (0, 6) AS is_weekend, CAST(year(d) AS INTEGER) AS fiscal_year,
               CAST(quarter(d) AS INTEGER) AS fiscal_quarter, strftime(d, '%Y-%m') AS year_month
        FROM (SELECT CAST(unnest(generate_series(
                         least(TIMESTAMP '2016-01-01', min(order_purchase_timestamp)),
                         greatest(TIMESTAMP '2019-12-31', max(order_purchase_timestamp)),
                         INTERVAL 1 DAY)) AS DATE) AS d
              FROM s_orders) AS days""",
    "g_persons": """
        SELECT * FROM s_customers
        QUALIFY row_number() OVER
            (PARTITION BY customer_unique_id ORDER BY customer_id DESC) = 1""",
    "g_customers": f"""
        SELECT customer_unique_id, customer_id, customer_zip_code_prefix, customer_city,
               customer_state, {_AT} AS dw_created_at FROM g_persons""",
    "g_products": f"""
        SELECT product_id, product_category_name, category_english, product_weight_g,
               product_length_cm, product_height_cm, product_width_cm, product_photos_qty,
               product_length_cm * product_height_cm * product_width_cm AS volume_cm3,
               CASE WHEN product_weight_g <= 300 THEN 'Light'
                    WHEN product_weight_g <= 2000 THEN 'Medium'
                    WHEN product_weight_g <= 10000 THEN 'Heavy' ELSE 'Very Heavy' END
                    AS weight_tier,
               {_AT} AS dw_created_at
        FROM s_products""",
    "g_sellers": f"""
        SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state,
               {_AT} AS dw_created_at FROM s_sellers""",
    "g_payments": f"""
        SELECT order_id, {_sum("payment_value")} AS total_payment_value,
               count(DISTINCT payment_type) AS payment_methods_count,
               first(payment_type ORDER BY payment_sequential NULLS LAST, payment_type NULLS FIRST)
                    AS primary_payment_type,
               max(payment_installments) AS max_installments
        FROM s_payments GROUP BY order_id""",
    **{
        name: f"""
        SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, c.customer_unique_id,
               CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS order_date_key,
               i.price, i.freight_value, i.item_total_value AS gross_revenue,
               p.total_payment_value, p.max_installments, p.primary_payment_type, o.order_status,
               coalesce(o.order_delivered_customer_date <= o.order_estimated_delivery_date, false)
                    AS was_delivered_on_time,
               o.delivery_delay_days, o.purchase_year, o.purchase_month
        FROM s_items i {how} JOIN s_orders o ON i.order_id = o.order_id
        LEFT JOIN s_customers c ON o.customer_id = c.customer_id
        LEFT JOIN g_payments p ON i.order_id = p.order_id"""
        for name, how in (("g_fact", "INNER"), ("g_fact_left", "LEFT"))
    },
    "g_live": "SELECT * FROM g_fact WHERE order_status <> 'cancelled'",
    "g_revenue": f"""
        SELECT purchase_year, purchase_month, category_english,
               {_sum("gross_revenue")} AS total_revenue, {_sum("freight_value")} AS total_freight,
               {_sum("price", 4)} AS total_product_revenue,
               count(DISTINCT order_id) AS order_count, count(order_item_id) AS item_sold,
               {_avg("price")} AS avg_item_price
        FROM g_live LEFT JOIN s_products USING (product_id)
        GROUP BY purchase_year, purchase_month, category_english""",
    **{
        name: f"""
        WITH spent AS (
            SELECT customer_unique_id, count(DISTINCT order_id) AS total_orders,
                   {_sum("gross_revenue")} AS lifetime_value, {average} AS avg_order_value,
                   {_sum("freight_value")} AS total_freight_paid,
                   CAST(min(order_date_key) AS VARCHAR) AS first_order_date,
                   CAST(max(order_date_key) AS VARCHAR) AS last_order_date,
                   CAST({purchased} AS BIGINT) AS total_items_purchased
            FROM g_live GROUP BY customer_unique_id)
        SELECT s.*, p.customer_id, p.customer_city, p.customer_state,
               CASE WHEN lifetime_value >= 1000 THEN 'Gold'
                    WHEN lifetime_value >= 500 THEN 'Silver'
                    WHEN lifetime_value >= 100 THEN 'Bronze' ELSE 'New' END AS customer_tier,
               total_orders > 1 AS is_repeat_buyer
        FROM spent s LEFT JOIN g_persons p ON s.customer_unique_id = p.customer_unique_id"""
        for name, average, purchased in (
            ("g_ltv", _avg("gross_revenue"), "sum(order_item_id)"),
            (
                "g_ltv_per_order",
                _ratio(
                    "sum(CAST(gross_revenue AS DECIMAL(18,2)))", "count(DISTINCT order_id)", 2
                ),
                "count(order_item_id)",
            ),
        )
    },
    "g_performance": f"""
        WITH months AS (
            SELECT seller_id, purchase_year, purchase_month,
                   count(DISTINCT order_id) AS total_orders,
                   count(order_item_id) AS total_item_sold,
                   {_sum("price")} AS total_revenue, {_avg("price")} AS avg_item_price,
                   {_ratio("sum(delivery_delay_days)", "count(delivery_delay_days)", 1)}
                        AS avg_delivery_delay_days,
                   count(*) FILTER (was_delivered_on_time) AS on_time_deliveries,
                   count(order_item_id) AS total_deliveries
            FROM g_live GROUP BY seller_id, purchase_year, purchase_month)
        SELECT m.*, {_ratio("on_time_deliveries * 100", "total_deliveries", 2)}
                    AS on_time_delivery_rate,
               seller_zip_code_prefix, seller_city, seller_state, processed_at
        FROM months m LEFT JOIN s_sellers s ON m.seller_id = s.seller_id""",
}

_TABLES = {
    "dim_date": "g_date",
    "dim_customers": "g_customers",
    "dim_products": "g_products",
    "dim_sellers": "g_sellers",
    "fact_orders": "g_fact",
    "revenue_by_category": "g_revenue",
    "customer_lifetime_value": "g_ltv",
    "seller_performance": "g_performance",
}


def _minimum(table: str, least: int) -> str:
    return f"""SELECT '{table}' AS table_name, 'min_rows' AS check_name, count(*) AS observed,
        CAST({least} AS BIGINT) AS expected, count(*) >= {least} AS passed FROM {_TABLES[table]}"""


def _no_nulls(table: str, column: str) -> str:
    return f"""SELECT '{table}' AS table_name, 'nulls_in_{column}' AS check_name,
        count(*) FILTER ({column} IS NULL) AS observed, CAST(0 AS BIGINT) AS expected,
        count(*) FILTER ({column} IS NULL) = 0 AS passed FROM {_TABLES[table]}"""


def _known_keys(table: str, column: str, other: str, other_column: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}_without_{other}' AS check_name,
        count(*) AS observed, CAST(0 AS BIGINT) AS expected, count(*) = 0 AS passed
        FROM {_TABLES[table]}
        WHERE {column} IS NOT NULL
          AND {column} NOT IN (SELECT {other_column} FROM {_TABLES[other]})"""


def _check(check: Check) -> str:
    if isinstance(check, KnownKeys):
        return _known_keys(check.table, check.column, check.other, check.other_column)
    if isinstance(check, NoNulls):
        return _no_nulls(check.table, check.column)
    return _minimum(check.table, check.least)


def _unreadable(table: str, label: str, column: str) -> str:
    number = f"TRY_CAST({column} AS DOUBLE)"
    wrong = f"{column} IS NOT NULL AND ({number} IS NULL OR NOT isfinite({number}))"
    return f"""SELECT '{label}' AS table_name, 'unreadable_{column}' AS check_name,
        count(*) FILTER ({wrong}) AS observed, CAST(0 AS BIGINT) AS expected,
        count(*) FILTER ({wrong}) = 0 AS passed FROM {table}"""


def _integral(table: str, label: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{column}' AS column_name,"
        f" coalesce(bool_and({column} % 1 = 0), false) AS all_integral FROM {table}"
        for column in columns
    )


def _whole_as_double(table: str, *columns: str) -> str:
    doubles = ", ".join(f"CAST({column} AS DOUBLE) AS {column}" for column in columns)
    return f"SELECT * REPLACE ({doubles}) FROM {table}"


_ORDER_WHOLE = tuple(name for name in NULLABLE_WHOLE if name != "order_date_key")
_SIZES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")

_FINAL: dict[str, str] = {
    "clean_orders": _whole_as_double("s_orders", *_ORDER_WHOLE),
    "clean_customers": "SELECT * FROM s_customers",
    "clean_order_items": "SELECT * FROM s_items",
    "clean_products": "SELECT * FROM s_products",
    "clean_payments": "SELECT * FROM s_payments",
    "clean_sellers": "SELECT * FROM s_sellers",
    **{
        table: f"SELECT {', '.join(GOLD[table].fieldNames())} FROM {source}"
        for table, source in _TABLES.items()
    },
    "dim_date": "SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM g_date",
    "payments_per_order": "SELECT * FROM g_payments",
    "fact_orders": _whole_as_double("g_fact", *NULLABLE_WHOLE),
    "fact_orders_left": _whole_as_double("g_fact_left", *NULLABLE_WHOLE),
    "customer_lifetime_value_per_order": "SELECT * FROM g_ltv_per_order",
    "customer_repeat_counts": """
        SELECT count(customer_id) AS customer_ids, count(DISTINCT customer_unique_id) AS persons,
               count(customer_id) - count(DISTINCT customer_unique_id) AS repeat_ids
        FROM s_customers""",
    "category_price_totals": f"""
        SELECT category_english AS category, {_sum("price")} AS total_revenue
        FROM s_items LEFT JOIN s_products USING (product_id) GROUP BY category_english""",
    "join_row_loss": """
        SELECT count(*) AS item_rows, count(o.order_id) AS joined_rows,
               count(*) - count(o.order_id) AS lost_rows
        FROM s_items i LEFT JOIN s_orders o ON i.order_id = o.order_id""",
    "orders_required_fields": """
        SELECT * FROM raw_orders
        WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_status IS NOT NULL""",
    "payments_positive": "SELECT * FROM s_payments WHERE payment_value > 0",
    "category_fill_unknown": """
        SELECT * REPLACE (coalesce(product_category_name, 'unknown') AS product_category_name)
        FROM raw_products""",
    "dq_checks": " UNION ALL ".join(map(_check, CHECKS)),
    "money_extremes": f"""
        SELECT seller_id, CAST(units || 'e-4' AS DOUBLE) AS total_revenue,
               CASE WHEN abs(CAST(units || 'e-4' AS DOUBLE)) < 9e14 * priced
                    THEN CAST(sign(TRY_CAST(units AS HUGEINT))
                              * ((2 * abs(TRY_CAST(units AS HUGEINT)) + 100 * priced)
                                 // nullif(200 * priced, 0)) / 100.0 AS DOUBLE)
                    ELSE CAST(units || 'e-4' AS DOUBLE) / nullif(priced, 0)
               END AS avg_item_price, priced, unpriced
        FROM x_sums""",
    "delivery_checks": " UNION ALL ".join(
        [
            _unreadable("raw_extreme_items", "order_items", "price"),
            _unreadable("raw_extreme_items", "order_items", "freight_value"),
            _unreadable("raw_payments", "payments", "payment_value"),
        ]
    ),
    "staging_min_rows": " UNION ALL ".join(
        _minimum(table, MINIMA.get(table, 1)) for table in _TABLES
    ),
    "integral_columns": _integral("g_products", "dim_products", *_SIZES, "volume_cm3")
    + " UNION ALL "
    + _integral("s_payments", "payments", "payment_value"),
    "narrow_integral": "SELECT * REPLACE ("
    + "CAST(CAST(product_weight_g AS BIGINT) AS VARCHAR) AS product_weight_g, "
    + ", ".join(f"CAST({column} AS BIGINT) AS {column}" for column in (*_SIZES[1:], "volume_cm3"))
    + ") FROM g_products",
    "nan_to_null": "SELECT product_id, product_weight_g AS weight FROM s_products",
    "raw_csv_roundtrip": "SELECT * FROM raw_customers",
    "partitioned_roundtrip": _whole_as_double("s_orders", *_ORDER_WHOLE),
    "publish_roundtrip": _whole_as_double("g_fact", *NULLABLE_WHOLE),
}
_FINAL |= {f"daily_{table}": _FINAL[table] for table in GOLD}
_FINAL["daily_revenue_by_category"] = _whole_as_double("g_revenue", *BY_MONTH)
_FINAL["daily_seller_performance"] = _whole_as_double("g_performance", *BY_MONTH)

# Queries over variants of the raw tables.
_SKEWED = {f"{query}_skewed": query for query in ("fact_orders", "revenue_by_category")}


def _needed(sql: str, given: Collection[str]) -> list[str]:
    """Names of the intermediate tables a statement uses, in definition order."""
    found: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name in _CTES:
            if name not in found and name not in given and re.search(rf"\b{name}\b", text):
                found.add(name)
                pending.append(_CTES[name])
    return [name for name in _CTES if name in found]


def statement(query: str, given: Collection[str] = ()) -> str:
    """SQL of one query; intermediate tables in ``given`` exist already."""
    plain = _SKEWED.get(query, query)
    variant = {f"raw_{n}": raw_sql(n, SKEWED) for n in SKEWED} if query in _SKEWED else {}
    names = _needed(_FINAL[plain], given)
    tables = ",\n".join(f"{name} AS ({variant.get(name, _CTES[name])})" for name in names)
    return f"WITH {tables}\n{_FINAL[plain]}" if tables else _FINAL[plain]


def oracle_sql() -> dict[str, str]:
    return {query: statement(query) for query in [*_FINAL, *_SKEWED]}
