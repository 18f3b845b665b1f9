"""The same queries as plain SQL over the same tables, for a second engine to run."""

from __future__ import annotations

import re

# Each entry is one common table expression; a query is given those it refers to.
TABLES = {
    "places": """
        SELECT n_nationkey, n_name, r_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "raw_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'person-' || (c_custkey // 2) AS customer_unique_id,
               n_name AS customer_city, r_name AS customer_state,
               CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix
        FROM customer JOIN places ON c_nationkey = n_nationkey""",
    "raw_sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, n_name AS seller_city,
               r_name AS seller_state, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix
        FROM supplier JOIN places ON s_nationkey = n_nationkey""",
    "geo": """
        SELECT CAST(c_nationkey AS VARCHAR) AS geolocation_zip_code_prefix,
               min(n_name) AS geolocation_city, min(r_name) AS geolocation_state,
               round(avg(c_acctbal), 6) AS avg_latitude,
               round(avg(CAST(c_custkey AS DOUBLE)), 6) AS avg_longitude
        FROM customer JOIN places ON c_nationkey = n_nationkey GROUP BY c_nationkey""",
    "raw_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category_name,
               CAST(length(p_name) AS INTEGER) AS product_name_lenght,
               CAST(length(p_brand) AS INTEGER) AS product_description_lenght,
               p_size AS product_photos_qty, p_retailprice AS product_weight_g,
               CAST(p_size AS DOUBLE) AS product_length_cm,
               CAST(p_size + 1 AS DOUBLE) AS product_height_cm,
               CAST(p_size + 2 AS DOUBLE) AS product_width_cm
        FROM part""",
    "products": """
        SELECT *, lower(product_category_name) AS product_category_name_english
        FROM raw_products""",
    "raw_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp,
               o_orderdate + INTERVAL 1 DAY AS order_approved_at,
               o_orderdate + to_days(handed_over) AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate + to_days(handed_over + travelled)
               END AS order_delivered_customer_date,
               o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
        FROM (SELECT *, CAST(2 + o_orderkey % 5 AS INTEGER) AS handed_over,
                     CAST(1 + (o_orderkey * 7 + o_custkey) % 40 AS INTEGER) AS travelled
              FROM orders)""",
    "raw_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_linenumber AS VARCHAR) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               CAST(l_quantity AS DOUBLE) AS freight_value
        FROM lineitem""",
    "event_props": """
        SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "raw_payments": """
        SELECT CAST(event_id // 4 AS VARCHAR) AS order_id,
               CAST(1 + user_id % 3 AS VARCHAR) AS payment_sequential,
               event_type AS payment_type, k AS payment_installments, value AS payment_value,
               event_id AS arrival
        FROM event_props""",
    "raw_reviews": """
        SELECT CAST(event_id // 2 AS VARCHAR) AS review_id,
               CAST(event_id // 6 AS VARCHAR) AS order_id, 1 + k % 5 AS review_score,
               'rated ' || json_extract_string(props, '$.k') AS review_comment_title,
               CAST(props AS VARCHAR) AS review_comment_message,
               CAST(ts AS DATE) AS review_creation_date, ts AS review_answer_timestamp,
               event_id AS arrival, event_type = 'error' AS failed
        FROM event_props""",
    "payments": """
        SELECT * EXCLUDE (arrival) FROM raw_payments
        QUALIFY row_number() OVER (
            PARTITION BY order_id, payment_sequential ORDER BY arrival) = 1""",
    "reviews": """
        SELECT * EXCLUDE (arrival, failed) FROM raw_reviews
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY arrival) = 1""",
    "sellers_geo": """
        SELECT s.*, g.* FROM raw_sellers s
        JOIN geo g ON s.seller_zip_code_prefix = g.geolocation_zip_code_prefix""",
    "customers_geo": """
        SELECT c.*, g.* FROM raw_customers c
        JOIN geo g ON c.customer_zip_code_prefix = g.geolocation_zip_code_prefix""",
    "valid_orders": """
        SELECT * FROM raw_orders WHERE customer_id IN (SELECT customer_id FROM customers_geo)""",
    "items_product": """
        SELECT * FROM raw_items WHERE product_id IN (SELECT product_id FROM products)""",
    "items_seller": """
        SELECT * FROM items_product WHERE seller_id IN (SELECT seller_id FROM sellers_geo)""",
    "items_order": """
        SELECT * FROM items_seller WHERE order_id IN (SELECT order_id FROM valid_orders)""",
    "valid_payments": """
        SELECT * FROM payments WHERE order_id IN (SELECT order_id FROM valid_orders)""",
    "valid_reviews": """
        SELECT * FROM reviews WHERE order_id IN (SELECT order_id FROM valid_orders)""",
    "bounds": """
        SELECT CAST(min(order_purchase_timestamp) AS DATE) AS lo,
               CAST(max(order_purchase_timestamp) AS DATE) AS hi FROM valid_orders""",
    "spine": """
        SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds""",
    "dim_date": """
        SELECT row_number() OVER (ORDER BY day) AS date_sk, day AS date,
               day(day) AS day, dayofweek(day) + 1 AS day_of_week, month(day) AS month,
               year(day) AS year, quarter(day) AS quarter
        FROM spine, bounds WHERE day > lo""",
    "dim_customers": """
        SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, customer_id,
               customer_unique_id, customer_city, customer_state, customer_zip_code_prefix
        FROM customers_geo""",
    "dim_sellers": """
        SELECT row_number() OVER (ORDER BY seller_id) AS seller_sk, seller_id, seller_city,
               seller_state, seller_zip_code_prefix
        FROM sellers_geo""",
    "dim_products": """
        SELECT row_number() OVER (ORDER BY product_id) AS product_sk, product_id,
               product_category_name_english AS product_category_english_name,
               product_category_name, product_name_lenght AS product_name_length,
               product_description_lenght AS product_description_length, product_photos_qty,
               product_weight_g, product_length_cm, product_height_cm, product_width_cm
        FROM products""",
    "dim_reviews": """
        SELECT row_number() OVER (ORDER BY review_id) AS review_sk, review_id, review_score,
               review_comment_title, review_comment_message, review_creation_date,
               review_answer_timestamp
        FROM valid_reviews""",
    "lifecycle": """
        SELECT i.order_id, CAST(i.order_item_id AS BIGINT) AS order_item_id,
               i.order_item_id AS item_text, i.product_id, i.seller_id, c.customer_sk, p.product_sk, s.seller_sk,
               d1.date_sk AS order_purchase_date_sk, d2.date_sk AS order_approved_date_sk,
               d3.date_sk AS shipping_limit_date_sk, d4.date_sk AS delivered_carrier_date_sk,
               d5.date_sk AS delivered_customer_date_sk, d6.date_sk AS estimated_delivery_date_sk,
               r.review_id, r.review_sk, o.order_status, i.shipping_limit_date,
               o.order_purchase_timestamp, o.order_approved_at, o.order_delivered_carrier_date,
               o.order_delivered_customer_date, o.order_estimated_delivery_date,
               i.price, i.freight_value, i.price + i.freight_value AS total_price
        FROM items_order i
        JOIN valid_orders o ON i.order_id = o.order_id
        JOIN dim_customers c ON o.customer_id = c.customer_id
        JOIN dim_products p ON i.product_id = p.product_id
        JOIN dim_sellers s ON i.seller_id = s.seller_id
        LEFT JOIN valid_reviews v ON i.order_id = v.order_id
        LEFT JOIN dim_reviews r ON v.review_id = r.review_id
        LEFT JOIN dim_date d1 ON CAST(o.order_purchase_timestamp AS DATE) = d1.date
        LEFT JOIN dim_date d2 ON CAST(o.order_approved_at AS DATE) = d2.date
        LEFT JOIN dim_date d3 ON CAST(i.shipping_limit_date AS DATE) = d3.date
        LEFT JOIN dim_date d4 ON CAST(o.order_delivered_carrier_date AS DATE) = d4.date
        LEFT JOIN dim_date d5 ON CAST(o.order_delivered_customer_date AS DATE) = d5.date
        LEFT JOIN dim_date d6 ON CAST(o.order_estimated_delivery_date AS DATE) = d6.date""",
    "fact_orderlifecycle": """
        SELECT row_number() OVER (
                   ORDER BY order_id, item_text, review_id NULLS FIRST, product_id, seller_id,
                            shipping_limit_date, price, freight_value) AS order_sk,
               * EXCLUDE (item_text, review_id, product_id, seller_id)
        FROM lifecycle""",
    "fact_orderpayments": """
        SELECT row_number() OVER (
                   ORDER BY p.order_id, CAST(p.payment_sequential AS BIGINT)) AS payment_sk,
               p.order_id, CAST(p.payment_sequential AS BIGINT) AS payment_sequential,
               p.payment_type, p.payment_installments, p.payment_value, c.customer_sk,
               d.date_sk AS payment_date_sk, o.order_purchase_timestamp AS payment_timestamp
        FROM valid_payments p
        JOIN valid_orders o ON p.order_id = o.order_id
        JOIN dim_customers c ON o.customer_id = c.customer_id
        LEFT JOIN dim_date d ON CAST(o.order_purchase_timestamp AS DATE) = d.date""",
    "customers_in_loads": """
        SELECT row_number() OVER (
                   ORDER BY customer_id IN (SELECT customer_id FROM raw_orders
                                            WHERE order_purchase_timestamp < DATE '1998-01-01') DESC,
                            customer_id) AS customer_sk,
               * EXCLUDE (customer_sk)
        FROM dim_customers""",
    "item_sales": """
        SELECT i.order_id, i.product_id, o.customer_id, o.order_purchase_timestamp,
               i.price + i.freight_value AS total_price
        FROM items_order i JOIN valid_orders o ON i.order_id = o.order_id""",
    "order_events": """
        SELECT DISTINCT order_id, order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date,
               order_estimated_delivery_date
        FROM fact_orderlifecycle""",
    "findings": """
        SELECT DISTINCT 'orphan_sellers' AS "check", seller_id AS orphan_key FROM raw_items
        WHERE seller_id NOT IN (SELECT seller_id FROM sellers_geo)
        UNION ALL
        SELECT DISTINCT 'orphan_products', product_id FROM raw_items
        WHERE product_id NOT IN (SELECT product_id FROM products)
        UNION ALL
        SELECT DISTINCT 'orphan_customer_zips', customer_zip_code_prefix FROM raw_customers
        WHERE customer_zip_code_prefix NOT IN (SELECT geolocation_zip_code_prefix FROM geo)
        UNION ALL
        SELECT DISTINCT 'orders_without_items', order_id FROM raw_orders
        WHERE order_id NOT IN (SELECT order_id FROM raw_items)""",
    "spend": """
        SELECT customer_unique_id, sum(payment_value) AS spend
        FROM fact_orderpayments JOIN dim_customers USING (customer_sk)
        GROUP BY customer_unique_id""",
    "segments": """
        SELECT customer_unique_id, spend,
               CASE WHEN spend >= quantile_cont(spend, 2.0 / 3.0) OVER () THEN 'High'
                    WHEN spend >= quantile_cont(spend, 1.0 / 3.0) OVER () THEN 'Medium'
                    ELSE 'Low' END AS segment
        FROM spend""",
    "monthly": """
        SELECT CAST(date_trunc('month', payment_timestamp) AS DATE) AS month,
               sum(payment_value) AS value
        FROM fact_orderpayments GROUP BY 1""",
    "months": """
        SELECT m.month, coalesce(value, 0.0) AS value
        FROM (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE)
                     AS month FROM monthly) m
        LEFT JOIN monthly ON m.month = monthly.month""",
}

# Chains from zips and categories down, once more over tables with gaps (sources/adapter.py).
_CUT = {"geo": "c_nationkey < 20", "products": "product_category_name <> 'STANDARD'"}
_CHAIN = (
    "geo products sellers_geo customers_geo valid_orders items_product items_seller items_order "
    "valid_payments valid_reviews findings"
).split()


def _with_gaps(sql: str) -> str:
    return re.sub(rf"\b({'|'.join(_CHAIN)})\b", r"gaps_\1", sql)


def _cut(name: str) -> str:
    body = _with_gaps(TABLES[name])
    if name not in _CUT:
        return body
    head, group, tail = body.partition(" GROUP BY")
    return f"{head} WHERE {_CUT[name]}{group}{tail}"


TABLES |= {f"gaps_{name}": _cut(name) for name in _CHAIN}


def _days(select: str, *days: str) -> str:
    """``select`` with the named day columns as text."""
    texts = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in days)
    return f"SELECT * REPLACE ({texts}) FROM ({select})"


_EVENT_DAYS = {
    "order_purchase_date": "order_purchase_timestamp",
    "order_approved_date": "order_approved_at",
    "delivered_carrier_date": "order_delivered_carrier_date",
    "delivered_customer_date": "order_delivered_customer_date",
    "estimated_delivery_date": "order_estimated_delivery_date",
}

_FAILED_REVIEWS = """
    SELECT * EXCLUDE (arrival, failed) FROM (
        SELECT * REPLACE (CASE WHEN NOT failed THEN order_id END AS order_id) FROM raw_reviews
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY {order}) = 1)
    WHERE order_id IS NOT NULL"""


def _rejected(table: str, column: str, all_rows: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS key_name, "
        f"count({all_rows}) - count(DISTINCT {column}) AS violations FROM {table}"
    )


def _dangling(table: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS key_name, count(*) AS violations "
        f"FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"
    )


# Declared keys of the warehouse tables.
_PRIMARY = {
    "dim_customers": "customer_sk",
    "dim_sellers": "seller_sk",
    "dim_products": "product_sk",
    "dim_reviews": "review_sk",
    "dim_date": "date_sk",
    "fact_orderlifecycle": "order_sk",
    "fact_orderpayments": "payment_sk",
}

_UNIQUE = {
    "dim_customers": "customer_id",
    "dim_sellers": "seller_id",
    "dim_products": "product_id",
    "dim_reviews": "review_id",
    "dim_date": "date",
}

_FOREIGN = [
    ("fact_orderlifecycle", "customer_sk", "dim_customers", "customer_sk"),
    ("fact_orderlifecycle", "product_sk", "dim_products", "product_sk"),
    ("fact_orderlifecycle", "seller_sk", "dim_sellers", "seller_sk"),
    ("fact_orderlifecycle", "order_purchase_date_sk", "dim_date", "date_sk"),
    ("fact_orderlifecycle", "order_approved_date_sk", "dim_date", "date_sk"),
    ("fact_orderlifecycle", "shipping_limit_date_sk", "dim_date", "date_sk"),
    ("fact_orderlifecycle", "delivered_carrier_date_sk", "dim_date", "date_sk"),
    ("fact_orderlifecycle", "delivered_customer_date_sk", "dim_date", "date_sk"),
    ("fact_orderlifecycle", "estimated_delivery_date_sk", "dim_date", "date_sk"),
    ("fact_orderlifecycle", "review_sk", "dim_reviews", "review_sk"),
    ("fact_orderpayments", "customer_sk", "dim_customers", "customer_sk"),
    ("fact_orderpayments", "payment_date_sk", "dim_date", "date_sk"),
]

_COUNTED = {
    "customers": "customers_geo",
    "orders": "valid_orders",
    "order_items": "items_order",
    "products": "products",
    "sellers": "sellers_geo",
    "geolocation": "geo",
    "payments": "valid_payments",
    "reviews": "valid_reviews",
    "categories": "(SELECT DISTINCT p_type FROM part WHERE p_type <> 'STANDARD')",
}


def _finding(check: str, column: str) -> str:
    return f"SELECT orphan_key AS {column} FROM gaps_findings WHERE \"check\" = '{check}'"


def _diff(end: str, start: str) -> str:
    return f"round(avg(date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE))), 6)"


BODIES = {
    "clean_drop_null_keys": """
        SELECT * EXCLUDE (arrival) FROM raw_payments WHERE payment_type <> 'error'""",
    "typed_orders": "SELECT * FROM raw_orders",
    "typed_order_items": "SELECT * FROM raw_items",
    "typed_products": "SELECT * FROM raw_products",
    "event_dates": "SELECT order_id, "
    + ", ".join(f"CAST(CAST({m} AS DATE) AS VARCHAR) AS {d}" for d, m in _EVENT_DAYS.items())
    + " FROM raw_orders",
    "shipping_limit_days": """
        SELECT order_id, order_item_id,
               CAST(CAST(shipping_limit_date AS DATE) AS VARCHAR) AS shipping_limit_day
        FROM raw_items""",
    "date_attributes": """
        SELECT order_id, CAST(CAST(t AS DATE) AS VARCHAR) AS date, day(t) AS day,
               dayofweek(t) + 1 AS day_of_week, month(t) AS month, year(t) AS year,
               quarter(t) AS quarter
        FROM (SELECT order_id, order_purchase_timestamp AS t FROM raw_orders)""",
    "item_total_price": """
        SELECT order_id, order_item_id, price + freight_value AS total_price FROM raw_items""",
    "dedup_reviews": _days("SELECT * FROM reviews", "review_creation_date"),
    "dedup_payments": "SELECT * FROM payments",
    "dedup_orders": """
        SELECT * FROM (
            SELECT * FROM raw_orders UNION ALL
            SELECT * REPLACE ('Z' AS order_status) FROM raw_orders
            WHERE CAST(order_id AS BIGINT) % 3 = 0)
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_status) = 1""",
    "dimensions_from_repeats": """
        SELECT 'dim_customers' AS table_name, customer_sk AS sk, customer_id AS id,
               CAST(CASE WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN 'A' ELSE customer_city END AS VARCHAR)
                   AS attribute
        FROM dim_customers
        UNION ALL SELECT 'dim_sellers' AS table_name, seller_sk AS sk, seller_id AS id,
               CAST(CASE WHEN CAST(seller_id AS BIGINT) % 3 = 0 THEN 'A' ELSE seller_city END AS VARCHAR)
                   AS attribute
        FROM dim_sellers
        UNION ALL SELECT 'dim_products' AS table_name, product_sk AS sk, product_id AS id,
               CAST(CASE WHEN CAST(product_id AS BIGINT) % 3 = 0 THEN product_photos_qty - 1 ELSE product_photos_qty END AS VARCHAR)
                   AS attribute
        FROM dim_products""",
    "unreadable_numbers": """
        SELECT * REPLACE (CASE WHEN order_item_id NOT IN ('3', '5') THEN price END AS price)
        FROM raw_items""",
    "dedup_then_dropna": _days(_FAILED_REVIEWS.format(order="arrival"), "review_creation_date"),
    "dedup_prefers_order": _days(
        _FAILED_REVIEWS.format(order="failed, arrival"), "review_creation_date"
    ),
    "geolocation_rollup": "SELECT * FROM geo",
    "products_translated": "SELECT * FROM products",
    "orphan_sellers": _finding("orphan_sellers", "seller_id"),
    "orphan_products": _finding("orphan_products", "product_id"),
    "orphan_customer_zips": _finding("orphan_customer_zips", "customer_zip_code_prefix"),
    "orders_without_items": _finding("orders_without_items", "order_id"),
    "integrity_findings": "SELECT * FROM gaps_findings",
    "integrity_report": 'SELECT "check", count(*) AS orphans FROM gaps_findings GROUP BY "check"',
    "items_with_valid_product": "SELECT * FROM gaps_items_product",
    "items_with_valid_seller": "SELECT * FROM gaps_items_seller",
    "items_with_valid_order": "SELECT * FROM gaps_items_order",
    "sellers_with_geo": "SELECT * FROM gaps_sellers_geo",
    "customers_with_geo": "SELECT * FROM gaps_customers_geo",
    "orders_with_valid_customer": "SELECT * FROM gaps_valid_orders",
    "reviews_with_valid_order": _days("SELECT * FROM gaps_valid_reviews", "review_creation_date"),
    "payments_with_valid_order": "SELECT * FROM gaps_valid_payments",
    "cascade_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {_with_gaps(source)}"
        for name, source in _COUNTED.items()
    ),
    "purchase_date_bounds": _days("SELECT * FROM bounds", "lo", "hi"),
    "date_spine": """
        SELECT row_number() OVER (ORDER BY day) AS date_sk, CAST(day AS VARCHAR) AS date
        FROM spine, bounds WHERE day > lo""",
    "date_spine_inclusive": """
        SELECT row_number() OVER (ORDER BY day) AS date_sk, CAST(day AS VARCHAR) AS date
        FROM spine""",
    "dim_customers": "SELECT * FROM dim_customers",
    "dim_sellers": "SELECT * FROM dim_sellers",
    "dim_products": "SELECT * FROM dim_products",
    "dim_reviews": _days("SELECT * FROM dim_reviews", "review_creation_date"),
    "dim_date": _days("SELECT * FROM dim_date", "date"),
    "fact_orderlifecycle": "SELECT * FROM fact_orderlifecycle",
    "fact_orderpayments": "SELECT * FROM fact_orderpayments",
    "fact_review_fanout": "SELECT order_id, order_item_id, review_id, review_sk FROM lifecycle",
    "fact_date_keys": """
        SELECT order_id, order_item_id, review_id, order_purchase_date_sk,
               order_approved_date_sk, shipping_limit_date_sk, delivered_carrier_date_sk,
               delivered_customer_date_sk, estimated_delivery_date_sk
        FROM lifecycle""",
    "dim_customers_incremental": "SELECT * FROM customers_in_loads",
    "fact_payments_incremental": """
        SELECT row_number() OVER (ORDER BY payment_timestamp >= DATE '1998-01-01', order_id,
                                           payment_sequential) AS payment_sk,
               order_id, CAST(payment_sequential AS INTEGER) AS payment_sequential, payment_type,
               payment_installments, payment_value, n.customer_sk,
               payment_date_sk, payment_timestamp
        FROM fact_orderpayments f JOIN dim_customers c ON f.customer_sk = c.customer_sk
        JOIN customers_in_loads n ON n.customer_id = c.customer_id""",
    "conform_fact_payments": """
        SELECT * REPLACE (CAST(payment_sk AS INTEGER) AS payment_sk,
                          CAST(payment_sequential AS INTEGER) AS payment_sequential,
                          CAST(customer_sk AS INTEGER) AS customer_sk,
                          CAST(payment_date_sk AS INTEGER) AS payment_date_sk)
        FROM fact_orderpayments""",
    "check_primary_keys": " UNION ALL ".join(_rejected(t, c, "*") for t, c in _PRIMARY.items()),
    "check_unique_keys": " UNION ALL ".join(_rejected(t, c, c) for t, c in _UNIQUE.items()),
    "check_foreign_keys": " UNION ALL ".join(_dangling(*key) for key in _FOREIGN),
    "total_sales": "SELECT round(sum(total_price), 2) AS total_sales FROM item_sales",
    "total_sales_from_fact": """
        SELECT round(sum(price + freight_value), 2) AS total_sales FROM items_order""",
    "order_count": "SELECT count(DISTINCT order_id) AS orders FROM fact_orderlifecycle",
    "on_time_delivery": """
        SELECT on_time_orders, delivered_orders,
               round(100.0 * on_time_orders / delivered_orders, 6) AS on_time_pct
        FROM (SELECT count(*) FILTER (CAST(order_delivered_customer_date AS DATE)
                         <= CAST(order_estimated_delivery_date AS DATE)) AS on_time_orders,
                     count(order_delivered_customer_date) AS delivered_orders
              FROM order_events)""",
    "payment_mix": """
        SELECT payment_type, count(*) AS payments, round(sum(payment_value), 2) AS value,
               round(100.0 * sum(payment_value) / (SELECT sum(payment_value)
                                                   FROM fact_orderpayments), 6) AS value_pct
        FROM fact_orderpayments GROUP BY payment_type""",
    "payments_mom": """
        SELECT CAST(month AS VARCHAR) AS month, round(value, 2) AS value,
               round(previous, 2) AS previous_value,
               CASE WHEN previous <> 0 THEN round(100.0 * (value - previous) / previous, 6)
               END AS growth_pct
        FROM (SELECT *, lag(value) OVER (ORDER BY month) AS previous FROM months)""",
    "customer_segments": """
        SELECT customer_unique_id, round(spend, 2) AS spend, segment FROM segments""",
    "segment_summary": """
        SELECT segment, count(*) AS customers, round(sum(spend), 2) AS spend
        FROM segments GROUP BY segment""",
    "review_nps": """
        SELECT *, round(100.0 * (promoters - detractors) / scored, 6) AS nps
        FROM (SELECT count(*) FILTER (review_score = 5) AS promoters,
                     count(*) FILTER (review_score = 4) AS passives,
                     count(*) FILTER (review_score <= 3) AS detractors,
                     count(review_score) AS scored
              FROM dim_reviews)""",
    "sales_by_month": """
        SELECT CAST(CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS VARCHAR)
                   AS month,
               round(sum(total_price), 2) AS total_sales, count(DISTINCT order_id) AS orders
        FROM item_sales GROUP BY 1""",
    "sales_by_category": """
        SELECT product_category_name_english AS category,
               round(sum(total_price), 2) AS total_sales, count(DISTINCT order_id) AS orders
        FROM item_sales JOIN products USING (product_id) GROUP BY 1""",
    "sales_by_state": """
        SELECT customer_state, round(sum(total_price), 2) AS total_sales,
               count(DISTINCT order_id) AS orders
        FROM item_sales JOIN customers_geo USING (customer_id) GROUP BY 1""",
    "lifecycle_by_status": f"""
        SELECT order_status, count(*) AS orders,
               {_diff("order_approved_at", "order_purchase_timestamp")} AS days_to_approval,
               {_diff("order_delivered_carrier_date", "order_approved_at")} AS days_to_carrier,
               {_diff("order_delivered_customer_date", "order_delivered_carrier_date")}
                   AS days_to_customer,
               {_diff("order_delivered_customer_date", "order_estimated_delivery_date")}
                   AS days_past_estimate
        FROM order_events GROUP BY order_status""",
    "order_detail": """
        SELECT f.order_id, f.order_item_id, f.order_status, f.shipping_limit_date,
               f.order_purchase_timestamp, f.order_approved_at, f.order_delivered_carrier_date,
               f.order_delivered_customer_date, f.order_estimated_delivery_date, f.price,
               f.freight_value, f.total_price, c.customer_id, c.customer_city, c.customer_state,
               p.product_id, p.product_category_english_name, s.seller_id, s.seller_city,
               r.review_id, r.review_score, d.year AS purchase_year, d.month AS purchase_month
        FROM fact_orderlifecycle f
        JOIN dim_customers c ON f.customer_sk = c.customer_sk
        JOIN dim_products p ON f.product_sk = p.product_sk
        JOIN dim_sellers s ON f.seller_sk = s.seller_sk
        LEFT JOIN dim_reviews r ON f.review_sk = r.review_sk
        LEFT JOIN dim_date d ON f.order_purchase_date_sk = d.date_sk""",
    "order_payment_detail": """
        SELECT order_id, payment_sequential, payment_type, payment_installments,
               payment_value, payment_date_sk, payment_timestamp, customer_id, customer_unique_id
        FROM fact_orderpayments JOIN dim_customers USING (customer_sk)""",
}


def _needed(sql: str, found: set[str]) -> set[str]:
    for name in TABLES:
        if name not in found and re.search(rf"\b{name}\b", sql):
            found.add(name)
            _needed(TABLES[name], found)
    return found


def sql(name: str) -> str:
    body = BODIES[name]
    needed = _needed(body, set())
    parts = ", ".join(f"{t} AS ({TABLES[t]})" for t in TABLES if t in needed)
    return f"WITH {parts} {body}" if parts else body
