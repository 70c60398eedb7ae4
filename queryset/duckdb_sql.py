"""DuckDB SQL for the registered queries, over the same parquet tables.

``TABLES`` holds one SELECT per table; a query gets the ones it needs as common
table expressions. They state each table the plain way, with the joins, windows
and distinct counts the Spark plans avoid, so that the two can disagree.
"""

from __future__ import annotations

import re

from queryset.dirty import cleaned_sql


# The declared constraints, stated here a second time so that a wrong list
# in the library cannot pass.
_NOT_NULL_LINES = """
raw.orders: order_id
raw.order_items: order_id, order_item_id
raw.order_payments: order_id
raw.order_reviews: order_id, review_id
raw.customers: customer_id
raw.sellers: seller_id
raw.products: product_id
raw.geolocation: geolocation_zip_code_prefix
raw.product_category_name_translation: product_category_name
stg_customers: customer_id, customer_unique_id
stg_geolocation: zip_code_prefix
stg_order_items: order_id, order_item_id, product_id, seller_id
stg_order_payments: order_id, payment_sequential
stg_order_reviews: order_id
stg_orders: order_id, order_purchase_timestamp
stg_product_category_translation: product_category_name, product_category_name_english
stg_products: product_id
stg_sellers: seller_id
int_order_delivery_metrics: order_id, order_status
int_order_freight_metrics: order_id
int_customer_experience_metrics: order_id
int_seller_performance_metrics: seller_id
int_seller_freight_metrics: seller_id, time_period
int_data_quality_flags: order_month
dim_customer: customer_unique_id
dim_date: date_day
dim_location: zip_code_prefix
dim_product: product_id
dim_seller: seller_id
fct_order_items: order_id, order_item_id, product_id, seller_id
fct_orders: order_id
mart_data_quality: order_month
mart_logistics_performance_score: order_month, final_score, order_count, delivery_coverage
mart_seller_freight: seller_id, time_period
mart_seller_performance: seller_id, time_period
"""
_UNIQUE_LINES = """
raw.orders: order_id
raw.customers: customer_id
raw.sellers: seller_id
raw.products: product_id
raw.product_category_name_translation: product_category_name
stg_customers: customer_id
stg_geolocation: zip_code_prefix
stg_order_reviews: order_id
stg_orders: order_id
stg_product_category_translation: product_category_name
stg_products: product_id
stg_sellers: seller_id
int_order_delivery_metrics: order_id
int_order_freight_metrics: order_id
int_customer_experience_metrics: order_id
int_seller_performance_metrics: seller_id
int_data_quality_flags: order_month
dim_customer: customer_unique_id
dim_date: date_day
dim_location: zip_code_prefix
dim_product: product_id
dim_seller: seller_id
fct_orders: order_id
mart_data_quality: order_month
mart_logistics_performance_score: order_month
"""
_COMBINATION_LINES = """
raw.order_items: order_id, order_item_id
stg_order_items: order_id, order_item_id
stg_order_payments: order_id, payment_sequential
int_seller_freight_metrics: seller_id, time_period
fct_order_items: order_id, order_item_id
mart_seller_freight: seller_id, time_period
mart_seller_performance: seller_id, time_period
"""
_RELATION_LINES = """
fct_order_items.order_id: fct_orders.order_id
fct_order_items.product_id: dim_product.product_id
fct_order_items.seller_id: dim_seller.seller_id
fct_orders.customer_unique_id: dim_customer.customer_unique_id
mart_seller_freight.seller_id: dim_seller.seller_id
mart_seller_performance.seller_id: dim_seller.seller_id
"""
ACCEPTED = {
    ("stg_order_reviews", "review_score"): [1, 2, 3, 4, 5],
    ("int_order_delivery_metrics", "order_status"): [
        "approved", "canceled", "created", "delivered", "invoiced", "processing", "shipped",
        "unavailable",
    ],
    ("int_order_delivery_metrics", "severity"): [
        "On Time", "1-3 days late", "4-7 days late", "8+ days late",
        "Delivery data unavailable", "Canceled or unavailable",
    ],
    ("int_customer_experience_metrics", "review_score"): [1, 2, 3, 4, 5],
    ("dim_date", "month_name"): [
        "January", "February", "March", "April", "May", "June", "July", "August",
        "September", "October", "November", "December",
    ],
    ("dim_date", "day_of_week"): [1, 2, 3, 4, 5, 6, 7],
    ("dim_date", "is_weekend"): [0, 1],
}
_QUALITY_SHARES = (
    "pct_orders_unavailable_delivery_data pct_orders_canceled_or_unavailable "
    "pct_orders_missing_review pct_orders_impossible_date_ordering"
).split()
RANGES = {
    ("stg_order_items", "price"): (0, None),
    ("stg_order_items", "freight_value"): (0, None),
    ("stg_order_payments", "payment_value"): (0, None),
    ("int_seller_freight_metrics", "total_price"): (0, None),
    ("int_seller_freight_metrics", "total_freight_value"): (0, None),
    ("int_seller_freight_metrics", "freight_ratio"): (0, None),
    **{("int_data_quality_flags", c): (0, 1) for c in _QUALITY_SHARES},
    **{("mart_data_quality", c): (0, 1) for c in _QUALITY_SHARES},
    ("mart_logistics_performance_score", "final_score"): (0, 100),
    ("mart_logistics_performance_score", "order_count"): (1, None),
    ("mart_logistics_performance_score", "delivery_coverage"): (0, 1),
    ("mart_seller_freight", "freight_ratio"): (0, None),
    ("mart_seller_performance", "on_time_rate"): (0, 1),
}


# Targets of each declared check, and the reconciliations that must hold.
GENERIC_TARGETS = {
    "not_null": 54,
    "unique": 25,
    "accepted_values": 7,
    "relationships": 6,
    "accepted_range": 19,
    "unique_combination": 7,
    "equal_rowcount": 2,
}
SINGULAR_ERRORS = (
    "calendar_gaps item_fact_differences experience_orphans invalid_review_scores "
    "experience_rowcount delivery_rowcount inconsistent_severity negative_freight_ratio "
    "freight_rowcount freight_sums seller_ratio_expression seller_sums on_time_rate_range "
    "order_volume_positive seller_grain_differences"
).split()


def _columns(lines: str) -> dict[str, list[str]]:
    pairs = (line.split(": ") for line in lines.strip().splitlines())
    return {table: names.split(", ") for table, names in pairs}

TABLES: dict[str, str] = {
    # Source tables, typed.
    "src_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               CASE WHEN o_orderkey % 40 = 0 THEN 'canceled'
                    WHEN o_orderkey % 40 = 1 THEN 'unavailable'
                    WHEN o_orderstatus = 'F' THEN 'delivered'
                    WHEN o_orderstatus = 'O' THEN 'shipped'
                    ELSE 'processing' END AS order_status,
               o_orderdate + to_seconds(o_orderkey % 86400) AS order_purchase_timestamp,
               o_orderdate + to_seconds(o_orderkey % 86400) + INTERVAL 1 HOUR AS order_approved_at,
               o_orderdate + INTERVAL 1 DAY AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 50 = 7 THEN NULL
                    WHEN o_orderkey % 997 = 3 THEN o_orderdate - INTERVAL 2 DAY
                    ELSE o_orderdate + to_days(CAST((o_orderkey * 7) % 31 AS INTEGER))
                         + to_hours(CAST(o_orderkey % 24 AS INTEGER))
               END AS order_delivered_customer_date,
               o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date
        FROM orders""",
    "src_order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_linenumber AS SMALLINT) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date,
               CASE WHEN l_orderkey % 500 = 9 THEN 0.0
                    ELSE floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) / 100
               END AS price,
               floor(l_extendedprice * l_tax * 100 + 0.5) / 100 AS freight_value
        FROM lineitem""",
    "src_order_payments": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(1 AS SMALLINT) AS payment_sequential,
               lower(trim(o_orderpriority)) AS payment_type,
               CAST(o_orderkey % 12 AS SMALLINT) AS payment_installments,
               o_totalprice AS payment_value
        FROM orders
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), CAST(2 AS SMALLINT), 'voucher', CAST(1 AS SMALLINT),
               CAST(0 AS DOUBLE)
        FROM orders WHERE o_orderkey % 5 = 0""",
    "src_order_reviews": """
        SELECT CAST(event_id AS VARCHAR) AS review_id,
               CAST((event_id * 13) % (SELECT count(*) * 3 // 5 FROM orders) AS VARCHAR)
                   AS order_id,
               CAST(1 + event_id % 5 AS SMALLINT) AS review_score,
               lower(trim(event_type)) AS review_comment_title,
               lower(trim(props)) AS review_comment_message,
               CAST(CASE WHEN event_id % 2 = 0 THEN date_trunc('month', ts)
                         ELSE date_trunc('week', ts) END AS TIMESTAMP) AS review_creation_date,
               CAST(CASE WHEN event_id % 4 = 0 THEN date_trunc('month', ts)
                         ELSE date_trunc('second', ts) END AS TIMESTAMP) AS review_answer_timestamp
        FROM events""",
    "src_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               CAST(c_custkey % (SELECT count(*) * 4 // 5 FROM customer) AS VARCHAR)
                   AS customer_unique_id,
               lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               lower(n_name) AS customer_city,
               lower(r_name) AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "src_sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
               lower(n_name) AS seller_city,
               lower(r_name) AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "src_geolocation": """
        SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
               c_acctbal / 1000 AS geolocation_lat,
               -c_acctbal / 2000 AS geolocation_lng,
               lower(c_mktsegment) AS geolocation_city,
               lower(r_name) AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "src_product_category_name_translation": """
        SELECT DISTINCT p_type AS product_category_name,
               'en_' || lower(p_type) AS product_category_name_english
        FROM part WHERE p_type > (SELECT min(p_type) FROM part)""",
    "src_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               p_type AS product_category_name,
               CAST(length(p_name) AS BIGINT) AS product_name_lenght,
               CAST(length(p_brand) AS BIGINT) AS product_description_lenght,
               CAST(p_size % 6 AS BIGINT) AS product_photos_qty,
               p_retailprice AS product_weight_g,
               CAST(p_size AS DOUBLE) AS product_length_cm,
               CAST(p_size AS DOUBLE) / 2 AS product_height_cm,
               CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS DOUBLE) END AS product_width_cm
        FROM part""",
    # Staging.
    "stg_customers": "SELECT * FROM src_customers",
    "stg_sellers": "SELECT * FROM src_sellers",
    "stg_orders": "SELECT * FROM src_orders",
    "stg_order_items": "SELECT * FROM src_order_items",
    "stg_order_payments": "SELECT * FROM src_order_payments",
    "stg_product_category_translation": "SELECT * FROM src_product_category_name_translation",
    "stg_products": """
        SELECT p.*, product_category_name_english
        FROM src_products p
        LEFT JOIN src_product_category_name_translation USING (product_category_name)""",
    "stg_order_reviews": """
        SELECT order_id, review_id, review_score, review_comment_title, review_comment_message,
               review_creation_date, review_answer_timestamp
        FROM src_order_reviews
        QUALIFY row_number() OVER (
            PARTITION BY order_id
            ORDER BY review_creation_date DESC NULLS LAST,
                     review_answer_timestamp DESC NULLS LAST, review_id) = 1""",
    "prefix_places": """
        SELECT geolocation_zip_code_prefix AS zip_code_prefix,
               geolocation_city AS city, geolocation_state AS state
        FROM src_geolocation
        GROUP BY geolocation_zip_code_prefix, geolocation_city, geolocation_state
        QUALIFY row_number() OVER (
            PARTITION BY geolocation_zip_code_prefix
            ORDER BY count(*) DESC, geolocation_city, geolocation_state) = 1""",
    "stg_geolocation": """
        SELECT zip_code_prefix, avg(geolocation_lat) AS lat, avg(geolocation_lng) AS lng,
               any_value(city) AS city, any_value(state) AS state
        FROM src_geolocation JOIN prefix_places ON geolocation_zip_code_prefix = zip_code_prefix
        GROUP BY zip_code_prefix""",
    # Intermediate.
    "order_delay": """
        SELECT *, CASE WHEN order_status NOT IN ('canceled', 'unavailable') THEN
                  date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                            CAST(order_delivered_customer_date AS DATE)) END AS delay_days
        FROM stg_orders""",
    "int_order_delivery_metrics": """
        SELECT order_id, order_status, order_purchase_timestamp, order_delivered_customer_date,
               order_estimated_delivery_date, delay_days,
               CASE WHEN order_status IN ('canceled', 'unavailable')
                    THEN 'Canceled or unavailable'
                    WHEN delay_days IS NULL THEN 'Delivery data unavailable'
                    WHEN delay_days >= 8 THEN '8+ days late'
                    WHEN delay_days >= 4 THEN '4-7 days late'
                    WHEN delay_days >= 1 THEN '1-3 days late'
                    ELSE 'On Time' END AS severity
        FROM order_delay""",
    "int_order_freight_metrics": """
        SELECT order_id, sum(price) AS total_price, sum(freight_value) AS total_freight_value,
               sum(freight_value) / nullif(sum(price), 0) AS freight_ratio
        FROM stg_order_items GROUP BY order_id""",
    "int_customer_experience_metrics": """
        SELECT order_id, order_purchase_timestamp, order_delivered_customer_date,
               order_estimated_delivery_date, delay_days, severity AS delivery_severity,
               review_id, review_score, review_comment_title, review_comment_message,
               review_creation_date, review_answer_timestamp
        FROM int_order_delivery_metrics LEFT JOIN stg_order_reviews USING (order_id)""",
    "sold_orders": "SELECT DISTINCT order_id, seller_id FROM stg_order_items",
    "int_seller_performance_metrics": """
        SELECT seller_id, count(DISTINCT order_id) AS order_volume,
               avg(CASE delivery_severity WHEN 'On Time' THEN 1.0
                                          WHEN 'Delivery data unavailable' THEN NULL
                                          WHEN 'Canceled or unavailable' THEN NULL
                                          ELSE 0.0 END) AS on_time_rate,
               avg(review_score) AS avg_review_score
        FROM sold_orders LEFT JOIN int_customer_experience_metrics USING (order_id)
        WHERE seller_id IS NOT NULL
        GROUP BY seller_id""",
    "dated_items": """
        SELECT i.*, CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS time_period
        FROM stg_order_items i JOIN stg_orders USING (order_id)
        WHERE order_purchase_timestamp IS NOT NULL""",
    "int_seller_freight_metrics": """
        SELECT seller_id, time_period, count(DISTINCT order_id) AS order_volume,
               sum(price) AS total_price, sum(freight_value) AS total_freight_value,
               sum(freight_value) / nullif(sum(price), 0) AS freight_ratio
        FROM dated_items WHERE seller_id IS NOT NULL
        GROUP BY seller_id, time_period""",
    "int_data_quality_flags": """
        SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_month,
               count(*) AS order_count,
               avg(CASE WHEN delivery_severity <> 'Canceled or unavailable' THEN
                   CAST(delivery_severity = 'Delivery data unavailable' AS INTEGER) END)
                   AS pct_orders_unavailable_delivery_data,
               avg(CAST(delivery_severity = 'Canceled or unavailable' AS INTEGER))
                   AS pct_orders_canceled_or_unavailable,
               avg(CAST(review_score IS NULL AS INTEGER)) AS pct_orders_missing_review,
               avg(CAST(coalesce(order_delivered_customer_date < order_purchase_timestamp, false)
                   AS INTEGER)) AS pct_orders_impossible_date_ordering
        FROM int_customer_experience_metrics GROUP BY 1""",
    # Marts.
    "dim_customer": """
        SELECT customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
        FROM stg_customers
        GROUP BY customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
        QUALIFY row_number() OVER (
            PARTITION BY customer_unique_id ORDER BY count(*) DESC, min(customer_id)) = 1""",
    "order_days": """
        SELECT CAST(unnest([order_purchase_timestamp, order_approved_at,
                            order_delivered_carrier_date, order_delivered_customer_date,
                            order_estimated_delivery_date]) AS DATE) AS day
        FROM stg_orders""",
    "dim_date": """
        SELECT CAST(d AS DATE) AS date_day, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
               monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
               CAST(isodow(d) AS INTEGER) AS day_of_week,
               CAST(isodow(d) IN (6, 7) AS INTEGER) AS is_weekend
        FROM (SELECT unnest(generate_series(CAST(min(day) AS TIMESTAMP),
                                            CAST(max(day) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
              FROM order_days)""",
    "dim_location": "SELECT zip_code_prefix, city, state, lat, lng FROM stg_geolocation",
    "dim_product": "SELECT * FROM stg_products",
    "dim_seller": "SELECT * FROM stg_sellers",
    "fct_order_items": "SELECT * FROM stg_order_items",
    "fct_orders": """
        SELECT order_id, customer_id, customer_unique_id, s.order_status,
               s.order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
               s.order_delivered_customer_date, s.order_estimated_delivery_date, delay_days,
               severity AS delivery_severity, total_price, total_freight_value, freight_ratio,
               review_score, a.customer_state, a.customer_city
        FROM stg_orders s
        JOIN int_order_delivery_metrics USING (order_id)
        LEFT JOIN int_order_freight_metrics USING (order_id)
        LEFT JOIN stg_order_reviews USING (order_id)
        LEFT JOIN (SELECT customer_id, customer_unique_id FROM stg_customers) USING (customer_id)
        LEFT JOIN dim_customer a USING (customer_unique_id)""",
    "hot_customers": """
        SELECT * REPLACE (CASE WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN '0'
                               ELSE customer_unique_id END AS customer_unique_id)
        FROM stg_customers""",
    "hot_addresses": """
        SELECT customer_unique_id, customer_city, customer_state
        FROM hot_customers
        GROUP BY customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
        QUALIFY row_number() OVER (
            PARTITION BY customer_unique_id ORDER BY count(*) DESC, min(customer_id)) = 1""",
    "fct_orders_hot": """
        SELECT f.* REPLACE (c.hot_id AS customer_id, h.customer_unique_id AS customer_unique_id,
                            a.customer_state AS customer_state, a.customer_city AS customer_city)
        FROM fct_orders f
        JOIN (SELECT order_id, CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN '1'
                                    WHEN CAST(order_id AS BIGINT) % 7 = 0 THEN NULL
                                    ELSE customer_id END AS hot_id FROM stg_orders) c
             ON c.order_id = f.order_id
        LEFT JOIN hot_customers h ON h.customer_id = c.hot_id
        LEFT JOIN hot_addresses a ON a.customer_unique_id = h.customer_unique_id""",
    "mart_data_quality": "SELECT * EXCLUDE (order_count) FROM int_data_quality_flags",
    "severity_points": """
        SELECT * FROM (VALUES ('On Time', 100.0), ('1-3 days late', 70.0),
                              ('4-7 days late', 35.0), ('8+ days late', 0.0)) t(severity, points)""",
    "scored_orders": """
        SELECT f.*, CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_month,
               CAST(points AS DOUBLE) AS points
        FROM fct_orders f LEFT JOIN severity_points ON delivery_severity = severity
        WHERE order_purchase_timestamp IS NOT NULL""",
    "score_components": """
        SELECT o.order_month, o.delivery_score, o.customer_experience_score,
               CASE WHEN g.hi = g.lo THEN 0 * o.mean_ratio + 100
                    ELSE 100 * (g.hi - o.mean_ratio) / (g.hi - g.lo)
               END AS logistics_cost_score,
               s.seller_score, o.order_count, o.delivery_coverage
        FROM (SELECT order_month, avg(points) AS delivery_score,
                     25 * (avg(review_score) - 1) AS customer_experience_score,
                     avg(freight_ratio) AS mean_ratio, count(*) AS order_count,
                     count(points) / count(*) AS delivery_coverage
              FROM scored_orders GROUP BY order_month) o
        LEFT JOIN (SELECT order_month, avg(points) AS seller_score
                   FROM scored_orders JOIN sold_orders USING (order_id)
                   GROUP BY order_month) s USING (order_month),
             (SELECT min(freight_ratio) AS lo, max(freight_ratio) AS hi FROM scored_orders) g""",
    "component_weights": """
        SELECT * FROM (VALUES ('delivery_score', 0.4), ('customer_experience_score', 0.3),
                              ('logistics_cost_score', 0.2), ('seller_score', 0.1))
                      t(component, weight)""",
    "final_scores": """
        SELECT order_month,
               sum(CAST(weight AS DOUBLE) * score) / sum(CAST(weight AS DOUBLE)) AS final_score
        FROM (UNPIVOT score_components
              ON delivery_score, customer_experience_score, logistics_cost_score, seller_score
              INTO NAME component VALUE score)
        JOIN component_weights USING (component)
        GROUP BY order_month""",
    "mart_logistics_performance_score": """
        SELECT order_month, delivery_score, customer_experience_score, logistics_cost_score,
               seller_score, final_score, order_count, delivery_coverage
        FROM score_components JOIN final_scores USING (order_month)""",
    "mart_seller_freight": """
        SELECT seller_id, time_period, order_volume, total_price, total_freight_value,
               freight_ratio, seller_city, seller_state
        FROM int_seller_freight_metrics JOIN dim_seller USING (seller_id)""",
    "mart_seller_performance": """
        SELECT seller_id, time_period, order_volume, on_time_rate, avg_review_score,
               seller_city, seller_state
        FROM (SELECT seller_id,
                     CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS time_period,
                     count(DISTINCT order_id) AS order_volume,
                     avg(CASE delivery_severity WHEN 'On Time' THEN 1.0
                                                WHEN 'Delivery data unavailable' THEN NULL
                                                WHEN 'Canceled or unavailable' THEN NULL
                                                ELSE 0.0 END) AS on_time_rate,
                     avg(review_score) AS avg_review_score
              FROM sold_orders JOIN int_customer_experience_metrics USING (order_id)
              WHERE order_purchase_timestamp IS NOT NULL
              GROUP BY 1, 2)
        JOIN dim_seller USING (seller_id)""",
}


# Staging tables of dirty sources, by the same SQL as those of clean ones.
_CLEAN_NAMES = {"product_category_name_translation": "product_category_translation"}
_STAGED = (
    "customers sellers orders order_items order_payments product_category_name_translation "
    "products order_reviews geolocation"
).split()
for _table in _STAGED:
    TABLES[f"clean_src_{_table}"] = cleaned_sql(_table)
_FROM_SOURCE = re.compile(r"\b(src_\w+)\b")
TABLES["clean_prefix_places"] = _FROM_SOURCE.sub(r"clean_\1", TABLES["prefix_places"])
for _table in _STAGED:
    _stg = f"stg_{_CLEAN_NAMES.get(_table, _table)}"
    TABLES[f"clean_{_stg}"] = _FROM_SOURCE.sub(r"clean_\1", TABLES[_stg]).replace(
        "prefix_places", "clean_prefix_places"
    )


def with_tables(
    body: str, more: dict[str, str] | None = None, changed: dict[str, str] | None = None
) -> str:
    """``body`` preceded by the tables it names, directly or through others, and by ``more``.

    ``changed`` puts other rows under the name of a table, for whatever reads it; its SQL
    names the table as it was ``sound_<table>``.
    """
    changed = changed or {}
    needed: set[str] = set()
    more = more or {}
    pending = [body, *more.values()]
    while pending:
        text = pending.pop()
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(TABLES[name])
    parts = []
    for name in (n for n in TABLES if n in needed):
        given = f"sound_{name}" if name in changed else name
        parts.append(f"{given} AS ({TABLES[name]}\n)")
        if name in changed:
            parts.append(f"{name} AS ({changed[name]}\n)")
    parts += [f"{name} AS ({sql}\n)" for name, sql in more.items()]
    return f"WITH {', '.join(parts)}\n{body}" if parts else body


def nudge(digits: int) -> float:
    """Added before rounding: the mean of a few amounts in cents often lies exactly
    between two roundings, where the last bit of a float sum would decide."""
    return 10.0 ** -(digits + 3)


def rounded(body: str, digits: dict[str, int]) -> str:
    """``body`` with float columns rounded, as sums of floats depend on their order."""
    if not digits:
        return body
    terms = ", ".join(
        f'round(CAST("{c}" AS DOUBLE) + {nudge(n)!r}, {n}) AS "{c}"' for c, n in digits.items()
    )
    return f"SELECT * REPLACE ({terms}) FROM ({body})"


def _name(table: str) -> str:
    return table.replace("raw.", "src_")


def _violations(table: str, column: str, count: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        f"CAST({count} AS BIGINT) AS violations FROM {source}"
    )


def _literals(values: list) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _outside(column: str, low: float | None, high: float | None) -> str:
    ends = [f"{column} < {low}"] if low is not None else []
    ends += [f"{column} > {high}"] if high is not None else []
    return " OR ".join(ends)


def _duplicates(table: str, columns: list[str]) -> str:
    keys = ", ".join(columns)
    return f"(SELECT {keys} FROM {_name(table)} GROUP BY {keys} HAVING count(*) > 1)"


CONSTRAINTS: dict[str, str] = {
    "chk1_not_null": " UNION ALL ".join(
        _violations(t, c, f"count(*) FILTER (WHERE {c} IS NULL)", _name(t))
        for t, columns in _columns(_NOT_NULL_LINES).items()
        for c in columns
    ),
    "chk2_unique": " UNION ALL ".join(
        _violations(t, c, f"count({c})", _duplicates(t, [c]))
        for t, (c,) in _columns(_UNIQUE_LINES).items()
    ),
    "chk3_accepted_values": " UNION ALL ".join(
        _violations(t, c, f"count(*) FILTER (WHERE {c} NOT IN ({_literals(v)}))", _name(t))
        for (t, c), v in ACCEPTED.items()
    ),
    "chk4_relationships": " UNION ALL ".join(
        _violations(
            child,
            c,
            "count(*)",
            f"{child} x WHERE {c} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} y WHERE y.{field} = x.{c})",
        )
        for line in _RELATION_LINES.strip().splitlines()
        for child, c, parent, field in [re.split(r"\.|: ", line)]
    ),
    "chk5_accepted_range": " UNION ALL ".join(
        _violations(t, c, f"count(*) FILTER (WHERE {_outside(c, *ends)})", _name(t))
        for (t, c), ends in RANGES.items()
    ),
    "chk6_unique_combination": " UNION ALL ".join(
        _violations(t, ", ".join(columns), "count(*)", _duplicates(t, columns))
        for t, columns in _columns(_COMBINATION_LINES).items()
    ),
    "chk7_equal_rowcount": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '*' AS column_name, "
        f"abs((SELECT count(*) FROM {t}) - (SELECT count(*) FROM {other})) AS violations"
        for t, other in (("fct_orders", "stg_orders"), ("fct_order_items", "stg_order_items"))
    ),
}
