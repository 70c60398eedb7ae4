"""Table layouts and the fixed values the metrics are defined by."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw tables and their columns, in file order. Every raw column is
# a nullable string; "lenght" is how the source spells it.
RAW_COLUMNS: dict[str, list[str]] = {
    "customers": [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ],
    "geolocation": [
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ],
    "order_items": [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ],
    "order_payments": [
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ],
    "order_reviews": [
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ],
    "orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "products": [
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "sellers": [
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    ],
    "product_category_name_translation": [
        "product_category_name",
        "product_category_name_english",
    ],
}

# Order statuses.
ORDER_STATUSES = [
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
]
CLOSED_STATUSES = ["canceled", "unavailable"]

# Delivery severities, and the points each dated one scores.
ON_TIME = "On Time"
LATE_1_3 = "1-3 days late"
LATE_4_7 = "4-7 days late"
LATE_8_UP = "8+ days late"
NO_DELIVERY_DATA = "Delivery data unavailable"
CLOSED = "Canceled or unavailable"

DATED_SEVERITIES = [ON_TIME, LATE_1_3, LATE_4_7, LATE_8_UP]
NO_OUTCOME = [NO_DELIVERY_DATA, CLOSED]
SEVERITY_POINTS = {ON_TIME: 100.0, LATE_1_3: 70.0, LATE_4_7: 35.0, LATE_8_UP: 0.0}

# Share of each component in the monthly score.
SCORE_WEIGHTS = {
    "delivery_score": 0.4,
    "customer_experience_score": 0.3,
    "logistics_cost_score": 0.2,
    "seller_score": 0.1,
}

# First and last day of the default calendar.
CALENDAR_START = "2016-06-04"
CALENDAR_END = "2019-02-12"


def raw_schema(table: str) -> T.StructType:
    """All-string schema of one raw table."""
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])
