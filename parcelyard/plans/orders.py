"""Order-level metrics and the two fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.functions.metrics import delay_days, ratio_or_null, severity
from parcelyard.operators.pick import lookup
from parcelyard.operators.spread import spread_left_join

_DATES = (
    "order_status",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def order_delivery(orders: DataFrame) -> DataFrame:
    """Delay and severity per order (INT1). Row by row: no shuffle."""
    dates = [F.col(c) for c in _DATES]
    return orders.select(
        "order_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        delay_days(*dates).alias("delay_days"),
        severity(*dates).alias("severity"),
    )


def order_freight(items: DataFrame) -> DataFrame:
    """Price, freight and their ratio per order that has items (INT2)."""
    return items.groupBy("order_id").agg(
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight_value"),
        ratio_or_null(F.sum("freight_value"), F.sum("price")).alias("freight_ratio"),
    )


def order_experience(delivery: DataFrame, reviews: DataFrame) -> DataFrame:
    """Delivery outcome beside the order's one review (INT3)."""
    return delivery.join(reviews, "order_id", "left").select(
        "order_id",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "delay_days",
        F.col("severity").alias("delivery_severity"),
        "review_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    )


def order_sellers(items: DataFrame) -> DataFrame:
    """One row per (order, seller) pair, with the seller's own part of the order.

    Everything about sellers starts here, so items shrink once, with a partial sum
    in every task, before they meet the orders.
    """
    return items.groupBy("order_id", "seller_id").agg(
        F.sum("price").alias("price"), F.sum("freight_value").alias("freight_value")
    )


def order_freight_and_sellers(pairs: DataFrame) -> DataFrame:
    """INT2 plus the number of sellers in the order (items without one count as one)."""
    return pairs.groupBy("order_id").agg(
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight_value"),
        ratio_or_null(F.sum("freight_value"), F.sum("price")).alias("freight_ratio"),
        F.count(F.lit(1)).alias("seller_count"),
    )


def order_facts(orders: DataFrame, freight: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders with outcome, freight and review score.

    The outcome is computed in place, and both joins use ``order_id``, so the
    orders are shuffled once.
    """
    dates = [F.col(c) for c in _DATES]
    return (
        orders.withColumns(
            {"delay_days": delay_days(*dates), "delivery_severity": severity(*dates)}
        )
        .join(freight, "order_id", "left")
        .join(lookup(reviews, "order_id", "review_score"), "order_id", "left")
    )


def fct_orders(
    orders: DataFrame,
    freight: DataFrame,
    reviews: DataFrame,
    customers: DataFrame,
    addresses: DataFrame,
) -> DataFrame:
    """Order fact with the address the person uses most (FCT2).

    The address goes onto the narrow customer table first; the wide order rows then
    need a single join by ``customer_id``. Persons with many customer ids, customers
    with many orders and orders without a customer are spread over all tasks. A report
    that reads no address leaves both joins out.
    """
    people = spread_left_join(
        customers.select("customer_id", "customer_unique_id"),
        addresses.select("customer_unique_id", "customer_state", "customer_city"),
        "customer_unique_id",
        spread_by="customer_id",
    )
    return (
        spread_left_join(
            order_facts(orders, freight, reviews), people, "customer_id", spread_by="order_id"
        )
        .select(
            "order_id",
            "customer_id",
            "customer_unique_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
            "delay_days",
            "delivery_severity",
            "total_price",
            "total_freight_value",
            "freight_ratio",
            "review_score",
            "customer_state",
            "customer_city",
        )
    )


def fct_order_items(items: DataFrame) -> DataFrame:
    """Item fact, as staged (FCT1)."""
    return items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    )
