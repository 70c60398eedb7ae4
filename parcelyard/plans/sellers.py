"""Seller metrics, all-time and per month.

Outcomes (on-time rate, review) credit the whole order to each of its sellers;
money only counts a seller's own items. ``pairs`` is one row per (order, seller),
``outcomes`` one row per order with purchase time, severity and review score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.functions.metrics import month_start, on_time_rate, ratio_or_null


def seller_performance(pairs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """All-time snapshot per seller (INT4); orders that are not on file still count."""
    sold = pairs.filter("seller_id is not null").select("seller_id", "order_id")
    results = outcomes.select("order_id", "delivery_severity", "review_score")
    return (
        sold.join(results, "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.count("order_id").alias("order_volume"),
            on_time_rate(F.col("delivery_severity")).alias("on_time_rate"),
            F.avg("review_score").alias("avg_review_score"),
        )
    )


def _by_month(pairs: DataFrame, orders: DataFrame, *columns: str) -> DataFrame:
    dated = orders.filter("order_purchase_timestamp is not null").select(
        "order_id",
        month_start(F.col("order_purchase_timestamp")).alias("time_period"),
        *columns,
    )
    return pairs.join(dated, "order_id").groupBy("seller_id", "time_period")


def seller_freight(pairs: DataFrame, orders: DataFrame) -> DataFrame:
    """Own price and freight per seller and purchase month (INT5)."""
    sold = pairs.filter("seller_id is not null")
    return _by_month(sold, orders).agg(
        F.count(F.lit(1)).alias("order_volume"),
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight_value"),
        ratio_or_null(F.sum("freight_value"), F.sum("price")).alias("freight_ratio"),
    )


def mart_seller_freight(freight: DataFrame, sellers: DataFrame) -> DataFrame:
    """INT5 with the seller's own city and state (MRT3)."""
    return freight.join(sellers, "seller_id").select(
        "seller_id",
        "time_period",
        "order_volume",
        "total_price",
        "total_freight_value",
        "freight_ratio",
        "seller_city",
        "seller_state",
    )


def seller_months(pairs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Volume, on-time rate and review per seller and purchase month."""
    return _by_month(
        pairs.select("order_id", "seller_id"), outcomes, "delivery_severity", "review_score"
    ).agg(
        F.count(F.lit(1)).alias("order_volume"),
        on_time_rate(F.col("delivery_severity")).alias("on_time_rate"),
        F.avg("review_score").alias("avg_review_score"),
    )


def mart_seller_performance(
    pairs: DataFrame, outcomes: DataFrame, sellers: DataFrame
) -> DataFrame:
    """:func:`seller_months` with the seller's own city and state (MRT4)."""
    return with_places(seller_months(pairs, outcomes), sellers)


def with_places(monthly: DataFrame, sellers: DataFrame) -> DataFrame:
    """Monthly outcomes of sellers that are on file, with their city and state."""
    return monthly.join(sellers, "seller_id").select(
        "seller_id",
        "time_period",
        "order_volume",
        "on_time_rate",
        "avg_review_score",
        "seller_city",
        "seller_state",
    )
