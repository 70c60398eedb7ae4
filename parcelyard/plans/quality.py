"""Monthly share of orders with missing or impossible data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard import schema as S
from parcelyard.functions.metrics import month_start, share


def data_quality_flags(outcomes: DataFrame) -> DataFrame:
    """Data-quality percentages per purchase month (INT6); a null month is a group."""
    sev = F.col("delivery_severity")
    impossible = F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp")
    return outcomes.groupBy(
        month_start(F.col("order_purchase_timestamp")).alias("order_month")
    ).agg(
        F.count(F.lit(1)).alias("order_count"),
        share(sev == S.NO_DELIVERY_DATA, among=sev != S.CLOSED).alias(
            "pct_orders_unavailable_delivery_data"
        ),
        share(sev == S.CLOSED).alias("pct_orders_canceled_or_unavailable"),
        share(F.col("review_score").isNull()).alias("pct_orders_missing_review"),
        share(impossible).alias("pct_orders_impossible_date_ordering"),
    )


def mart_data_quality(flags: DataFrame) -> DataFrame:
    """INT6 without the order count (MRT1). Never part of the score."""
    return flags.drop("order_count")
