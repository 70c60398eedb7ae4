"""Monthly logistics score, 0 to 100."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelyard import schema as S
from parcelyard.functions.metrics import (
    min_max_score,
    month_start,
    severity_points,
    share,
    weighted_score,
)


def logistics_score(orders: DataFrame) -> DataFrame:
    """Four components and their weighted mean per purchase month (MRT2).

    The freight bounds are those of single orders over all months: each month keeps
    its own, and only the month rows are compared.
    """
    return score_from_months(month_components(orders))


def month_components(orders: DataFrame) -> DataFrame:
    """What one month's orders give to the score, with the month's own freight bounds.

    ``orders`` carries ``seller_count``, the sellers in the order (null without
    items). An order weighs that often in the seller component, which equals
    averaging over (order, seller) pairs but needs no second pass or join.
    """
    sev = F.col("delivery_severity")
    points = severity_points(sev)
    seller_weight = F.when(points.isNotNull(), F.col("seller_count"))
    return (
        orders.filter("order_purchase_timestamp is not null")
        .groupBy(month_start(F.col("order_purchase_timestamp")).alias("order_month"))
        .agg(
            F.avg(points).alias("delivery_score"),
            ((F.avg("review_score") - 1) / 4 * 100).alias("customer_experience_score"),
            F.avg("freight_ratio").alias("mean_ratio"),
            F.min("freight_ratio").alias("min_ratio"),
            F.max("freight_ratio").alias("max_ratio"),
            (F.sum(points * seller_weight) / F.nullif(F.sum(seller_weight), F.lit(0))).alias(
                "seller_score"
            ),
            F.count(F.lit(1)).alias("order_count"),
            share(sev.isin(S.DATED_SEVERITIES)).alias("delivery_coverage"),
        )
    )


def score_from_months(monthly: DataFrame) -> DataFrame:
    """The score of all months, whose freight costs are placed between the bounds of all."""
    all_months = Window.partitionBy()
    scored = monthly.withColumn(
        "logistics_cost_score",
        min_max_score(
            F.col("mean_ratio"),
            F.min("min_ratio").over(all_months),
            F.max("max_ratio").over(all_months),
        ),
    )
    return scored.filter(F.coalesce(*S.SCORE_WEIGHTS).isNotNull()).select(
        "order_month",
        *S.SCORE_WEIGHTS,
        weighted_score(S.SCORE_WEIGHTS).alias("final_score"),
        "order_count",
        "delivery_coverage",
    )
