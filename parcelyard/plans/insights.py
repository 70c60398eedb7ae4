"""Headline figures over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard import schema as S
from parcelyard.functions.metrics import share
from parcelyard.operators.quantile import exact_quantile

_COMPONENTS = [*S.SCORE_WEIGHTS, "final_score"]


def mean_scores(score: DataFrame) -> DataFrame:
    """INS1: mean of the score and its components over the months."""
    return score.agg(*[F.avg(c).alias(c) for c in _COMPONENTS])


def outcome_shares(orders: DataFrame) -> DataFrame:
    """INS2: share of orders on time, without delivery data, and closed."""
    sev = F.col("delivery_severity")
    return orders.agg(
        share(sev == S.ON_TIME).alias("on_time"),
        share(sev == S.NO_DELIVERY_DATA).alias("unavailable"),
        share(sev == S.CLOSED).alias("canceled_or_unavailable"),
    )


def late_share_by_state(orders: DataFrame) -> DataFrame:
    """INS3: share of orders four or more days late per customer state.

    Given over orders with a delivery outcome and over all orders.
    """
    sev = F.col("delivery_severity")
    late = sev.isin(S.LATE_4_7, S.LATE_8_UP)
    return (
        orders.groupBy("customer_state")
        .agg(
            share(late, among=~sev.isin(S.NO_OUTCOME)).alias("late_of_outcomes"),
            share(late).alias("late_of_all"),
            F.count(F.lit(1)).alias("order_count"),
        )
        .orderBy(F.desc_nulls_last("late_of_outcomes"))
    )


def weakest_sellers(performance: DataFrame, min_orders: int = 50) -> DataFrame:
    """INS4: all-time on-time rate of sellers with enough orders, lowest first."""
    return performance.filter(F.col("order_volume") >= min_orders).orderBy(
        F.asc_nulls_last("on_time_rate"), "seller_id"
    )


def typical_freight_ratio(orders: DataFrame) -> DataFrame:
    """INS5: mean and exact (lower) median of the order freight ratio.

    The median takes a few passes over the ratio, which is cheap on the stored fact.
    """
    median = exact_quantile(orders, "freight_ratio")
    return orders.agg(F.avg("freight_ratio").alias("mean_ratio")).select(
        "mean_ratio", F.lit(median).cast("double").alias("median_ratio")
    )


def review_by_severity(orders: DataFrame) -> DataFrame:
    """INS6: mean review score per severity."""
    return orders.groupBy("delivery_severity").agg(F.avg("review_score").alias("mean_review"))


def review_swing(orders: DataFrame) -> DataFrame:
    """INS6: gap between the best and the worst mean review score."""
    return review_by_severity(orders).agg(
        (F.max("mean_review") - F.min("mean_review")).alias("review_swing")
    )


def freight_ratio_by_severity(orders: DataFrame) -> DataFrame:
    """INS7: mean freight ratio per severity."""
    return orders.groupBy("delivery_severity").agg(F.avg("freight_ratio").alias("mean_ratio"))


def score_spread(score: DataFrame) -> DataFrame:
    """INS8: lowest, highest and standard deviation of each score over the months."""
    return (
        score.unpivot([], _COMPONENTS, "component", "score")
        .groupBy("component")
        .agg(
            F.min("score").alias("lowest"),
            F.max("score").alias("highest"),
            F.stddev("score").alias("deviation"),
        )
    )


def score_range_by_year(score: DataFrame) -> DataFrame:
    """INS8: lowest and highest final score per year."""
    return score.groupBy(F.year("order_month").alias("year")).agg(
        F.min("final_score").alias("lowest"), F.max("final_score").alias("highest")
    )
