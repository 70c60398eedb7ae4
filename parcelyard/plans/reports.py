"""The eighteen dashboard reports, their filters and the three dashboards.

Every report reads one stored or lazy mart, or the two facts. A filter that is
not set drops out of the plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.functions.metrics import month_start

PURCHASE = "order_purchase_timestamp"
Month = dt.date | str
Values = str | Sequence[str]


def _first_day(month: Month) -> dt.date:
    if isinstance(month, str):
        month = dt.date.fromisoformat(month if len(month) > 7 else f"{month}-01")
    return month.replace(day=1)


def in_month(df: DataFrame, column: str, month: Month | None) -> DataFrame:
    """Rows whose date or timestamp falls in a calendar month; ``YYYY-MM`` or a date.

    A plain range on the column reaches the file scan. Where the table is stored
    in month folders, the folder is filtered as well.
    """
    if month is None:
        return df
    first = _first_day(month)
    after = (first + dt.timedelta(days=31)).replace(day=1)
    kind = dict(df.dtypes)[column]
    low, high = F.lit(first).cast(kind), F.lit(after).cast(kind)
    df = df.filter((F.col(column) >= low) & (F.col(column) < high))
    if column == PURCHASE and "order_month" in df.columns:
        df = df.filter(F.col("order_month") == F.lit(first))
    return df


def one_of(df: DataFrame, column: str, values: Values | None) -> DataFrame:
    """Rows whose column equals one of the values."""
    if values is None:
        return df
    return df.filter(F.col(column).isin([values] if isinstance(values, str) else list(values)))


def equal_to(df: DataFrame, column: str, value: str | None, required: bool = False) -> DataFrame:
    """Rows whose column equals a value; a required value must be given."""
    if value is None:
        if required:
            raise ValueError(f"{column} is required")
        return df
    return df.filter(F.col(column) == value)


def _count() -> Column:
    return F.count(F.lit(1))


def _purchase_month(orders: DataFrame) -> Column:
    """The month folder where there is one, so that the timestamp need not be read."""
    return F.col("order_month") if "order_month" in orders.columns else month_start(F.col(PURCHASE))


def _sorted(groups: DataFrame, *columns: str) -> DataFrame:
    """A report of a few groups in order, nulls last.

    Months, severities and scores are few in any table, so their rows are gathered and
    sorted in one task instead of being sampled and split into ranges.
    """
    return groups.repartition(1).sortWithinPartitions(*[F.asc_nulls_last(c) for c in columns])


def score_and_components(score: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT1: monthly score and its components."""
    return (
        in_month(score, "order_month", month)
        .select(
            "order_month",
            "final_score",
            "delivery_score",
            "customer_experience_score",
            "logistics_cost_score",
            "seller_score",
            "order_count",
            "delivery_coverage",
        )
        .orderBy(F.asc_nulls_last("order_month"))
    )


def delivery_kpis(orders: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT2: orders and mean delay per severity."""
    return (
        in_month(orders, PURCHASE, month)
        .groupBy("delivery_severity")
        .agg(_count().alias("count"), F.avg("delay_days").alias("avg"))
    )


def review_scores(orders: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT3: orders per review score."""
    return (
        in_month(orders, PURCHASE, month).groupBy("review_score").agg(_count().alias("count"))
    )


def logistics_cost(orders: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT4: mean freight ratio, total freight and orders."""
    return in_month(orders, PURCHASE, month).agg(
        F.avg("freight_ratio").alias("avg"),
        F.sum("total_freight_value").alias("sum"),
        _count().alias("count"),
    )


def seller_performance(
    performance: DataFrame, month: Month | None = None, limit: int = 100
) -> DataFrame:
    """RPT5: seller months with the most orders."""
    return (
        in_month(performance, "time_period", month)
        .select(
            "seller_id",
            "time_period",
            "order_volume",
            "on_time_rate",
            "avg_review_score",
            "seller_state",
            "seller_city",
        )
        .orderBy(F.desc_nulls_last("order_volume"), "seller_id", "time_period")
        .limit(limit)
    )


def data_quality(quality: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT6: monthly data-quality percentages."""
    return (
        in_month(quality, "order_month", month)
        .select(
            "order_month",
            "pct_orders_unavailable_delivery_data",
            "pct_orders_canceled_or_unavailable",
            "pct_orders_missing_review",
            "pct_orders_impossible_date_ordering",
        )
        .orderBy(F.asc_nulls_last("order_month"))
    )


def trends(orders: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT7: orders and mean review score per purchase month."""
    return (
        in_month(orders, PURCHASE, month)
        .groupBy(_purchase_month(orders).alias(PURCHASE))
        .agg(_count().alias("count"), F.avg("review_score").alias("avg"))
    )


def severity_by_month(orders: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT8: orders per purchase month and severity."""
    groups = in_month(orders, PURCHASE, month).groupBy(
        _purchase_month(orders).alias("month"), "delivery_severity"
    )
    return _sorted(groups.agg(_count().alias("order_count")), "month")


def slowest_sellers(
    performance: DataFrame,
    month: Month | None = None,
    seller_id: Values | None = None,
    min_orders: int = 5,
    limit: int = 50,
) -> DataFrame:
    """RPT9: seller months by on-time rate, worst first, among those with enough orders."""
    rows = one_of(in_month(performance, "time_period", month), "seller_id", seller_id)
    return (
        rows.filter(F.col("order_volume") >= min_orders)
        .select(
            "seller_id",
            "seller_state",
            "seller_city",
            "on_time_rate",
            "order_volume",
            "avg_review_score",
            "time_period",
        )
        .orderBy(F.asc_nulls_last("on_time_rate"), "seller_id", "time_period")
        .limit(limit)
    )


def cost_by_month(orders: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT10: freight ratio and freight per purchase month."""
    groups = in_month(orders, PURCHASE, month).groupBy(_purchase_month(orders).alias("month"))
    costs = groups.agg(
        F.avg("freight_ratio").alias("avg_freight_ratio"),
        F.avg("total_freight_value").alias("avg_freight_value"),
        F.sum("total_freight_value").alias("sum_freight_value"),
    )
    return _sorted(costs, "month")


def severity_by_place(
    orders: DataFrame, month: Month | None = None, customer_state: Values | None = None
) -> DataFrame:
    """RPT11: orders per customer state, city and severity."""
    rows = one_of(in_month(orders, PURCHASE, month), "customer_state", customer_state)
    return (
        rows.groupBy("customer_state", "customer_city", "delivery_severity")
        .agg(_count().alias("order_count"))
        .orderBy(F.asc_nulls_last("customer_state"), F.asc_nulls_last("customer_city"))
    )


def review_by_severity(orders: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT12: orders per review score and severity."""
    groups = in_month(orders, PURCHASE, month).groupBy("review_score", "delivery_severity")
    return _sorted(groups.agg(_count().alias("order_count")), "review_score", "delivery_severity")


def cost_by_severity(orders: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT13: freight, delay and orders per severity."""
    costs = (
        in_month(orders, PURCHASE, month)
        .groupBy("delivery_severity")
        .agg(
            F.avg("freight_ratio").alias("avg_freight_ratio"),
            F.avg("total_freight_value").alias("avg_freight_value"),
            F.avg("delay_days").alias("avg_delay_days"),
            _count().alias("order_count"),
        )
    )
    return _sorted(costs, "delivery_severity")


def seller_drill_down(items: DataFrame, orders: DataFrame, seller_id: str | None) -> DataFrame:
    """RPT14: the items of one seller with their orders, newest first."""
    return (
        equal_to(items, "seller_id", seller_id, required=True)
        .join(orders, "order_id")
        .select(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "price",
            "freight_value",
            "shipping_limit_date",
            "order_status",
            "order_purchase_timestamp",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
            "delay_days",
            "delivery_severity",
            "review_score",
            "customer_city",
            "customer_state",
        )
        .orderBy(F.desc_nulls_last(PURCHASE))
    )


def location_drill_down(
    orders: DataFrame, city: str | None = None, state: str | None = None
) -> DataFrame:
    """RPT15: orders of a customer city or state, newest first."""
    rows = equal_to(equal_to(orders, "customer_city", city), "customer_state", state)
    return rows.select(
        "order_id",
        "customer_id",
        "customer_city",
        "customer_state",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "delay_days",
        "delivery_severity",
        "review_score",
        "total_price",
        "total_freight_value",
        "freight_ratio",
    ).orderBy(F.desc_nulls_last(PURCHASE))


def order_drill_down(orders: DataFrame, items: DataFrame, order_id: str | None) -> DataFrame:
    """RPT16: one order with its items."""
    return (
        equal_to(orders, "order_id", order_id, required=True)
        .join(items, "order_id")
        .select(
            "order_id",
            "order_status",
            "order_purchase_timestamp",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
            "delay_days",
            "delivery_severity",
            "review_score",
            "customer_city",
            "customer_state",
            "total_price",
            "total_freight_value",
            "freight_ratio",
            "order_item_id",
            "product_id",
            "seller_id",
            "price",
            "freight_value",
        )
        .orderBy(F.asc_nulls_last("order_item_id"))
    )


def freight_by_seller(
    freight: DataFrame, month: Month | None = None, seller_id: Values | None = None
) -> DataFrame:
    """RPT17: seller months by freight ratio, highest first."""
    rows = one_of(in_month(freight, "time_period", month), "seller_id", seller_id)
    return rows.select(
        "seller_id",
        "seller_state",
        "seller_city",
        "time_period",
        "order_volume",
        "total_freight_value",
        "freight_ratio",
    ).orderBy(F.desc_nulls_last("freight_ratio"))


def freight_by_state(
    orders: DataFrame, month: Month | None = None, customer_state: Values | None = None
) -> DataFrame:
    """RPT18: freight per customer state, highest ratio first."""
    rows = one_of(in_month(orders, PURCHASE, month), "customer_state", customer_state)
    return (
        rows.groupBy("customer_state")
        .agg(
            F.avg("freight_ratio").alias("avg_freight_ratio"),
            F.sum("total_freight_value").alias("total_freight_value"),
            _count().alias("order_count"),
        )
        .orderBy(F.desc_nulls_last("avg_freight_ratio"))
    )


@dataclass(frozen=True)
class Filters:
    """Dashboard filters; one value reaches every report that knows the filter."""

    month: Month | None = None
    customer_state: Values | None = None
    seller_id: Values | None = None
    city: str | None = None
    state: str | None = None
    order_id: str | None = None


@dataclass(frozen=True)
class Card:
    """A report, the marts it reads and the filters it takes."""

    report: Callable[..., DataFrame]
    marts: tuple[str, ...]
    filters: tuple[str, ...]


_SCORE = ("mart_logistics_performance_score",)
_ORDERS = ("fct_orders",)
_PERFORMANCE = ("mart_seller_performance",)

# The cards of each dashboard and the filters wired to them.
DASHBOARDS: dict[str, dict[str, Card]] = {
    "Executive Overview": {
        "Logistics Performance Score & Components": Card(
            score_and_components, _SCORE, ("month",)
        ),
        "Delivery KPIs": Card(delivery_kpis, _ORDERS, ("month",)),
        "Customer Experience (Review Score)": Card(review_scores, _ORDERS, ("month",)),
        "Logistics Cost (Freight Ratio)": Card(logistics_cost, _ORDERS, ("month",)),
        "Seller Performance": Card(seller_performance, _PERFORMANCE, ("month",)),
        "Data Quality": Card(data_quality, ("mart_data_quality",), ("month",)),
        "Trends": Card(trends, _ORDERS, ("month",)),
    },
    "Problem Analysis": {
        "Late-Delivery Severity by Month": Card(severity_by_month, _ORDERS, ("month",)),
        "On-Time Rate by Seller (Worst First)": Card(
            slowest_sellers, _PERFORMANCE, ("month", "seller_id")
        ),
        "Logistics Cost by Month": Card(cost_by_month, _ORDERS, ("month",)),
        "Late-Delivery Severity by Customer State/City": Card(
            severity_by_place, _ORDERS, ("month", "customer_state")
        ),
        "Freight Ratio by Seller": Card(
            freight_by_seller, ("mart_seller_freight",), ("month", "seller_id")
        ),
        "Freight Ratio by Customer State": Card(
            freight_by_state, _ORDERS, ("month", "customer_state")
        ),
    },
    "Root Cause & Drill-Down": {
        "Review Score by Delivery Severity": Card(review_by_severity, _ORDERS, ("month",)),
        "Freight Ratio by Delivery Severity": Card(cost_by_severity, _ORDERS, ("month",)),
        "Seller Drill-Down": Card(
            seller_drill_down, ("fct_order_items", "fct_orders"), ("seller_id",)
        ),
        "Location Drill-Down": Card(location_drill_down, _ORDERS, ("city", "state")),
        "Order Drill-Down": Card(
            order_drill_down, ("fct_orders", "fct_order_items"), ("order_id",)
        ),
    },
}


def dashboard(marts, name: str, filters: Filters | None = None) -> dict[str, DataFrame]:
    """All reports of a dashboard under one set of filters.

    ``marts`` maps table names to DataFrames. Drill-downs whose required filter is
    not set are left out, as there is nothing to show yet.
    """
    filters = filters or Filters()
    shown = {}
    for title, card in DASHBOARDS[name].items():
        values = {f: getattr(filters, f) for f in card.filters}
        if card.report in (seller_drill_down, order_drill_down) and None in values.values():
            continue
        shown[title] = card.report(*[marts[m] for m in card.marts], **values)
    return shown
