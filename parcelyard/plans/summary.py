"""A summary of the order fact whose rows can be added up, and the reports it answers.

One grouping-sets pass keeps sums and counts per month and outcome (severity and review
score) and per month and place. Counts, sums and means of any coarser group or filter
follow from these rows, so a report reads a few thousand of them instead of all orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.plans import reports
from parcelyard.plans.reports import Month, Values, in_month, one_of

NAME = "mart_order_summary"
#: Columns of a row by level; the others are null there.
LEVELS = {
    "outcome": ["month", "delivery_severity", "review_score"],
    "place": ["month", "customer_state", "customer_city", "delivery_severity"],
}
_GROUPS = ["month", "delivery_severity", "review_score", "customer_state", "customer_city"]
#: Columns of the fact that are summed, and what their states are called.
_SUMMED = {"delay_days": "delay", "freight_ratio": "ratio", "total_freight_value": "freight"}


def order_summary(orders: DataFrame) -> DataFrame:
    """Level, group columns, ``n_orders``, and sum and count of each summed column.

    A sum of no values is null. Every order counts once per level.
    """
    dated = orders.withColumn("month", reports._purchase_month(orders))
    states = [
        state
        for column, name in _SUMMED.items()
        for state in (F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n"))
    ]
    level = F.when(F.grouping("review_score") == 0, "outcome").otherwise("place")
    return dated.groupingSets(
        [[F.col(c) for c in columns] for columns in LEVELS.values()], *[F.col(c) for c in _GROUPS]
    ).agg(level.alias("level"), F.count(F.lit(1)).alias("n_orders"), *states)


def _rows(summary: DataFrame, level: str, month: Month | None) -> DataFrame:
    return in_month(summary.filter(F.col("level") == level), "month", month)


def _orders() -> Column:
    return F.sum("n_orders")


def _sum(name: str) -> Column:
    return F.sum(f"{name}_sum")


def _mean(name: str) -> Column:
    return F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_n"), F.lit(0))


def delivery_kpis(summary: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT2 from the summary."""
    groups = _rows(summary, "outcome", month).groupBy("delivery_severity")
    return groups.agg(_orders().alias("count"), _mean("delay").alias("avg"))


def review_scores(summary: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT3 from the summary."""
    groups = _rows(summary, "outcome", month).groupBy("review_score")
    return groups.agg(_orders().alias("count"))


def logistics_cost(summary: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT4 from the summary."""
    return _rows(summary, "outcome", month).agg(
        _mean("ratio").alias("avg"),
        _sum("freight").alias("sum"),
        F.coalesce(_orders(), F.lit(0)).alias("count"),
    )


def trends(summary: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT7 from the summary."""
    scored = F.when(F.col("review_score").isNotNull(), F.col("n_orders"))
    mean = F.sum(F.col("review_score") * F.col("n_orders")) / F.nullif(F.sum(scored), F.lit(0))
    groups = _rows(summary, "outcome", month).groupBy(F.col("month").alias(reports.PURCHASE))
    return groups.agg(_orders().alias("count"), mean.alias("avg"))


def severity_by_month(summary: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT8 from the summary."""
    groups = _rows(summary, "outcome", month).groupBy("month", "delivery_severity")
    return reports._sorted(groups.agg(_orders().alias("order_count")), "month")


def cost_by_month(summary: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT10 from the summary."""
    costs = _rows(summary, "outcome", month).groupBy("month").agg(
        _mean("ratio").alias("avg_freight_ratio"),
        _mean("freight").alias("avg_freight_value"),
        _sum("freight").alias("sum_freight_value"),
    )
    return reports._sorted(costs, "month")


def severity_by_place(
    summary: DataFrame, month: Month | None = None, customer_state: Values | None = None
) -> DataFrame:
    """RPT11 from the summary."""
    rows = one_of(_rows(summary, "place", month), "customer_state", customer_state)
    groups = rows.groupBy("customer_state", "customer_city", "delivery_severity")
    return groups.agg(_orders().alias("order_count")).orderBy(
        F.asc_nulls_last("customer_state"), F.asc_nulls_last("customer_city")
    )


def review_by_severity(summary: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT12 from the summary."""
    groups = _rows(summary, "outcome", month).groupBy("review_score", "delivery_severity")
    counts = groups.agg(_orders().alias("order_count"))
    return reports._sorted(counts, "review_score", "delivery_severity")


def cost_by_severity(summary: DataFrame, month: Month | None = None) -> DataFrame:
    """RPT13 from the summary."""
    costs = _rows(summary, "outcome", month).groupBy("delivery_severity").agg(
        _mean("ratio").alias("avg_freight_ratio"),
        _mean("freight").alias("avg_freight_value"),
        _mean("delay").alias("avg_delay_days"),
        _orders().alias("order_count"),
    )
    return reports._sorted(costs, "delivery_severity")


def freight_by_state(
    summary: DataFrame, month: Month | None = None, customer_state: Values | None = None
) -> DataFrame:
    """RPT18 from the summary."""
    rows = one_of(_rows(summary, "place", month), "customer_state", customer_state)
    return (
        rows.groupBy("customer_state")
        .agg(
            _mean("ratio").alias("avg_freight_ratio"),
            _sum("freight").alias("total_freight_value"),
            _orders().alias("order_count"),
        )
        .orderBy(F.desc_nulls_last("avg_freight_ratio"))
    )


#: The report over all orders, and the one that gives the same rows from the summary.
SUMMARIZED: dict[Callable[..., DataFrame], Callable[..., DataFrame]] = {
    reports.delivery_kpis: delivery_kpis,
    reports.review_scores: review_scores,
    reports.logistics_cost: logistics_cost,
    reports.trends: trends,
    reports.severity_by_month: severity_by_month,
    reports.cost_by_month: cost_by_month,
    reports.severity_by_place: severity_by_place,
    reports.review_by_severity: review_by_severity,
    reports.cost_by_severity: cost_by_severity,
    reports.freight_by_state: freight_by_state,
}


def dashboard(marts, name: str, filters: reports.Filters | None = None) -> dict[str, DataFrame]:
    """:func:`reports.dashboard`, with every card that the summary answers read from it."""
    filters = filters or reports.Filters()
    shown = reports.dashboard(marts, name, filters)
    for title, card in reports.DASHBOARDS[name].items():
        if card.report in SUMMARIZED:
            values = {f: getattr(filters, f) for f in card.filters}
            shown[title] = SUMMARIZED[card.report](marts[NAME], **values)
    return shown
