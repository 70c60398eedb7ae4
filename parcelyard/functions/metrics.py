"""Column expressions for delay, ratios, shares and scores."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelyard import schema as S


def month_start(ts: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(ts, "month")


def delay_days(status: Column, delivered: Column, estimated: Column) -> Column:
    """Midnights passed from the estimate to the delivery; null without an outcome."""
    late = F.date_diff(delivered, estimated).cast("long")
    return F.when(status.isin(S.CLOSED_STATUSES), F.lit(None)).otherwise(late)


def severity(status: Column, delivered: Column, estimated: Column) -> Column:
    """Delivery severity. The status wins over whatever the dates say."""
    late = F.date_diff(delivered, estimated)
    return (
        F.when(status.isin(S.CLOSED_STATUSES), S.CLOSED)
        .when(late.isNull(), S.NO_DELIVERY_DATA)
        .when(late <= 0, S.ON_TIME)
        .when(late <= 3, S.LATE_1_3)
        .when(late <= 7, S.LATE_4_7)
        .otherwise(S.LATE_8_UP)
    )


def severity_points(col: Column) -> Column:
    """Points of a dated severity, null for the others."""
    return F.coalesce(*[F.when(col == label, p) for label, p in S.SEVERITY_POINTS.items()])


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    """Division that is null where the denominator is zero or null."""
    return F.when(denominator != 0, numerator / denominator)


def share(condition: Column, among: Column | None = None) -> Column:
    """Aggregate: rows meeting ``condition`` over rows meeting ``among`` (default all)."""
    total = F.count(F.lit(1)) if among is None else F.count_if(among)
    return F.count_if(condition) / F.nullif(total, F.lit(0))


def on_time_rate(sev: Column) -> Column:
    """Aggregate: on-time orders over orders that have a delivery outcome."""
    return share(sev == S.ON_TIME, among=~sev.isin(S.NO_OUTCOME))


def min_max_score(value: Column, low: Column, high: Column) -> Column:
    """100 at the lowest value, 0 at the highest, 100 when there is no spread."""
    scaled = 100 * (1 - (value - low) / F.nullif(high - low, F.lit(0.0)))
    return F.when(value.isNotNull(), F.when(high == low, F.lit(100.0)).otherwise(scaled))


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Weighted mean of the named columns, re-weighted over the ones that are not null."""
    present = [(F.col(name), F.lit(w)) for name, w in weights.items()]
    points = reduce(add, [F.when(c.isNotNull(), w * c).otherwise(0.0) for c, w in present])
    weight = reduce(add, [F.when(c.isNotNull(), w).otherwise(0.0) for c, w in present])
    return points / F.nullif(weight, F.lit(0.0))
