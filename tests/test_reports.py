import datetime as dt

import pytest

from parcelyard.plans import insights, reports
from parcelyard.plans.reports import Filters
from parcelyard.sources import tables
from tests.helpers import plan, rows


def test_month_filter_bounds(spark):
    df = spark.sql(
        "select stack(4, timestamp_ntz'2018-01-31 23:59:59', timestamp_ntz'2018-02-01 00:00:00',"
        " timestamp_ntz'2018-02-28 23:59:59', timestamp_ntz'2018-03-01 00:00:00') as t"
    )
    for month in ("2018-02", "2018-02-17", dt.date(2018, 2, 28)):
        kept = sorted(r.t.day for r in reports.in_month(df, "t", month).collect())
        assert kept == [1, 28]
    december = spark.sql("select date'2018-12-31' as t union all select date'2019-01-01'")
    assert reports.in_month(december, "t", "2018-12").count() == 1
    assert reports.in_month(df, "t", None) is df


def test_optional_filters_leave_the_table_alone(models):
    orders = models.fct_orders
    assert reports.one_of(orders, "customer_state", None) is orders
    assert reports.equal_to(orders, "customer_city", None) is orders
    assert reports.one_of(orders, "customer_state", "asia").select("customer_state").distinct().count() == 1


def test_required_filters(models):
    with pytest.raises(ValueError, match="seller_id"):
        reports.seller_drill_down(models.fct_order_items, models.fct_orders, None)
    with pytest.raises(ValueError, match="order_id"):
        reports.order_drill_down(models.fct_orders, models.fct_order_items, None)


def test_reports_are_sorted(models):
    slow = reports.slowest_sellers(models.mart_seller_performance, min_orders=1).collect()
    rates = [r.on_time_rate for r in slow]
    assert rates == sorted(rates, key=lambda v: (v is None, v))
    months = [r.order_month for r in reports.data_quality(models.mart_data_quality).collect()]
    assert months == sorted(months)
    ratio = [r.freight_ratio for r in reports.freight_by_seller(models.mart_seller_freight).collect()]
    present = [r for r in ratio if r is not None]
    assert present == sorted(present, reverse=True)
    assert ratio[: len(present)] == present


def test_null_rates_rank_last(spark):
    df = spark.createDataFrame(
        [("a", None, 9), ("b", 0.5, 9), ("c", 0.1, 9), ("d", 0.0, 4)],
        "seller_id string, on_time_rate double, order_volume long",
    ).selectExpr(
        "*", "'x' as seller_state", "'y' as seller_city", "1.0D as avg_review_score",
        "date'2018-01-01' as time_period",
    )
    assert [r.seller_id for r in reports.slowest_sellers(df).collect()] == ["c", "b", "a"]
    assert [r.seller_id for r in reports.slowest_sellers(df, limit=1).collect()] == ["c"]


def test_dashboards(models):
    assert {k: len(v) for k, v in reports.DASHBOARDS.items()} == {
        "Executive Overview": 7,
        "Problem Analysis": 6,
        "Root Cause & Drill-Down": 5,
    }
    plain = reports.dashboard(models, "Root Cause & Drill-Down")
    assert set(plain) == {
        "Review Score by Delivery Severity",
        "Freight Ratio by Delivery Severity",
        "Location Drill-Down",
    }
    chosen = reports.dashboard(
        models, "Root Cause & Drill-Down", Filters(seller_id="7", order_id="77", month="1996-03")
    )
    assert {r.seller_id for r in chosen["Seller Drill-Down"].collect()} == {"7"}
    assert {r.order_id for r in chosen["Order Drill-Down"].collect()} == {"77"}
    overview = reports.dashboard(models, "Executive Overview", Filters(month="1996-03"))
    assert overview["Logistics Performance Score & Components"].count() == 1
    assert overview["Trends"].first()["count"] == overview["Logistics Cost (Freight Ratio)"].first()["count"]


def test_month_reaches_the_folders_of_stored_orders(models, tmp_path):
    stored = tables.write_orders(models.fct_orders, str(tmp_path / "o"))
    text = plan(reports.severity_by_month(stored, month="1996-03"))
    assert "PartitionFilters: [isnotnull(order_month" in text
    assert "PushedFilters: [IsNotNull(order_purchase_timestamp)" in text
    lazy = reports.severity_by_month(models.fct_orders, month="1996-03")
    assert rows(reports.severity_by_month(stored, month="1996-03")) == rows(lazy)


def test_review_swing(spark):
    df = spark.createDataFrame(
        [("a", 5), ("a", 4), ("b", 1), ("c", None)], "delivery_severity string, review_score short"
    )
    assert insights.review_swing(df).first().review_swing == 3.5
