import pytest

from parcelyard import Models
from parcelyard import schema as S
from tests.helpers import by, item, order, raw_tables, review, rows


@pytest.mark.parametrize(
    ("delivered", "days", "severity"),
    [
        ("2018-01-09 12:00:00", -1, S.ON_TIME),
        ("2018-01-10 23:59:59", 0, S.ON_TIME),
        ("2018-01-11 00:00:00", 1, S.LATE_1_3),
        ("2018-01-13 00:00:00", 3, S.LATE_1_3),
        ("2018-01-14 00:00:00", 4, S.LATE_4_7),
        ("2018-01-17 23:00:00", 7, S.LATE_4_7),
        ("2018-01-18 00:00:00", 8, S.LATE_8_UP),
        (None, None, S.NO_DELIVERY_DATA),
    ],
)
def test_severity_boundaries(spark, delivered, days, severity):
    models = Models.from_raw(raw_tables(spark, orders=[order("o", delivered)]))
    row = models.int_order_delivery_metrics.first()
    assert (row.delay_days, row.severity) == (days, severity)


def test_delay_counts_midnights_and_status_wins(spark):
    late = "2018-01-20 00:00:00"
    orders = [
        order("midnight", "2018-01-11 00:01:00", "2018-01-10 23:59:00"),
        order("canceled", late, order_status=" Canceled "),
        order("unavailable", late, order_status="unavailable"),
        order("nostatus", late, order_status=None),
        order("noestimate", late, None),
    ]
    got = by(Models.from_raw(raw_tables(spark, orders=orders)).int_order_delivery_metrics, "order_id")
    assert got["midnight"].delay_days == 1
    assert (got["canceled"].delay_days, got["canceled"].severity) == (None, S.CLOSED)
    assert (got["unavailable"].delay_days, got["unavailable"].severity) == (None, S.CLOSED)
    assert (got["nostatus"].delay_days, got["nostatus"].severity) == (10, S.LATE_8_UP)
    assert got["noestimate"].severity == S.NO_DELIVERY_DATA


def test_freight(spark):
    items = [
        item("two", price="100", freight="10"),
        item("two", price="50", freight="20", n="2"),
        item("free", price="0", freight="5"),
        item("bad", price="x", freight="5"),
    ]
    got = by(Models.from_raw(raw_tables(spark, order_items=items)).int_order_freight_metrics, "order_id")
    assert (got["two"].total_price, got["two"].total_freight_value) == (150.0, 30.0)
    assert got["two"].freight_ratio == pytest.approx(0.2)
    assert got["free"].freight_ratio is None
    assert (got["bad"].total_price, got["bad"].freight_ratio) == (None, None)


def _customer(customer_id, person, city, state="SP", prefix="1"):
    return {
        "customer_id": customer_id,
        "customer_unique_id": person,
        "customer_zip_code_prefix": prefix,
        "customer_city": city,
        "customer_state": state,
    }


def test_fct_orders_keeps_every_order_once(spark):
    raw = raw_tables(
        spark,
        orders=[order("full", "2018-01-09 00:00:00"), order("bare"), order("lost", customer_id=None)],
        order_items=[item("full"), item("full", n="2", seller="s2"), item("orphan")],
        order_reviews=[review("full", "r1", "4"), review("orphan", "r2")],
        customers=[
            _customer("c-full", "ann", "rio"),
            _customer("c-other", "ann", "santos"),
            _customer("c-third", "ann", "santos"),
        ],
    )
    models = Models.from_raw(raw)
    got = by(models.fct_orders, "order_id")
    assert set(got) == {"full", "bare", "lost"}
    assert len(models.fct_orders.columns) == 17
    full, bare = got["full"], got["bare"]
    assert (full.total_price, full.total_freight_value, full.review_score) == (200.0, 20.0, 4)
    assert (full.customer_unique_id, full.customer_city) == ("ann", "santos")
    assert (bare.total_price, bare.total_freight_value, bare.freight_ratio) == (None, None, None)
    assert (bare.review_score, bare.customer_state) == (None, None)


def test_person_address_ties_go_to_the_lowest_customer_id(spark):
    customers = [
        _customer("c2", "tie", "rio"),
        _customer("c1", "tie", "santos"),
        _customer("c9", "mode", "rio"),
        _customer("c8", "mode", "rio"),
        _customer("c0", "mode", "santos"),
        _customer("c5", "blank", None),
    ]
    got = by(Models.from_raw(raw_tables(spark, customers=customers)).dim_customer, "customer_unique_id")
    assert {k: r.customer_city for k, r in got.items()} == {
        "tie": "santos",
        "mode": "rio",
        "blank": None,
    }


def test_quality_percentages(spark):
    orders = [
        order("ok", "2018-01-09 00:00:00"),
        order("early", "2017-12-30 00:00:00"),
        order("nodata"),
        order("closed", order_status="canceled"),
        order("undated", "2018-01-09 00:00:00", order_purchase_timestamp=None),
    ]
    models = Models.from_raw(raw_tables(spark, orders=orders, order_reviews=[review("ok", "r")]))
    months = by(models.int_data_quality_flags, "order_month")
    assert len(months) == 2 and None in months
    month = next(r for m, r in months.items() if m)
    assert month.order_count == 4
    assert month.pct_orders_unavailable_delivery_data == pytest.approx(1 / 3)
    assert month.pct_orders_canceled_or_unavailable == pytest.approx(1 / 4)
    assert month.pct_orders_missing_review == pytest.approx(3 / 4)
    assert month.pct_orders_impossible_date_ordering == pytest.approx(1 / 4)


def test_quality_without_open_orders_is_null(spark):
    orders = [order("closed", order_status="canceled")]
    row = Models.from_raw(raw_tables(spark, orders=orders)).mart_data_quality.first()
    assert row.pct_orders_unavailable_delivery_data is None
    assert "order_count" not in row.asDict()


def test_sellers_share_outcomes_but_not_money(spark):
    raw = raw_tables(
        spark,
        orders=[
            order("both", "2018-01-09 00:00:00"),
            order("late", "2018-01-12 00:00:00"),
            order("open"),
            order("undated", "2018-01-09 00:00:00", order_purchase_timestamp=None),
        ],
        order_items=[
            item("both", "s1", "100", "10"),
            item("both", "s1", "50", "5", n="2"),
            item("both", "s2", "10", "10", n="3"),
            item("late", "s1", "0", "1"),
            item("open", "s2", "10", "2"),
            item("undated", "s2", "10", "2"),
            item("missing", "s1", "7", "7"),
            item("both", None, "1", "1", n="4"),
        ],
        order_reviews=[review("both", "r1", "5"), review("late", "r2", "2")],
        sellers=[
            {"seller_id": "s1", "seller_city": "Rio", "seller_state": "RJ"},
            {"seller_id": "s2", "seller_city": "Santos", "seller_state": "SP"},
        ],
    )
    models = Models.from_raw(raw)
    total = by(models.int_seller_performance_metrics, "seller_id")
    assert set(total) == {"s1", "s2"}
    assert (total["s1"].order_volume, total["s1"].on_time_rate) == (3, 0.5)
    assert (total["s2"].order_volume, total["s2"].on_time_rate) == (3, 1.0)
    assert (total["s1"].avg_review_score, total["s2"].avg_review_score) == (3.5, 5.0)

    monthly = by(models.mart_seller_performance, "seller_id")
    assert set(monthly) == {"s1", "s2"}
    assert (monthly["s1"].order_volume, monthly["s2"].order_volume) == (2, 2)
    assert (monthly["s2"].seller_city, monthly["s2"].on_time_rate) == ("santos", 1.0)

    money = by(models.mart_seller_freight, "seller_id")
    assert (money["s1"].total_price, money["s1"].total_freight_value) == (150.0, 16.0)
    assert (money["s2"].total_price, money["s2"].total_freight_value) == (20.0, 12.0)
    assert money["s2"].freight_ratio == pytest.approx(0.6)
    assert (money["s1"].order_volume, money["s2"].order_volume) == (2, 2)


def test_seller_without_outcomes_has_no_rate(spark):
    raw = raw_tables(spark, orders=[order("open")], order_items=[item("open")])
    row = Models.from_raw(raw).int_seller_performance_metrics.first()
    assert (row.order_volume, row.on_time_rate, row.avg_review_score) == (1, None, None)


def test_result_does_not_depend_on_partitioning(spark, small_dir):
    from parcelyard.sources.demo import staged_tables

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            models = Models(staged_tables(spark, small_dir))
            results.append([rows(models[t]) for t in ("fct_orders", "mart_seller_performance")])
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
