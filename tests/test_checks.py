"""Every check finds planted violations and passes clean tables."""

import datetime as dt

import pytest

from parcelyard import Models
from parcelyard import schema as S
from parcelyard.operators import constraints as C
from parcelyard.operators.compare import count_mismatch, row_differences
from parcelyard.plans import checks
from parcelyard.sources.calendar import observed_range
from parcelyard.sources.demo import raw_tables, staged_tables
from tests.helpers import rows

T = dt.datetime


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 2), (None, 9), (None, 9)], "k string, v int"
    )


def test_generic_constraints(spark, keyed):
    parent = spark.createDataFrame([("a",)], "id string")
    assert rows(C.not_null(keyed, "k")) == {(None, 9): 2}
    assert rows(C.unique(keyed, "k"), "k", "n_rows") == {("a", 2): 1}
    assert rows(C.accepted_values(keyed, "k", ["a"]), "k") == {("b",): 1}
    assert rows(C.accepted_values(keyed, "v", [1, 2]), "v") == {(9,): 2}
    assert rows(C.relationships(keyed, "k", parent, "id"), "k", "n_rows") == {("b", 1): 1}
    assert rows(C.accepted_range(keyed, "v", low=2), "v") == {(1,): 1}
    assert rows(C.accepted_range(keyed, "v", high=2), "v") == {(9,): 2}
    assert rows(C.accepted_range(keyed, "v", 1, 9, inclusive=False), "v") == {(1,): 1, (9,): 2}
    assert rows(C.unique_combination(keyed, ["k", "v"]), "k", "v", "n_rows") == {(None, 9, 2): 1}
    assert rows(C.equal_rowcount(keyed, parent), "row_count", "other_count") == {(5, 1): 1}
    assert C.equal_rowcount(keyed, keyed).count() == 0
    assert count_mismatch(parent.limit(0), parent, "l", "r").first().asDict() == {"l": 0, "r": 1}
    assert count_mismatch(parent.limit(0), parent.limit(0), "l", "r").count() == 0


def test_row_differences_with_repeated_keys(spark):
    left = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", None)], "k string, v double")
    right = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0)], "k string, v double")
    got = rows(row_differences(left, right, ["k"], ["v"]), "k", "left_rows", "right_rows")
    assert got == {("a", 2, 1): 1, ("c", 0, 1): 1}
    assert row_differences(left, left.repartition(3), ["k"], ["v"]).count() == 0


def _delivery(spark, *rows_):
    return spark.createDataFrame(
        rows_,
        """order_id string, order_purchase_timestamp timestamp_ntz,
           order_delivered_customer_date timestamp_ntz, delay_days long, severity string""",
    )


DAY = T(2018, 1, 5)


def _found(check, **tables):
    return checks.SINGULAR[check].violations(tables)


def test_calendar_gaps(spark):
    stamp = "timestamp_ntz'2018-01-0{} 23:00:00' as {}"
    columns = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    orders = spark.sql(
        "select " + ", ".join(stamp.format(i + 1, c) for i, c in enumerate(columns))
    )
    calendar = spark.sql("select explode(array(date'2018-01-01', date'2018-01-04')) as date_day")
    missing = _found("calendar_gaps", stg_orders=orders, dim_date=calendar).collect()
    assert sorted(r.missing_date.day for r in missing) == [2, 3, 5]


def test_item_fact_differences(spark):
    schema = "order_id string, order_item_id short, price double, freight_value double"
    stg = spark.createDataFrame(
        [("same", 1, 1.0, None), ("price", 1, 1.0, 2.0), ("null", 1, None, 2.0), ("stg", 1, 3.0, 1.0)],
        schema,
    )
    fct = spark.createDataFrame(
        [("same", 1, 1.0, None), ("price", 1, 9.0, 2.0), ("null", 1, 5.0, 2.0), ("fct", 1, 4.0, 1.0)],
        schema,
    )
    found = _found("item_fact_differences", stg_order_items=stg, fct_order_items=fct)
    assert rows(found, "order_id", "stg_price", "fct_price", "stg_rows", "fct_rows") == {
        ("price", 1.0, None, 1, 0): 1,
        ("price", None, 9.0, 0, 1): 1,
        ("null", None, None, 1, 0): 1,
        ("null", None, 5.0, 0, 1): 1,
        ("stg", 3.0, None, 1, 0): 1,
        ("fct", None, 4.0, 0, 1): 1,
    }


def test_order_level_checks(spark):
    delivery = _delivery(
        spark,
        ("good", DAY, T(2018, 1, 9), 0, S.ON_TIME),
        ("back", DAY, T(2018, 1, 1), 2, S.LATE_1_3),
        ("wrong", DAY, None, 5, S.LATE_8_UP),
        ("nosev", DAY, None, 5, None),
        ("nodelay", DAY, None, None, S.ON_TIME),
        ("closed", DAY, None, None, S.CLOSED),
    )
    experience = spark.createDataFrame(
        [("good", 5), ("back", 6), ("ghost", None), (None, 0)], "order_id string, review_score short"
    )
    given = {"int_order_delivery_metrics": delivery, "int_customer_experience_metrics": experience}
    assert set(rows(_found("experience_orphans", **given))) == {("ghost",), (None,)}
    assert set(rows(_found("invalid_review_scores", **given), "order_id")) == {("back",), (None,)}
    assert rows(_found("experience_rowcount", **given)) == {(6, 4): 1}
    assert set(rows(_found("impossible_dates", **given), "order_id")) == {("back",)}
    assert rows(_found("delivery_rowcount", **given, stg_orders=delivery.limit(2))) == {(6, 2): 1}
    bad = rows(_found("inconsistent_severity", **given), "order_id")
    assert set(bad) == {("wrong",), ("nosev",), ("nodelay",)}


def test_freight_checks(spark):
    items = spark.createDataFrame(
        [("a", 1.0, 0.1), ("a", 2.0, 0.2), ("b", 1.0, 1.0), ("c", None, 1.0), ("d", 1.0, 1.0)],
        "order_id string, price double, freight_value double",
    )
    metrics = spark.createDataFrame(
        [("a", 3.0, 0.30000000000000004, 0.1), ("b", 1.5, 1.0, -1.0), ("c", 0.0, 1.0, None), ("x", 1.0, 1.0, 1.0)],
        "order_id string, total_price double, total_freight_value double, freight_ratio double",
    )
    given = {"stg_order_items": items, "int_order_freight_metrics": metrics}
    assert set(rows(_found("freight_sums", **given), "order_id")) == {("b",), ("c",), ("d",), ("x",)}
    assert set(rows(_found("negative_freight_ratio", **given), "order_id")) == {("b",)}
    assert _found("freight_rowcount", **given).count() == 0
    fewer = {**given, "int_order_freight_metrics": metrics.limit(3)}
    assert rows(_found("freight_rowcount", **fewer)) == {(3, 4): 1}


def test_seller_checks(spark):
    month, later = dt.date(2018, 1, 1), dt.date(2018, 2, 1)
    metrics = spark.createDataFrame(
        [
            ("ok", month, 1, 4.0, 2.0, 0.5),
            ("ratio", month, 1, 4.0, 2.0, 0.7),
            ("noratio", month, 1, 4.0, 2.0, None),
            ("zero", month, 1, 0.0, 2.0, 0.0),
            ("zerook", month, 1, 0.0, 2.0, None),
            ("ok", later, 1, 4.0, 2.0, 0.5),
        ],
        """seller_id string, time_period date, order_volume long, total_price double,
           total_freight_value double, freight_ratio double""",
    )
    bad = _found("seller_ratio_expression", int_seller_freight_metrics=metrics)
    assert set(rows(bad, "seller_id")) == {("ratio",), ("noratio",), ("zero",)}

    items = spark.createDataFrame(
        [(o, s, 4.0, 2.0) for o, s in
         [("o1", "ok"), ("o2", "ratio"), ("o2", "noratio"), ("o3", "lost"), ("o1", None)]]
        + [("o1", "zero", 0.0, 2.0), ("o2", "zero", 0.0, 0.0), ("o1", "zerook", 0.0, 2.5)],
        "order_id string, seller_id string, price double, freight_value double",
    )
    delivery = _delivery(spark, *[(o, DAY, None, None, None) for o in ("o1", "o2", "o3")])
    bad = _found(
        "seller_sums",
        int_seller_freight_metrics=metrics,
        stg_order_items=items,
        int_order_delivery_metrics=delivery,
    )
    assert set(rows(bad, "seller_id", "time_period")) == {
        ("lost", month),
        ("zero", month),
        ("zerook", month),
        ("ok", later),
    }

    totals = spark.createDataFrame(
        [("a", 0, 0.5), ("b", None, None), ("c", 3, 1.5), ("d", 3, -0.1), ("e", 1, 1.0)],
        "seller_id string, order_volume long, on_time_rate double",
    )
    given = {"int_seller_performance_metrics": totals}
    assert set(rows(_found("on_time_rate_range", **given), "seller_id")) == {("c",), ("d",)}
    assert set(rows(_found("order_volume_positive", **given), "seller_id")) == {("a",), ("b",)}

    grain = _found(
        "seller_grain_differences",
        mart_seller_freight=metrics.filter("seller_id != 'zero'"),
        mart_seller_performance=metrics.filter("seller_id != 'ratio'"),
    )
    assert rows(grain, "seller_id", "in_freight", "in_perf") == {
        ("ratio", 1, None): 1,
        ("zero", None, 1): 1,
    }


def test_declared_constraints_are_complete():
    assert sum(map(len, checks.NOT_NULL.values())) == 54
    assert len(checks.UNIQUE) == 25
    assert sum(map(len, checks.ACCEPTED_VALUES.values())) == 7
    assert len(checks.RELATIONSHIPS) == 6
    assert sum(map(len, checks.ACCEPTED_RANGE.values())) == 19
    assert len(checks.UNIQUE_COMBINATION) == 7
    assert len(checks.EQUAL_ROWCOUNT) == 2
    assert len(checks.SINGULAR) == 16
    assert [n for n, c in checks.SINGULAR.items() if c.level == "warn"] == ["impossible_dates"]


def test_run_checks_over_everything(spark, small_dir):
    staged = staged_tables(spark, small_dir)
    days = observed_range(
        staged["stg_orders"],
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    tables = checks.WithRaw(Models(staged, lambda: days), raw_tables(spark, small_dir))
    found = [r for r in checks.singular_counts(tables).collect() if r.violations]
    assert [(r.check, r.level, r.violations) for r in found] == [("impossible_dates", "warn", 4)]
    # Line numbers repeat within an order of the source, so its grain check must fire.
    repeated = {r.table_name: r.violations for r in checks.unique_combination_counts(tables).collect()}
    assert repeated["fct_order_items"] == repeated["raw.order_items"] > 0
    assert repeated["mart_seller_freight"] == repeated["stg_order_payments"] == 0
    assert checks.run_checks(tables).columns == ["check", "target", "level", "violations"]
