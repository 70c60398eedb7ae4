"""Reports from the summary equal those over all orders."""

import pytest

from parcelyard.plans import reports, summary
from parcelyard.sources import tables
from tests.helpers import plan

FILTERED = {reports.severity_by_place, reports.freight_by_state}


def _orders(spark):
    """Orders with every column null somewhere, and a month with no freight at all."""
    return spark.sql(
        """SELECT cast(id AS string) AS order_id,
             CASE WHEN id % 11 <> 0 THEN timestamp_ntz'2018-01-05 00:00:00'
                  + make_interval(0, cast(id % 4 AS int)) END AS order_purchase_timestamp,
             element_at(array('On Time', '1-3 days late', null, '8+ days late'), cast(id % 4 AS int) + 1)
               AS delivery_severity,
             CASE WHEN id % 5 <> 0 THEN id % 9 - 3 END AS delay_days,
             CASE WHEN id % 4 <> 3 AND id % 3 <> 0 THEN cast(id % 16 AS double) / 8 END AS freight_ratio,
             CASE WHEN id % 4 <> 3 THEN cast(id % 64 AS double) / 4 END AS total_freight_value,
             CASE WHEN id % 6 <> 0 THEN cast(id % 5 + 1 AS smallint) END AS review_score,
             CASE WHEN id % 7 <> 0 THEN 's' || id % 3 END AS customer_state,
             CASE WHEN id % 8 <> 0 THEN 'c' || id % 10 END AS customer_city
           FROM range(997)"""
    )


def _values(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return tables._write_summary(_orders(spark), str(tmp_path_factory.mktemp("s") / "t"))


@pytest.mark.parametrize("report", summary.SUMMARIZED, ids=lambda f: f.__name__)
def test_equal_to_the_report_over_all_orders(spark, stored, report):
    orders, short = _orders(spark), summary.SUMMARIZED[report]
    cases = [{}, {"month": "2018-02"}, {"month": "2018-04"}, {"month": "1999-01"}]
    if report in FILTERED:
        cases += [{"customer_state": "s1"}, {"month": "2018-03", "customer_state": ["s0", "s2", "x"]}]
    for filters in cases:
        expected, got = report(orders, **filters), short(stored, **filters)
        assert got.columns == expected.columns and got.dtypes == expected.dtypes
        assert _values(got) == _values(expected), filters


def test_an_empty_fact(spark, tmp_path):
    none = _orders(spark).limit(0)
    empty = tables._write_summary(none, str(tmp_path / "t"))
    for report, short in summary.SUMMARIZED.items():
        assert _values(short(empty)) == _values(report(none))


def test_one_pass_and_one_folder(spark, stored):
    text = plan(summary.order_summary(_orders(spark)), "simple")
    assert text.count("Range (") == 1 and text.count("Exchange") == 1
    assert "PartitionFilters: [isnotnull(level" in plan(summary.delivery_kpis(stored), "simple")
    outcome = stored.filter("level = 'outcome'")
    assert outcome.agg({"n_orders": "sum"}).first()[0] == 997


def test_dashboards_read_the_summary(spark, models, stored):
    marts = {n: models[n] for n in ("mart_logistics_performance_score", "mart_seller_performance", "mart_data_quality", "fct_orders")}
    marts[summary.NAME] = summary.order_summary(models.fct_orders)
    plain = reports.dashboard(marts, "Executive Overview")
    short = summary.dashboard({**marts, "fct_orders": models.fct_orders.limit(0)}, "Executive Overview")
    assert list(short) == list(plain)
    counts = lambda cards: sorted(map(tuple, cards["Customer Experience (Review Score)"].collect()), key=str)
    assert counts(short) == counts(plain)
