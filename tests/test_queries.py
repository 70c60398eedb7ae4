"""Every registered query against its SQL in DuckDB."""

import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from queryset.catalog import QUERIES
from tests.helpers import plan

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from compare import duck, duck_rows, spark_rows  # noqa: E402

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry_points.queries())
    assert set(NAMES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, small_dir, name):
    df = entry_points.queries()[name](spark, small_dir)
    text = plan(df, "simple")
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in text
    columns, got = spark_rows(df)
    expected_columns, expected = duck_rows(con, entry_points.oracle_sql()[name])
    assert columns == expected_columns
    assert got == expected


def test_entry(spark, small_dir):
    df = entry_points.entry(spark)
    assert df.columns == ["month", "delivery_severity", "order_count"]
    assert df.count() > 0


def test_unused_lookups_leave_the_plan(models):
    from parcelyard.plans import reports

    text = plan(reports.severity_by_month(models.fct_orders), "simple")
    assert "o_orderdate" in text and "o_totalprice" not in text
    assert "l_orderkey" not in text and "event_id" not in text
    text = plan(models.fct_orders, "simple")
    assert "event_id" in text and "props" not in text
