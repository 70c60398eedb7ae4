"""Facts in equal buckets join without a shuffle, and one order is one bucket."""

import re

import pytest

from parcelyard.plans import reports
from parcelyard.sources import bucketed, tables
from tests.helpers import plan, rows


@pytest.fixture(scope="module")
def marts(spark, models, tmp_path_factory):
    return tables.write_marts(models, str(tmp_path_factory.mktemp("marts")), buckets=8)


@pytest.fixture
def without_broadcast(spark):
    """What tables of many gigabytes get."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _drill_downs(marts):
    orders, items = marts["fct_orders_by_id"], marts["fct_order_items"]
    return reports.seller_drill_down(items, orders, "7"), reports.order_drill_down(orders, items, "77")


def test_drill_downs_join_without_a_shuffle(marts, models, without_broadcast):
    lazy = _drill_downs({"fct_orders_by_id": models.fct_orders, "fct_order_items": models.fct_order_items})
    for df, expected in zip(_drill_downs(marts), lazy):
        text = plan(df, "simple")
        below = text[text.index("SortMergeJoin") :]
        assert "Exchange" not in below and "Bucketed: true" in below
        assert text.count("Exchange") == 1  # of the final sort
        assert rows(df) == rows(expected) and df.count() > 0


def test_a_search_for_one_order_reads_one_bucket(marts, without_broadcast):
    text = plan(_drill_downs(marts)[1], "simple")
    assert re.findall(r"SelectedBucketsCount: (\d+) out of (\d+)", text) == [("1", "8")] * 2


def test_buckets_are_found_by_another_reader(spark, marts, tmp_path):
    df = spark.range(1000).selectExpr("cast(id % 97 as string) as k", "id", "timestamp_ntz'2018-01-02 03:04:05' t")
    path = str(tmp_path / "t")
    stored = bucketed.write_bucketed(df, path, "k", 4)
    assert rows(stored) == rows(df)
    spark.sql(f"DROP TABLE {bucketed._table(path, 'k', 4)}")
    again = bucketed.read_bucketed(spark, path, "k", 4)
    assert rows(again) == rows(df)
    text = plan(again.groupBy("k").count(), "simple")
    assert "Exchange" not in text and "out of 4" in text
    bucketed.write_bucketed(df.limit(10), path, "k", 4)
    assert bucketed.read_bucketed(spark, path, "k", 4).count() == 10


def test_a_hot_key_is_written_by_several_tasks(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        df = spark.range(0, 200_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) k", "uuid() v")
        path = tmp_path / "t"
        stored = bucketed.write_bucketed(df, str(path), "k", 4)
        assert stored.count() == 200_000
        assert len(list(path.glob("*.parquet"))) > 8
    finally:
        spark.conf.set(name, before)


def test_aggregates_shuffle_neither_items_nor_orders(spark, models, tmp_path, monkeypatch, without_broadcast):
    read = []

    def watched(pairs, facts, *others):
        read.append((pairs, facts))
        return performance(pairs, facts, *others)

    performance = tables.sellers.mart_seller_performance
    monkeypatch.setattr(tables.sellers, "mart_seller_performance", watched)
    stored = tables.write_marts(models, str(tmp_path), buckets=8)
    ((pairs, facts),) = read
    for df in (tables.sellers.seller_months(pairs, facts), tables.sellers.seller_freight(pairs, facts)):
        text = plan(df, "simple")
        assert "Exchange" not in text[text.index("SortMergeJoin") :] and text.count("Bucketed: true") == 2
        assert text.count("Exchange") == 1  # of sellers and months
    for name in ("mart_seller_performance", "mart_seller_freight", "mart_logistics_performance_score"):
        assert rows(stored[name]) == rows(models[name]), name
