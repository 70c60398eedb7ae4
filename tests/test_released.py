"""Shuffle files go when their job ends, so the disk holds those of one job."""

import time

from pyspark.sql import functions as F

from parcelyard.operators.observed import CountedRows
from parcelyard.plans import checks
from parcelyard.released import CLEANUP, released
from parcelyard.sources.demo import staged_tables
from queryset import catalog


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(w for w in found.mkString(" ").split() if "/shuffle_" in w)


def shuffles_left(spark, run, seconds=10):
    """Shuffle files that ``run`` leaves behind; they are deleted in the background."""
    before, _ = _shuffle_files(spark), run()
    until = time.time() + seconds
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_jobs_in_the_block_leave_no_shuffle_files(spark, tmp_path):
    df, before = spark.range(1000), spark.conf.get(CLEANUP)

    def run():
        with released(spark):
            counts = df.groupBy((F.col("id") % 7).alias("k")).count()
            counts.repartition(3, "count").write.parquet(str(tmp_path / "t"))
            assert counts.count() == counts.count() == 7

    assert not shuffles_left(spark, run)
    assert spark.conf.get(CLEANUP) == before
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7


def test_checks_of_a_build_leave_no_shuffle_files(spark, small_dir, monkeypatch):
    staged = staged_tables(spark, small_dir)
    monkeypatch.setattr(checks, "GENERIC", {"unique": checks.unique_counts})
    monkeypatch.setattr(checks, "UNIQUE", {"stg_orders": "customer_id", "stg_customers": "customer_id"})
    monkeypatch.setattr(checks, "_SHUFFLED", {"unique": checks.UNIQUE})
    monkeypatch.setattr(checks, "SINGULAR", {})
    found = []
    assert not shuffles_left(spark, lambda: found.extend(checks.run_checks(staged, CountedRows()).collect()))
    repeated = staged["stg_orders"].groupBy("customer_id").count().filter("count > 1").count()
    assert [tuple(r) for r in found] == [
        ("unique", "stg_orders.customer_id", "error", repeated), ("unique", "stg_customers.customer_id", "error", 0)
    ]


def test_views_are_counted_one_after_the_other(spark, small_dir, monkeypatch):
    for kind, names in {"STAGING": ("stg_orders",), "INTERMEDIATE": ("int_order_freight_metrics",), "MARTS": ()}.items():
        monkeypatch.setattr(catalog, kind, names)
    found = []
    run = lambda: found.extend(catalog.QUERIES["snk1_all_views"].run(spark, small_dir).collect())
    assert not shuffles_left(spark, run)
    orders = staged_tables(spark, small_dir)["stg_order_items"].select("order_id").distinct().count()
    assert [tuple(r) for r in found] == [("stg_orders", 1500, 1500), ("int_order_freight_metrics", orders, orders)]
