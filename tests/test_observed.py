"""Checks of single rows are counted by the job that writes their table."""

import pytest
from pyspark.sql import functions as F

from parcelyard import Models
from parcelyard.operators import constraints as C
from parcelyard.operators.observed import CountedRows
from parcelyard.plans import checks
from parcelyard.sources import raw, tables
from parcelyard.sources.demo import raw_tables
from tests.helpers import rows


def test_counts_of_a_write(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", None), (None, None)], "k string, v int")
    counted = CountedRows()
    watched = counted.watch("t", df.repartition(3), {"no k": F.col("k").isNull(), "big": F.col("v") > 1})
    watched.write.parquet(str(tmp_path / "t"))
    assert "t" in counted and "u" not in counted
    assert counted.rows("t") == 4 and counted.matching("t") == {"no k": 2, "big": 1}
    for name, none in (("u", df.limit(0)), ("v", df.filter("k = 'x'").repartition("k"))):
        counted.watch(name, none, {"no k": F.col("k").isNull()}).write.parquet(str(tmp_path / name))
        assert (counted.rows(name), counted.matching(name)) == (0, {"no k": 0})


def test_rows_that_are_written_partitioned_count_once(spark, tmp_path):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("order_id"),
        F.expr("timestamp_ntz'2018-01-05 00:00:00' + make_interval(0, cast(id % 3 as int))").alias(
            "order_purchase_timestamp"
        ),
    )
    counted = CountedRows()
    stored = tables.write_orders(df, str(tmp_path / "orders"), counted)
    assert counted.rows("fct_orders") == stored.count() == 1000
    assert counted.matching("fct_orders") == {("not_null", "fct_orders.order_id"): 0}


def test_a_checked_build_scans_nothing_for_checks_of_rows(spark, small_dir, tmp_path, monkeypatch):
    counted = CountedRows()
    source = raw_tables(spark, small_dir)
    imported = raw.import_raw(source, str(tmp_path / "raw"), counted)
    models = Models.from_raw(imported)
    seen = {}
    run_checks = checks.run_checks
    monkeypatch.setattr(checks, "run_checks", lambda t, c: seen.update(tables=t) or run_checks(t, c))
    with monkeypatch.context() as patched:
        patched.setattr(C, "count_by_condition", lambda *_: pytest.fail("a table was scanned"))
        for name in checks.ROW_CHECKS:
            stub = checks.Check(lambda t: pytest.fail("a table was scanned"), checks.SINGULAR[name].level)
            patched.setitem(checks.SINGULAR, name, stub)
        with pytest.raises(tables.ChecksFailed) as refused:  # item numbers repeat here
            tables.build_and_check(models, imported, str(tmp_path / "shop"), counted)
    every = run_checks(seen["tables"])
    assert rows(refused.value.findings) == rows(every)
    assert len(checks.counted_findings(counted)) == 91
