"""Clustered tables hold the same rows, and a filter on any clustered column skips most files."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parcelyard.plans import reports
from parcelyard.sources import clustered, tables
from tests.helpers import plan, rows


def _met(path, **wanted):
    """Row groups whose least and greatest values admit all ``wanted`` ones, and all row groups."""
    met = total = 0
    for file in Path(path).glob("*.parquet"):
        meta = pq.read_metadata(file)
        names = {meta.schema.column(n).name: n for n in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            total += 1
            stats = {c: meta.row_group(g).column(names[c]).statistics for c in wanted}
            met += all(
                s is not None and s.has_min_max and s.min <= wanted[c] <= s.max for c, s in stats.items()
            )
    return met, total


def _facts(spark, n=60_000):
    """Orders of 40 states, 8 cities each and 48 months; a third in one place and month."""
    hot = F.col("id") % 3 == 0
    h = lambda name, n: F.pmod(F.xxhash64(F.lit(name), "id"), F.lit(n))
    state = F.when(hot, 7).otherwise(h("s", 40))
    return spark.range(0, n, 1, 6).select(
        F.col("id").cast("string").alias("order_id"),
        F.format_string("state %02d", state).alias("customer_state"),
        F.format_string("city %03d", state * 8 + F.when(hot, 1).otherwise(h("c", 8))).alias("customer_city"),
        F.add_months(F.lit(dt.date(2015, 1, 1)), F.when(hot, 5).otherwise(h("m", 48)).cast("int")).alias("order_month"),
        F.col("id").alias("v"),
    )


PLACE = ("customer_state", "customer_city", "order_month")


def test_filters_on_each_column_skip_most_row_groups(spark, tmp_path):
    df = _facts(spark)
    df.write.parquet(str(tmp_path / "plain"))
    path = str(tmp_path / "clustered")
    stored = clustered.write_clustered(spark.read.parquet(str(tmp_path / "plain")), path, PLACE, files=64)
    assert rows(stored) == rows(df)
    for wanted in (
        {"customer_state": "state 21"},
        {"customer_city": "city 100"},
        {"customer_state": "state 21", "customer_city": "city 170"},
        {"order_month": dt.date(2017, 3, 1)},
        {"customer_state": "state 30", "order_month": dt.date(2016, 1, 1)},
    ):
        plain = _met(tmp_path / "plain", **wanted)
        assert plain[0] == plain[1]
        met, total = _met(path, **wanted)
        least = 3 if list(wanted) == ["order_month"] else 5
        assert 0 < met * least <= total, (wanted, met, total)
        found = stored
        for name, value in wanted.items():
            found = found.filter(F.col(name) == F.lit(value))
        text = plan(found, "formatted")
        assert "PushedFilters: [IsNotNull" in text and "EqualTo" in text
        expected = df
        for name, value in wanted.items():
            expected = expected.filter(F.col(name) == F.lit(value))
        assert rows(found) == rows(expected)


def test_a_hot_cell_is_written_by_many_tasks(spark, tmp_path):
    clustered.write_clustered(_facts(spark), str(tmp_path / "t"), PLACE, files=32)
    sizes = [pq.read_metadata(f).num_rows for f in (tmp_path / "t").glob("*.parquet")]
    assert sum(sizes) == 60_000 and len(sizes) == 32 and max(sizes) < 3 * 60_000 / 32


def test_borders_do_not_depend_on_partitions(spark):
    df = _facts(spark, 20_000)
    assert clustered.borders(df, PLACE) == clustered.borders(df.repartition(13), PLACE)


def test_nulls_empty_tables_ties_and_clashing_names(spark, tmp_path):
    kind = "a string, b timestamp_ntz, c double, _cell int, _part int, _drawn int"
    when = dt.datetime(2018, 1, 2, 3, 4, 5)
    some = [("x", when, 1.5, 1, 2, 3)] * 50 + [(None, None, None, None, None, None)] * 20
    some += [("é" * 500, when, float("nan"), 0, 0, 0), ("", None, -0.0, 1, 1, 1)]
    for n, values in enumerate((some, [], [(None,) * 6])):
        df = spark.createDataFrame(values, kind)
        stored = clustered.write_clustered(df, str(tmp_path / str(n)), ("a", "b", "c"), files=4)
        assert stored.schema == df.schema and stored.count() == len(values)
        key = lambda r: str(tuple(r))
        assert sorted(map(key, stored.collect())) == sorted(map(key, df.collect()))


@pytest.fixture(scope="module")
def marts(spark, models, tmp_path_factory):
    return tables.write_marts(models, str(tmp_path_factory.mktemp("marts")), buckets=8)


def test_copies_answer_reports_like_the_marts(spark, marts, tmp_path):
    copies = clustered.write_clustered_marts(marts, str(tmp_path), files=16)
    again = clustered.read_clustered_marts(spark, str(tmp_path))
    for name, (mart, _) in clustered.CLUSTERED.items():
        assert rows(copies[name]) == rows(marts[mart]) == rows(again[name])
    place, seller = again["fct_orders_by_place"], again["mart_seller_freight_by_seller"]
    for state in ("asia", "nowhere"):
        want = reports.location_drill_down(marts["fct_orders"], state=state)
        assert rows(reports.location_drill_down(place, state=state)) == rows(want)
    want = reports.freight_by_seller(marts["mart_seller_freight"], seller_id=["3", "7"])
    assert rows(reports.freight_by_seller(seller, seller_id=["3", "7"])) == rows(want)
