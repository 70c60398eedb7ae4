import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelyard import Models
from parcelyard.plans.dimensions import dim_date
from parcelyard.plans.models import INTERMEDIATE, MARTS, STAGING
from parcelyard.sources import raw, tables
from parcelyard.sources.calendar import fixed_range, observed_range
from parcelyard.sources.demo import raw_tables
from parcelyard.streaming.intake import load_new_files
from tests.helpers import rows

REVIEW_HEADER = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
)


def test_csv_text_with_breaks_quotes_and_blanks(spark, tmp_path):
    path = tmp_path / "order_reviews.csv"
    path.write_text(
        REVIEW_HEADER
        + 'r1,o1,5,,"line one\nline ""two"", end",2018-01-01 00:00:00,\n'
        + 'r2,o2,4,"",plain,2018-01-02 00:00:00,2018-01-03 10:11:12\n',
        encoding="utf-8",
    )
    got = {r.review_id: r for r in raw.read_raw_table(spark, str(path), "order_reviews").collect()}
    assert set(got) == {"r1", "r2"}
    assert got["r1"].review_comment_message == 'line one\nline "two", end'
    assert got["r1"].review_comment_title is None
    assert got["r1"].review_answer_timestamp is None


def test_csv_byte_order_mark_is_not_part_of_the_header(spark, tmp_path):
    path = tmp_path / "product_category_name_translation.csv"
    path.write_bytes(
        b"\xef\xbb\xbfproduct_category_name,product_category_name_english\r\nmoveis,furniture\r\n"
    )
    df = raw.read_raw_table(spark, str(path), "product_category_name_translation")
    assert [tuple(r) for r in df.collect()] == [("moveis", "furniture")]


def test_csv_with_another_header_fails(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,zip,seller_city,seller_state\ns1,1,rio,RJ\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        raw.read_raw_table(spark, str(path), "sellers").collect()


def test_read_raw_finds_files_and_keeps_strings(spark, small_dir, tmp_path):
    source = raw_tables(spark, small_dir)
    raw.write_raw_csv(source, str(tmp_path / "csv"))
    raw.write_raw_csv({"sellers": source["sellers"]}, str(tmp_path / "csv"))
    loaded = raw.read_raw(spark, str(tmp_path / "csv"))
    assert {t: rows(df) for t, df in loaded.items()} == {t: rows(source[t]) for t in loaded}
    counts = {r.table_name: r.row_count for r in raw.raw_counts(loaded).collect()}
    assert counts["orders"] == 1500 and len(counts) == 9

    imported = raw.import_raw(loaded, str(tmp_path / "parquet"))
    assert rows(imported["orders"]) == rows(source["orders"])
    models = Models.from_raw(imported)
    assert models.fct_orders.count() == 1500


def test_repeated_load_adds_only_new_files(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()

    def drop(name, *ids):
        lines = "".join(f"{i},1,rio,RJ\n" for i in ids)
        (inbox / name).write_text(
            "seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + lines
        )

    def load(max_files=None):
        df = load_new_files(
            spark, str(inbox), "sellers", str(tmp_path / "t"), str(tmp_path / "c"), max_files
        )
        return sorted(r.seller_id for r in df.collect())

    drop("a.csv", "s1", "s2")
    assert load() == ["s1", "s2"]
    assert load() == ["s1", "s2"]
    drop("b.csv", "s3")
    drop("c.csv", "s4")
    assert load(max_files=1) == ["s1", "s2", "s3", "s4"]


def test_default_calendar(spark):
    days = {r.date_day: r for r in dim_date(fixed_range(spark)).collect()}
    assert len(days) == 984
    assert (min(days), max(days)) == (dt.date(2016, 6, 4), dt.date(2019, 2, 12))
    for day, row in days.items():
        assert (row.year, row.month, row.day_of_week) == (day.year, day.month, day.isoweekday())
        assert row.quarter == (day.month + 2) // 3
        assert row.week_of_year == day.isocalendar().week
        assert row.month_name == day.strftime("%B")
        assert row.is_weekend == int(day.isoweekday() >= 6)


def test_observed_calendar(spark):
    df = spark.sql(
        "select timestamp_ntz'2018-01-30 23:59:59' as a, cast(null as timestamp_ntz) as b "
        "union all select timestamp_ntz'2018-02-02 00:00:00', timestamp_ntz'2018-01-29 10:00:00'"
    )
    assert [r.date_day.day for r in dim_date(observed_range(df, "a", "b")).collect()] == [
        29, 30, 31, 1, 2,
    ]
    assert dim_date(observed_range(df, "a")).count() == 4


def test_stored_marts_equal_lazy_marts(spark, models, tmp_path):
    stored = tables.write_marts(models, str(tmp_path))
    again = tables.read_marts(spark, str(tmp_path))
    assert set(stored) == set(again) == {*MARTS, "fct_orders_by_id", "mart_order_summary"}
    assert rows(again["fct_orders_by_id"]) == rows(models["fct_orders"])
    for name in MARTS:
        lazy = models[name]
        assert rows(again[name].select(*lazy.columns)) == rows(lazy), name
    assert again["fct_orders"].columns == [*models["fct_orders"].columns, "order_month"]
    again = tables.write_marts(models, str(tmp_path))
    assert again["fct_orders"].count() == models["fct_orders"].count()


def test_orders_without_a_month_are_stored_too(spark, tmp_path):
    df = spark.sql(
        "select 'a' as order_id, cast(null as timestamp_ntz) as order_purchase_timestamp "
        "union all select 'b', timestamp_ntz'2018-02-03 04:05:06'"
    )
    stored = tables.write_orders(df, str(tmp_path / "orders"))
    assert {r.order_id: r.order_month for r in stored.collect()} == {
        "a": None,
        "b": dt.date(2018, 2, 1),
    }


def test_views_answer_sql(spark, models):
    tables.register_views(models)
    names = {t.name for t in spark.catalog.listTables()}
    assert names >= {*STAGING, *INTERMEDIATE, *MARTS}
    total = spark.sql("select sum(order_count) n from mart_logistics_performance_score").first().n
    assert total == models.fct_orders.count()


def test_scratch_folder_comes_from_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = tables.scratch_path(spark), tables.scratch_path(spark)
    assert one != two and one.startswith(shared)


def test_unknown_table(models):
    with pytest.raises(KeyError):
        models["nope"]
    assert models["fct_orders"].filter(F.lit(False)).count() == 0


def test_build_publishes_only_what_passes_its_checks(spark, small_dir, tmp_path):
    from parcelyard.lazy import LazyTables
    from parcelyard.plans.checks import SINGULAR
    from parcelyard.sources.demo import staged_tables

    staged, source = staged_tables(spark, small_dir), raw_tables(spark, small_dir)
    folder = str(tmp_path / "shop")
    days = lambda: observed_range(staged["stg_orders"], *[c for c in staged["stg_orders"].columns if c.endswith(("timestamp", "_at", "_date"))])
    with pytest.raises(tables.ChecksFailed, match="unique_combination fct_order_items"):
        tables.build_and_check(Models(staged, days), source, folder)
    assert not (tmp_path / "shop" / "versions").exists()

    keys = ["order_id", "order_item_id"]
    items = staged["stg_order_items"].dropDuplicates(keys)
    fixed = LazyTables({t: lambda t=t: items if t == "stg_order_items" else staged[t] for t in staged})
    raw_items = source["order_items"].dropDuplicates(keys)
    fixed_raw = LazyTables({t: lambda t=t: raw_items if t == "order_items" else source[t] for t in source})
    found = tables.build_and_check(Models(fixed, days), fixed_raw, folder).collect()
    assert {r.check for r in found if r.violations} == {"impossible_dates"}
    assert len({r.check for r in found}) == 7 + len(SINGULAR)
    published = tables.read_published(spark, folder)
    assert set(published) == {*MARTS, "fct_orders_by_id", "mart_order_summary"} and published["fct_orders"].count() == 1500


def test_a_build_agrees_with_itself_where_its_source_changes(spark, small_dir, tmp_path):
    from parcelyard.lazy import LazyTables
    from parcelyard.sources.demo import staged_tables

    class Changing(LazyTables):
        """Items that cost more each time they are read."""

        def __getitem__(self, name):
            self.reads = getattr(self, "reads", 0) + 1
            df = super().__getitem__(name)
            return df.withColumn("price", F.col("price") + self.reads) if name == "stg_order_items" else df

    plain, source = staged_tables(spark, small_dir), raw_tables(spark, small_dir)
    keys = ["order_id", "order_item_id"]
    once = {"stg_order_items": plain["stg_order_items"].dropDuplicates(keys)}
    staged = Changing({t: lambda t=t: once.get(t, plain[t]) for t in plain})
    raw_items = source["order_items"].dropDuplicates(keys)
    fixed_raw = LazyTables({t: lambda t=t: raw_items if t == "order_items" else source[t] for t in source})
    days = lambda: observed_range(plain["stg_orders"], *[c for c in plain["stg_orders"].columns if c.endswith(("timestamp", "_at", "_date"))])
    found = tables.build_and_check(Models(staged, days), fixed_raw, str(tmp_path / "shop")).collect()
    assert {r.check for r in found if r.violations} <= {"impossible_dates"}
