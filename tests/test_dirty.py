"""The staging queries see dirty strings, and notice when a part of the cleaning is gone."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parcelyard.functions import casts
from parcelyard.plans import staging
from queryset.catalog import QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from compare import duck, duck_rows, spark_rows  # noqa: E402

MUTATIONS = [
    ("stg1_customers", "clean_text", lambda c, a=False: F.lower(c)),
    ("stg9_sellers", "clean_text", lambda c, a=False: F.trim(c)),
    ("stg6_orders", "clean_text", lambda c, a=False: c),
    ("stg3_order_items", "to_uint8", lambda c: F.trim(c).try_cast("smallint")),
    ("stg4_order_payments", "to_double", lambda c: c.try_cast("double")),
    ("stg6_orders", "to_second", lambda c: F.trim(c).try_cast("timestamp_ntz")),
    ("stg5_order_reviews", "to_second", lambda c: F.substring(c, 1, 10).try_cast("timestamp_ntz")),
    ("stg8_products", "to_uint32", lambda c: c.try_cast("bigint")),
    ("stg2_geolocation", "to_double", lambda c: F.trim(c).try_cast("double")),
]


@pytest.mark.parametrize(("query", "function", "weaker"), MUTATIONS)
def test_weaker_cleaning_is_noticed(spark, small_dir, monkeypatch, query, function, weaker):
    monkeypatch.setattr(staging, function, weaker)
    got = spark_rows(QUERIES[query].run(spark, small_dir))
    assert got != duck_rows(duck(small_dir), QUERIES[query].oracle())


def test_blank_prefixes_are_noticed(spark, small_dir, monkeypatch):
    whole = staging.parse_geolocation

    def unfiltered(raw, ascii_only=False):
        filled = raw.withColumn(
            "geolocation_zip_code_prefix",
            F.when(F.trim("geolocation_zip_code_prefix") == "", "blank").otherwise(
                F.col("geolocation_zip_code_prefix")
            ),
        )
        return whole(filled, ascii_only)

    monkeypatch.setattr(staging, "parse_geolocation", unfiltered)
    query = QUERIES["stg2_geolocation"]
    assert spark_rows(query.run(spark, small_dir)) != duck_rows(duck(small_dir), query.oracle())


def test_ascii_only_keeps_accented_capitals(spark):
    df = spark.createDataFrame([(" SÃO É",)], "c string")
    assert df.select(casts.clean_text(F.col("c"), ascii_only=True)).first()[0] == "sÃo É"
