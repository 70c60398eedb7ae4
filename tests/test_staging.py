import random

import pytest

from parcelyard.plans import staging
from parcelyard.plans.models import STAGING
from parcelyard.sources.demo import raw_tables, staged_tables
from tests.helpers import by, raw_table, review, rows


def test_latest_review_ties(spark):
    day, later = "2018-01-05 00:00:00", "2018-01-06 00:00:00"
    raw = raw_table(
        spark,
        "order_reviews",
        [
            review("newest", "a", created=day),
            review("newest", "b", created=later),
            review("answer", "a", created=day, answered=day),
            review("answer", "b", created=day, answered=later),
            review("answer", "c", created=day),
            review("id", "z", created=day, answered=day),
            review("id", "m", created=day, answered=day),
            review("null", "a"),
            review("null", "b", created=day),
            review("noid", None, created=day),
            review("noid", "b", created=day),
        ],
    )
    latest = by(staging.stg_order_reviews(raw), "order_id")
    assert {k: r.review_id for k, r in latest.items()} == {
        "newest": "b",
        "answer": "b",
        "id": "m",
        "null": "b",
        "noid": "b",
    }


def test_latest_review_against_brute_force(spark):
    rng = random.Random(7)
    reviews = [
        review(
            f"o{rng.randrange(40) if rng.random() > 0.33 else 0}",
            f"r{i:04d}",
            score=str(1 + i % 5),
            created=rng.choice([None, "2018-01-01 00:00:00", "2018-01-02 00:00:00"]),
            answered=rng.choice([None, "2018-01-03 00:00:00", "2018-01-04 00:00:00"]),
        )
        for i in range(600)
    ]
    expected = {}
    for r in sorted(reviews, key=lambda r: r["review_id"]):
        best = expected.get(r["order_id"])
        rank = (r["review_creation_date"] or "", r["review_answer_timestamp"] or "")
        if best is None or rank > best[0]:
            expected[r["order_id"]] = (rank, r["review_id"])
    df = staging.stg_order_reviews(raw_table(spark, "order_reviews", reviews).repartition(7))
    got = {r.order_id: r.review_id for r in df.collect()}
    assert got == {k: v[1] for k, v in expected.items()}


def _point(prefix, city, state="sp", lat="1.0", lng="2.0"):
    return {
        "geolocation_zip_code_prefix": prefix,
        "geolocation_city": city,
        "geolocation_state": state,
        "geolocation_lat": lat,
        "geolocation_lng": lng,
    }


def test_geolocation(spark):
    raw = raw_table(
        spark,
        "geolocation",
        [
            _point("01000", "Beta", lat="1.0"),
            _point("01000", " beta ", lat="2.0"),
            _point("01000", "alpha", lat="6.0"),
            _point("02000", "beta"),
            _point("02000", "alpha", state="rj"),
            _point("02000", "alpha", state="ba"),
            _point("03000", None, lat="x", lng=None),
            _point("03000", "gamma", lat="x", lng="4.0"),
            _point(" ", "nowhere"),
            _point(None, "nowhere"),
        ],
    )
    places = by(staging.stg_geolocation(raw), "zip_code_prefix")
    assert set(places) == {"01000", "02000", "03000"}
    assert (places["01000"].city, places["01000"].lat) == ("beta", 3.0)
    assert (places["02000"].city, places["02000"].state) == ("alpha", "ba")
    assert places["03000"].city == "gamma"
    assert (places["03000"].lat, places["03000"].lng) == (None, 4.0)


def test_products_keep_unknown_categories(spark):
    products = raw_table(
        spark,
        "products",
        [
            {"product_id": "p1", "product_category_name": "moveis", "product_weight_g": "0"},
            {"product_id": "p2", "product_category_name": "novo", "product_photos_qty": " 3 "},
            {"product_id": "p3", "product_category_name": None, "product_name_lenght": "1.5"},
        ],
    )
    translation = raw_table(
        spark,
        "product_category_name_translation",
        [
            {"product_category_name": "moveis", "product_category_name_english": "furniture"},
            {"product_category_name": None, "product_category_name_english": "nothing"},
        ],
    )
    got = by(staging.stg_products(products, translation), "product_id")
    assert [got[p].product_category_name_english for p in ("p1", "p2", "p3")] == [
        "furniture",
        None,
        None,
    ]
    assert got["p1"].product_weight_g == 0.0
    assert got["p2"].product_photos_qty == 3
    assert got["p3"].product_name_lenght is None


@pytest.mark.parametrize("table", STAGING)
def test_strings_and_typed_tables_agree(spark, small_dir, table):
    parsed = staging.stage(raw_tables(spark, small_dir))[table]
    typed = staged_tables(spark, small_dir)[table]
    assert parsed.dtypes == typed.dtypes
    assert rows(parsed) == rows(typed)
