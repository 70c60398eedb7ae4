"""Raw strings to typed staging tables.

The ``parse_*`` functions work row by row. Three tables need a second step on
the whole table: the latest review, one place per postal prefix, and the
translated product category.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.functions.casts import clean_text, to_double, to_second, to_uint8, to_uint32
from parcelyard.lazy import LazyTables
from parcelyard.operators.pick import first_per_key


def stg_customers(raw: DataFrame, ascii_only: bool = False) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        clean_text(F.col("customer_city"), ascii_only).alias("customer_city"),
        clean_text(F.col("customer_state"), ascii_only).alias("customer_state"),
    )


def stg_sellers(raw: DataFrame, ascii_only: bool = False) -> DataFrame:
    return raw.select(
        "seller_id",
        "seller_zip_code_prefix",
        clean_text(F.col("seller_city"), ascii_only).alias("seller_city"),
        clean_text(F.col("seller_state"), ascii_only).alias("seller_state"),
    )


def stg_orders(raw: DataFrame, ascii_only: bool = False) -> DataFrame:
    times = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    return raw.select(
        "order_id",
        "customer_id",
        clean_text(F.col("order_status"), ascii_only).alias("order_status"),
        *[to_second(F.col(c)).alias(c) for c in times],
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        to_uint8(F.col("order_item_id")).alias("order_item_id"),
        "product_id",
        "seller_id",
        to_second(F.col("shipping_limit_date")).alias("shipping_limit_date"),
        to_double(F.col("price")).alias("price"),
        to_double(F.col("freight_value")).alias("freight_value"),
    )


def stg_order_payments(raw: DataFrame, ascii_only: bool = False) -> DataFrame:
    return raw.select(
        "order_id",
        to_uint8(F.col("payment_sequential")).alias("payment_sequential"),
        clean_text(F.col("payment_type"), ascii_only).alias("payment_type"),
        to_uint8(F.col("payment_installments")).alias("payment_installments"),
        to_double(F.col("payment_value")).alias("payment_value"),
    )


def parse_reviews(raw: DataFrame, ascii_only: bool = False) -> DataFrame:
    return raw.select(
        "order_id",
        "review_id",
        to_uint8(F.col("review_score")).alias("review_score"),
        clean_text(F.col("review_comment_title"), ascii_only).alias("review_comment_title"),
        clean_text(F.col("review_comment_message"), ascii_only).alias("review_comment_message"),
        to_second(F.col("review_creation_date")).alias("review_creation_date"),
        to_second(F.col("review_answer_timestamp")).alias("review_answer_timestamp"),
    )


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """One review per order: latest created, then latest answered, then lowest id."""
    return first_per_key(
        reviews,
        ["order_id"],
        [
            F.desc_nulls_last("review_creation_date"),
            F.desc_nulls_last("review_answer_timestamp"),
            F.asc_nulls_last("review_id"),
        ],
    )


def stg_order_reviews(raw: DataFrame, ascii_only: bool = False) -> DataFrame:
    return latest_reviews(parse_reviews(raw, ascii_only))


def parse_geolocation(raw: DataFrame, ascii_only: bool = False) -> DataFrame:
    return raw.filter(F.trim("geolocation_zip_code_prefix") != "").select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        to_double(F.col("geolocation_lat")).alias("lat"),
        to_double(F.col("geolocation_lng")).alias("lng"),
        clean_text(F.col("geolocation_city"), ascii_only).alias("city"),
        clean_text(F.col("geolocation_state"), ascii_only).alias("state"),
    )


def locate_prefixes(points: DataFrame) -> DataFrame:
    """Mean coordinates and most frequent (city, state) of every prefix.

    Both come out of one scan: points are summed per (prefix, city, state), and
    those partial sums are rolled up to the prefix.
    """
    places = points.groupBy("zip_code_prefix", "city", "state").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("lat").alias("lat_sum"),
        F.count("lat").alias("lat_n"),
        F.sum("lng").alias("lng_sum"),
        F.count("lng").alias("lng_n"),
    )
    # Struct fields compare left to right with nulls first, hence the null flags.
    rank = F.struct(
        -F.col("n"), F.isnull("city"), F.col("city"), F.isnull("state"), F.col("state")
    )
    return (
        places.groupBy("zip_code_prefix")
        .agg(
            (F.sum("lat_sum") / F.nullif(F.sum("lat_n"), F.lit(0))).alias("lat"),
            (F.sum("lng_sum") / F.nullif(F.sum("lng_n"), F.lit(0))).alias("lng"),
            F.min_by(F.struct("city", "state"), rank).alias("place"),
        )
        .select("zip_code_prefix", "lat", "lng", "place.city", "place.state")
    )


def stg_geolocation(raw: DataFrame, ascii_only: bool = False) -> DataFrame:
    return locate_prefixes(parse_geolocation(raw, ascii_only))


def stg_product_category_translation(raw: DataFrame) -> DataFrame:
    return raw.select("product_category_name", "product_category_name_english")


def parse_products(raw: DataFrame) -> DataFrame:
    counts = ["product_name_lenght", "product_description_lenght", "product_photos_qty"]
    sizes = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    return raw.select(
        "product_id",
        "product_category_name",
        *[to_uint32(F.col(c)).alias(c) for c in counts],
        *[to_double(F.col(c)).alias(c) for c in sizes],
    )


def translate_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Add the English category; unknown and null categories get null."""
    joined = products.join(translation, "product_category_name", "left")
    return joined.select(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def stg_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    return translate_products(parse_products(raw), translation)


def stage(raw: Mapping[str, DataFrame], ascii_only: bool = False) -> LazyTables:
    """All staging tables from the raw tables; ``ascii_only`` leaves accented capitals alone."""

    def translation() -> DataFrame:
        return stg_product_category_translation(raw["product_category_name_translation"])

    return LazyTables(
        {
            "stg_customers": lambda: stg_customers(raw["customers"], ascii_only),
            "stg_geolocation": lambda: stg_geolocation(raw["geolocation"], ascii_only),
            "stg_order_items": lambda: stg_order_items(raw["order_items"]),
            "stg_order_payments": lambda: stg_order_payments(raw["order_payments"], ascii_only),
            "stg_order_reviews": lambda: stg_order_reviews(raw["order_reviews"], ascii_only),
            "stg_orders": lambda: stg_orders(raw["orders"], ascii_only),
            "stg_product_category_translation": translation,
            "stg_products": lambda: stg_products(raw["products"], translation()),
            "stg_sellers": lambda: stg_sellers(raw["sellers"], ascii_only),
        }
    )
