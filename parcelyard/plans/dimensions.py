"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.operators.pick import most_frequent


def dim_customer(customers: DataFrame) -> DataFrame:
    """The address each person uses most; ties go to the lowest customer id (DIM1)."""
    return most_frequent(
        customers,
        ["customer_unique_id"],
        ["customer_zip_code_prefix", "customer_city", "customer_state"],
        tiebreak=F.min("customer_id"),
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    """Calendar from ``first_day`` to ``last_day`` of the one-row ``bounds`` (DIM2)."""
    day = F.col("date_day")
    weekday = F.weekday(day) + 1
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_day"))
    return days.select(
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.when(weekday >= 6, 1).otherwise(0).alias("is_weekend"),
    )


def dim_location(geolocation: DataFrame) -> DataFrame:
    """Postal prefixes, as staged (DIM3)."""
    return geolocation.select("zip_code_prefix", "city", "state", "lat", "lng")


def dim_product(products: DataFrame) -> DataFrame:
    """Products, as staged: nulls and zeros kept (DIM4)."""
    return products.select(
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


def dim_seller(sellers: DataFrame) -> DataFrame:
    """Sellers, as staged (DIM5)."""
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
