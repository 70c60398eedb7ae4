"""Every table by name, each built when first asked for."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from parcelyard.plans import dimensions, orders, quality, score, sellers
from parcelyard.plans.staging import stage
from parcelyard.sources.calendar import fixed_range

STAGING = (
    "stg_customers",
    "stg_geolocation",
    "stg_order_items",
    "stg_order_payments",
    "stg_order_reviews",
    "stg_orders",
    "stg_product_category_translation",
    "stg_products",
    "stg_sellers",
)
INTERMEDIATE = (
    "int_order_delivery_metrics",
    "int_order_freight_metrics",
    "int_customer_experience_metrics",
    "int_seller_performance_metrics",
    "int_seller_freight_metrics",
    "int_data_quality_flags",
)
MARTS = (
    "dim_customer",
    "dim_date",
    "dim_location",
    "dim_product",
    "dim_seller",
    "fct_order_items",
    "fct_orders",
    "mart_data_quality",
    "mart_logistics_performance_score",
    "mart_seller_freight",
    "mart_seller_performance",
)


class Models:
    """Lazy tables over a set of staging tables.

    ``models["fct_orders"]`` is a DataFrame; nothing runs until an action does.
    ``calendar`` gives a one-row range of days for ``dim_date``.
    """

    def __init__(
        self, staging: Mapping[str, DataFrame], calendar: Callable[[], DataFrame] | None = None
    ):
        self._staging = staging
        self._calendar = calendar

    @classmethod
    def from_raw(
        cls,
        raw: Mapping[str, DataFrame],
        calendar: Callable[[], DataFrame] | None = None,
        ascii_only: bool = False,
    ) -> Models:
        return cls(stage(raw, ascii_only), calendar)

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._staging:
            return self._staging[name]
        if name in INTERMEDIATE or name in MARTS:
            return getattr(self, name)
        raise KeyError(name)

    def settle(self, name: str, table: DataFrame) -> None:
        """From now on ``table`` is what ``name`` gives and what other tables are derived from."""
        if name not in INTERMEDIATE + MARTS:
            raise KeyError(name)
        setattr(self, name, table)

    @property
    def calendar(self) -> Callable[[], DataFrame] | None:
        return self._calendar

    @property
    def spark(self) -> SparkSession:
        return self["stg_orders"].sparkSession

    @cached_property
    def order_sellers(self) -> DataFrame:
        return orders.order_sellers(self["stg_order_items"])

    @cached_property
    def int_order_delivery_metrics(self) -> DataFrame:
        return orders.order_delivery(self["stg_orders"])

    @cached_property
    def int_order_freight_metrics(self) -> DataFrame:
        return orders.order_freight(self["stg_order_items"])

    @cached_property
    def int_customer_experience_metrics(self) -> DataFrame:
        return orders.order_experience(
            self.int_order_delivery_metrics, self["stg_order_reviews"]
        )

    @cached_property
    def int_seller_performance_metrics(self) -> DataFrame:
        return sellers.seller_performance(
            self.order_sellers, self.int_customer_experience_metrics
        )

    @cached_property
    def int_seller_freight_metrics(self) -> DataFrame:
        return sellers.seller_freight(self.order_sellers, self.int_order_delivery_metrics)

    @cached_property
    def int_data_quality_flags(self) -> DataFrame:
        return quality.data_quality_flags(self.int_customer_experience_metrics)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dimensions.dim_customer(self["stg_customers"])

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(
            self._calendar() if self._calendar else fixed_range(self.spark)
        )

    @cached_property
    def dim_location(self) -> DataFrame:
        return dimensions.dim_location(self["stg_geolocation"])

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.dim_product(self["stg_products"])

    @cached_property
    def dim_seller(self) -> DataFrame:
        return dimensions.dim_seller(self["stg_sellers"])

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return orders.fct_order_items(self["stg_order_items"])

    @cached_property
    def fct_orders(self) -> DataFrame:
        return orders.fct_orders(
            self["stg_orders"],
            self.int_order_freight_metrics,
            self["stg_order_reviews"],
            self["stg_customers"],
            self.dim_customer,
        )

    @cached_property
    def mart_data_quality(self) -> DataFrame:
        return quality.mart_data_quality(self.int_data_quality_flags)

    @cached_property
    def mart_logistics_performance_score(self) -> DataFrame:
        return score.logistics_score(
            orders.order_facts(
                self["stg_orders"],
                orders.order_freight_and_sellers(self.order_sellers),
                self["stg_order_reviews"],
            )
        )

    @cached_property
    def mart_seller_freight(self) -> DataFrame:
        return sellers.mart_seller_freight(self.int_seller_freight_metrics, self.dim_seller)

    @cached_property
    def mart_seller_performance(self) -> DataFrame:
        return sellers.mart_seller_performance(
            self.order_sellers, self.int_customer_experience_metrics, self.dim_seller
        )
