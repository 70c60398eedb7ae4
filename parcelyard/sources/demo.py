"""The benchmark tables seen as order-fulfilment tables.

They lack delivery dates, reviews and addresses, so those are derived from keys
with arithmetic that any SQL engine can repeat. Nothing here shuffles the large
tables: every order, item and review row is derived from its own source row.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.lazy import LazyTables
from parcelyard.plans.staging import latest_reviews, locate_prefixes, translate_products
from parcelyard.schema import RAW_COLUMNS


# Columns of the benchmark tables. Stating them saves Spark from
# opening a file of every table before a query starts.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def _read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[table]).parquet(f"{directory}/{table}.parquet")


def _orders(spark: SparkSession, directory: str) -> DataFrame:
    return (
        _read(spark, directory, "orders")
        .withColumnsRenamed({"o_orderkey": "k", "o_orderdate": "day"})
        .selectExpr(
            "string(k) as order_id",
            "string(o_custkey) as customer_id",
            """case when k % 40 = 0 then 'canceled' when k % 40 = 1 then 'unavailable'
                    when o_orderstatus = 'F' then 'delivered'
                    when o_orderstatus = 'O' then 'shipped'
                    else 'processing' end as order_status""",
            "day + interval '1' second * (k % 86400) as order_purchase_timestamp",
            "day + interval '1' second * (k % 86400 + 3600) as order_approved_at",
            "day + interval '1' day as order_delivered_carrier_date",
            """case when k % 50 = 7 then null
                    when k % 997 = 3 then day - interval '2' day
                    else day + interval '1' hour * (k * 7 % 31 * 24 + k % 24)
               end as order_delivered_customer_date""",
            "day + interval '20' day as order_estimated_delivery_date",
        )
    )


def _order_items(spark: SparkSession, directory: str) -> DataFrame:
    # Cents are rounded in plain float steps: every engine then treats half a cent alike.
    return _read(spark, directory, "lineitem").selectExpr(
        "string(l_orderkey) as order_id",
        "smallint(l_linenumber) as order_item_id",
        "string(l_partkey) as product_id",
        "string(l_suppkey) as seller_id",
        "l_shipdate as shipping_limit_date",
        """case when l_orderkey % 500 = 9 then 0D
                else floor(l_extendedprice * (1 - l_discount) * 100 + 0.5D) / 100
           end as price""",
        "floor(l_extendedprice * l_tax * 100 + 0.5D) / 100 as freight_value",
    )


def _order_payments(spark: SparkSession, directory: str) -> DataFrame:
    return (
        _read(spark, directory, "orders")
        .withColumn("n", F.expr("explode(sequence(1, if(o_orderkey % 5 = 0, 2, 1)))"))
        .selectExpr(
            "string(o_orderkey) as order_id",
            "smallint(n) as payment_sequential",
            "if(n = 1, lower(trim(o_orderpriority)), 'voucher') as payment_type",
            "smallint(if(n = 1, o_orderkey % 12, 1)) as payment_installments",
            "if(n = 1, o_totalprice, 0D) as payment_value",
        )
    )


def _order_reviews(spark: SparkSession, directory: str) -> DataFrame:
    reviewed = _read(spark, directory, "orders").agg(F.expr("count(*) * 3 div 5")).scalar()
    return (
        _read(spark, directory, "events")
        .withColumns(
            {
                "created": F.expr(
                    "cast(trunc(ts, if(event_id % 2 = 0, 'month', 'week')) as timestamp_ntz)"
                ),
                "key": F.pmod(F.col("event_id") * 13, reviewed),
            }
        )
        .selectExpr(
            "string(key) as order_id",
            "string(event_id) as review_id",
            "smallint(1 + event_id % 5) as review_score",
            "lower(trim(event_type)) as review_comment_title",
            "lower(trim(props)) as review_comment_message",
            "created as review_creation_date",
            """if(event_id % 4 = 0, created, cast(date(ts) as timestamp_ntz)
                  + interval '1' second * (hour(ts) * 3600 + minute(ts) * 60 + second(ts)))
               as review_answer_timestamp""",
        )
    )


def _with_place(spark: SparkSession, directory: str, table: str, key: str) -> DataFrame:
    return (
        _read(spark, directory, table)
        .withColumnRenamed(key, "n_nationkey")
        .join(_read(spark, directory, "nation"), "n_nationkey")
        .withColumnRenamed("n_regionkey", "r_regionkey")
        .join(_read(spark, directory, "region"), "r_regionkey")
        .withColumn("prefix", F.expr("lpad(string(n_nationkey), 5, '0')"))
    )


def _customers(spark: SparkSession, directory: str) -> DataFrame:
    people = _read(spark, directory, "customer").agg(F.expr("count(*) * 4 div 5")).scalar()
    return (
        _with_place(spark, directory, "customer", "c_nationkey")
        .withColumn("person", F.pmod("c_custkey", people))
        .selectExpr(
            "string(c_custkey) as customer_id",
            "string(person) as customer_unique_id",
            "prefix as customer_zip_code_prefix",
            "lower(trim(n_name)) as customer_city",
            "lower(trim(r_name)) as customer_state",
        )
    )


def _sellers(spark: SparkSession, directory: str) -> DataFrame:
    return _with_place(spark, directory, "supplier", "s_nationkey").selectExpr(
        "string(s_suppkey) as seller_id",
        "prefix as seller_zip_code_prefix",
        "lower(trim(n_name)) as seller_city",
        "lower(trim(r_name)) as seller_state",
    )


def _geolocation(spark: SparkSession, directory: str) -> DataFrame:
    return _with_place(spark, directory, "customer", "c_nationkey").selectExpr(
        "prefix as zip_code_prefix",
        "c_acctbal / 1000 as lat",
        "-c_acctbal / 2000 as lng",
        "lower(trim(c_mktsegment)) as city",
        "lower(trim(r_name)) as state",
    )


def _products(spark: SparkSession, directory: str) -> DataFrame:
    return _read(spark, directory, "part").selectExpr(
        "string(p_partkey) as product_id",
        "p_type as product_category_name",
        "bigint(length(p_name)) as product_name_lenght",
        "bigint(length(p_brand)) as product_description_lenght",
        "bigint(p_size % 6) as product_photos_qty",
        "p_retailprice as product_weight_g",
        "double(p_size) as product_length_cm",
        "p_size / 2D as product_height_cm",
        "if(p_size % 5 != 0, double(p_size), null) as product_width_cm",
    )


def _translation(spark: SparkSession, directory: str) -> DataFrame:
    types = _read(spark, directory, "part").select("p_type")
    first = types.agg(F.min("p_type")).scalar()
    return (
        types.filter(F.col("p_type") > first)
        .distinct()
        .selectExpr(
            "p_type as product_category_name",
            "'en_' || lower(p_type) as product_category_name_english",
        )
    )


def staged_tables(spark: SparkSession, directory: str) -> LazyTables:
    """Typed staging tables, without the detour through strings."""

    def translation() -> DataFrame:
        return _translation(spark, directory)

    return LazyTables(
        {
            "stg_customers": lambda: _customers(spark, directory),
            "stg_geolocation": lambda: locate_prefixes(_geolocation(spark, directory)),
            "stg_order_items": lambda: _order_items(spark, directory),
            "stg_order_payments": lambda: _order_payments(spark, directory),
            "stg_order_reviews": lambda: latest_reviews(_order_reviews(spark, directory)),
            "stg_orders": lambda: _orders(spark, directory),
            "stg_product_category_translation": translation,
            "stg_products": lambda: translate_products(
                _products(spark, directory), translation()
            ),
            "stg_sellers": lambda: _sellers(spark, directory),
        }
    )


def _as_strings(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[f"string({name}) as {name}" for name in df.columns])


def raw_tables(spark: SparkSession, directory: str) -> LazyTables:
    """All-string raw tables, as a CSV load would give them."""
    builders = {
        "customers": _customers,
        "geolocation": _geolocation,
        "order_items": _order_items,
        "order_payments": _order_payments,
        "order_reviews": _order_reviews,
        "orders": _orders,
        "products": _products,
        "sellers": _sellers,
        "product_category_name_translation": _translation,
    }

    def raw_table(name: str) -> DataFrame:
        df = builders[name](spark, directory)
        if name == "geolocation":
            df = df.toDF(*RAW_COLUMNS[name])
        return _as_strings(df.select(*RAW_COLUMNS[name]))

    return LazyTables({name: partial(raw_table, name) for name in builders})
