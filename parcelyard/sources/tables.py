"""Store the marts, read them back, and name tables for SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.functions.metrics import month_start
from parcelyard.operators.observed import CountedRows
from parcelyard.plans import checks, orders, quality, score, sellers, summary
from parcelyard.plans.models import INTERMEDIATE, MARTS, STAGING, Models
from parcelyard.released import released
from parcelyard.sources.bucketed import read_bucketed, write_bucketed

MONTH = "order_month"
#: Facts by order, in equal buckets, so that order and item drill-downs join without a shuffle.
BY_ORDER = {"fct_orders": "fct_orders_by_id", "fct_order_items": "fct_order_items"}
#: Buckets of these facts where a caller names no number; a search for one order reads one.
BUCKETS = 64


def scratch_path(spark: SparkSession) -> str:
    """A fresh folder below the session's shared checkpoint folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{shared}/parcelyard-{uuid.uuid4().hex}"


def register_views(models: Models, names: tuple[str, ...] = STAGING + INTERMEDIATE + MARTS) -> None:
    """Name lazy tables for use in SQL; nothing is computed or stored."""
    for name in names:
        models[name].createOrReplaceTempView(name)


def _bloom_filters(*columns: str) -> dict[str, str]:
    """Writer options that let a search for one id skip the row groups without it."""
    enabled = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {**enabled, "parquet.bloom.filter.adaptive.enabled": "true"}


def _watched(name: str, df: DataFrame, counted: CountedRows | None) -> DataFrame:
    """``df``, with the checks of its rows counted by the write that follows."""
    if counted is None:
        return df
    return counted.watch(name, df, checks.row_conditions(name))


def write_orders(
    fct_orders: DataFrame, path: str, counted: CountedRows | None = None
) -> DataFrame:
    """Store the order fact in one folder per purchase month and read it back.

    The rebalance gathers a month into few files yet splits a month that is far
    larger than the others, so no task has to write a hot month alone.
    """
    dated = fct_orders.withColumn(MONTH, month_start(F.col("order_purchase_timestamp")))
    dealt = _watched("fct_orders", dated.hint("rebalance", MONTH), counted)
    writer = dealt.write.mode("overwrite").partitionBy(MONTH)
    with released(fct_orders.sparkSession):
        writer.options(**_bloom_filters("order_id")).parquet(path)
    return read_orders(fct_orders.sparkSession, path)


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """The stored order fact, with its month folder as a trailing date column."""
    stored = spark.read.parquet(path)
    return stored.withColumn(MONTH, F.col(MONTH).cast("date"))


def _store(df: DataFrame, path: str, *searched: str) -> DataFrame:
    with released(df.sparkSession):
        df.write.mode("overwrite").options(**_bloom_filters(*searched)).parquet(path)
    return df.sparkSession.read.parquet(path)


def _write_summary(facts: DataFrame, path: str) -> DataFrame:
    """Store the order summary in one folder per level."""
    df = summary.order_summary(facts)
    with released(df.sparkSession):
        df.hint("rebalance", "level").write.mode("overwrite").partitionBy("level").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_marts(
    models: Models,
    directory: str,
    counted: CountedRows | None = None,
    buckets: int = BUCKETS,
) -> dict[str, DataFrame]:
    """Rebuild all marts below ``directory`` and return the stored tables.

    The item fact is bucketed by order. The order fact is stored twice: per purchase month
    for reports over time, and bucketed like the items as ``fct_orders_by_id``.

    The two facts are written first. The aggregates are then computed from the
    stored facts, so items, reviews and orders are joined once in the whole run,
    and a lost executor costs one stage, not the chain from the raw files. With
    ``counted``, the writes count what the checks ask of single rows.
    """
    stored: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, *searched: str) -> None:
        stored[name] = _store(_watched(name, df, counted), f"{directory}/{name}", *searched)

    for name in ("dim_customer", "dim_date", "dim_location", "dim_product", "dim_seller"):
        keep(name, models[name])
    stored["fct_order_items"] = write_bucketed(
        models.fct_order_items,
        f"{directory}/fct_order_items",
        "order_id",
        buckets,
        _bloom_filters("seller_id"),
        last=lambda items: _watched("fct_order_items", items, counted),
    )
    stored["fct_orders"] = write_orders(
        orders.fct_orders(
            models["stg_orders"],
            orders.order_freight(stored["fct_order_items"]),
            models["stg_order_reviews"],
            models["stg_customers"],
            stored["dim_customer"],
        ),
        f"{directory}/fct_orders",
        counted,
    )

    facts, dim_seller = stored["fct_orders"], stored["dim_seller"]
    stored["fct_orders_by_id"] = write_bucketed(
        facts.drop(MONTH), f"{directory}/fct_orders_by_id", "order_id", buckets
    )
    stored[summary.NAME] = _write_summary(facts, f"{directory}/{summary.NAME}")
    # From here on items meet orders bucket by bucket, so neither is shuffled again.
    pairs, by_id = orders.order_sellers(stored["fct_order_items"]), stored["fct_orders_by_id"]
    per_order = pairs.groupBy("order_id").agg(F.count(F.lit(1)).alias("seller_count"))
    aggregates = {
        "mart_data_quality": quality.mart_data_quality(quality.data_quality_flags(facts)),
        "mart_logistics_performance_score": score.logistics_score(
            by_id.join(per_order, "order_id", "left")
        ),
        "mart_seller_freight": sellers.mart_seller_freight(
            sellers.seller_freight(pairs, by_id), dim_seller
        ),
        "mart_seller_performance": sellers.mart_seller_performance(pairs, by_id, dim_seller),
    }
    for name, df in aggregates.items():
        keep(name, df)
    return stored


def read_marts(
    spark: SparkSession, directory: str, buckets: int = BUCKETS
) -> dict[str, DataFrame]:
    """Marts stored by :func:`write_marts` with the same number of buckets."""
    plain = [n for n in MARTS if n not in BY_ORDER] + [summary.NAME]
    stored = {name: spark.read.parquet(f"{directory}/{name}") for name in plain}
    stored["fct_orders"] = read_orders(spark, f"{directory}/fct_orders")
    return stored | {
        name: read_bucketed(spark, f"{directory}/{name}", "order_id", buckets)
        for name in BY_ORDER.values()
    }


class ChecksFailed(Exception):
    """Checks of level ``error`` found violations; the tables built stay unpublished.

    ``findings`` has the outcome of every check, as the version folder keeps it.
    """

    def __init__(self, message: str, findings: DataFrame):
        super().__init__(message)
        self.findings = findings


class BuiltTables:
    """Stored marts under their names, every other table from the models and raw tables."""

    def __init__(self, stored: dict[str, DataFrame], others):
        self._stored, self._others = stored, others

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._stored:
            return self._others[name]
        df = self._stored[name]
        return df.drop(MONTH) if name == "fct_orders" else df


def build_and_check(
    models: Models, raw, directory: str, counted: CountedRows | None = None
) -> DataFrame:
    """Store all tables in a new version folder, check them, and publish the version.

    Staging and intermediate tables are stored beside the marts, so that a check reads
    tables and derives none again. Every table is derived from the stored ones before it, so
    all agree even where a source gives other rows when it is read again. What a check asks of single rows or of row numbers is
    counted by the writes themselves; pass the counts of :func:`import_raw` as ``counted``
    and the raw tables are not read for such checks either. The findings are returned and kept in the version
    folder. If a check of level ``error`` finds anything, nothing is published and
    readers go on with the version before. Publishing is one appended row, which a
    reader sees wholly or not at all.
    """
    version = f"{directory}/version-{uuid.uuid4().hex}"
    counted = CountedRows() if counted is None else counted

    def kept(name: str, df: DataFrame) -> DataFrame:
        return _store(_watched(name, df, counted), f"{version}/{name}")

    stored = {name: kept(name, models[name]) for name in STAGING}
    built = Models(dict(stored), models.calendar)
    for name in INTERMEDIATE:
        stored[name] = kept(name, built[name])
        built.settle(name, stored[name])
    stored |= write_marts(built, version, counted)
    tables = checks.WithRaw(BuiltTables(stored, models), raw)
    findings = _store(checks.run_checks(tables, counted), f"{version}/_findings")
    broken = findings.filter("level = 'error' AND violations > 0")
    names = [f"{r['check']} {r['target']}: {r['violations']}" for r in broken.limit(20).collect()]
    if names:
        raise ChecksFailed("; ".join(names), findings)
    publish = findings.sparkSession.range(1).select(
        F.lit(version).alias("version"), F.current_timestamp().alias("published")
    )
    publish.write.mode("append").parquet(f"{directory}/versions")
    return findings


def read_published(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """Marts of the latest published version."""
    versions = spark.read.parquet(f"{directory}/versions")
    return read_marts(spark, versions.agg(F.max_by("version", "published")).first()[0])
