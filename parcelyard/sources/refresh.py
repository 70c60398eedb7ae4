"""Refresh the monthly marts by rebuilding only the purchase months whose inputs changed.

Every month has a fingerprint of all that its rows are made of: its orders, their items and
review scores, their customers' addresses. A refresh compares it with the one stored, and
builds what differs. A month is written to a folder of its own run, never over another, and
one appended row then says which run holds each month. Readers see a refresh wholly or not
at all, and a run that was broken off leaves folders that nobody reads.

Fingerprints need the keys and hashes of all rows, not their texts: that is the work left
for months that stay. Dimensions are small beside the facts and stored whole by every run.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelyard.functions.metrics import month_start
from parcelyard.operators.compare import row_digest
from parcelyard.operators.pick import lookup
from parcelyard.operators.spread import spread_left_join
from parcelyard.plans import orders, quality, score, sellers
from parcelyard.plans.models import Models
from parcelyard.sources.tables import MONTH

RUN = "refresh_run"
#: Tables in month folders, and dimensions stored whole by each run.
MONTHLY = ("fct_orders", "data_quality", "score_months", "seller_freight", "seller_months")
WHOLE = ("dim_customer", "dim_seller")
#: One row per run: its number, the run that holds each live month, and the tables' layouts.
_STATE = (
    "seq long, run string, months array<struct<month: date, orders: long, digest_1: decimal(38,0), "
    "digest_2: decimal(38,0), run: string>>, layouts map<string, string>"
)
_ITEM = ("seller_id", "price", "freight_value")
_ADDRESS = ("customer_unique_id", "customer_state", "customer_city")


def _digest_sums(columns, prefix: str) -> list[Column]:
    """Two sums of row hashes: the same for the same rows, however they lie and repeat."""
    return [
        F.sum(row_digest(columns, seed).cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"{prefix}{seed}")
        for seed in (1, 2)
    ]


def _digests(columns, prefix: str) -> list[Column]:
    return [row_digest(columns, seed).alias(f"{prefix}{seed}") for seed in (1, 2)]


def month_fingerprints(models: Models, addresses: DataFrame) -> DataFrame:
    """(order_month, orders, digest_1, digest_2) of what each month's rows are made of.

    Orders without a purchase time are the month null. Items, reviews and customers of no
    order on file are in no month. ``addresses`` is ``dim_customer``. An order goes on as
    two hashes of its row, then of what it was sold with, so that joins move no other column.
    """
    staged = models["stg_orders"]
    placed = staged.select(
        "order_id", "customer_id", month_start(F.col("order_purchase_timestamp")).alias(MONTH),
        *_digests(staged.columns, "_order_"),
    )
    items = (
        models["stg_order_items"]
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("_items"), *_digest_sums(_ITEM, "_item_"))
    )
    people = spread_left_join(
        models["stg_customers"].select("customer_id", "customer_unique_id"),
        addresses.select(*_ADDRESS),
        "customer_unique_id",
        spread_by="customer_id",
    )
    scores = lookup(models["stg_order_reviews"], "order_id", "review_score")
    sold = placed.join(items, "order_id", "left").join(scores, "order_id", "left")
    own = ["_order_1", "_order_2", "_items", "_item_1", "_item_2", "review_score"]
    sold = sold.select("customer_id", MONTH, *_digests(own, "_sold_"))
    wide = spread_left_join(sold, people, "customer_id", spread_by="_sold_1")
    columns = ["_sold_1", "_sold_2", *_ADDRESS]
    return wide.groupBy(MONTH).agg(F.count(F.lit(1)).alias("orders"), *_digest_sums(columns, "digest_"))


def _of_months(month: Column, months) -> Column:
    """``month`` is one of ``months``, null among them."""
    named = month.isin([m for m in months if m is not None])
    return F.when(month.isNull(), F.lit(None in months)).otherwise(named)


def _last_state(spark: SparkSession, directory: str):
    path = f"{directory}/runs"
    spark.createDataFrame([], _STATE).write.mode("ignore").parquet(path)
    states = spark.read.schema(_STATE).parquet(path)
    return states.agg(F.max_by(F.struct("*"), "seq").alias("last")).first()["last"]


def _changed_inputs(models: Models, months, all_of_them: bool) -> dict[str, DataFrame]:
    """The staging tables, cut to what belongs to the orders of ``months``.

    The cut is a semi join, before which the optimizer may put a Bloom filter, so that rows
    of other months need not be shuffled. Where every month is to be built nothing is cut.
    """
    names = ("stg_orders", "stg_order_items", "stg_order_reviews", "stg_customers")
    tables = {name: models[name] for name in names}
    if all_of_them:
        return tables
    placed = tables["stg_orders"]
    placed = placed.filter(_of_months(month_start(F.col("order_purchase_timestamp")), months))
    for name, key in zip(names[1:], ("order_id", "order_id", "customer_id")):
        tables[name] = tables[name].join(placed.select(key).distinct(), key, "left_semi")
    return tables | {"stg_orders": placed}


def _append(df: DataFrame, path: str, run: str) -> str:
    """Store rows in folders of their month and this run; return the layout of the table."""
    marked = df.withColumn(RUN, F.lit(run))
    dealt = marked.hint("rebalance", MONTH)
    dealt.write.mode("append").partitionBy(MONTH, RUN).parquet(path)
    return marked.schema.json()


def _read_monthly(spark: SparkSession, path: str, layout: str, live: list[tuple]) -> DataFrame:
    """Rows of the live (month, run) folders; the others are pruned before any file is read."""
    stored = spark.read.schema(StructType.fromJson(json.loads(layout))).parquet(path)
    named = [f"{'-' if month is None else month.isoformat()}/{run}" for month, run in live]
    folder = F.concat_ws("/", F.coalesce(F.col(MONTH).cast("string"), F.lit("-")), F.col(RUN))
    return stored.filter(folder.isin(named)).drop(RUN)


def refresh_marts(models: Models, directory: str) -> DataFrame:
    """Bring the monthly marts below ``directory`` up to date; return the months that changed.

    The result has one row per month built or gone: ``order_month`` and ``orders``, its orders
    now (0 for a month that is gone). No row means that nothing had changed. The first run
    builds all months. What comes to the driver is one row per purchase month.
    """
    spark = models.spark
    last = _last_state(spark, directory)
    run = f"run-{uuid.uuid4().hex}"
    for name in WHOLE:
        models[name].write.parquet(f"{directory}/{name}/{run}")
    whole = {name: spark.read.parquet(f"{directory}/{name}/{run}") for name in WHOLE}

    held = {m["month"]: m for m in last["months"]} if last else {}
    now = {f[MONTH]: f for f in month_fingerprints(models, whole["dim_customer"]).collect()}
    changed = [m for m in now if m not in held or tuple(held[m][1:4]) != tuple(now[m][1:4])]
    gone = [m for m in held if m not in now]
    layouts = dict(last["layouts"]) if last else {}
    if changed or not last:
        layouts = _build(models, whole, changed, len(changed) == len(now), directory, run)

    months = [
        (m, f["orders"], f["digest_1"], f["digest_2"], run if m in changed else held[m]["run"])
        for m, f in now.items()
    ]
    state = [((last["seq"] if last else 0) + 1, run, months, layouts)]
    spark.createDataFrame(state, _STATE).coalesce(1).write.mode("append").parquet(f"{directory}/runs")
    report = [(m, now[m]["orders"]) for m in changed] + [(m, 0) for m in gone]
    return spark.createDataFrame(report, f"{MONTH} date, orders long")


def _build(
    models: Models, whole: dict[str, DataFrame], months, all_of_them: bool, directory: str, run: str
) -> dict[str, str]:
    """Store all tables of ``months`` as of ``run``; the aggregates come from its stored facts."""
    spark = models.spark
    inputs = _changed_inputs(models, months, all_of_them)
    pairs_path = f"{directory}/order_sellers/{run}"
    orders.order_sellers(inputs["stg_order_items"]).write.parquet(pairs_path)
    pairs = spark.read.parquet(pairs_path)
    sold = orders.order_freight_and_sellers(pairs)
    facts = orders.fct_orders(
        inputs["stg_orders"],
        sold.drop("seller_count"),
        inputs["stg_order_reviews"],
        inputs["stg_customers"],
        whole["dim_customer"],
    ).withColumn(MONTH, month_start(F.col("order_purchase_timestamp")))
    layouts = {"fct_orders": _append(facts, f"{directory}/fct_orders", run)}

    built = [(m, run) for m in months]
    facts = _read_monthly(spark, f"{directory}/fct_orders", layouts["fct_orders"], built)
    counted = facts.drop(MONTH).join(sold.select("order_id", "seller_count"), "order_id", "left")
    tables = {
        "data_quality": quality.data_quality_flags(facts),
        "score_months": score.month_components(counted),
        "seller_freight": sellers.seller_freight(pairs, facts).withColumn(MONTH, F.col("time_period")),
        "seller_months": sellers.seller_months(pairs, facts).withColumn(MONTH, F.col("time_period")),
    }
    for name, df in tables.items():
        layouts[name] = _append(df, f"{directory}/{name}", run)
    return layouts


def read_refreshed(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The marts as of the last finished refresh.

    The score takes its freight bounds from all months, and sellers get their places, when
    they are read: both join or compare small monthly rows.
    """
    last = _last_state(spark, directory)
    if last is None:
        raise ValueError(f"no refresh has finished below {directory}")
    live = [(m["month"], m["run"]) for m in last["months"]]
    monthly = {
        name: _read_monthly(spark, f"{directory}/{name}", last["layouts"][name], live) for name in MONTHLY
    }
    whole = {name: spark.read.parquet(f"{directory}/{name}/{last['run']}") for name in WHOLE}
    freight, outcomes = (monthly[n].drop(MONTH) for n in ("seller_freight", "seller_months"))
    return whole | {
        "fct_orders": monthly["fct_orders"],
        "mart_data_quality": quality.mart_data_quality(monthly["data_quality"]),
        "mart_logistics_performance_score": score.score_from_months(monthly["score_months"]),
        "mart_seller_freight": sellers.mart_seller_freight(freight, whole["dim_seller"]),
        "mart_seller_performance": sellers.with_places(outcomes, whole["dim_seller"]),
    }


def stale_folders(spark: SparkSession, directory: str) -> DataFrame:
    """(mart, order_month, refresh_run) of month folders that no reader looks at any more.

    They are left by runs that were broken off and by months built anew since, and may be
    deleted once no reader of an earlier state is left.
    """
    last = _last_state(spark, directory)
    parts = []
    for name, layout in (last["layouts"] if last else {}).items():
        path = f"{directory}/{name}"
        stored = spark.read.schema(StructType.fromJson(json.loads(layout))).parquet(path)
        parts.append(stored.select(F.lit(name).alias("mart"), MONTH, RUN).distinct())
    live = spark.createDataFrame(
        [(m["month"], m["run"]) for m in last["months"]] if last else [], f"{MONTH} date, {RUN} string"
    )
    found = spark.createDataFrame([], f"mart string, {MONTH} date, {RUN} string")
    for part in parts:
        found = found.unionByName(part)
    same = found[MONTH].eqNullSafe(live[MONTH]) & (found[RUN] == live[RUN])
    return found.join(live, same, "left_anti")
