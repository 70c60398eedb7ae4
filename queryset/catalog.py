"""Registered queries: the Spark side, the DuckDB side and the rounding they share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.lazy import LazyTables
from parcelyard.plans import checks, insights, reports, summary
from parcelyard.operators.observed import CountedRows
from parcelyard.plans.checks import WithRaw
from parcelyard.plans.models import INTERMEDIATE, MARTS, STAGING, Models
from parcelyard.plans.staging import stage
from parcelyard.released import released
from parcelyard.sources import demo
from parcelyard.sources.calendar import observed_range
from parcelyard.sources.clustered import write_clustered_marts
from parcelyard.sources.raw import import_raw, raw_counts, read_raw_table, write_raw_csv
from parcelyard.sources.refresh import read_refreshed, refresh_marts
from parcelyard.sources.tables import (
    ChecksFailed,
    build_and_check,
    register_views,
    scratch_path,
    write_marts,
    write_orders,
)
from parcelyard.streaming.intake import load_new_files
from queryset import planted
from queryset.dirty import dirty
from queryset.duckdb_sql import (
    CONSTRAINTS,
    GENERIC_TARGETS,
    SINGULAR_ERRORS,
    nudge,
    rounded,
    with_tables,
)
from queryset.earlier import CHANGED_SQL, earlier

ORDER_DATES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
MONTH = "1996-03"
STATES = ["asia", "europe"]
SELLERS = ["3", "7"]
CITY = "nation_12"


_STORED_MARTS: dict[tuple[str, str], dict[str, DataFrame]] = {}
_CLUSTERED_MARTS: dict[tuple[str, str], dict[str, DataFrame]] = {}


class Inputs:
    """The tables of one scale folder, built as a query asks for them."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    @cached_property
    def staged(self) -> LazyTables:
        return demo.staged_tables(self.spark, self.directory)

    @cached_property
    def raw(self) -> LazyTables:
        return demo.raw_tables(self.spark, self.directory)

    @cached_property
    def parsed(self) -> LazyTables:
        return stage(self.dirty)

    @cached_property
    def dirty(self) -> LazyTables:
        return LazyTables({t: lambda t=t: dirty(t, self.raw[t]) for t in self.raw})

    @cached_property
    def models(self) -> Models:
        return Models(
            self.staged, lambda: observed_range(self.staged["stg_orders"], *ORDER_DATES)
        )

    @cached_property
    def everything(self) -> WithRaw:
        return WithRaw(self.models, self.raw)

    @cached_property
    def marts(self) -> dict[str, DataFrame]:
        """Stored marts; one session stores those of a folder once for all queries."""
        key = (self.spark.sparkContext.applicationId, self.directory)
        if key not in _STORED_MARTS:
            _STORED_MARTS[key] = write_marts(self.models, self.scratch())
        return _STORED_MARTS[key]

    @cached_property
    def clustered(self) -> dict[str, DataFrame]:
        """Copies of the stored marts by place and by seller, stored once like these."""
        key = (self.spark.sparkContext.applicationId, self.directory)
        if key not in _CLUSTERED_MARTS:
            _CLUSTERED_MARTS[key] = write_clustered_marts(self.marts, self.scratch())
        return _CLUSTERED_MARTS[key]

    def scratch(self) -> str:
        """A fresh shared folder; one is set only where the session names none."""
        if not self.spark.conf.get("spark.checkpoint.dir", None):
            self.spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="parcelyard-"))
        return scratch_path(self.spark)

    def stored(self, df: DataFrame) -> DataFrame:
        """``df`` written to the shared folder and read back."""
        path = self.scratch()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Query:
    build: Callable[[Inputs], DataFrame]
    sql: str
    digits: dict[str, int] = field(default_factory=dict)
    faults: dict[str, planted.Fault] = field(default_factory=dict)
    #: Tables with faults that reach whatever is computed from them.
    sources: dict[str, planted.Fault] = field(default_factory=dict)

    def run(self, spark: SparkSession, directory: str) -> DataFrame:
        df = self.build(Inputs(spark, directory))
        return df.withColumns(
            {c: F.round(F.col(c) + nudge(n), n) for c, n in self.digits.items()}
        )

    def oracle(self) -> str:
        body, tables = planted.planted_sql(rounded(self.sql, self.digits), self.faults)
        changed = {t: fault.duckdb(t, f"sound_{t}") for t, fault in self.sources.items()}
        return with_tables(body, tables, changed)


def _digits(money: str = "", rates: str = "") -> dict[str, int]:
    return {**dict.fromkeys(money.split(), 2), **dict.fromkeys(rates.split(), 6)}


_FREIGHT = _digits("total_price total_freight_value", "freight_ratio")
_SELLER = _digits(rates="on_time_rate avg_review_score")
_QUALITY = _digits(
    rates="pct_orders_unavailable_delivery_data pct_orders_canceled_or_unavailable "
    "pct_orders_missing_review pct_orders_impossible_date_ordering"
)
_SCORE = _digits(
    rates="delivery_score customer_experience_score logistics_cost_score seller_score "
    "final_score delivery_coverage"
)
_COMPONENTS = {c: n for c, n in _SCORE.items() if c != "delivery_coverage"}
_PLACE = _digits(rates="lat lng")

QUERIES: dict[str, Query] = {}


def _add(name: str, build: Callable[[Inputs], DataFrame], sql: str, digits=None) -> None:
    QUERIES[name] = Query(build, sql, digits or {})


def _table(name: str, table: str, digits=None) -> None:
    _add(name, lambda i: i.models[table], f"SELECT * FROM {table}", digits)


def _parsed(name: str, table: str, digits=None) -> None:
    _add(name, lambda i: i.parsed[table], f"SELECT * FROM clean_{table}", digits)


# --- sources and sinks ---------------------------------------------------------


def _through_csv(i: Inputs, table: str) -> DataFrame:
    """The staging table of what comes back from CSV files of all tables it needs."""
    needed = [table, "product_category_name_translation"] if table == "products" else [table]
    folder = i.scratch()
    write_raw_csv({t: i.raw[t] for t in needed}, folder)
    loaded = {t: read_raw_table(i.spark, f"{folder}/{t}", t) for t in needed}
    name = "product_category_translation" if table.startswith("product_category") else table
    return stage(LazyTables({t: lambda t=t: loaded[t] for t in needed}))[f"stg_{name}"]


def _with_other_header(i: Inputs) -> DataFrame:
    """Whether the loader takes files with the right and with a wrong header."""
    outcomes = []
    for case, renamed in (("as declared", {}), ("renamed", {"seller_city": "city"})):
        folder = i.scratch()
        i.raw["sellers"].withColumnsRenamed(renamed).write.option("header", "true").csv(folder)
        try:
            loaded = read_raw_table(i.spark, folder, "sellers")
            rows = loaded.agg(F.count("seller_city")).first()[0]  # reads the column, so checks it
            outcomes.append((case, True, rows))
        except Exception as error:  # noqa: BLE001  any failure to read counts as a refusal
            if "header" not in str(error).lower():
                raise
            outcomes.append((case, False, 0))
    return i.spark.createDataFrame(outcomes, "header string, accepted boolean, row_count long")


def _with_byte_order_mark(i: Inputs) -> DataFrame:
    folder = i.scratch()
    marked = i.raw["sellers"].withColumnRenamed("seller_id", "\ufeffseller_id")
    marked.write.option("header", "true").csv(folder)
    return read_raw_table(i.spark, folder, "sellers")


_add(
    "src2_header_check",
    _with_other_header,
    """SELECT 'as declared' AS header, true AS accepted, count(*) AS row_count FROM src_sellers
       UNION ALL SELECT 'renamed', false, 0""",
)
_add("src3_byte_order_mark", _with_byte_order_mark, "SELECT * FROM src_sellers")
_RAW_NAMES = (
    "customers geolocation order_items order_payments order_reviews orders products sellers "
    "product_category_name_translation"
).split()
for _raw_name in _RAW_NAMES:
    _stg = _raw_name.replace("category_name_translation", "category_translation")
    _add(
        f"src1_csv_{_raw_name}",
        lambda i, t=_raw_name: _through_csv(i, t),
        f"SELECT * FROM stg_{_stg}",
        _PLACE if _raw_name == "geolocation" else None,
    )
_add(
    "src4_raw_counts",
    lambda i: raw_counts(i.raw),
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM src_{t}" for t in _RAW_NAMES
    ),
)


def _loaded_twice(i: Inputs) -> DataFrame:
    """Rows of every table after its files were loaded twice."""
    folder = i.scratch()
    write_raw_csv(i.raw, f"{folder}/inbox")
    loaded = {}
    for table in _RAW_NAMES:
        for _ in range(2):
            loaded[table] = load_new_files(
                i.spark, f"{folder}/inbox/{table}", table, f"{folder}/{table}", f"{folder}/progress/{table}"
            )
    return raw_counts(loaded)


_BREAKS = "{0} || ' says' || {1} || '\"' || {2} || '\", and' || {1} || {1} || '\"\"' || {1} || 'end'"
_REVIEW_TEXTS = ("review_id", "order_id", "review_comment_title", "review_comment_message")


def _quoted_breaks(i: Inputs) -> DataFrame:
    """Reviews whose text holds quotes and line breaks, from one file that many tasks read."""
    folder, small = i.scratch(), {"spark.sql.files.maxPartitionBytes": "64k"}
    message = F.expr(_BREAKS.format("review_comment_message", "char(10)", "review_id"))
    texts = i.raw["order_reviews"].withColumn("review_comment_message", message)
    write_raw_csv({"order_reviews": texts.coalesce(1)}, folder)
    before = {name: i.spark.conf.get(name) for name in small}
    for name, value in small.items():
        i.spark.conf.set(name, value)
    try:
        loaded = read_raw_table(i.spark, f"{folder}/order_reviews", "order_reviews")
        return i.stored(loaded).select(*_REVIEW_TEXTS)
    finally:
        for name, value in before.items():
            i.spark.conf.set(name, value)


_add(
    "src6_quoted_line_breaks",
    _quoted_breaks,
    f"""SELECT {", ".join(_REVIEW_TEXTS)} FROM (
          SELECT * REPLACE ({_BREAKS.format("review_comment_message", "chr(10)", "review_id")}
                            AS review_comment_message) FROM src_order_reviews)""",
)
_add("src5_repeated_load", _loaded_twice, QUERIES["src4_raw_counts"].sql)


def _severity_through_view(i: Inputs) -> DataFrame:
    register_views(i.models, ("fct_orders",))
    return i.spark.sql(
        "SELECT delivery_severity, count(*) AS order_count, avg(delay_days) AS avg_delay_days "
        "FROM fct_orders GROUP BY delivery_severity"
    )


_add(
    "snk1_views",
    _severity_through_view,
    """SELECT delivery_severity, count(*) AS order_count, avg(delay_days) AS avg_delay_days
       FROM fct_orders GROUP BY delivery_severity""",
    _digits(rates="avg_delay_days"),
)


def _rows_of_all_views(i: Inputs) -> DataFrame:
    """Rows and distinct rows of every view, all asked by name, one view after the other."""
    register_views(i.models)
    counts = [
        f"SELECT '{name}' AS view_name, count(*) AS n_rows, (SELECT count(*) FROM "
        f"(SELECT DISTINCT * FROM {name})) AS n_distinct FROM {name}"
        for name in STAGING + INTERMEDIATE + MARTS
    ]
    with released(i.spark):
        found = [tuple(i.spark.sql(count).first()) for count in counts]
    return i.spark.createDataFrame(found, "view_name string, n_rows long, n_distinct long")


_add(
    "snk1_all_views",
    _rows_of_all_views,
    " UNION ALL ".join(
        f"SELECT '{name}' AS view_name, count(*) AS n_rows, (SELECT count(*) FROM "
        f"(SELECT DISTINCT * FROM {name})) AS n_distinct FROM {name}"
        for name in STAGING + INTERMEDIATE + MARTS
    ),
)


def _findings(i: Inputs) -> DataFrame:
    """Violations per check over stored tables of which the repeated item numbers are made unique."""
    items = i.staged["stg_order_items"].dropDuplicates(["order_id", "order_item_id"])
    staged = LazyTables({t: lambda t=t: items if t == "stg_order_items" else i.staged[t] for t in i.staged})
    raw = LazyTables(
        {
            t: lambda t=t: i.raw[t].dropDuplicates(["order_id", "order_item_id"])
            if t == "order_items" else i.raw[t]
            for t in i.raw
        }
    )
    models = Models(staged, lambda: observed_range(staged["stg_orders"], *ORDER_DATES))
    found = build_and_check(models, raw, i.scratch())
    return found.groupBy("check", "level").agg(
        F.count(F.lit(1)).alias("targets"), F.sum("violations").alias("violations")
    )


_add(
    "snk3_build_and_check",
    _findings,
    f"""SELECT * REPLACE (CAST(violations AS BIGINT) AS violations) FROM (
          VALUES {", ".join(f"('{c}', 'error', {n}, 0)" for c, n in GENERIC_TARGETS.items())},
                 {", ".join(f"('{c}', 'error', 1, 0)" for c in SINGULAR_ERRORS)}
        ) t("check", level, targets, violations)
        UNION ALL
        SELECT 'impossible_dates', 'warn', 1, count(*) FROM int_order_delivery_metrics
        WHERE order_delivered_customer_date < order_purchase_timestamp""",
)
_add(
    "snk2_stored_orders",
    lambda i: write_orders(i.models.fct_orders, f"{i.scratch()}/fct_orders"),
    """SELECT *, CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_month
       FROM fct_orders""",
    _FREIGHT,
)

_MART_DIGITS = {
    "dim_location": _PLACE,
    "fct_orders": _FREIGHT,
    "mart_data_quality": _QUALITY,
    "mart_logistics_performance_score": _SCORE,
    "mart_seller_freight": _FREIGHT,
    "mart_seller_performance": _SELLER,
}
for _mart in MARTS:
    if _mart != "fct_orders":
        _add(
            f"snk2_stored_{_mart}",
            lambda i, m=_mart: i.marts[m],
            f"SELECT * FROM {_mart}",
            _MART_DIGITS.get(_mart),
        )

_add(
    "snk7_clustered_orders",
    lambda i: i.clustered["fct_orders_by_place"],
    QUERIES["snk2_stored_orders"].sql,
    _FREIGHT,
)
for _copy in ("mart_seller_performance", "mart_seller_freight"):
    _add(
        f"snk7_clustered_{_copy}",
        lambda i, m=_copy: i.clustered[f"{m}_by_seller"],
        f"SELECT * FROM {_copy}",
        _MART_DIGITS[_copy],
    )

_REFRESHED: dict[tuple[str, str], tuple[dict[str, DataFrame], DataFrame]] = {}


def _refreshed(i: Inputs) -> tuple[dict[str, DataFrame], DataFrame]:
    """Marts built from an earlier load and refreshed by this one, and the months that took."""
    key = (i.spark.sparkContext.applicationId, i.directory)
    if key not in _REFRESHED:
        path = i.scratch()
        refresh_marts(earlier(i.models), path)
        report = refresh_marts(i.models, path)
        _REFRESHED[key] = read_refreshed(i.spark, path), report
    return _REFRESHED[key]


_add("snk8_refreshed_months", lambda i: _refreshed(i)[1], CHANGED_SQL)
_add(
    "snk8_refreshed_orders",
    lambda i: _refreshed(i)[0]["fct_orders"],
    QUERIES["snk2_stored_orders"].sql,
    _FREIGHT,
)
for _mart in MARTS:
    if _mart.startswith("mart_"):
        _add(
            f"snk8_refreshed_{_mart}",
            lambda i, m=_mart: _refreshed(i)[0][m],
            f"SELECT * FROM {_mart}",
            _MART_DIGITS[_mart],
        )

# --- staging, from the all-string tables ---------------------------------------

_parsed("stg1_customers", "stg_customers")
_parsed("stg2_geolocation", "stg_geolocation", _PLACE)
_parsed("stg3_order_items", "stg_order_items")
_parsed("stg4_order_payments", "stg_order_payments")
_parsed("stg5_order_reviews", "stg_order_reviews")
_parsed("stg6_orders", "stg_orders")
_parsed("stg7_product_category_translation", "stg_product_category_translation")
_parsed("stg8_products", "stg_products")
_parsed("stg9_sellers", "stg_sellers")



def _accented(i: Inputs) -> DataFrame:
    raw = i.raw["customers"].withColumn("customer_city", F.expr("upper(customer_city) || ' ÉÑ'"))
    return stage(LazyTables({"customers": lambda: raw}), ascii_only=True)["stg_customers"]


_add(
    "stg1_customers_ascii",
    _accented,
    "SELECT * REPLACE (customer_city || ' ÉÑ' AS customer_city) FROM stg_customers",
)

# --- intermediate --------------------------------------------------------------

_table("int1_order_delivery_metrics", "int_order_delivery_metrics")
_table("int2_order_freight_metrics", "int_order_freight_metrics", _FREIGHT)
_table("int3_customer_experience_metrics", "int_customer_experience_metrics")
_table("int4_seller_performance_metrics", "int_seller_performance_metrics", _SELLER)
_table("int5_seller_freight_metrics", "int_seller_freight_metrics", _FREIGHT)
_table("int6_data_quality_flags", "int_data_quality_flags", _QUALITY)

# --- marts ---------------------------------------------------------------------

_table("dim1_customer", "dim_customer")
_table("dim2_date", "dim_date")
_table("dim3_location", "dim_location", _PLACE)
_table("dim4_product", "dim_product")
_table("dim5_seller", "dim_seller")
_table("fct1_order_items", "fct_order_items")
_table("fct2_orders", "fct_orders", _FREIGHT)
_table("mrt1_data_quality", "mart_data_quality", _QUALITY)
_table("mrt2_logistics_performance_score", "mart_logistics_performance_score", _SCORE)
_table("mrt3_seller_freight", "mart_seller_freight", _FREIGHT)
_table("mrt4_seller_performance", "mart_seller_performance", _SELLER)



class HotInputs(Inputs):
    """A third of the customers are one person; a third of the orders belong to one
    customer, and a seventh of the rest to none."""

    @cached_property
    def staged(self) -> LazyTables:
        cold = super().staged
        person = "CASE WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN '0' ELSE customer_unique_id END"
        buyer = """CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN '1'
                        WHEN CAST(order_id AS BIGINT) % 7 = 0 THEN NULL ELSE customer_id END"""
        hot = {
            "stg_customers": lambda: cold["stg_customers"].withColumn(
                "customer_unique_id", F.expr(person)
            ),
            "stg_orders": lambda: cold["stg_orders"].withColumn("customer_id", F.expr(buyer)),
        }
        return LazyTables({name: hot.get(name, lambda n=name: cold[n]) for name in cold})


QUERIES["fct2_orders_hot"] = Query(
    lambda i: HotInputs(i.spark, i.directory).models.fct_orders, "SELECT * FROM fct_orders_hot", _FREIGHT
)

# --- reports -------------------------------------------------------------------

_MONTH_OF = "CAST(date_trunc('month', order_purchase_timestamp) AS DATE)"
_IN_MONTH = f"strftime(order_purchase_timestamp, '%Y-%m') = '{MONTH}'"

_add(
    "rpt1_score_and_components",
    lambda i: reports.score_and_components(i.models.mart_logistics_performance_score),
    "SELECT * FROM mart_logistics_performance_score ORDER BY order_month",
    _SCORE,
)
_add(
    "rpt2_delivery_kpis",
    lambda i: reports.delivery_kpis(i.models.fct_orders),
    """SELECT delivery_severity, count(*) AS "count", avg(delay_days) AS "avg"
       FROM fct_orders GROUP BY delivery_severity""",
    _digits(rates="avg"),
)
_add(
    "rpt3_review_scores",
    lambda i: reports.review_scores(i.models.fct_orders),
    """SELECT review_score, count(*) AS "count" FROM fct_orders GROUP BY review_score""",
)
_add(
    "rpt4_logistics_cost",
    lambda i: reports.logistics_cost(i.models.fct_orders),
    """SELECT avg(freight_ratio) AS "avg", sum(total_freight_value) AS "sum", count(*) AS "count"
       FROM fct_orders""",
    _digits("sum", "avg"),
)
_add(
    "rpt5_seller_performance",
    lambda i: reports.seller_performance(i.models.mart_seller_performance),
    """SELECT seller_id, time_period, order_volume, on_time_rate, avg_review_score,
              seller_state, seller_city
       FROM mart_seller_performance
       ORDER BY order_volume DESC, seller_id, time_period LIMIT 100""",
    _SELLER,
)
_add(
    "rpt6_data_quality",
    lambda i: reports.data_quality(i.models.mart_data_quality),
    "SELECT * FROM mart_data_quality ORDER BY order_month",
    _QUALITY,
)
_add(
    "rpt7_trends",
    lambda i: reports.trends(i.models.fct_orders),
    f"""SELECT {_MONTH_OF} AS order_purchase_timestamp, count(*) AS "count",
               avg(review_score) AS "avg"
        FROM fct_orders GROUP BY 1""",
    _digits(rates="avg"),
)
_add(
    "rpt8_severity_by_month",
    lambda i: reports.severity_by_month(i.models.fct_orders),
    f"""SELECT {_MONTH_OF} AS month, delivery_severity, count(*) AS order_count
        FROM fct_orders GROUP BY ALL ORDER BY month""",
)
_add(
    "rpt9_slowest_sellers",
    lambda i: reports.slowest_sellers(i.models.mart_seller_performance),
    """SELECT seller_id, seller_state, seller_city, on_time_rate, order_volume,
              avg_review_score, time_period
       FROM mart_seller_performance WHERE order_volume >= 5
       ORDER BY on_time_rate, seller_id, time_period LIMIT 50""",
    _SELLER,
)
_COST_BY_MONTH = f"""SELECT {_MONTH_OF} AS month, avg(freight_ratio) AS avg_freight_ratio,
    avg(total_freight_value) AS avg_freight_value, sum(total_freight_value) AS sum_freight_value
    FROM fct_orders WHERE %s GROUP BY 1"""
_COST_DIGITS = _digits("sum_freight_value", "avg_freight_ratio avg_freight_value")
_add(
    "rpt10_cost_by_month",
    lambda i: reports.cost_by_month(i.models.fct_orders),
    _COST_BY_MONTH % "true",
    _COST_DIGITS,
)
_BY_PLACE = """SELECT customer_state, customer_city, delivery_severity, count(*) AS order_count
    FROM fct_orders WHERE %s GROUP BY ALL"""
_add(
    "rpt11_severity_by_place",
    lambda i: reports.severity_by_place(i.models.fct_orders),
    _BY_PLACE % "true",
)
_add(
    "rpt12_review_by_severity",
    lambda i: reports.review_by_severity(i.models.fct_orders),
    """SELECT review_score, delivery_severity, count(*) AS order_count
       FROM fct_orders GROUP BY ALL""",
)
_add(
    "rpt13_cost_by_severity",
    lambda i: reports.cost_by_severity(i.models.fct_orders),
    """SELECT delivery_severity, avg(freight_ratio) AS avg_freight_ratio,
              avg(total_freight_value) AS avg_freight_value, avg(delay_days) AS avg_delay_days,
              count(*) AS order_count
       FROM fct_orders GROUP BY delivery_severity""",
    _digits(rates="avg_freight_ratio avg_freight_value avg_delay_days"),
)
_add(
    "rpt14_seller_drill_down",
    lambda i: reports.seller_drill_down(i.models.fct_order_items, i.models.fct_orders, "7"),
    """SELECT i.order_id, order_item_id, product_id, seller_id, price, freight_value,
              shipping_limit_date, order_status, order_purchase_timestamp,
              order_delivered_customer_date, order_estimated_delivery_date, delay_days,
              delivery_severity, review_score, customer_city, customer_state
       FROM fct_orders o, fct_order_items i
       WHERE o.order_id = i.order_id AND seller_id = '7'""",
)
_LOCATION = """SELECT order_id, customer_id, customer_city, customer_state, order_status,
    order_purchase_timestamp, order_delivered_customer_date, order_estimated_delivery_date,
    delay_days, delivery_severity, review_score, total_price, total_freight_value, freight_ratio
    FROM fct_orders WHERE %s"""
_add(
    "rpt15_location_drill_down",
    lambda i: reports.location_drill_down(i.models.fct_orders),
    _LOCATION % "true",
    _FREIGHT,
)
_add(
    "rpt16_order_drill_down",
    lambda i: reports.order_drill_down(i.models.fct_orders, i.models.fct_order_items, "77"),
    """SELECT o.order_id, order_status, order_purchase_timestamp, order_delivered_customer_date,
              order_estimated_delivery_date, delay_days, delivery_severity, review_score,
              customer_city, customer_state, total_price, total_freight_value, freight_ratio,
              order_item_id, product_id, seller_id, price, freight_value
       FROM fct_order_items i, fct_orders o
       WHERE o.order_id = i.order_id AND i.order_id = '77'""",
    _FREIGHT,
)
_add(
    "rpt14_seller_drill_down_by_bucket",
    lambda i: reports.seller_drill_down(i.marts["fct_order_items"], i.marts["fct_orders_by_id"], "7"),
    QUERIES["rpt14_seller_drill_down"].sql,
)
_add(
    "rpt16_order_drill_down_by_bucket",
    lambda i: reports.order_drill_down(i.marts["fct_orders_by_id"], i.marts["fct_order_items"], "77"),
    QUERIES["rpt16_order_drill_down"].sql,
    _FREIGHT,
)
_SELLER_FREIGHT = _digits("total_freight_value", "freight_ratio")
_add(
    "rpt17_freight_by_seller",
    lambda i: reports.freight_by_seller(i.models.mart_seller_freight),
    """SELECT seller_id, seller_state, seller_city, time_period, order_volume,
              total_freight_value, freight_ratio
       FROM mart_seller_freight""",
    _SELLER_FREIGHT,
)
_add(
    "rpt18_freight_by_state",
    lambda i: reports.freight_by_state(i.models.fct_orders),
    """SELECT customer_state, avg(freight_ratio) AS avg_freight_ratio,
              sum(total_freight_value) AS total_freight_value, count(*) AS order_count
       FROM fct_orders GROUP BY customer_state""",
    _digits("total_freight_value", "avg_freight_ratio"),
)

# The same reports from the stored summary, by the same SQL over all orders.
_BY_REPORT = {
    "rpt2_delivery_kpis": summary.delivery_kpis,
    "rpt3_review_scores": summary.review_scores,
    "rpt4_logistics_cost": summary.logistics_cost,
    "rpt7_trends": summary.trends,
    "rpt8_severity_by_month": summary.severity_by_month,
    "rpt10_cost_by_month": summary.cost_by_month,
    "rpt11_severity_by_place": summary.severity_by_place,
    "rpt12_review_by_severity": summary.review_by_severity,
    "rpt13_cost_by_severity": summary.cost_by_severity,
    "rpt18_freight_by_state": summary.freight_by_state,
}
for _report, _from_summary in _BY_REPORT.items():
    _add(
        f"{_report}_from_summary",
        lambda i, f=_from_summary: f(i.marts[summary.NAME]),
        QUERIES[_report].sql,
        QUERIES[_report].digits,
    )

# --- filters -------------------------------------------------------------------

_add(
    "flt1_optional_clause",
    lambda i: reports.severity_by_place(i.models.fct_orders, month=MONTH, customer_state=None),
    _BY_PLACE % _IN_MONTH,
)
_add(
    "flt2_month",
    lambda i: reports.cost_by_month(i.models.fct_orders, month=MONTH),
    _COST_BY_MONTH % _IN_MONTH,
    _COST_DIGITS,
)
_add(
    "flt3_values",
    lambda i: reports.severity_by_place(i.models.fct_orders, customer_state=STATES),
    _BY_PLACE % "customer_state IN ('asia', 'europe')",
)
_add(
    "flt4_text_variable",
    lambda i: reports.location_drill_down(i.models.fct_orders, state="asia"),
    _LOCATION % "customer_state = 'asia'",
    _FREIGHT,
)


def _dashboard_rows(i: Inputs) -> DataFrame:
    filters = reports.Filters(month=MONTH, customer_state=STATES, seller_id=SELLERS)
    cards = reports.dashboard(i.models, "Problem Analysis", filters)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(title).alias("card"), "n_rows")
        for title, df in cards.items()
    ]
    return reduce(DataFrame.unionAll, counts)


_SELLER_MONTHS = f"strftime(time_period, '%Y-%m') = '{MONTH}' AND seller_id IN ('3', '7')"
_add(
    "flt5_dashboard",
    _dashboard_rows,
    f"""SELECT 'Late-Delivery Severity by Month' AS card,
               count(DISTINCT delivery_severity) AS n_rows FROM fct_orders WHERE {_IN_MONTH}
        UNION ALL
        SELECT 'On-Time Rate by Seller (Worst First)', count(*) FROM mart_seller_performance
        WHERE order_volume >= 5 AND {_SELLER_MONTHS}
        UNION ALL
        SELECT 'Logistics Cost by Month', count(DISTINCT {_MONTH_OF}) FROM fct_orders
        WHERE {_IN_MONTH}
        UNION ALL
        SELECT 'Late-Delivery Severity by Customer State/City',
               count(DISTINCT (customer_state, customer_city, delivery_severity))
        FROM fct_orders WHERE {_IN_MONTH} AND customer_state IN ('asia', 'europe')
        UNION ALL
        SELECT 'Freight Ratio by Seller', count(*) FROM mart_seller_freight
        WHERE {_SELLER_MONTHS}
        UNION ALL
        SELECT 'Freight Ratio by Customer State', count(DISTINCT customer_state)
        FROM fct_orders WHERE {_IN_MONTH} AND customer_state IN ('asia', 'europe')""",
)

# What the cards of the filtered dashboard show, not just how many rows.
_CARDS: dict[str, tuple[str, str, dict[str, int]]] = {
    "severity_by_month": (
        "Late-Delivery Severity by Month",
        f"""SELECT {_MONTH_OF} AS month, delivery_severity, count(*) AS order_count
            FROM fct_orders WHERE {_IN_MONTH} GROUP BY ALL""",
        {},
    ),
    "slowest_sellers": (
        "On-Time Rate by Seller (Worst First)",
        f"""SELECT seller_id, seller_state, seller_city, on_time_rate, order_volume,
                   avg_review_score, time_period
            FROM mart_seller_performance WHERE order_volume >= 5 AND {_SELLER_MONTHS}
            ORDER BY on_time_rate, seller_id, time_period LIMIT 50""",
        _SELLER,
    ),
    "cost_by_month": ("Logistics Cost by Month", _COST_BY_MONTH % _IN_MONTH, _COST_DIGITS),
    "severity_by_place": (
        "Late-Delivery Severity by Customer State/City",
        _BY_PLACE % f"{_IN_MONTH} AND customer_state IN ('asia', 'europe')",
        {},
    ),
    "freight_by_seller": (
        "Freight Ratio by Seller",
        f"""SELECT seller_id, seller_state, seller_city, time_period, order_volume,
                   total_freight_value, freight_ratio
            FROM mart_seller_freight WHERE {_SELLER_MONTHS}""",
        _SELLER_FREIGHT,
    ),
    "freight_by_state": (
        "Freight Ratio by Customer State",
        f"""SELECT customer_state, avg(freight_ratio) AS avg_freight_ratio,
                   sum(total_freight_value) AS total_freight_value, count(*) AS order_count
            FROM fct_orders WHERE {_IN_MONTH} AND customer_state IN ('asia', 'europe')
            GROUP BY customer_state""",
        _digits("total_freight_value", "avg_freight_ratio"),
    ),
}
_FILTERS = reports.Filters(month=MONTH, customer_state=STATES, seller_id=SELLERS)
for _card, (_title, _sql, _card_digits) in _CARDS.items():
    _add(
        f"flt5_card_{_card}",
        lambda i, t=_title: reports.dashboard(i.models, "Problem Analysis", _FILTERS)[t],
        _sql,
        _card_digits,
    )
    _add(
        f"flt5_stored_card_{_card}",
        lambda i, t=_title: summary.dashboard(i.marts, "Problem Analysis", _FILTERS)[t],
        _sql,
        _card_digits,
    )

# Reports on one place or seller from the clustered copies.
_add(
    "rpt15_location_drill_down_by_place",
    lambda i: reports.location_drill_down(i.clustered["fct_orders_by_place"], CITY, STATES[0]),
    _LOCATION % f"customer_state = '{STATES[0]}' AND customer_city = '{CITY}'",
    _FREIGHT,
)
_add(
    "flt3_values_by_place",
    lambda i: reports.severity_by_place(i.clustered["fct_orders_by_place"], MONTH, STATES),
    _BY_PLACE % f"customer_state IN ('asia', 'europe') AND {_IN_MONTH}",
)
_add(
    "flt4_text_variable_by_place",
    lambda i: reports.location_drill_down(i.clustered["fct_orders_by_place"], state=STATES[0]),
    QUERIES["flt4_text_variable"].sql,
    _FREIGHT,
)
_add(
    "rpt9_slowest_sellers_by_seller",
    lambda i: reports.slowest_sellers(
        i.clustered["mart_seller_performance_by_seller"], seller_id=SELLERS, min_orders=1
    ),
    """SELECT seller_id, seller_state, seller_city, on_time_rate, order_volume,
              avg_review_score, time_period
       FROM mart_seller_performance WHERE order_volume >= 1 AND seller_id IN ('3', '7')
       ORDER BY on_time_rate, seller_id, time_period LIMIT 50""",
    _SELLER,
)
_add(
    "rpt17_freight_by_seller_clustered",
    lambda i: reports.freight_by_seller(
        i.clustered["mart_seller_freight_by_seller"], seller_id=SELLERS
    ),
    QUERIES["rpt17_freight_by_seller"].sql + " WHERE seller_id IN ('3', '7')",
    _SELLER_FREIGHT,
)

# --- insights ------------------------------------------------------------------

_add(
    "ins1_mean_scores",
    lambda i: insights.mean_scores(i.models.mart_logistics_performance_score),
    "SELECT " + ", ".join(f"avg({c}) AS {c}" for c in _COMPONENTS)
    + " FROM mart_logistics_performance_score",
    _COMPONENTS,
)
_add(
    "ins2_outcome_shares",
    lambda i: insights.outcome_shares(i.models.fct_orders),
    """SELECT avg(CAST(delivery_severity = 'On Time' AS INTEGER)) AS on_time,
              avg(CAST(delivery_severity = 'Delivery data unavailable' AS INTEGER)) AS unavailable,
              avg(CAST(delivery_severity = 'Canceled or unavailable' AS INTEGER))
                  AS canceled_or_unavailable
       FROM fct_orders""",
    _digits(rates="on_time unavailable canceled_or_unavailable"),
)
_add(
    "ins3_late_share_by_state",
    lambda i: insights.late_share_by_state(i.models.fct_orders),
    """SELECT customer_state,
              count(*) FILTER (WHERE delay_days >= 4) / nullif(count(delay_days), 0)
                  AS late_of_outcomes,
              count(*) FILTER (WHERE delay_days >= 4) / count(*) AS late_of_all,
              count(*) AS order_count
       FROM fct_orders GROUP BY customer_state""",
    _digits(rates="late_of_outcomes late_of_all"),
)
_add(
    "ins4_weakest_sellers",
    lambda i: insights.weakest_sellers(i.models.int_seller_performance_metrics),
    "SELECT * FROM int_seller_performance_metrics WHERE order_volume >= 50",
    _SELLER,
)
_add(
    "ins5_typical_freight_ratio",
    lambda i: insights.typical_freight_ratio(i.stored(i.models.fct_orders.select("freight_ratio"))),
    """SELECT avg(freight_ratio) AS mean_ratio,
              quantile_disc(freight_ratio, 0.5) AS median_ratio FROM fct_orders""",
    _digits(rates="mean_ratio median_ratio"),
)
_add(
    "ins6_review_by_severity",
    lambda i: insights.review_by_severity(i.models.fct_orders),
    """SELECT delivery_severity, avg(review_score) AS mean_review
       FROM fct_orders GROUP BY delivery_severity""",
    _digits(rates="mean_review"),
)
_add(
    "ins6_review_swing",
    lambda i: insights.review_swing(i.models.fct_orders),
    """SELECT max(m) - min(m) AS review_swing
       FROM (SELECT avg(review_score) AS m FROM fct_orders GROUP BY delivery_severity)""",
    _digits(rates="review_swing"),
)
_add(
    "ins7_freight_ratio_by_severity",
    lambda i: insights.freight_ratio_by_severity(i.models.fct_orders),
    """SELECT delivery_severity, avg(freight_ratio) AS mean_ratio
       FROM fct_orders GROUP BY delivery_severity""",
    _digits(rates="mean_ratio"),
)
_add(
    "ins8_score_spread",
    lambda i: insights.score_spread(i.models.mart_logistics_performance_score),
    """SELECT component, min(score) AS lowest, max(score) AS highest,
              stddev_samp(score) AS deviation
       FROM (UNPIVOT (SELECT * FROM mart_logistics_performance_score)
             ON delivery_score, customer_experience_score, logistics_cost_score, seller_score,
                final_score INTO NAME component VALUE score)
       GROUP BY component""",
    _digits(rates="lowest highest deviation"),
)
_add(
    "ins8_score_range_by_year",
    lambda i: insights.score_range_by_year(i.models.mart_logistics_performance_score),
    """SELECT CAST(year(order_month) AS INTEGER) AS year, min(final_score) AS lowest,
              max(final_score) AS highest
       FROM mart_logistics_performance_score GROUP BY 1""",
    _digits(rates="lowest highest"),
)

# --- checks --------------------------------------------------------------------

_GENERIC_FAULTS = {
    "not_null": planted.null_faults(checks.NOT_NULL),
    "unique": planted.twice_faults(checks.UNIQUE),
    "accepted_values": planted.value_faults(checks.ACCEPTED_VALUES),
    "relationships": planted.orphan_faults(checks.RELATIONSHIPS),
    "accepted_range": planted.range_faults(checks.ACCEPTED_RANGE),
    "unique_combination": planted.twice_faults(checks.UNIQUE_COMBINATION),
    "equal_rowcount": planted.missing_faults(*checks.EQUAL_ROWCOUNT),
}

# Every check runs on the tables as they are and on tables with faults that it must find.
for _key, _sql in CONSTRAINTS.items():
    _kind = _key.split("_", 1)[1]
    _faults = _GENERIC_FAULTS[_kind]
    _add(_key, lambda i, kind=_kind: checks.GENERIC[kind](i.everything), _sql)
    QUERIES[f"{_key}_planted"] = Query(
        lambda i, kind=_kind, f=_faults: checks.GENERIC[kind](planted.Planted(i.everything, f)),
        _sql,
        faults=_faults,
    )


def _purchase_days_only(i: Inputs) -> DataFrame:
    def bought() -> DataFrame:
        return observed_range(i.staged["stg_orders"], "order_purchase_timestamp")

    return checks.calendar_gaps(Models(i.staged, bought))


def _check(name: str, check: str, sql: str, digits=None) -> None:
    find, faults = checks.SINGULAR[check].violations, planted.SINGULAR_FAULTS.get(check)
    _add(name, lambda i: find(i.models), sql, digits)
    if faults:
        QUERIES[f"{name}_planted"] = Query(
            lambda i: find(planted.Planted(i.models, faults)), sql, digits or {}, faults
        )


# A calendar that ends with the last purchase misses the later deliveries.
_add(
    "chk8_calendar_gaps",
    _purchase_days_only,
    """SELECT DISTINCT day AS missing_date FROM order_days
       WHERE day < (SELECT CAST(min(order_purchase_timestamp) AS DATE) FROM stg_orders)
          OR day > (SELECT CAST(max(order_purchase_timestamp) AS DATE) FROM stg_orders)""",
)
_check(
    "chk9_item_fact_differences",
    "item_fact_differences",
    """SELECT order_id, order_item_id,
              CASE WHEN stg_rows > fct_rows THEN price END AS stg_price,
              CASE WHEN stg_rows > fct_rows THEN freight_value END AS stg_freight_value,
              CASE WHEN stg_rows < fct_rows THEN price END AS fct_price,
              CASE WHEN stg_rows < fct_rows THEN freight_value END AS fct_freight_value,
              stg_rows, fct_rows
       FROM (SELECT order_id, order_item_id, price, freight_value,
                    count(*) FILTER (WHERE side = 's') AS stg_rows,
                    count(*) FILTER (WHERE side = 'f') AS fct_rows
             FROM (SELECT 's' AS side, * FROM stg_order_items
                   UNION ALL SELECT 'f' AS side, * FROM fct_order_items)
             GROUP BY order_id, order_item_id, price, freight_value)
       WHERE stg_rows <> fct_rows""",
)
_check(
    "chk10_experience_orphans",
    "experience_orphans",
    """SELECT order_id FROM int_customer_experience_metrics
       WHERE order_id NOT IN (SELECT order_id FROM int_order_delivery_metrics)""",
)
_check(
    "chk11_invalid_review_scores",
    "invalid_review_scores",
    """SELECT order_id, review_score FROM int_customer_experience_metrics
       WHERE review_score < 1 OR review_score > 5""",
)
_check(
    "chk12_experience_rowcount",
    "experience_rowcount",
    """SELECT * FROM (SELECT count(*) AS int_cnt FROM int_customer_experience_metrics),
                     (SELECT count(*) AS delivery_cnt FROM int_order_delivery_metrics)
       WHERE int_cnt <> delivery_cnt""",
)
_check(
    "chk13_impossible_dates",
    "impossible_dates",
    """SELECT order_id, order_purchase_timestamp, order_delivered_customer_date
       FROM int_order_delivery_metrics
       WHERE order_delivered_customer_date < order_purchase_timestamp""",
)
_check(
    "chk14_delivery_rowcount",
    "delivery_rowcount",
    """SELECT * FROM (SELECT count(*) AS int_cnt FROM int_order_delivery_metrics),
                     (SELECT count(*) AS stg_cnt FROM stg_orders)
       WHERE int_cnt <> stg_cnt""",
)
_check(
    "chk15_inconsistent_severity",
    "inconsistent_severity",
    """SELECT order_id, delay_days, severity FROM int_order_delivery_metrics
       WHERE severity IS DISTINCT FROM
             CASE WHEN delay_days IS NULL AND severity = 'Canceled or unavailable' THEN severity
                  WHEN delay_days IS NULL THEN 'Delivery data unavailable'
                  WHEN delay_days <= 0 THEN 'On Time' WHEN delay_days < 4 THEN '1-3 days late'
                  WHEN delay_days < 8 THEN '4-7 days late' ELSE '8+ days late' END""",
)
_check(
    "chk16_negative_freight_ratio",
    "negative_freight_ratio",
    "SELECT order_id, freight_ratio FROM int_order_freight_metrics WHERE freight_ratio < 0",
    _digits(rates="freight_ratio"),
)
_check(
    "chk17_freight_rowcount",
    "freight_rowcount",
    """SELECT * FROM (SELECT count(*) AS int_cnt FROM int_order_freight_metrics),
                     (SELECT count(DISTINCT order_id) AS stg_cnt FROM stg_order_items)
       WHERE int_cnt <> stg_cnt""",
)
_check(
    "chk18_freight_sums",
    "freight_sums",
    """SELECT order_id, exp_price, total_price, exp_freight, total_freight_value
       FROM (SELECT order_id, sum(price) AS exp_price, sum(freight_value) AS exp_freight
             FROM stg_order_items GROUP BY order_id)
       FULL JOIN int_order_freight_metrics USING (order_id)
       WHERE round(exp_price, 2) IS DISTINCT FROM round(total_price, 2)
          OR round(exp_freight, 2) IS DISTINCT FROM round(total_freight_value, 2)""",
    _digits("exp_price total_price exp_freight total_freight_value"),
)
_check(
    "chk19_seller_ratio_expression",
    "seller_ratio_expression",
    """SELECT seller_id, time_period, total_price, total_freight_value, freight_ratio
       FROM int_seller_freight_metrics
       WHERE (total_price = 0) <> (freight_ratio IS NULL)
          OR abs(freight_ratio * total_price - total_freight_value) > 1e-6""",
    _FREIGHT,
)
_check(
    "chk20_seller_sums",
    "seller_sums",
    """SELECT seller_id, time_period, exp_price, total_price, exp_freight, total_freight_value,
              exp_orders, order_volume
       FROM (SELECT seller_id, time_period, sum(price) AS exp_price,
                    sum(freight_value) AS exp_freight, count(DISTINCT order_id) AS exp_orders
             FROM dated_items GROUP BY ALL)
       FULL JOIN int_seller_freight_metrics USING (seller_id, time_period)
       WHERE round(exp_price, 2) IS DISTINCT FROM round(total_price, 2)
          OR round(exp_freight, 2) IS DISTINCT FROM round(total_freight_value, 2)
          OR exp_orders IS DISTINCT FROM order_volume""",
    _digits("exp_price total_price exp_freight total_freight_value"),
)
_check(
    "chk21_on_time_rate_range",
    "on_time_rate_range",
    """SELECT seller_id, on_time_rate FROM int_seller_performance_metrics
       WHERE on_time_rate NOT BETWEEN 0 AND 1""",
)
_check(
    "chk22_order_volume_positive",
    "order_volume_positive",
    """SELECT seller_id, order_volume FROM int_seller_performance_metrics
       WHERE coalesce(order_volume, 0) < 1""",
)
_check(
    "chk23_seller_grain_differences",
    "seller_grain_differences",
    """SELECT seller_id, time_period, in_freight, in_perf
       FROM (SELECT seller_id, time_period, 1 AS in_freight FROM mart_seller_freight)
       FULL JOIN (SELECT seller_id, time_period, 1 AS in_perf FROM mart_seller_performance)
            USING (seller_id, time_period)
       WHERE in_freight IS NULL OR in_perf IS NULL""",
)

# --- checks counted by the writes, and builds that they stop ----------------------

_CHECKS_OF_ROWS = {"chk1_not_null", "chk3_accepted_values", "chk5_accepted_range"}
_SINGULAR_SQL = {
    key.split("_", 1)[1]: query.sql
    for key, query in QUERIES.items()
    if key.startswith("chk") and key.split("_", 1)[1] in checks.SINGULAR
}


def _generic_findings(keys) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{key.split("_", 1)[1]}' AS "check", table_name || '.' || column_name AS target,
                   'error' AS level, violations FROM ({CONSTRAINTS[key]})"""
        for key in keys
    )


def _singular_findings(names) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", '' AS target, '{checks.SINGULAR[name].level}' AS level,
                   count(*) AS violations FROM ({_SINGULAR_SQL[name]})"""
        for name in names
    )


#: Every fault that a row shows by itself, in one set of tables; a column has one kind of fault.
_ROW_FAULTS = {
    table: planted.Fault(
        {
            column: cases
            for kind in ("not_null", "accepted_values", "accepted_range")
            for column, cases in _GENERIC_FAULTS[kind].get(table, planted.Fault()).values.items()
        }
    )
    for table in {*checks.NOT_NULL, *checks.ACCEPTED_VALUES, *checks.ACCEPTED_RANGE}
}


def _counted_while_stored(i: Inputs) -> DataFrame:
    """Findings of the checks of single rows, counted by the writes of tables with faults."""
    counted, faulty = CountedRows(), planted.Planted(i.everything, _ROW_FAULTS)
    raw = {t[4:]: faulty[t] for t in _ROW_FAULTS if t.startswith("raw.")}
    import_raw(raw, i.scratch(), counted)
    for table in _ROW_FAULTS:
        if not table.startswith("raw."):
            i.stored(counted.watch(table, faulty[table], checks.row_conditions(table)))
    schema = "check string, target string, level string, violations long"
    # row numbers would compare tables that this query stores with different faults
    findings = [
        f for f in checks.counted_findings(counted)
        if f[0] in checks.ROW_CHECKS or f"{f[1]}".split(".")[-1] != "*" and f[1]
    ]
    return i.spark.createDataFrame(findings, schema)


QUERIES["snk4_counted_while_stored"] = Query(
    _counted_while_stored,
    f"{_generic_findings(sorted(_CHECKS_OF_ROWS))} UNION ALL {_singular_findings(checks.ROW_CHECKS)}",
    faults=_ROW_FAULTS,
)

_UNSOUND = {
    "stg_order_items": planted.Fault(
        {"price": [("# % 7 = 1", "CAST(-1 AS DOUBLE)")], "seller_id": [("# % 97 = 2", "'nobody'")]},
        twice="# % 89 = 3",
    ),
    "stg_order_reviews": planted.Fault({"review_score": [("# % 7 = 4", "CAST(9 AS SMALLINT)")]}),
}


def _refused(i: Inputs) -> DataFrame:
    """All findings of a build over faulty staging tables, which must not be published."""
    faulty = planted.Planted(i.staged, _UNSOUND)
    staged = LazyTables({t: lambda t=t: faulty[t] for t in i.staged})
    models = Models(staged, lambda: observed_range(staged["stg_orders"], *ORDER_DATES))
    try:
        build_and_check(models, i.raw, i.scratch())
    except ChecksFailed as refused:
        return refused.findings
    raise AssertionError("a build with violations was published")


QUERIES["snk5_refused_build"] = Query(
    _refused,
    f"""{_generic_findings(CONSTRAINTS)}
        UNION ALL {_singular_findings(n for n in checks.SINGULAR if n != "calendar_gaps")}
        UNION ALL SELECT 'calendar_gaps', '', 'error', count(*) FROM order_days
        WHERE day < (SELECT min(date_day) FROM dim_date) OR day > (SELECT max(date_day) FROM dim_date)""",
    sources=_UNSOUND,
)
