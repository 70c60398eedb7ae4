"""The shop tables as of an earlier load, so that a refresh finds months that changed since.

What differs is stated by key and month, as SQL that Spark and DuckDB both read:
orders of 1996-02 with a key divisible by 3 had not come in, items of 1997-05 cost less,
reviews of 1998-08 had not been written, and some orders of 1999-11 were still dated
2031-01, a month that is gone afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard import Models
from parcelyard.lazy import LazyTables
from parcelyard.plans.models import STAGING

_BOUGHT = "order_purchase_timestamp"


def _in(month: str, column: str = _BOUGHT) -> str:
    return f"date_trunc('month', {column}) = DATE '{month}-01'"


MISSING = f"{_in('1996-02')} AND CAST(order_id AS BIGINT) % 3 = 0"
CHEAPER = _in("1997-05")
UNREVIEWED = _in("1998-08")
MISDATED = f"{_in('1999-11')} AND CAST(order_id AS BIGINT) % 2 = 0"

#: Months a refresh has to build or drop, with the orders that are in them now.
CHANGED_SQL = f"""
    SELECT * FROM (WITH dated AS (
        SELECT o.order_id, CAST(date_trunc('month', {_BOUGHT}) AS DATE) AS order_month,
               ({MISSING}) AS missing, ({CHEAPER}) AS cheaper, ({UNREVIEWED}) AS unreviewed,
               ({MISDATED}) AS misdated
        FROM stg_orders o
    ),
    touched AS (
        SELECT order_month FROM dated WHERE missing OR misdated
        UNION SELECT order_month FROM dated JOIN stg_order_items USING (order_id) WHERE cheaper
        UNION SELECT order_month FROM dated JOIN stg_order_reviews r USING (order_id)
              WHERE unreviewed AND r.review_score IS NOT NULL
    )
    SELECT order_month, count(*) AS orders FROM dated
    WHERE order_month IN (SELECT order_month FROM touched) GROUP BY order_month
    UNION ALL
    SELECT DATE '2031-01-01', 0 WHERE EXISTS (SELECT 1 FROM dated WHERE misdated))"""


def earlier(models: Models) -> Models:
    """``models`` over the tables as they were before."""
    now = models["stg_orders"]

    def of(condition: str) -> DataFrame:
        return now.filter(condition).select("order_id").distinct()

    def items() -> DataFrame:
        cheaper = of(CHEAPER).withColumn("_less", F.lit(1.0))
        joined = models["stg_order_items"].join(cheaper, "order_id", "left")
        less = F.col("price") - F.coalesce(F.col("_less"), F.lit(0.0))
        return joined.withColumn("price", less).drop("_less")

    placed = F.when(F.expr(MISDATED), F.expr("TIMESTAMP_NTZ '2031-01-05 00:00:00'")).otherwise(F.col(_BOUGHT))
    before = {
        "stg_orders": lambda: now.filter(f"NOT coalesce({MISSING}, false)").withColumn(_BOUGHT, placed),
        "stg_order_items": items,
        "stg_order_reviews": lambda: models["stg_order_reviews"].join(of(UNREVIEWED), "order_id", "left_anti"),
    }
    others = {name: lambda n=name: models[n] for name in STAGING if name not in before}
    return Models(LazyTables(others | before), models.calendar)
