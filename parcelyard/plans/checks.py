"""Declared constraints and reconciliation checks over all tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard import schema as S
from parcelyard.functions.metrics import month_start
from parcelyard.operators import constraints as C
from parcelyard.operators.compare import count_mismatch, differing_rows
from parcelyard.operators.observed import CountedRows
from parcelyard.released import released

# The declared constraints, by table. ``raw.`` tables are the
# unparsed sources.
NOT_NULL: dict[str, list[str]] = {
    "raw.orders": ["order_id"],
    "raw.order_items": ["order_id", "order_item_id"],
    "raw.order_payments": ["order_id"],
    "raw.order_reviews": ["order_id", "review_id"],
    "raw.customers": ["customer_id"],
    "raw.sellers": ["seller_id"],
    "raw.products": ["product_id"],
    "raw.geolocation": ["geolocation_zip_code_prefix"],
    "raw.product_category_name_translation": ["product_category_name"],
    "stg_customers": ["customer_id", "customer_unique_id"],
    "stg_geolocation": ["zip_code_prefix"],
    "stg_order_items": ["order_id", "order_item_id", "product_id", "seller_id"],
    "stg_order_payments": ["order_id", "payment_sequential"],
    "stg_order_reviews": ["order_id"],
    "stg_orders": ["order_id", "order_purchase_timestamp"],
    "stg_product_category_translation": [
        "product_category_name",
        "product_category_name_english",
    ],
    "stg_products": ["product_id"],
    "stg_sellers": ["seller_id"],
    "int_order_delivery_metrics": ["order_id", "order_status"],
    "int_order_freight_metrics": ["order_id"],
    "int_customer_experience_metrics": ["order_id"],
    "int_seller_performance_metrics": ["seller_id"],
    "int_seller_freight_metrics": ["seller_id", "time_period"],
    "int_data_quality_flags": ["order_month"],
    "dim_customer": ["customer_unique_id"],
    "dim_date": ["date_day"],
    "dim_location": ["zip_code_prefix"],
    "dim_product": ["product_id"],
    "dim_seller": ["seller_id"],
    "fct_order_items": ["order_id", "order_item_id", "product_id", "seller_id"],
    "fct_orders": ["order_id"],
    "mart_data_quality": ["order_month"],
    "mart_logistics_performance_score": [
        "order_month",
        "final_score",
        "order_count",
        "delivery_coverage",
    ],
    "mart_seller_freight": ["seller_id", "time_period"],
    "mart_seller_performance": ["seller_id", "time_period"],
}
UNIQUE: dict[str, str] = {
    "raw.orders": "order_id",
    "raw.customers": "customer_id",
    "raw.sellers": "seller_id",
    "raw.products": "product_id",
    "raw.product_category_name_translation": "product_category_name",
    "stg_customers": "customer_id",
    "stg_geolocation": "zip_code_prefix",
    "stg_order_reviews": "order_id",
    "stg_orders": "order_id",
    "stg_product_category_translation": "product_category_name",
    "stg_products": "product_id",
    "stg_sellers": "seller_id",
    "int_order_delivery_metrics": "order_id",
    "int_order_freight_metrics": "order_id",
    "int_customer_experience_metrics": "order_id",
    "int_seller_performance_metrics": "seller_id",
    "int_data_quality_flags": "order_month",
    "dim_customer": "customer_unique_id",
    "dim_date": "date_day",
    "dim_location": "zip_code_prefix",
    "dim_product": "product_id",
    "dim_seller": "seller_id",
    "fct_orders": "order_id",
    "mart_data_quality": "order_month",
    "mart_logistics_performance_score": "order_month",
}
_SCORES = [1, 2, 3, 4, 5]
ACCEPTED_VALUES: dict[str, dict[str, list]] = {
    "stg_order_reviews": {"review_score": _SCORES},
    "int_order_delivery_metrics": {
        "order_status": S.ORDER_STATUSES,
        "severity": [*S.DATED_SEVERITIES, *S.NO_OUTCOME],
    },
    "int_customer_experience_metrics": {"review_score": _SCORES},
    "dim_date": {
        "month_name": [
            "January",
            "February",
            "March",
            "April",
            "May",
            "June",
            "July",
            "August",
            "September",
            "October",
            "November",
            "December",
        ],
        "day_of_week": [1, 2, 3, 4, 5, 6, 7],
        "is_weekend": [0, 1],
    },
}
RELATIONSHIPS: list[tuple[str, str, str, str]] = [
    ("fct_order_items", "order_id", "fct_orders", "order_id"),
    ("fct_order_items", "product_id", "dim_product", "product_id"),
    ("fct_order_items", "seller_id", "dim_seller", "seller_id"),
    ("fct_orders", "customer_unique_id", "dim_customer", "customer_unique_id"),
    ("mart_seller_freight", "seller_id", "dim_seller", "seller_id"),
    ("mart_seller_performance", "seller_id", "dim_seller", "seller_id"),
]
_CHILDREN = list(dict.fromkeys(child for child, *_ in RELATIONSHIPS))
_SHARES = {
    "pct_orders_unavailable_delivery_data": (0, 1),
    "pct_orders_canceled_or_unavailable": (0, 1),
    "pct_orders_missing_review": (0, 1),
    "pct_orders_impossible_date_ordering": (0, 1),
}
ACCEPTED_RANGE: dict[str, dict[str, tuple[float | None, float | None]]] = {
    "stg_order_items": {"price": (0, None), "freight_value": (0, None)},
    "stg_order_payments": {"payment_value": (0, None)},
    "int_seller_freight_metrics": {
        "total_price": (0, None),
        "total_freight_value": (0, None),
        "freight_ratio": (0, None),
    },
    "int_data_quality_flags": _SHARES,
    "mart_data_quality": _SHARES,
    "mart_logistics_performance_score": {
        "final_score": (0, 100),
        "order_count": (1, None),
        "delivery_coverage": (0, 1),
    },
    "mart_seller_freight": {"freight_ratio": (0, None)},
    "mart_seller_performance": {"on_time_rate": (0, 1)},
}
UNIQUE_COMBINATION: dict[str, list[str]] = {
    "raw.order_items": ["order_id", "order_item_id"],
    "stg_order_items": ["order_id", "order_item_id"],
    "stg_order_payments": ["order_id", "payment_sequential"],
    "int_seller_freight_metrics": ["seller_id", "time_period"],
    "fct_order_items": ["order_id", "order_item_id"],
    "mart_seller_freight": ["seller_id", "time_period"],
    "mart_seller_performance": ["seller_id", "time_period"],
}
EQUAL_ROWCOUNT: dict[str, str] = {
    "fct_orders": "stg_orders",
    "fct_order_items": "stg_order_items",
}

Tables = Mapping[str, DataFrame]


class WithRaw:
    """Tables plus their raw sources under ``raw.<name>``."""

    def __init__(self, tables: Tables, raw: Tables):
        self._tables, self._raw = tables, raw

    def __getitem__(self, name: str) -> DataFrame:
        return self._raw[name[4:]] if name.startswith("raw.") else self._tables[name]


def _stacked(results: list[tuple[str, DataFrame]]) -> DataFrame:
    named = [
        df.select(F.lit(table).alias("table_name"), "column_name", "violations")
        for table, df in results
    ]
    return reduce(DataFrame.unionAll, named)


def _counted(table: str, columns: str, broken: DataFrame, amount: Column) -> tuple[str, DataFrame]:
    total = broken.agg(F.coalesce(amount, F.lit(0)).alias("violations"))
    return table, total.withColumn("column_name", F.lit(columns))


def not_null_counts(t: Tables, only: Collection[str] = NOT_NULL) -> DataFrame:
    """CHK1: missing values per declared column, one scan per table."""
    return _stacked(
        [
            (table, C.count_by_condition(t[table], [(c, C.null_condition(c)) for c in columns]))
            for table, columns in NOT_NULL.items()
            if table in only
        ]
    )


def unique_counts(t: Tables, only: Collection[str] = UNIQUE) -> DataFrame:
    """CHK2: repeated values per declared key."""
    return _stacked(
        [
            _counted(table, column, C.unique(t[table], column), F.count("*"))
            for table, column in UNIQUE.items()
            if table in only
        ]
    )


def accepted_values_counts(t: Tables, only: Collection[str] = ACCEPTED_VALUES) -> DataFrame:
    """CHK3: rows outside the declared lists, one scan per table."""
    return _stacked(
        [
            (
                table,
                C.count_by_condition(
                    t[table], [(c, C.values_condition(c, v)) for c, v in columns.items()]
                ),
            )
            for table, columns in ACCEPTED_VALUES.items()
            if table in only
        ]
    )


def relationships_counts(t: Tables, only: Collection[str] = _CHILDREN) -> DataFrame:
    """CHK4: rows whose declared foreign key has no parent."""
    return _stacked(
        [
            _counted(
                child, column, C.relationships(t[child], column, t[parent], field), F.sum("n_rows")
            )
            for child, column, parent, field in RELATIONSHIPS
            if child in only
        ]
    )


def accepted_range_counts(t: Tables, only: Collection[str] = ACCEPTED_RANGE) -> DataFrame:
    """CHK5: rows outside the declared ranges, one scan per table."""
    return _stacked(
        [
            (
                table,
                C.count_by_condition(
                    t[table], [(c, C.range_condition(c, *ends)) for c, ends in columns.items()]
                ),
            )
            for table, columns in ACCEPTED_RANGE.items()
            if table in only
        ]
    )


def unique_combination_counts(t: Tables, only: Collection[str] = UNIQUE_COMBINATION) -> DataFrame:
    """CHK6: repeated combinations per declared grain."""
    return _stacked(
        [
            _counted(
                table, ", ".join(columns), C.unique_combination(t[table], columns), F.count("*")
            )
            for table, columns in UNIQUE_COMBINATION.items()
            if table in only
        ]
    )


def equal_rowcount_counts(t: Tables, only: Collection[str] = EQUAL_ROWCOUNT) -> DataFrame:
    """CHK7: rows by which two tables that should match differ."""
    return _stacked(
        [
            _counted(
                table,
                "*",
                C.equal_rowcount(t[table], t[other]),
                F.sum(F.abs(F.col("row_count") - F.col("other_count"))),
            )
            for table, other in EQUAL_ROWCOUNT.items()
            if table in only
        ]
    )


GENERIC: dict[str, Callable[[Tables], DataFrame]] = {
    "not_null": not_null_counts,
    "unique": unique_counts,
    "accepted_values": accepted_values_counts,
    "relationships": relationships_counts,
    "accepted_range": accepted_range_counts,
    "unique_combination": unique_combination_counts,
    "equal_rowcount": equal_rowcount_counts,
}


def differs(left: Column, right: Column, tolerance: float = 1e-9) -> Column:
    """True unless both are null or agree up to the rounding of a float sum."""
    scale = F.greatest(F.abs(left), F.abs(right), F.lit(1.0))
    return F.coalesce(F.abs(left - right) > tolerance * scale, ~left.eqNullSafe(right))


def calendar_gaps(t: Tables) -> DataFrame:
    """CHK8: order dates that the calendar lacks."""
    dates = F.array(
        *[
            F.to_date(c)
            for c in (
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            )
        ]
    )
    used = t["stg_orders"].select(F.explode(dates).alias("missing_date"))
    known = t["dim_date"].select(F.col("date_day").alias("missing_date"))
    return (
        used.filter("missing_date is not null").distinct().join(known, "missing_date", "left_anti")
    )


def item_fact_differences(t: Tables) -> DataFrame:
    """CHK9: item rows that staging and the fact hold a different number of times.

    One row for each differing content, with its counts. The money stands on the side
    that holds more of it, so a changed price shows as two rows.
    """
    keys, values = ["order_id", "order_item_id"], ["price", "freight_value"]
    broken = differing_rows(t["stg_order_items"], t["fct_order_items"], keys, values)
    in_stg = F.col("left_rows") > F.col("right_rows")
    sides = {"stg_price": "price", "stg_freight_value": "freight_value"}
    return broken.select(
        *keys,
        *[F.when(in_stg, F.col(c)).alias(name) for name, c in sides.items()],
        *[F.when(~in_stg, F.col(c)).alias(name.replace("stg", "fct")) for name, c in sides.items()],
        F.col("left_rows").alias("stg_rows"),
        F.col("right_rows").alias("fct_rows"),
    )


def experience_orphans(t: Tables) -> DataFrame:
    """CHK10: orders with experience metrics but no delivery metrics."""
    return (
        t["int_customer_experience_metrics"]
        .select("order_id")
        .join(t["int_order_delivery_metrics"].select("order_id"), "order_id", "left_anti")
    )


def _invalid_review_score() -> Column:
    return C.values_condition("review_score", _SCORES)


def invalid_review_scores(t: Tables) -> DataFrame:
    """CHK11: review scores outside 1 to 5."""
    return (
        t["int_customer_experience_metrics"]
        .filter(_invalid_review_score())
        .select("order_id", "review_score")
    )


def experience_rowcount(t: Tables) -> DataFrame:
    """CHK12: experience and delivery metrics differ in rows."""
    return count_mismatch(
        t["int_customer_experience_metrics"],
        t["int_order_delivery_metrics"],
        "int_cnt",
        "delivery_cnt",
    )


def _impossible_date() -> Column:
    return F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp")


def impossible_dates(t: Tables) -> DataFrame:
    """CHK13: delivered before purchased."""
    return (
        t["int_order_delivery_metrics"]
        .filter(_impossible_date())
        .select("order_id", "order_purchase_timestamp", "order_delivered_customer_date")
    )


def delivery_rowcount(t: Tables) -> DataFrame:
    """CHK14: delivery metrics and orders differ in rows."""
    return count_mismatch(
        t["int_order_delivery_metrics"], t["stg_orders"], "int_cnt", "stg_cnt"
    )


def _wrong_severity() -> Column:
    days, sev = F.col("delay_days"), F.col("severity")
    implied = (
        F.when(days.isNull(), sev.isin(S.NO_OUTCOME))
        .when(days <= 0, sev == S.ON_TIME)
        .when(days <= 3, sev == S.LATE_1_3)
        .when(days <= 7, sev == S.LATE_4_7)
        .otherwise(sev == S.LATE_8_UP)
    )
    return ~F.coalesce(implied, F.lit(False))


def inconsistent_severity(t: Tables) -> DataFrame:
    """CHK15: severity that does not follow from the delay."""
    return (
        t["int_order_delivery_metrics"]
        .filter(_wrong_severity())
        .select("order_id", "delay_days", "severity")
    )


def _negative_ratio() -> Column:
    return C.range_condition("freight_ratio", low=0)


def negative_freight_ratio(t: Tables) -> DataFrame:
    """CHK16: freight ratio below zero."""
    return (
        t["int_order_freight_metrics"].filter(_negative_ratio()).select("order_id", "freight_ratio")
    )


def freight_rowcount(t: Tables) -> DataFrame:
    """CHK17: freight metrics and distinct orders among the items differ in rows."""
    ordered = t["stg_order_items"].select("order_id").filter("order_id is not null").distinct()
    return count_mismatch(t["int_order_freight_metrics"], ordered, "int_cnt", "stg_cnt")


def freight_sums(t: Tables) -> DataFrame:
    """CHK18: order money that does not add up to its items."""
    expected = (
        t["stg_order_items"]
        .groupBy("order_id")
        .agg(F.sum("price").alias("exp_price"), F.sum("freight_value").alias("exp_freight"))
        .withColumn("in_items", F.lit(True))
    )
    actual = t["int_order_freight_metrics"].select(
        "order_id", "total_price", "total_freight_value", F.lit(True).alias("in_metrics")
    )
    return (
        expected.join(actual, "order_id", "full")
        .filter(
            F.col("in_items").isNull()
            | F.col("in_metrics").isNull()
            | differs(F.col("exp_price"), F.col("total_price"))
            | differs(F.col("exp_freight"), F.col("total_freight_value"))
        )
        .select("order_id", "exp_price", "total_price", "exp_freight", "total_freight_value")
    )


def _wrong_ratio() -> Column:
    price, freight, ratio = (
        F.col(c) for c in ("total_price", "total_freight_value", "freight_ratio")
    )
    wrong = F.when(price == 0, ratio.isNotNull()).otherwise(
        ratio.isNull() | (F.abs(ratio - freight / F.nullif(price, F.lit(0.0))) > 1e-9)
    )
    return price.isNotNull() & wrong


def seller_ratio_expression(t: Tables) -> DataFrame:
    """CHK19: seller freight ratio that is not freight over price."""
    return (
        t["int_seller_freight_metrics"]
        .filter(_wrong_ratio())
        .select("seller_id", "time_period", "total_price", "total_freight_value", "freight_ratio")
    )


def seller_sums(t: Tables) -> DataFrame:
    """CHK20: seller month money or volume that does not add up to the items."""
    keys = ["seller_id", "time_period"]
    bought = t["int_order_delivery_metrics"].filter("order_purchase_timestamp is not null").select(
        "order_id", month_start(F.col("order_purchase_timestamp")).alias("time_period")
    )
    # Items are summed per order and seller before the join, so a seller or order
    # that holds much of the table arrives as partial sums.
    parts = (
        t["stg_order_items"]
        .filter("seller_id is not null")
        .groupBy("seller_id", "order_id")
        .agg(F.sum("price").alias("price"), F.sum("freight_value").alias("freight"))
    )
    expected = (
        parts.join(bought, "order_id")
        .groupBy(*keys)
        .agg(
            F.sum("price").alias("exp_price"),
            F.sum("freight").alias("exp_freight"),
            F.count("order_id").alias("exp_orders"),
        )
    )
    actual = t["int_seller_freight_metrics"].select(
        *keys, "total_price", "total_freight_value", "order_volume"
    )
    return (
        expected.join(actual, keys, "full")
        .filter(
            ~F.col("exp_orders").eqNullSafe(F.col("order_volume"))
            | differs(F.col("exp_price"), F.col("total_price"))
            | differs(F.col("exp_freight"), F.col("total_freight_value"))
        )
        .select(
            *keys,
            "exp_price",
            "total_price",
            "exp_freight",
            "total_freight_value",
            "exp_orders",
            "order_volume",
        )
    )


def _rate_outside() -> Column:
    return C.range_condition("on_time_rate", low=0, high=1)


def on_time_rate_range(t: Tables) -> DataFrame:
    """CHK21: on-time rate outside 0 to 1."""
    return (
        t["int_seller_performance_metrics"]
        .filter(_rate_outside())
        .select("seller_id", "on_time_rate")
    )


def _no_orders() -> Column:
    return F.col("order_volume").isNull() | (F.col("order_volume") <= 0)


def order_volume_positive(t: Tables) -> DataFrame:
    """CHK22: seller without orders."""
    return (
        t["int_seller_performance_metrics"]
        .filter(_no_orders())
        .select("seller_id", "order_volume")
    )


def seller_grain_differences(t: Tables) -> DataFrame:
    """CHK23: seller months that only one of the two seller marts holds."""
    keys = ["seller_id", "time_period"]
    freight = t["mart_seller_freight"].select(*keys, F.lit(1).alias("in_freight"))
    performance = t["mart_seller_performance"].select(*keys, F.lit(1).alias("in_perf"))
    return freight.join(performance, keys, "full").filter(
        "in_freight is null or in_perf is null"
    )


@dataclass(frozen=True)
class Check:
    """A reconciliation check; ``warn`` findings are reported but do not fail a run."""

    violations: Callable[[Tables], DataFrame]
    level: str = "error"


SINGULAR: dict[str, Check] = {
    "calendar_gaps": Check(calendar_gaps),
    "item_fact_differences": Check(item_fact_differences),
    "experience_orphans": Check(experience_orphans),
    "invalid_review_scores": Check(invalid_review_scores),
    "experience_rowcount": Check(experience_rowcount),
    "impossible_dates": Check(impossible_dates, level="warn"),
    "delivery_rowcount": Check(delivery_rowcount),
    "inconsistent_severity": Check(inconsistent_severity),
    "negative_freight_ratio": Check(negative_freight_ratio),
    "freight_rowcount": Check(freight_rowcount),
    "freight_sums": Check(freight_sums),
    "seller_ratio_expression": Check(seller_ratio_expression),
    "seller_sums": Check(seller_sums),
    "on_time_rate_range": Check(on_time_rate_range),
    "order_volume_positive": Check(order_volume_positive),
    "seller_grain_differences": Check(seller_grain_differences),
}


#: Reconciliation checks that look at one row at a time: table and condition of a violation.
ROW_CHECKS: dict[str, tuple[str, Callable[[], Column]]] = {
    "invalid_review_scores": ("int_customer_experience_metrics", _invalid_review_score),
    "impossible_dates": ("int_order_delivery_metrics", _impossible_date),
    "inconsistent_severity": ("int_order_delivery_metrics", _wrong_severity),
    "negative_freight_ratio": ("int_order_freight_metrics", _negative_ratio),
    "seller_ratio_expression": ("int_seller_freight_metrics", _wrong_ratio),
    "on_time_rate_range": ("int_seller_performance_metrics", _rate_outside),
    "order_volume_positive": ("int_seller_performance_metrics", _no_orders),
}
#: Reconciliation checks that compare the rows of two tables.
ROWCOUNT_CHECKS: dict[str, tuple[str, str]] = {
    "experience_rowcount": ("int_customer_experience_metrics", "int_order_delivery_metrics"),
    "delivery_rowcount": ("int_order_delivery_metrics", "stg_orders"),
}


def row_conditions(table: str) -> dict[tuple[str, str], Column]:
    """(check, target) and condition of each violation that a row of ``table`` shows by itself."""
    found = {("not_null", c): C.null_condition(c) for c in NOT_NULL.get(table, [])}
    for column, values in ACCEPTED_VALUES.get(table, {}).items():
        found[("accepted_values", column)] = C.values_condition(column, values)
    for column, ends in ACCEPTED_RANGE.get(table, {}).items():
        found[("accepted_range", column)] = C.range_condition(column, *ends)
    named = {(kind, f"{table}.{column}"): cond for (kind, column), cond in found.items()}
    return named | {
        (name, ""): condition() for name, (of, condition) in ROW_CHECKS.items() if of == table
    }


Finding = tuple[str, str, str, int]


def counted_findings(counted: CountedRows) -> list[Finding]:
    """(check, target, level, violations) of all checks that the counts of written tables decide."""
    tables = {*NOT_NULL, *ACCEPTED_VALUES, *ACCEPTED_RANGE, *(t for t, _ in ROW_CHECKS.values())}
    found = []
    for table in sorted(tables):
        if table in counted:
            for (name, target), n in counted.matching(table).items():
                found.append((name, target, SINGULAR[name].level if name in SINGULAR else "error", n))
    for table, other in EQUAL_ROWCOUNT.items():
        if table in counted and other in counted:
            apart = abs(counted.rows(table) - counted.rows(other))
            found.append(("equal_rowcount", f"{table}.*", "error", apart))
    for name, (table, other) in ROWCOUNT_CHECKS.items():
        if table in counted and other in counted:
            differ = int(counted.rows(table) != counted.rows(other))
            found.append((name, "", SINGULAR[name].level, differ))
    return found


#: Constraints that shuffle their tables, which are therefore scanned in a job of their own.
_SHUFFLED: dict[str, Collection[str]] = {
    "unique": UNIQUE,
    "relationships": _CHILDREN,
    "unique_combination": UNIQUE_COMBINATION,
}


def _uncounted(kind: str, counted: CountedRows) -> Callable[[Tables], DataFrame] | None:
    """The scan of a declared constraint over the tables that were not counted, if any is left."""
    declared = {"not_null": NOT_NULL, "accepted_values": ACCEPTED_VALUES, "accepted_range": ACCEPTED_RANGE}
    if kind in declared:
        left = [t for t in declared[kind] if t not in counted]
        return partial(GENERIC[kind], only=left) if left else None
    if kind == "equal_rowcount":
        left = [t for t, o in EQUAL_ROWCOUNT.items() if t not in counted or o not in counted]
        return partial(GENERIC[kind], only=left) if left else None
    return GENERIC[kind]


def _generic(kind: str, counts: DataFrame) -> DataFrame:
    return counts.select(
        F.lit(kind).alias("check"),
        F.concat_ws(".", "table_name", "column_name").alias("target"),
        F.lit("error").alias("level"),
        "violations",
    )


def generic_counts(t: Tables, counted: CountedRows | None = None) -> DataFrame:
    """Violations of every declared constraint that ``counted`` does not decide."""
    counted = counted or CountedRows()
    scans = {kind: _uncounted(kind, counted) for kind in GENERIC}
    return reduce(
        DataFrame.unionAll, [_generic(kind, count(t)) for kind, count in scans.items() if count]
    )


def _singular(name: str, t: Tables) -> DataFrame:
    return (
        SINGULAR[name]
        .violations(t)
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(
            F.lit(name).alias("check"),
            F.lit("").alias("target"),
            F.lit(SINGULAR[name].level).alias("level"),
            "violations",
        )
    )


def _undecided(counted: CountedRows) -> list[str]:
    """The reconciliation checks that ``counted`` does not decide."""
    decided = {name for name, (table, _) in ROW_CHECKS.items() if table in counted}
    decided |= {n for n, (a, b) in ROWCOUNT_CHECKS.items() if a in counted and b in counted}
    return [name for name in SINGULAR if name not in decided]


def singular_counts(t: Tables, counted: CountedRows | None = None) -> DataFrame:
    """Violations of every reconciliation check that ``counted`` does not decide."""
    names = _undecided(counted or CountedRows())
    return reduce(DataFrame.unionAll, [_singular(name, t) for name in names])


def _scans(t: Tables, counted: CountedRows) -> Iterator[DataFrame]:
    """What :func:`generic_counts` and :func:`singular_counts` give, in parts that each shuffle little."""
    for kind in GENERIC:
        if kind in _SHUFFLED:
            for table in _SHUFFLED[kind]:
                yield _generic(kind, GENERIC[kind](t, only=[table]))
        elif count := _uncounted(kind, counted):
            yield _generic(kind, count(t))
    for name in _undecided(counted):
        yield _singular(name, t)


def run_checks(t: Tables, counted: CountedRows | None = None) -> DataFrame:
    """All checks: name, what they look at, level and number of violations.

    What ``counted`` saw while tables were written is taken from there; only the other
    checks read tables, and do so now, one after the other: each gives back its shuffle
    files, so the disk holds those of the largest check, not of all.
    """
    if counted is None:
        return generic_counts(t).unionAll(singular_counts(t))
    spark, found = t["stg_orders"].sparkSession, counted_findings(counted)
    with released(spark):
        for scan in _scans(t, counted):
            found += [tuple(row) for row in scan.collect()]
    return spark.createDataFrame(found, "check string, target string, level string, violations long")
