"""Tables with faults planted by key arithmetic, the same in Spark and in DuckDB.

A fault names what is wrong in a table: columns that get another value in some rows,
rows that are there twice, rows that are missing. Conditions and values are SQL that
both engines read alike. ``#`` stands for the number in the row's key.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The number in a row's key, by table; the first pattern that fits counts.
_NUMBERS = {
    r"raw\.geolocation": "CAST(geolocation_zip_code_prefix AS BIGINT)",
    r"raw\.product_category.*|stg_product_category.*": "length(product_category_name)",
    r"stg_geolocation|dim_location": "CAST(zip_code_prefix AS BIGINT)",
    r".*products|dim_product": "CAST(product_id AS BIGINT)",
    r".*customers": "CAST(customer_id AS BIGINT)",
    r"dim_customer": "CAST(customer_unique_id AS BIGINT)",
    r".*seller.*": "CAST(seller_id AS BIGINT)",
    r"dim_date": "day(date_day)",
    r"int_data_quality.*|mart_data_quality|mart_logistics.*": "month(order_month)",
    r".*": "CAST(order_id AS BIGINT)",
}


def number(table: str) -> str:
    return next(sql for pattern, sql in _NUMBERS.items() if re.fullmatch(pattern, table))


@dataclass(frozen=True)
class Fault:
    """``values`` maps a column to (condition, value) pairs, of which the first true one counts."""

    values: Mapping[str, list[tuple[str, str]]] = field(default_factory=dict)
    twice: str = ""
    missing: str = ""

    def column(self, table: str, name: str) -> str:
        cases = " ".join(f"WHEN {c} THEN {v}" for c, v in self.values[name])
        return f"CASE {cases} ELSE {name} END".replace("#", number(table))

    def condition(self, table: str, which: str) -> str:
        return f"coalesce({which}, false)".replace("#", number(table))

    def spark(self, table: str, df: DataFrame) -> DataFrame:
        changed = df.withColumns({c: F.expr(self.column(table, c)) for c in self.values})
        if self.missing:
            kept = df.filter(f"NOT {self.condition(table, self.missing)}")
            changed = kept.withColumns({c: F.expr(self.column(table, c)) for c in self.values})
        if self.twice:
            changed = changed.unionAll(df.filter(self.condition(table, self.twice)))
        return changed

    def duckdb(self, table: str, source: str) -> str:
        replaced = ", ".join(f"{self.column(table, c)} AS {c}" for c in self.values)
        star = f"* REPLACE ({replaced})" if replaced else "*"
        sql = f"SELECT {star} FROM {source}"
        if self.missing:
            sql += f" WHERE NOT {self.condition(table, self.missing)}"
        if self.twice:
            sql += f" UNION ALL SELECT * FROM {source} WHERE {self.condition(table, self.twice)}"
        return sql


class Planted:
    """Tables with their faults."""

    def __init__(self, tables: Mapping[str, DataFrame], faults: Mapping[str, Fault]):
        self._tables, self._faults = tables, faults

    def __getitem__(self, name: str) -> DataFrame:
        df = self._tables[name]
        return self._faults[name].spark(name, df) if name in self._faults else df


def planted_sql(body: str, faults: Mapping[str, Fault]) -> tuple[str, dict[str, str]]:
    """``body`` on the faulty tables, and the SELECT of each of these."""
    tables = {}
    for table, fault in faults.items():
        source = table.replace("raw.", "src_")
        body = re.sub(rf"(?<!['\w]){source}(?!['\w])", f"faulty_{source}", body)
        tables[f"faulty_{source}"] = fault.duckdb(table, source)
    return body, tables


def null_faults(declared: Mapping[str, list[str]]) -> dict[str, Fault]:
    return {
        t: Fault({c: [(f"# % 7 = {k}", "NULL")] for k, c in enumerate(columns, 1)})
        for t, columns in declared.items()
    }


def twice_faults(declared) -> dict[str, Fault]:
    return {t: Fault(twice="# % 7 = 1") for t in declared}


def value_faults(declared: Mapping[str, dict[str, list]]) -> dict[str, Fault]:
    return {
        t: Fault(
            {
                c: [(f"# % 7 = {k}", "'unheard of'" if isinstance(v[0], str) else "77")]
                for k, (c, v) in enumerate(columns.items(), 1)
            }
        )
        for t, columns in declared.items()
    }


def orphan_faults(declared) -> dict[str, Fault]:
    columns: dict[str, list[str]] = {}
    for child, column, _, _ in declared:
        columns.setdefault(child, []).append(column)
    return {
        t: Fault({c: [(f"# % 7 = {k}", "'nobody'")] for k, c in enumerate(names, 1)})
        for t, names in columns.items()
    }


def range_faults(declared) -> dict[str, Fault]:
    def cases(k, low, high):
        below = [(f"# % 7 = {k % 6}", f"CAST({low} - 1 AS DOUBLE)")] if low is not None else []
        above = [(f"# % 7 = {(k + 1) % 6}", f"CAST({high} + 1 AS DOUBLE)")] if high is not None else []
        return below + above

    return {
        t: Fault({c: cases(k, *ends) for k, (c, ends) in enumerate(columns.items(), 1)})
        for t, columns in declared.items()
    }


def missing_faults(*tables: str) -> dict[str, Fault]:
    return {t: Fault(missing=f"# % 7 = {k}") for k, t in enumerate(tables, 1)}


#: Faults for the reconciliation checks, by check.
SINGULAR_FAULTS: dict[str, dict[str, Fault]] = {
    "item_fact_differences": {
        "fct_order_items": Fault(
            {"price": [("# % 7 = 1", "price + 1")], "freight_value": [("# % 7 = 2", "NULL")]},
            twice="# % 7 = 3",
            missing="# % 7 = 4",
        )
    },
    "experience_orphans": missing_faults("int_order_delivery_metrics"),
    "invalid_review_scores": {
        "int_customer_experience_metrics": Fault(
            {"review_score": [("# % 7 = 1", "0"), ("# % 7 = 2", "6"), ("# % 7 = 3", "NULL")]}
        )
    },
    "experience_rowcount": missing_faults("int_customer_experience_metrics"),
    "delivery_rowcount": missing_faults("int_order_delivery_metrics"),
    "inconsistent_severity": {
        "int_order_delivery_metrics": Fault(
            {"severity": [("# % 7 = 1", "'On Time'"), ("# % 7 = 2", "NULL")]}
        )
    },
    "negative_freight_ratio": {
        "int_order_freight_metrics": Fault(
            {"freight_ratio": [("# % 7 = 1", "CAST(-0.5 AS DOUBLE)"), ("# % 7 = 2", "NULL")]}
        )
    },
    "freight_rowcount": missing_faults("int_order_freight_metrics"),
    "freight_sums": {
        "int_order_freight_metrics": Fault(
            {
                "total_price": [("# % 7 = 1", "total_price + 1"), ("# % 7 = 2", "NULL")],
                "total_freight_value": [("# % 7 = 3", "total_freight_value - 1")],
            },
            missing="# % 7 = 4",
        )
    },
    "seller_ratio_expression": {
        "int_seller_freight_metrics": Fault(
            {"freight_ratio": [("# % 7 = 1", "freight_ratio + 1"), ("# % 7 = 2", "NULL")]}
        )
    },
    "seller_sums": {
        "int_seller_freight_metrics": Fault(
            {
                "order_volume": [("# % 7 = 1", "order_volume + 1")],
                "total_price": [("# % 7 = 2", "total_price + 1")],
            },
            missing="# % 7 = 3",
        )
    },
    "on_time_rate_range": {
        "int_seller_performance_metrics": Fault(
            {
                "on_time_rate": [
                    ("# % 7 = 1", "CAST(1.5 AS DOUBLE)"),
                    ("# % 7 = 2", "CAST(-0.5 AS DOUBLE)"),
                    ("# % 7 = 3", "NULL"),
                ]
            }
        )
    },
    "order_volume_positive": {
        "int_seller_performance_metrics": Fault(
            {"order_volume": [("# % 7 = 1", "0"), ("# % 7 = 2", "NULL")]}
        )
    },
    "seller_grain_differences": missing_faults("mart_seller_freight", "mart_seller_performance"),
}
