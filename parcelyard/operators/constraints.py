"""Generic data constraints. Each function returns the rows that break one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.operators.compare import count_mismatch


def null_condition(column: str) -> Column:
    return F.col(column).isNull()


def values_condition(column: str, values: Sequence) -> Column:
    return ~F.col(column).isin(list(values))


def range_condition(
    column: str, low: float | None = None, high: float | None = None, inclusive: bool = True
) -> Column:
    col, outside = F.col(column), []
    if low is not None:
        outside.append(col < low if inclusive else col <= low)
    if high is not None:
        outside.append(col > high if inclusive else col >= high)
    return reduce(or_, outside)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(null_condition(column))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with a value outside the list; nulls pass."""
    return df.filter(values_condition(column, values))


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive=True) -> DataFrame:
    """Rows with a value outside the range; nulls pass."""
    return df.filter(range_condition(column, low, high, inclusive))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows; nulls pass."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their number of rows."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter("n_rows > 1")


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with their number of rows; nulls pass.

    Child rows are counted per key first, so only distinct keys are looked up.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(field).alias(column))
    return keys.join(known, column, "left_anti")


def equal_rowcount(df: DataFrame, other: DataFrame) -> DataFrame:
    """One row with both counts if they differ."""
    return count_mismatch(df, other, "row_count", "other_count")


def count_by_condition(df: DataFrame, conditions: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows meeting each named condition, all counted in one scan."""
    counted = df.agg(*[F.count_if(c).alias(f"c{i}") for i, (_, c) in enumerate(conditions)])
    pairs = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}").alias("violations"))
        for i, (name, _) in enumerate(conditions)
    ]
    return counted.select(F.inline(F.array(*pairs)))
