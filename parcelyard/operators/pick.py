"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key.

    Every task keeps only the leading row of each of its keys before the shuffle, so
    a key that holds much of the table moves one row per task. Columns that nobody
    reads afterwards are neither sorted nor shuffled.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def most_frequent(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    tiebreak: Column,
) -> DataFrame:
    """Per key, the combination of ``values`` seen most often.

    Ties go to the combination with the smallest ``tiebreak`` aggregate. Rows are
    counted per combination first, so the choice only sees distinct combinations.
    """
    counted = df.groupBy(*keys, *values).agg(
        F.count(F.lit(1)).alias("_n"), tiebreak.alias("_tie")
    )
    best = first_per_key(counted, keys, [F.desc("_n"), F.asc_nulls_last("_tie")])
    return best.select(*keys, *values)


def lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """One ``value`` per ``key``, for use as the right side of a left join.

    The aggregate needs the partitioning the join needs anyway. It keeps the join
    from ever multiplying rows, and it tells the optimizer so: where a query does
    not read the value, the join and all below it leave the plan.
    """
    return df.groupBy(key).agg(F.min(value).alias(value))
