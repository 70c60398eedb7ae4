"""Exact quantile of a distributed column."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges that one pass counts: as many rows at most leave a task, whatever the table.
RANGES = 4096


def exact_quantile(df: DataFrame, column: str, q: float = 0.5, ranges: int = RANGES) -> float | None:
    """The smallest value with at least a share ``q`` of the values at or below it.

    Every pass counts the values per range of equal width, picks the range that holds
    the wanted rank by running count, and shrinks it to the values really in it, until
    those are a single one. A pass shuffles at most ``ranges`` counts per task and
    brings one row to the driver. Null without values. Each pass reads ``column``
    again, so ``df`` should be a stored table.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    first = values.agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    ).first()
    if not first["n"]:
        return None
    low, high, below = first["low"], first["high"], 0
    rank = max(math.ceil(first["n"] * q), 1)
    while low < high:
        counted = (
            values.filter(F.col("v").between(low, high))
            .groupBy(F.width_bucket("v", F.lit(low), F.lit(high), F.lit(ranges)).alias("range"))
            .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .orderBy("range")
            .limit(ranges + 1)
            .collect()
        )
        for row in counted:
            if below + row["n"] >= rank:
                break
            below += row["n"]
        else:
            raise AssertionError("the table changed between two passes")
        low, high = row["low"], row["high"]
    return low
