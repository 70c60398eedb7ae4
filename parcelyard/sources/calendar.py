"""Day ranges for the calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard import schema as S


def fixed_range(
    spark: SparkSession, first: str = S.CALENDAR_START, last: str = S.CALENDAR_END
) -> DataFrame:
    """One row with the given first and last day."""
    return spark.range(1).select(
        F.lit(first).cast("date").alias("first_day"), F.lit(last).cast("date").alias("last_day")
    )


def observed_range(df: DataFrame, *columns: str) -> DataFrame:
    """One row with the earliest and latest day found in ``columns``."""
    days = [F.to_date(c) for c in columns]
    first = F.least(*[F.min(d) for d in days]) if len(days) > 1 else F.min(days[0])
    last = F.greatest(*[F.max(d) for d in days]) if len(days) > 1 else F.max(days[0])
    return df.agg(first.alias("first_day"), last.alias("last_day"))
