"""Left join to a lookup table when a few keys hold much of the left side.

The optimizer splits a hot key by itself only if both sides arrive straight from a
shuffle. Here the lookup usually comes out of an aggregate, so the split is spelled
out: rows of hot keys are spread over all shuffle partitions, and the lookup rows of
just those keys are repeated there. Rows without a key are spread too, as they match
nothing anywhere. No row is dropped and none is matched twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shuffle_ways(spark: SparkSession) -> int:
    """Partitions of a shuffle in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, ways: int) -> DataFrame:
    """(key, hot): keys that hold at least the share of rows that one of ``ways`` tasks should.

    There can be no more than ``ways`` of them, whatever the size of the table. Counts
    are exact, so every evaluation yields the same keys.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()  # of the same counts, so the table is read once
    hot = F.col(key).isNotNull() & (F.col("_n") * ways >= total)
    return counts.filter(hot).select(key, F.lit(True).alias("_hot"))


def spread_left_join(
    left: DataFrame, right: DataFrame, key: str, spread_by: str, ways: int | None = None
) -> DataFrame:
    """``left`` joined to ``right`` on ``key``, with hot and null keys spread over all tasks.

    ``right`` counts by its least row per key, so that no left row is multiplied.
    ``spread_by`` is a left column that varies within a hot key, such as a row id. It
    decides the partition by its hash, so a retried task repeats its choice. What is
    broadcast are the hot keys, at most ``ways`` (by default the shuffle partitions).
    Where a query reads no column of ``right``, the join and all below it leave the plan.
    """
    ways = ways or shuffle_ways(left.sparkSession)
    hot = hot_keys(left, key, ways)
    slot = F.pmod(F.xxhash64(spread_by), F.lit(ways)).cast("int")
    spread = left.join(F.broadcast(hot), key, "left").withColumn(
        "_slot", F.when(F.col(key).isNull() | F.col("_hot"), slot).otherwise(0)
    )
    values = [c for c in right.columns if c != key]
    slots = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(ways - 1)))
    repeated = (
        right.join(F.broadcast(hot), key, "left")
        .withColumn("_slot", F.explode(F.coalesce(slots, F.array(F.lit(0)))))
        .groupBy(key, "_slot")
        .agg(F.min(F.struct(*values)).alias("_row"))
        .select(key, "_slot", "_row.*")
    )
    return spread.drop("_hot").join(repeated, [key, "_slot"], "left").drop("_slot")
