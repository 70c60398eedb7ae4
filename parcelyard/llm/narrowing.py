"""Semi join on a 64-bit key that drops most other rows before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 64-bit words of the bitmap: at most 131,072 rows are broadcast, whatever the data.
BITMAP_WORDS = 2**17


def _marked(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``df`` with ``_hit``: whether the bitmap over ``ids`` has the bit of the row's key."""
    bits = 64 * BITMAP_WORDS
    word = F.expr(f"CAST(pmod({key}, {bits}) DIV 64 AS INT)")
    bit = F.expr(f"shiftleft(1L, CAST(pmod({key}, {bits}) % 64 AS INT))")
    bitmap = ids.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    met = df.withColumn("_word", word).join(F.broadcast(bitmap), "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))
    return met.withColumn("_hit", hit).drop("_word", "_bits")


def likely(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be in ``ids``, for an exact join to follow.

    A bitmap of fixed size over the keys, broadcast as rows of 64 bits, filters ``df``
    where it is read. With very many keys the bitmap fills up and filters less.
    """
    return _marked(df, ids, key).filter("_hit").drop("_hit")


def narrowed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``ids``.

    The join is an inner one with distinct keys, as the optimizer would move a semi join
    below the bitmap.
    """
    return likely(df, ids, key).join(ids.select(key).distinct(), key)


def parted(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``key`` may be in ``ids``, and those whose key is not.

    The second part needs no join with whatever ``ids`` names, so it is not shuffled.
    """
    marked = _marked(df, ids, key)
    return marked.filter("_hit").drop("_hit"), marked.filter("NOT _hit").drop("_hit")
