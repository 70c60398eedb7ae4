"""Reconcile two tables without joining row against row.

:func:`row_differences` counts rows by content, which shuffles both tables.
:func:`differing_rows` gives the same rows, but looks at fingerprints of key ranges first,
so that tables which agree move a few thousand sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leading bits of a key's hash that name its range, and its range within that one.
RANGE_BITS = (12, 24)


def count_mismatch(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """One row with both row counts if they differ, no row if they agree."""
    tagged = left.select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = tagged.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias(left_name),
        F.coalesce(F.sum("r"), F.lit(0)).alias(right_name),
    )
    return counts.filter(F.col(left_name) != F.col(right_name))


def row_differences(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Rows held a different number of times by the two sides, nulls equal to nulls.

    Returns the keys and values with ``left_rows`` and ``right_rows``. Rows are
    counted by content, so a key repeated on both sides cannot multiply, and a
    changed value shows as one row missing on each side.
    """
    columns = [*keys, *values]
    return _counted_by_content(_tagged(left, right, columns), columns)


def _tagged(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    return left.select(*columns, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(*columns, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )


def _counted_by_content(tagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    counted = tagged.groupBy(*columns).agg(
        F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows")
    )
    return counted.filter("left_rows != right_rows")


def row_digest(columns: Sequence[str], seed: int) -> Column:
    """A 64-bit hash of a row's values; a null is told from a value and from other nulls."""
    nulls = [F.col(c).isNull() for c in columns]
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns], *nulls)


def _unequal_ranges(tagged: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Ranges whose rows differ between the sides.

    The rows of a range are summed up: one side adds the hashes of its rows, the other
    subtracts them. Sums do not depend on the order of rows, and count repeated ones.
    """
    side = F.col("l") - F.col("r")
    sums = [
        F.sum(side * row_digest(columns, seed).cast("decimal(20,0)")).alias(f"_d{seed}")
        for seed in (1, 2)
    ]
    summed = tagged.groupBy(name).agg(F.sum(side).alias("_n"), *sums)
    return summed.filter("_n <> 0 OR _d1 <> 0 OR _d2 <> 0").select(name)


def differing_rows(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """The rows of :func:`row_differences`, of which only those in unequal ranges are shuffled.

    Ranges are the leading bits of the key's hash, 4,096 of them; the unequal ones are cut
    into 4,096 each once more, and what is left is counted by content. Rows that differ are
    missed only if two 64-bit hashes agree at once for the sums of a range. Both tables are
    read again for what is unequal, so they should be stored.
    """
    columns, (first, second) = [*keys, *values], RANGE_BITS
    place = row_digest(keys, 0)
    tagged = _tagged(left, right, columns).withColumns(
        {
            "_range": F.shiftrightunsigned(place, 64 - first),
            "_part": F.shiftrightunsigned(place, 64 - second),
        }
    )
    unequal = F.broadcast(_unequal_ranges(tagged, columns, "_range"))  # at most 4,096 rows
    within = tagged.join(unequal, "_range")
    narrowed = within.join(_unequal_ranges(within, columns, "_part"), "_part")
    return _counted_by_content(narrowed, columns)
