"""Parquet tables clustered on several columns at once.

Every column is ranked by its range, the bits of all ranks are interleaved to one key, and
rows are dealt to files by ranges of that key. A file then covers a narrow range of each
column, so a filter on any one of them, or on several, skips most files by the smallest and
greatest values that Parquet keeps. Sorting by the columns in turn would do so for the first
one only.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.sources.tables import MONTH

#: Bits of the rank of each column: 31 borders at most.
BITS = 5
#: Rows that borders are taken from. They decide where rows lie, not which are stored.
SAMPLE = 8192
#: Files of a clustered table where a caller names no number.
FILES = 64

#: Clustered copies of marts: name, the mart, and the columns its filters ask for.
CLUSTERED = {
    "fct_orders_by_place": ("fct_orders", ("customer_state", "customer_city", MONTH)),
    "mart_seller_performance_by_seller": ("mart_seller_performance", ("seller_id", "time_period")),
    "mart_seller_freight_by_seller": ("mart_seller_freight", ("seller_id", "time_period")),
}


def borders(df: DataFrame, columns: tuple[str, ...], bits: int = BITS) -> dict[str, list]:
    """Values that cut each column into at most ``2 ** bits`` ranges of about equal rows.

    They come from the ``SAMPLE`` rows with the least hashes, so a table gives the same
    borders however it is partitioned. Nulls count as least. Fewer distinct values than
    ranges give a range each.
    """
    order = _unused(df, "_drawn")
    drawn = (
        df.select(*columns, F.xxhash64(*df.columns).alias(order))
        .orderBy(order, *columns)
        .limit(SAMPLE)
        .toLocalIterator()
    )
    rows = [row[: len(columns)] for row in drawn]
    found = {}
    for n, name in enumerate(columns):
        values = sorted(row[n] for row in rows if row[n] is not None)
        distinct = sorted(set(values))
        if len(distinct) < 2**bits:
            found[name] = distinct
            continue
        found[name] = sorted({values[i * len(values) // 2**bits] for i in range(1, 2**bits)})
    return found


def _literal(value) -> Column:
    """``value``; dates and times as text, which a comparison casts without a time zone."""
    return F.lit(str(value) if isinstance(value, dt.date) else value)


def interleaved(cuts: dict[str, list], bits: int = BITS) -> Column:
    """The bits of all columns' ranks, those of highest value first, as one number."""
    ranks = []
    for name, values in cuts.items():
        passed = [F.when(F.col(name) >= _literal(value), 1).otherwise(0) for value in values]
        rank = reduce(lambda a, b: a + b, passed, F.lit(0))
        # ranks of few ranges are spread, so that their highest bits tell them apart
        ranks.append((rank * (2**bits - 1) / max(1, len(values))).cast("int"))
    key = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for rank in ranks:
            key = key * 2 + F.shiftright(rank, bit).bitwiseAND(F.lit(1))
    return key


def write_clustered(
    df: DataFrame, path: str, columns: tuple[str, ...], files: int = FILES, bits: int = BITS
) -> DataFrame:
    """Store all rows of ``df`` in ``files`` ranges of the interleaved key and read them back.

    A cell that holds a large share of the rows is cut by a hash of the row, so no task
    writes it alone. ``df`` is read three times: pass a stored table.
    """
    key, part = _unused(df, "_cell"), _unused(df, "_part")
    placed = df.withColumn(part, F.xxhash64(*df.columns)).withColumn(
        key, interleaved(borders(df, columns, bits), bits)
    )
    ranged = placed.repartitionByRange(files, key, part).sortWithinPartitions(key, *columns)
    ranged.drop(key, part).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def write_clustered_marts(
    marts: dict[str, DataFrame], directory: str, files: int = FILES
) -> dict[str, DataFrame]:
    """Clustered copies of stored ``marts`` for reports on one place or seller."""
    return {
        name: write_clustered(marts[mart], f"{directory}/{name}", columns, files)
        for name, (mart, columns) in CLUSTERED.items()
    }


def read_clustered_marts(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """What :func:`write_clustered_marts` stored."""
    return {name: spark.read.parquet(f"{directory}/{name}") for name in CLUSTERED}
