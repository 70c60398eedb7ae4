"""Parquet tables dealt to a fixed number of buckets by a key.

Two tables with the same key and number of buckets join without a shuffle, and a search for
one key reads one bucket. Bucketing is a property of a catalog table, so a stored folder is
named in the session's catalog when it is written or read; the files stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.released import released


def _table(path: str, key: str, buckets: int) -> str:
    return f"parcelyard_{sha256(f'{path}|{key}|{buckets}'.encode()).hexdigest()[:24]}"


def write_bucketed(
    df: DataFrame,
    path: str,
    key: str,
    buckets: int,
    options: dict[str, str] | None = None,
    last: Callable[[DataFrame], DataFrame] = lambda gathered: gathered,
) -> DataFrame:
    """Store ``df`` below ``path`` in ``buckets`` buckets of ``key`` and read it back.

    Rows are gathered by bucket first, so a bucket is one file. A bucket far larger than
    the others, such as that of a key with very many rows, is written by several tasks.
    ``last`` is applied to the gathered rows, in the tasks that write.
    """
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    gathered = df.withColumn("_bucket", bucket).hint("rebalance", "_bucket").drop("_bucket")
    writer = last(gathered).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    with released(df.sparkSession):
        writer.options(**(options or {})).option("path", path).saveAsTable(_table(path, key, buckets))
    return read_bucketed(df.sparkSession, path, key, buckets)


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A table stored by :func:`write_bucketed`, also in another session, with the same arguments."""
    name = _table(path, key, buckets)
    if not spark.catalog.tableExists(name):
        fields = spark.read.parquet(path).schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
            f"SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    else:
        spark.catalog.refreshTable(name)
    return spark.table(name)
