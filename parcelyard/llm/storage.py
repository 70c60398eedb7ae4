"""Tables written once to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.released import released


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    The setting is read from the session. Only where none is set, as in a test, a
    temporary folder takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="parcelyard-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/parcelyard-{uuid4().hex}"


def stored_at(df: DataFrame) -> tuple[DataFrame, str]:
    """What :func:`stored` gives, and the folder it lies in, for :func:`discard`."""
    path = shared_folder(df.sparkSession)
    with released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet and read back: its lineage is cut, its values are fixed.

    The shuffles of the job that writes it are deleted when it ends.
    """
    return stored_at(df)[0]


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def carried(df: DataFrame, *new: str) -> list[str]:
    """The columns of ``df`` that an operator passes on; its own take precedence."""
    return [c for c in df.columns if c not in new]
