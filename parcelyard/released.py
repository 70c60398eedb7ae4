"""Shuffle files given back as soon as the job that wrote them has ended."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Without it, shuffle files stay until the driver happens to collect the garbage of their plan.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Jobs of DataFrames made and run in this block leave no shuffle files on disk.

    A job's shuffles serve that job alone, so a run of many jobs needs room for the
    largest of them, not for all. A DataFrame that is run again computes them anew.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
