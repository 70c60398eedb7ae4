"""Load CSV files into raw tables once each, however often the load runs.

A plain append would store every row again when a load is repeated. Here the
stream's checkpoint remembers which files are in, and the sink commits a file's
rows all or not at all, so a run that loses executors, or is started twice, adds
only what is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelyard.schema import raw_schema
from parcelyard.sources.raw import csv_options


def load_new_files(
    spark: SparkSession,
    inbox: str,
    table: str,
    target: str,
    checkpoint: str,
    max_files: int | None = None,
) -> DataFrame:
    """Append the files of ``inbox`` not loaded yet to ``target`` and return it.

    ``max_files`` bounds one micro-batch, not the load: all new files are read.
    """
    reader = spark.readStream.schema(raw_schema(table)).options(**csv_options(table))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    load = (
        reader.csv(inbox)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    load.awaitTermination()
    return spark.read.schema(raw_schema(table)).parquet(target)
