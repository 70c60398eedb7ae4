"""CSV files whose quoted text holds line breaks, read by many tasks per file.

Whether a line break ends a record depends on all quotes before it in the file. Files are
read as lines of byte ranges. Each range counts its quotes, a running sum over the ranges
of a file tells whether a range starts inside quoted text, and so which of its lines start
a record. Records of several lines, also those that run across ranges, are put together;
all others are parsed as they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_FILE, _RANGE = ["file"], ["file", "start"]


def quoted_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, at, line, quotes): lines with the byte range they start in and their order there."""
    text = spark.read.option("lineSep", "\n").text(path)
    line = F.col("value")
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        line.alias("line"),
        (F.length(line) - F.length(F.replace(line, F.lit('"')))).alias("quotes"),
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, start, open, last_start, last_no, returns) per range; one row each, a small table.

    ``open`` is 1 where the range starts inside quoted text. ``last_start`` and ``last_no``
    name the last record that starts in an earlier range of the file. ``returns`` tells
    whether the first line break of the file has a carriage return.
    """
    counted = lines.groupBy(*_RANGE).agg(
        F.sum("quotes").alias("quotes"),
        F.count_if(F.col("inside") == 0).alias("if_closed"),
        F.count_if(F.col("inside") == 1).alias("if_open"),
        F.min_by(F.col("line").endswith("\r"), "at").alias("returns"),
    )
    of_file = Window.partitionBy(*_FILE).orderBy("start")
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    opened = counted.withColumn("open", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    records = F.when(F.col("open") == 0, F.col("if_closed")).otherwise(F.col("if_open"))
    last = F.when(records > 0, F.struct("start", records.alias("no")))
    return opened.withColumn("last", F.last(last, ignorenulls=True).over(earlier)).select(
        *_RANGE,
        "open",
        F.col("last.start").alias("last_start"),
        F.col("last.no").alias("last_no"),
        F.first("returns").over(of_file).alias("returns"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, no, record): every record as text, by the range and place where it starts.

    Quotes inside a field must be doubled and the field quoted, as the CSV format has it. A
    quote that is never closed makes one record of the rest of its file. In a file whose
    first line ends with a carriage return and a line feed, that pair is one line break: it
    ends records, and within quoted text it becomes a line feed.
    """
    in_range = Window.partitionBy(*_RANGE).orderBy("at")
    before = in_range.rowsBetween(Window.unboundedPreceding, -1)
    lines = quoted_lines(spark, path).withColumn(
        "inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    )
    starts = (F.col("inside") + F.col("open")) % 2 == 0
    placed = (
        lines.join(_ranges(lines), _RANGE)
        .withColumn("starts", starts)
        .withColumn("no", F.sum(F.col("starts").cast("long")).over(in_range))
    )
    alone = F.col("starts") & (F.col("quotes") % 2 == 0)
    whole = placed.filter(alone).select(
        "file", "start", "no", "returns", F.col("line").alias("record")
    )
    own = F.col("no") > 0
    parts = placed.filter(~alone).select(
        "file",
        F.when(own, F.col("start")).otherwise(F.col("last_start")).alias("start"),
        F.when(own, F.col("no")).otherwise(F.col("last_no")).alias("no"),
        "returns",
        F.struct(F.col("start").alias("range"), "at", "line").alias("part"),
    )
    in_order = F.array_sort(F.collect_list("part"))["line"]
    joined = parts.groupBy("file", "start", "no", "returns").agg(
        F.array_join(in_order, "\n").alias("record")
    )
    plain = F.regexp_replace("record", "\r(\n|$)", "$1")
    return whole.unionAll(joined).withColumn(
        "record", F.when(F.col("returns"), plain).otherwise(F.col("record"))
    )


def _checked_header(names: list[str]) -> Column:
    """False for the first record of a file; an error if it does not name the columns."""
    plain = F.regexp_replace(F.regexp_replace("record", "^﻿", ""), '"', "")
    found = F.split(F.lower(plain), ",")
    differs = F.concat(F.lit("The header of "), F.col("file"), F.lit(" differs from the schema: "), plain)
    first = (F.col("start") == 0) & (F.col("no") == 1)
    right = found == F.array(*[F.lit(n.lower()) for n in names])
    refused = F.raise_error(differs).cast("boolean")
    return F.when(~first, F.lit(True)).when(right, F.lit(False)).otherwise(refused)


def read_quoted(
    spark: SparkSession, path: str, schema: StructType, options: dict[str, str]
) -> DataFrame:
    """CSV with a header, as the multi-line reader gives it, without one task per file.

    ``path`` is a file, a folder or a pattern. Empty records are skipped, a byte order mark
    is no part of the header, and a header that differs from ``schema`` is an error when
    rows are read. Files without a row give no rows.
    """
    found = records(spark, path).filter(_checked_header(schema.names)).filter("record <> ''")
    parsed = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), {**options, "multiLine": "true"})
    return found.select(parsed.alias("row")).select("row.*")
