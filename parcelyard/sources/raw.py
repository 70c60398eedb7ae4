"""CSV files to all-string raw tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.operators.observed import CountedRows
from parcelyard.plans.checks import row_conditions
from parcelyard.schema import RAW_COLUMNS, raw_schema
from parcelyard.sources.quoted import read_quoted

# Only free text can hold line breaks. Their tables are read by quote parity, the other
# ones line by line.
MULTILINE_TABLES = frozenset({"order_reviews"})


def csv_options(table: str) -> dict[str, str]:
    """Reader options of one table: header checked by name, quotes doubled inside text."""
    return {
        "header": "true",
        "enforceSchema": "false",
        "escape": '"',
        "multiLine": str(table in MULTILINE_TABLES).lower(),
    }


def read_raw_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One raw table, verbatim. A header that differs from the layout is an error."""
    if table in MULTILINE_TABLES:
        return read_quoted(spark, path, raw_schema(table), {"escape": '"'})
    return spark.read.schema(raw_schema(table)).options(**csv_options(table)).csv(path)


def read_raw(
    spark: SparkSession, directory: str, pattern: str = "*{table}*"
) -> dict[str, DataFrame]:
    """All raw tables of a directory; ``pattern`` names the file or folder of a table."""
    return {
        table: read_raw_table(spark, f"{directory}/{pattern.format(table=table)}", table)
        for table in RAW_COLUMNS
    }


def write_raw_csv(raw: Mapping[str, DataFrame], directory: str) -> None:
    """Write raw tables as CSV, one folder per table. A rerun replaces, never appends."""
    for table, df in raw.items():
        df.write.mode("overwrite").options(header="true", escape='"').csv(f"{directory}/{table}")


def import_raw(
    raw: Mapping[str, DataFrame], directory: str, counted: CountedRows | None = None
) -> dict[str, DataFrame]:
    """Convert raw tables to Parquet once, so later runs read split, columnar files.

    With ``counted``, the checks on raw tables are counted in passing, as ``raw.<table>``.
    """
    for table, df in raw.items():
        if counted is not None:
            df = counted.watch(f"raw.{table}", df, row_conditions(f"raw.{table}"))
        df.write.mode("overwrite").parquet(f"{directory}/{table}")
    return read_imported(next(iter(raw.values())).sparkSession, directory, raw)


def read_imported(
    spark: SparkSession, directory: str, tables: Iterable[str] = tuple(RAW_COLUMNS)
) -> dict[str, DataFrame]:
    """Raw tables converted by :func:`import_raw`."""
    return {t: spark.read.schema(raw_schema(t)).parquet(f"{directory}/{t}") for t in tables}


def raw_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"), "row_count"
        )
        for table, df in raw.items()
    ]
    return reduce(DataFrame.unionAll, counts)
