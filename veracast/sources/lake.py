"""Reading and writing tables. The storage format is a parameter; Parquet is the default."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LAKE_FORMAT = "parquet"
OUTPUT_MODES = ("auto", "lake", "local")
SMALL_TABLES = (
    "leaderboard", "leadtime_correlation", "dashboard_spec", "reports",
    "segment_performance", "segment_value_added", "segment_alerts",
)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Pass the schema: inferring it costs a second pass over the file."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = LAKE_FORMAT,
    csv_fallback: str | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """The lake table, else the CSV copy, else the lake reader's own error."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException:
        if csv_fallback is None:
            raise
        return read_csv(spark, csv_fallback, schema)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = LAKE_FORMAT,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> int:
    """Write and return the row count, observed during the write instead of by a second job."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return seen.get["rows"]


def save_managed(
    df: DataFrame,
    name: str,
    fmt: str = LAKE_FORMAT,
    mode: str = "overwrite",
    bucket_by: Sequence | None = None,
) -> None:
    """Managed table; bucketing on the product key spares later joins and groupings a shuffle.

    ``bucket_by`` is the number of buckets and then one column or more.
    """
    writer = df.write.format(fmt).mode(mode)
    if bucket_by:
        buckets, *columns = bucket_by
        writer = writer.bucketBy(buckets, *columns).sortBy(*columns)
    writer.saveAsTable(name)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of CSV files, written by the tasks that hold the rows."""
    df.write.mode(mode).option("header", True).csv(path)


def write_single_csv(df: DataFrame, path: str, table: str) -> None:
    """One CSV file, for a table whose rows are bounded by what it describes.

    A single file means a single task, so the table is named: ``SMALL_TABLES`` have a row per
    algorithm, segment or window, never per product.
    """
    if table not in SMALL_TABLES:
        raise ValueError(f"{table} grows with the catalogue; write_csv writes it by all tasks")
    write_csv(df.repartition(1), path)


def write_output(
    df: DataFrame, name: str, base: str, mode: str = "auto", fmt: str = LAKE_FORMAT
) -> None:
    """``lake`` writes the table format, ``local`` writes CSV, ``auto`` means lake."""
    if mode not in OUTPUT_MODES:
        raise ValueError(f"output mode must be one of {OUTPUT_MODES}, not {mode!r}")
    target = os.path.join(base, name)
    if mode == "local":
        write_csv(df, target)
    else:
        write_table(df, target, fmt)


def load_csv_to_lake(
    spark: SparkSession,
    csv_path: str,
    table_path: str,
    schema: StructType | str | None = None,
    fmt: str = LAKE_FORMAT,
    mode: str = "overwrite",
) -> int:
    """Copy a CSV into the lake and return the rows written; errors are raised."""
    return write_table(read_csv(spark, csv_path, schema), table_path, fmt, mode)
