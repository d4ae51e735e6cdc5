"""Raw feeds stored so that Silver folds and joins them where they lie.

The four feeds fold to a row per product and month and join on that pair. Stored as managed tables
in buckets of it, with their months already dates, they need no exchange for either: a task reads
the same bucket of each feed. The shuffle is paid once, when a feed is stored, and not by every build.
The segments of products are the one side that isn't laid out by month; they are joined last.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from veracast.config import Settings
from veracast.operators.clean import align_month, as_aligned
from veracast.operators.silver import MONTH_KEY, RawTables, build_silver
from veracast.sources import lake

# A bucket of the longest feed, five rows a product month, then stays at some 100 MB in memory.
ROWS_PER_BUCKET = 200_000
_FEEDS = [field.name for field in dataclasses.fields(RawTables)]


def _save(df: DataFrame, name: str, buckets: int) -> DataFrame:
    dated = as_aligned(align_month(df))
    # One file a bucket, not one a bucket and task.
    lake.save_managed(dated.repartition(buckets, *MONTH_KEY), name, bucket_by=(buckets, *MONTH_KEY))
    return lake.read_catalog(df.sparkSession, name)


def save_feeds(raw: RawTables, prefix: str, buckets: int) -> RawTables:
    """The feeds as managed tables ``prefix_<feed>``, overwritten, and read back."""
    return RawTables(**{f: _save(getattr(raw, f), f"{prefix}_{f}", buckets) for f in _FEEDS})


def read_feeds(spark: SparkSession, prefix: str) -> RawTables:
    return RawTables(**{f: lake.read_catalog(spark, f"{prefix}_{f}") for f in _FEEDS})


def drop_feeds(spark: SparkSession, prefix: str) -> None:
    for feed in [*_FEEDS, "clean_actuals"]:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{feed}")


def silver_of_feeds(
    spark: SparkSession,
    prefix: str,
    buckets: int,
    processed_at: dt.datetime,
    source: str,
    settings: Settings = Settings(),
) -> DataFrame:
    """``build_silver`` over stored feeds; the cleaned actuals are stored in the same buckets."""

    def keep(actuals: DataFrame, label: str) -> DataFrame:
        return _save(actuals, f"{prefix}_clean_{label}", buckets)

    return build_silver(read_feeds(spark, prefix), processed_at, source, settings, keep)


def bucket_count(rows: int, least: int = 8) -> int:
    """Buckets for feeds of so many product months: a task has about as many rows at any size."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


def fresh_prefix() -> str:
    return f"feeds_{uuid.uuid4().hex}"
