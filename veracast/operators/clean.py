"""Cleaning of the raw feeds: month alignment, whitelist, one row per key, defaults."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from veracast.config import VALID_ALGORITHMS
from veracast.functions.months import parse_month

# Local column names and the canonical name each one stands for.
CANONICAL_NAMES = {"ventes_reelles_qty": "actual_qty", "algorithme": "algo_name"}
AUDIT_COLUMNS = ("sku_id", "algo_name", "date_month", "actual_qty", "forecast_qty")

_ALIGNED = "month_aligned"


def align_month(df: DataFrame, column: str = "periode") -> DataFrame:
    """The column as a date on day 1; text in any of the three accepted formats.

    A column that ``as_aligned`` has marked stays as it is, and with it how its table is laid out.
    """
    if df.schema[column].metadata.get(_ALIGNED):
        return df
    dated = isinstance(df.schema[column].dataType, (DateType, TimestampType, TimestampNTZType))
    month = F.trunc(F.col(column), "month") if dated else parse_month(F.col(column))
    return df.withColumn(column, month)


def as_aligned(df: DataFrame, column: str = "periode") -> DataFrame:
    """Marks a column of dates on day 1 as such; tables keep the mark."""
    return df.withColumn(column, F.col(column).alias(column, metadata={_ALIGNED: True}))


def known_algorithms(
    df: DataFrame, valid: Iterable[str] = VALID_ALGORITHMS, column: str = "algorithme"
) -> DataFrame:
    return df.filter(F.col(column).isin(*valid))


def algorithm_census(
    df: DataFrame, valid: Iterable[str] = VALID_ALGORITHMS, column: str = "algorithme"
) -> DataFrame:
    """Accepted and rejected row counts, taken before the whitelist removes anything."""
    known = F.col(column).isin(*valid)
    return df.agg(
        F.count_if(known).alias("rows_kept"),
        F.count_if(~F.coalesce(known, F.lit(False))).alias("rows_rejected"),
    )


def month_census(df: DataFrame, column: str = "periode") -> DataFrame:
    """Rows whose month is known, missing, or a text in no accepted format; taken before
    cleaning, where the last two become a null month that joins nothing."""
    given = df.select(F.col(column).alias("_given"), F.col(column).alias("_month"))
    return align_month(given, "_month").agg(
        F.count("_month").alias("rows_with_month"),
        F.count_if(F.col("_given").isNull()).alias("rows_without_month"),
        F.count_if(F.col("_given").isNotNull() & F.col("_month").isNull()).alias(
            "rows_unparseable"
        ),
    )


def one_row_per_key(
    df: DataFrame, keys: list[str], wanted: Iterable[str] | None = None
) -> DataFrame:
    """The smallest row of each key, comparing the other columns left to right, nulls last.

    A row that has a value never loses to one that lacks it. Unlike an arbitrary survivor this is
    repeatable after a lost executor, and being a plain ``min`` it folds copies of a hot key on
    the map side before anything is shuffled.

    With ``wanted``, only those other columns are returned, and those after the last of them are
    not compared: they can't change it. A single column is a plain ``min`` by hashing, without the
    sort that a struct takes.
    """
    rest = [c for c in df.columns if c not in keys]
    if wanted is not None:
        last = max((i for i, c in enumerate(rest) if c in wanted), default=-1)
        rest = rest[: last + 1]
        df = df.select(*keys, *rest)
    if not rest:
        return df.distinct()
    if wanted is not None and len(rest) == 1:
        return df.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0]))
    best = df.groupBy(*keys).agg(F.min(nulls_last(rest)).alias("_row"))
    return best.select(*[F.col(f"_row.{c}").alias(c) if c in rest else c for c in df.columns])


def nulls_last(columns: list[str]) -> Column:
    """The columns as a struct that compares them left to right, a missing value last."""
    parts = [
        part
        for i, c in enumerate(columns)
        for part in (F.col(c).isNull().alias(f"_no_{i}"), F.col(c).alias(c))
    ]
    return F.struct(*parts)


def fill_defaults(df: DataFrame, defaults: Mapping[str, float]) -> DataFrame:
    return df.fillna(dict(defaults))


def normalize_inputs(df: DataFrame) -> DataFrame:
    """Canonical names plus ``date_month``; ``periode`` stays, so month filters reach the scan."""
    names = {
        old: new
        for old, new in CANONICAL_NAMES.items()
        if old in df.columns and new not in df.columns
    }
    out = df.withColumnsRenamed(names)
    if "periode" in out.columns:
        out = out.withColumn("date_month", F.trunc("periode", "month"))
    return out


def missing_audit_columns(df: DataFrame) -> list[str]:
    return [c for c in AUDIT_COLUMNS if c not in df.columns]


def input_profile(df: DataFrame) -> DataFrame:
    """Rows, products and months of a normalised input, in one job and only when asked for.

    Rows fold to months on the map side; only the product count shuffles products, and it
    carries nothing else.
    """
    products = df.agg(F.countDistinct("sku_id").alias("n")).scalar()
    return (
        df.groupBy("date_month")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n").alias("n_rows"), F.count("date_month").alias("n_months"))
        .withColumn("n_products", products)
    )
