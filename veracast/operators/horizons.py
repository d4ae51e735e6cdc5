"""Rolling windows: "the last N months up to an anchor", for many N at once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracast.functions.months import Anchor, as_column, months_ago


def max_month(df: DataFrame, anchor: str = "data") -> DataFrame:
    """One row, ``max_month``. ``"data"`` counts future forecasts, ``"actuals"`` does not."""
    if anchor not in ("data", "actuals"):
        raise ValueError(f"anchor must be 'data' or 'actuals', not {anchor!r}")
    month = F.col("date_month")
    if anchor == "actuals":
        month = F.when(F.col("actual_qty").isNotNull(), month)
    return df.agg(F.max(month).alias("max_month"))


def window_filter(df: DataFrame, anchor: Anchor, months: int) -> DataFrame:
    """Rows of the last ``months`` months, both ends included.

    The range is put on the stored date where there is one: a month starts on day 1, so
    ``periode >= first day`` and ``periode < next month`` mean the same as comparing truncated
    months, and Parquet can skip row groups by it.
    """
    last = as_column(anchor)
    day = F.col("periode" if "periode" in df.columns else "date_month")
    return df.filter(
        (day >= F.add_months(last, 1 - months)) & (day < F.add_months(F.trunc(last, "month"), 1))
    )


def assign_windows(df: DataFrame, anchor: Anchor, windows: Iterable[int]) -> DataFrame:
    """Each row once per window that contains it, as ``analytical_window_months``.

    Replaces one scan and one aggregation per window by a single pass. Windows are nested, so
    for 1/3/6/12 a full year grows 1.8-fold, and the aggregation that follows folds it on the
    map side. Months after the anchor belong to no window.
    """
    lengths = sorted(set(windows))
    # Windows are nested, so a row belongs to the shortest one that reaches it and to all longer
    # ones: a slice, which unlike a lambda filter stays inside whole-stage codegen.
    shortest = F
    for position, length in enumerate(lengths, 1):
        shortest = shortest.when(F.col("_age") < length, position)
    hit = F.slice(
        F.array(*[F.lit(w).cast("int") for w in lengths]),
        F.col("_shortest"),
        F.lit(len(lengths) + 1) - F.col("_shortest"),
    )
    return (
        window_filter(df, anchor, lengths[-1])
        .withColumn("_age", months_ago(F.col("date_month"), anchor))
        .withColumn("_shortest", shortest)
        .filter(F.col("_shortest").isNotNull())
        .withColumn("analytical_window_months", F.explode(hit))
        .drop("_age", "_shortest")
    )
