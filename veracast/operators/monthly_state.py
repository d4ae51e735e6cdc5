"""Monthly loads without recomputing history: additive error states, stored by month.

A state row holds what the KPIs of any window need of one product, algorithm and month. A load folds
the rows it was given and overwrites the months it has, and no others; windows are put together from
the states of their months alone. A month that arrives again replaces itself.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracast.functions.months import Anchor, months_ago
from veracast.operators.accuracy import TERMS, error_rows, performance_of_months

KEY = ("product_id", "algo_name", "date_month")


def month_states(rows: DataFrame, *along: str) -> DataFrame:
    """One row of sums per product, algorithm and month of normalised rows; no month, no state.

    Columns ``along`` follow from a row's product.
    """
    return (
        error_rows(rows.where(F.col("date_month").isNotNull()))
        .groupBy(*KEY, *along)
        .agg(*[F.expr(total).alias(name) for name, total in TERMS.items()])
    )


def dealt_states(rows: DataFrame) -> DataFrame:
    """``month_states`` in the layout of their files.

    Rows are dealt to files before they fold, so quantities are shuffled once, and sums never.
    """
    product = "sku_id" if "sku_id" in rows.columns else "product_id"
    quantities = rows.select(product, "algo_name", "date_month", "actual_qty", "forecast_qty")
    file = F.pmod(F.xxhash64(product), F.lit(8))
    dealt = quantities.withColumn("_file", file).repartition("date_month", "_file")
    return month_states(dealt, "_file").drop("_file")


def load_months(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Fold ``rows`` and replace the months that they have in the states at ``path``.

    ``rows`` must hold these months whole. Nothing stored is read. Without rows nothing changes.
    """
    (
        dealt_states(rows)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date_month")
        .save(path)
    )


def stored_states(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    kinds = {name: "long" if total.startswith("count") else "double" for name, total in TERMS.items()}
    columns = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
    schema = f"product_id string, algo_name string, {columns}, date_month date"
    return spark.read.format(fmt).schema(schema).load(path)


def performance_of_states(states: DataFrame, anchor: Anchor, windows: Iterable[int]) -> DataFrame:
    """The performance table of many windows from stored states.

    Only months of the longest window are read, by their folders.
    """
    lengths = sorted(set(windows))
    end = F.trunc(anchor if not hasattr(anchor, "isoformat") else F.lit(anchor), "month")
    recent = states.where(
        (F.col("date_month") <= end) & (F.col("date_month") > F.add_months(end, -lengths[-1]))
    )
    aged = recent.withColumn("_age", months_ago(F.col("date_month"), anchor)).drop("date_month")
    return performance_of_months(aged, lengths)
