"""Forecast error per row, per product and algorithm, and across products."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veracast.functions.errors import product_errors, safe_tracking_signal
from veracast.functions.months import Anchor, months_ago
from veracast.functions.numeric import ratio, steady
from veracast.operators.horizons import assign_windows, window_filter

GRAIN = ("product_id", "algo_name", "analytical_window_months")
DETAIL = (
    "product_id", "algo_name", "date_month", "analytical_window_months", "actual_qty",
    "forecast_qty", "signed_error", "abs_error", "squared_error", "ape", "is_zero_actual",
)
PERFORMANCE = (
    *GRAIN, "mape", "wape", "rmse", "mae", "smape", "bias", "tracking_signal", "theils_u", "n_obs",
)

# Sums that add up over months, and that all KPIs of a window follow from.
TERMS = {
    "abs": "sum(abs_error)",
    "act": "sum(actual_qty)",
    "sq": "sum(squared_error)",
    "ape": "sum(ape)",
    "smape": "sum(smape_element)",
    "signed": "sum(signed_error)",
    "n": "count(1)",
    "n_err": "count(abs_error)",
    "n_ape": "count(ape)",
    "n_smape": "count(smape_element)",
}


def error_rows(df: DataFrame) -> DataFrame:
    """Add the error columns to normalised rows; a row-local projection."""
    errors = product_errors(F.col("actual_qty"), F.col("forecast_qty"))
    out = df.withColumns(errors)
    return out.withColumnRenamed("sku_id", "product_id") if "sku_id" in out.columns else out


def error_detail(df: DataFrame, anchor: Anchor, windows: Iterable[int]) -> DataFrame:
    """Normalised rows with their errors, once per window they belong to."""
    return assign_windows(error_rows(df), anchor, windows).select(*DETAIL)


def _kpis(theils_u: Column) -> dict[str, Column]:
    return {
        "mape": F.avg("ape") * 100,
        "wape": ratio(F.sum("abs_error"), F.sum("actual_qty")) * 100,
        "rmse": F.sqrt(F.avg("squared_error")),
        "mae": F.avg("abs_error"),
        "smape": F.avg("smape_element") * 100,
        "bias": F.avg("signed_error"),
        "tracking_signal": safe_tracking_signal(F.sum("signed_error"), F.avg("abs_error")),
        "theils_u": theils_u,
        "n_obs": F.count(F.lit(1)),
    }


def performance(
    df: DataFrame,
    anchor: Anchor,
    windows: Iterable[int],
    naive_column: str | None = None,
) -> DataFrame:
    """All KPIs of every product, algorithm and window in one scan and one shuffle.

    ``n_obs`` counts rows, also those without an actual. Theil's U is null unless
    ``naive_column`` names the previous observed actual; then it is the RMSE over the RMSE of
    that naive forecast. Errors are computed before the windows multiply the rows.
    """
    rows = error_rows(df)
    theils_u = F.lit(None).cast("double")
    if naive_column:
        naive = F.pow(F.col(naive_column) - F.col("actual_qty"), 2)
        rows = rows.withColumn("_naive_squared", naive)
        theils_u = ratio(F.sqrt(F.avg("squared_error")), F.sqrt(F.avg("_naive_squared")))
    return _aggregate(assign_windows(rows, anchor, windows), theils_u)


def performance_of_detail(detail: DataFrame) -> DataFrame:
    """The same KPIs from a stored ``error_detail``, whose rows already carry their window.

    Only the sMAPE term is not stored; it follows from the two quantities.
    """
    return _aggregate(error_rows(detail), F.lit(None).cast("double"))


def _aggregate(rows: DataFrame, theils_u: Column) -> DataFrame:
    kpis = [c.alias(name) for name, c in _kpis(theils_u).items()]
    return rows.groupBy(*GRAIN).agg(*kpis).select(*PERFORMANCE)


def performance_by_union(df: DataFrame, anchor: Anchor, windows: Iterable[int]) -> DataFrame:
    """The same table as a union of one aggregation per window; the check for ``performance``."""
    parts = [performance(df, anchor, [w]) for w in windows]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# At most so many rows are folded and sorted by a task of ``performance_all_windows``.
ROWS_PER_TASK = 1_000_000


def task_count(spark: SparkSession, rows: int) -> int:
    """Tasks for so many rows: a task's memory stays the same at any size."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def performance_all_windows(
    df: DataFrame, anchor: Anchor, windows: int | Iterable[int] = 24, tasks: int | None = None
) -> DataFrame:
    """Many window lengths (1 to ``windows``, or those listed) without repeating rows per window.

    Rows are first folded to months, then added up from the newest month backwards: after
    month ``a`` the running totals are the window ``a + 1``, and they stay valid for every
    longer window until the next observed month. So each (product, algorithm) sorts at most
    as many rows as the longest window has months, and only the result cells are produced.
    Months and windows both group below (product, algorithm), so one shuffle on that pair serves
    both; the input has about a row per month, which folding before it would not shrink. ``tasks``
    is the number of tasks that share it; without it Spark goes by the bytes shuffled, which are
    a small part of the memory that the sums take.
    """
    lengths = sorted(set(range(1, windows + 1) if isinstance(windows, int) else windows))
    longest = lengths[-1]
    rows = (
        window_filter(error_rows(df), anchor, longest)
        .withColumn("_age", months_ago(F.col("date_month"), anchor))
        .filter((F.col("_age") >= 0) & (F.col("_age") < longest))
        .repartition(*([] if tasks is None else [tasks]), "product_id", "algo_name")
    )
    monthly = rows.groupBy("product_id", "algo_name", "_age").agg(
        *[F.expr(total).alias(name) for name, total in TERMS.items()]
    )
    return performance_of_months(monthly, lengths)


def performance_of_months(monthly: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """KPIs of windows of ascending ``lengths`` from one row of ``TERMS`` per month.

    ``_age`` counts a row's months before the newest; ages lie below the longest window.
    """
    longest = lengths[-1]
    series = Window.partitionBy("product_id", "algo_name").orderBy("_age")
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.lead("_age").over(series), F.lit(longest))
    running = (
        monthly.select(
            "product_id",
            "algo_name",
            (F.col("_age") + 1).alias("_from"),
            until.alias("_until"),
            *[F.sum(name).over(so_far).alias(name) for name in TERMS],
        )
        .withColumn("analytical_window_months", F.explode(_within(lengths)))
        .drop("_from", "_until")
    )
    mad = ratio(F.col("abs"), F.col("n_err"))
    return running.select(
        *GRAIN,
        (ratio(F.col("ape"), F.col("n_ape")) * 100).alias("mape"),
        (ratio(F.col("abs"), F.col("act")) * 100).alias("wape"),
        F.sqrt(ratio(F.col("sq"), F.col("n_err"))).alias("rmse"),
        mad.alias("mae"),
        (ratio(F.col("smape"), F.col("n_smape")) * 100).alias("smape"),
        ratio(F.col("signed"), F.col("n_err")).alias("bias"),
        safe_tracking_signal(F.col("signed"), mad).alias("tracking_signal"),
        F.lit(None).cast("double").alias("theils_u"),
        F.col("n").alias("n_obs"),
    )


def _within(lengths: Sequence[int]) -> Column:
    """The wanted lengths from ``_from`` to ``_until``."""
    if list(lengths) == list(range(1, lengths[-1] + 1)):
        return F.sequence("_from", "_until")
    wanted = F.array(*[F.lit(w).cast("int") for w in lengths])
    return F.filter(wanted, lambda w: w.between(F.col("_from"), F.col("_until")))


def best_algorithm(perf: DataFrame, metric: str) -> DataFrame:
    """The row with the lowest ``metric`` per product and window; ties go to the first name.

    An algorithm without the metric is chosen only when no other has it. A ``min`` over a
    struct: candidates fold on the map side, by a sort of each task's rows since a struct can't
    be hash-aggregated, and only one row a group is shuffled.
    """
    rest = [c for c in perf.columns if c not in ("product_id", "analytical_window_months")]
    order = F.struct(
        F.col(metric).isNull().alias("_missing"),
        steady(F.col(metric)).alias("_metric"),
        F.col("algo_name").alias("_tie"),
        *rest,
    )
    return (
        perf.groupBy("product_id", "analytical_window_months")
        .agg(F.min(order).alias("_best"))
        .select(
            "product_id", "analytical_window_months", *[F.col(f"_best.{c}").alias(c) for c in rest]
        )
    )


def leaderboard(
    perf: DataFrame, segment: str = "segment_abcxyz", one_row_per_product: bool = False
) -> DataFrame:
    """Algorithms ranked by mean MAPE within window and segment; ``ALL`` without a segment.

    Pass ``one_row_per_product=True`` for a table at the ``performance`` grain: products are
    then counted without the shuffle a distinct count needs. The ranking runs on the
    aggregate, one row per window, segment and algorithm.
    """
    if segment not in perf.columns:
        perf = perf.withColumn(segment, F.lit("ALL"))
    products = F.count("product_id") if one_row_per_product else F.countDistinct("product_id")
    board = perf.groupBy(
        "analytical_window_months", F.col(segment).alias("segment_abcxyz"), "algo_name"
    ).agg(
        F.avg("mape").alias("avg_mape"),
        F.avg("wape").alias("avg_wape"),
        F.avg("rmse").alias("avg_rmse"),
        F.avg("bias").alias("avg_bias"),
        products.alias("count_products"),
    )
    order = Window.partitionBy("analytical_window_months", "segment_abcxyz").orderBy(
        steady(F.col("avg_mape")).asc_nulls_last()
    )
    return board.withColumn("rank_mape", F.dense_rank().over(order))
