"""ABC by cumulative revenue, XYZ by demand variability."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracast.config import Settings
from veracast.functions.months import Anchor, as_column
from veracast.functions.numeric import ratio, steady
from veracast.sources.scratch import stage


def sales_profile(
    actuals: DataFrame, settings: Settings = Settings(), anchor: Anchor | None = None
) -> DataFrame:
    """Revenue and volume statistics per product over the look-back, in one shuffle.

    ABC and XYZ read the same rows, so one aggregation feeds both and no join is needed.
    """
    last = actuals.agg(F.max("periode")).scalar() if anchor is None else as_column(anchor)
    recent = actuals.filter(
        F.col("periode") >= F.add_months(last, -settings.segment_lookback_months)
    )
    return recent.groupBy("sku_id").agg(
        F.sum("ventes_reelles_valeur").alias("ca_total_12m"),
        F.avg("ventes_reelles_qty").alias("moyenne_ventes"),
        F.stddev_samp("ventes_reelles_qty").alias("ecart_type_ventes"),
        F.count("periode").alias("nb_periodes"),
    )


def cumulative_revenue(profile: DataFrame) -> DataFrame:
    """Add ``rang_ca``, ``ca_cumul`` and ``ca_total`` in descending revenue order.

    A global running sum without a global sort task. Products are range-partitioned on
    (revenue, sku), so even a revenue shared by a third of them is spread by the sku; each
    range gets its own running sum; what precedes a range comes from a table with one row per
    range, which is as small as the number of shuffle partitions. Range bounds are sampled, so
    the ranged rows are staged before they are read twice. Runs a job.
    """
    revenue = F.col("ca_total_12m")
    order = [revenue.desc_nulls_last(), F.col("sku_id").asc()]
    ranged = profile.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())

    within = Window.partitionBy("_range").orderBy(*order)
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = stage(
        ranged.withColumns(
            {
                "_sum": F.sum(revenue).over(running),
                "_rank": F.rank().over(
                    Window.partitionBy("_range").orderBy(revenue.desc_nulls_last())
                ),
            }
        ),
        "revenue-ranges",
    )

    per_range = ranged.groupBy("_range").agg(
        F.sum(revenue).alias("_range_sum"),
        F.count(F.lit(1)).alias("_range_rows"),
        F.max("_rank").alias("_last_rank"),
        F.max(revenue).alias("_top"),
        F.min(revenue).alias("_bottom"),
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous = Window.orderBy("_range")
    offsets = (
        per_range.withColumns(
            {
                "_sum_before": F.coalesce(F.sum("_range_sum").over(before), F.lit(0)),
                "_rows_before": F.coalesce(F.sum("_range_rows").over(before), F.lit(0)),
                "ca_total": F.sum("_range_sum").over(Window.partitionBy()),
                "_tied": F.col("_top").eqNullSafe(F.lag("_bottom").over(previous))
                & (F.row_number().over(previous) > 1),
            }
        )
        # Rank of the range's lowest revenue. A range that only continues the tie of the
        # range above has no rank of its own and inherits the one above.
        .withColumn(
            "_bottom_rank",
            F.when(
                ~(F.col("_tied") & F.col("_top").eqNullSafe(F.col("_bottom"))),
                F.col("_rows_before") + F.col("_last_rank"),
            ),
        )
        .withColumn("_bottom_rank", F.last("_bottom_rank", ignorenulls=True).over(upto))
        .withColumn("_tie_rank", F.when(F.col("_tied"), F.lag("_bottom_rank").over(previous)))
    )
    continues = F.col("_tie_rank").isNotNull() & (F.col("_rank") == 1)
    return (
        # One row per range: bounded by spark.sql.shuffle.partitions, whatever the data.
        ranged.join(F.broadcast(offsets), "_range")
        .withColumns(
            {
                "rang_ca": F.when(continues, F.col("_tie_rank"))
                .otherwise(F.col("_rows_before") + F.col("_rank"))
                .cast("long"),
                "ca_cumul": F.coalesce(F.col("_sum"), F.lit(0)) + F.col("_sum_before"),
            }
        )
        .select(*profile.columns, "rang_ca", "ca_cumul", "ca_total")
    )


def abc_segments(profile: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A up to 80 % of cumulative revenue, B up to 95 %, else C.

    The cuts compare exact decimals (``100 * cumulative <= 80 * total``), so a product on the
    boundary never changes class with the order of a floating-point sum.
    """
    cut_a, cut_b = settings.abc_cuts_pct
    share = F.col("ca_cumul") * 100
    has_sales = F.col("ca_total") > 0
    return cumulative_revenue(profile).withColumns(
        {
            "pct_ca_cumul": ratio(F.col("ca_cumul"), F.col("ca_total")),
            "segment_abc": F.when(has_sales & (share <= F.col("ca_total") * cut_a), "A")
            .when(has_sales & (share <= F.col("ca_total") * cut_b), "B")
            .otherwise("C"),
        }
    )


def xyz_segments(profile: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """X below 0.5, Y up to 1, else Z; one observation has no deviation and falls into Z."""
    x_cut, y_cut = settings.xyz_cuts
    mean = F.col("moyenne_ventes")
    cv = F.when(mean > 0, ratio(F.col("ecart_type_ventes"), mean)).otherwise(
        settings.cv_without_sales
    )
    return profile.withColumn("cv", cv).withColumn(
        "segment_xyz",
        F.when(steady(F.col("cv")) < x_cut, "X")
        .when(steady(F.col("cv")) <= y_cut, "Y")
        .otherwise("Z"),
    )


def mape_target(abc: str = "segment_abc", settings: Settings = Settings()):
    targets = settings.mape_targets
    return (
        F.when(F.col(abc) == "A", targets["A"])
        .when(F.col(abc) == "B", targets["B"])
        .otherwise(targets["C"])
    )


def abcxyz_segments(profile: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return abc_segments(xyz_segments(profile, settings), settings).withColumns(
        {
            "segment_abcxyz": F.concat("segment_abc", "segment_xyz"),
            "mape_cible_pct": mape_target("segment_abc", settings),
        }
    )


def segment_distribution(segments: DataFrame) -> DataFrame:
    """Products per ABC class and per XYZ class, from one pass over the products."""
    labels = F.array(
        F.struct(F.lit("abc").alias("axis"), F.col("segment_abc").alias("segment")),
        F.struct(F.lit("xyz").alias("axis"), F.col("segment_xyz").alias("segment")),
    )
    return (
        segments.select(F.inline(labels))
        .groupBy("axis", "segment")
        .agg(F.count(F.lit(1)).alias("n_products"))
        .orderBy("axis", "segment")
    )
