"""KPIs, value added and alerts at the algorithm x segment grain the BI measures read.

Sign convention of this grain: ``forecast - actual`` (positive means over-forecast), the
opposite of the product grain. Rows without sales are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracast.config import SEGMENT_PLANNER, Settings
from veracast.functions.errors import safe_tracking_signal
from veracast.functions.months import month_index
from veracast.functions.numeric import ratio, rounded, steady
from veracast.operators.segmentation import mape_target

SEGMENT = ["segment_abc", "segment_xyz", "segment_abcxyz", "horizon_mois"]

# Verdict, alert and owner labels read by the BI layer.
VERDICTS = (
    "HUMAIN_SURPERFORME",
    "HUMAIN_NEUTRE",
    "HUMAIN_DEGRADE_LEGEREMENT",
    "HUMAIN_DEGRADE_SIGNIFICATIVEMENT",
)
ALERT_TYPES = ("TRACKING_SIGNAL", "MAPE_HORS_CIBLE")
CRITICALITY = ("CRITIQUE", "ELEVEE")
STATUS_OPEN = "OUVERTE"
OWNER = "Demand Planner"


def with_previous_actual(silver: DataFrame) -> DataFrame:
    """Add ``forecast_naive``: the product's actual in its previous observed month.

    All algorithms of a month carry the same actual, so a frame that ends one month earlier
    gives the lag over distinct months directly, without building that table and joining it
    back. A product has at most one row per month and algorithm. ``build_silver`` can find the
    column before it parts months into rows; then it is taken as it is.
    """
    if "forecast_naive" in silver.columns:
        return silver
    earlier = (
        Window.partitionBy("sku_id")
        .orderBy(month_index(F.col("periode")))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    return silver.withColumn("forecast_naive", F.last("ventes_reelles_qty").over(earlier))


def segment_totals(silver: DataFrame) -> DataFrame:
    """Additive error totals per algorithm and segment: a handful of rows from one shuffle."""
    actual, forecast = F.col("ventes_reelles_qty"), F.col("forecast_qty")
    error = forecast - actual
    naive_error = F.abs(F.col("forecast_naive") - actual)
    rows = with_previous_actual(silver).filter(actual > 0)
    if "horizon_mois" not in silver.columns:
        rows = rows.withColumn("horizon_mois", F.lit(1))
    size = forecast + actual
    return rows.groupBy("algorithme", *SEGMENT).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(ratio(F.abs(error), actual) * 100).alias("mape"),
        F.avg(F.when(size > 0, ratio(F.abs(error) * 2, size) * 100)).alias("smape"),
        F.sum(F.abs(error)).alias("abs_total"),
        F.avg(F.abs(error)).alias("mad"),
        F.avg(error * error).alias("mse"),
        F.sum(error).alias("signed_total"),
        F.avg(error).alias("biais"),
        F.sum(actual).alias("actual_total"),
        F.avg(actual).alias("volume_moyen_actuals"),
        F.stddev_samp(actual).alias("volatilite_actuals"),
        F.avg(naive_error * naive_error).alias("naive_mse"),
        F.sum(ratio(naive_error, actual) * 100).alias("naive_ape_total"),
        F.count(naive_error).alias("naive_n"),
    )


def _kpis(totals: DataFrame, settings: Settings) -> DataFrame:
    mad, signed = F.col("mad"), F.col("signed_total")
    signal = safe_tracking_signal(signed, mad)
    target = mape_target("segment_abc", settings)
    return totals.select(
        "algorithme",
        *SEGMENT,
        rounded(F.col("mape"), 4).alias("mape"),
        rounded(F.col("smape"), 4).alias("smape"),
        rounded(ratio(F.col("abs_total"), F.col("actual_total")) * 100, 4).alias("wape"),
        rounded(mad, 4).alias("mae"),
        rounded(F.sqrt("mse"), 4).alias("rmse"),
        rounded(F.col("biais"), 4).alias("biais"),
        rounded(ratio(signed, F.col("actual_total")) * 100, 4).alias("biais_pct"),
        rounded(ratio(F.sqrt("mse"), F.sqrt("naive_mse")), 4).alias("theil_u"),
        F.col("n").alias("nb_observations"),
        "volume_moyen_actuals",
        "volatilite_actuals",
        "mad",
        signed.alias("cumul_erreurs_signees"),
        rounded(signal, 4).alias("tracking_signal"),
        F.coalesce(steady(F.abs(signal)) > settings.tracking_signal_limit, F.lit(False)).alias(
            "flag_derive"
        ),
        target.alias("mape_cible"),
        F.coalesce(steady(F.col("mape")) > target, F.lit(False)).alias("flag_mape_hors_cible"),
        "naive_ape_total",
        "naive_n",
    )


def segment_performance(silver: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return performance_of_totals(segment_totals(silver), settings)


def performance_of_totals(totals: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return _kpis(totals, settings).drop("naive_ape_total", "naive_n")


def verdict(points: Column) -> Column:
    """More than 2, at least 0, at least -2 points; a missing value is the worst verdict."""
    return (
        F.when(points > 2, VERDICTS[0])
        .when(points >= 0, VERDICTS[1])
        .when(points >= -2, VERDICTS[2])
        .otherwise(VERDICTS[3])
    )


def segment_value_added(silver: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return value_added_of_totals(segment_totals(silver), settings)


def value_added_of_totals(totals: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Naive, best algorithm and planner side by side for each segment, ties kept.

    Everything derives from the few rows of the segment totals by windows over the segment,
    so Silver is read once and nothing is joined. Products without a segment are pooled into
    one row that has a naive error but, having no segment to match on, no best algorithm and
    no planner figure.
    """
    planner = F.col("algorithme") == SEGMENT_PLANNER
    known = F.col("segment_abcxyz").isNotNull()
    segment = Window.partitionBy(*SEGMENT)
    contest = segment.orderBy(planner.cast("int"), F.col("mape").asc_nulls_last())
    listed = segment.orderBy("algorithme")
    naive, best, dp = F.col("mape_naive"), F.col("mape_best_algo"), F.col("mape_dp")
    return (
        _kpis(totals, settings)
        .withColumns(
            {
                "mape_naive": rounded(
                    ratio(
                        F.sum("naive_ape_total").over(segment), F.sum("naive_n").over(segment)
                    ),
                    4,
                ),
                "mape_dp": F.max(F.when(planner & known, F.col("mape"))).over(segment),
                "_naive_rows": F.sum("naive_n").over(segment),
                "_place": F.when(known, F.rank().over(contest)).otherwise(
                    F.row_number().over(listed)
                ),
            }
        )
        .filter((F.col("_place") == 1) & (F.col("_naive_rows") > 0))
        .withColumns(
            {
                "meilleur_algo": F.when(~planner & known, F.col("algorithme")),
                "mape_best_algo": F.when(~planner & known, F.col("mape")),
            }
        )
        .withColumns(
            {
                "fva_algo_pts": rounded(naive - best, 4),
                "fva_humain_pts": rounded(best - dp, 4),
                "fva_total_pts": rounded(naive - dp, 4),
            }
        )
        .select(
            "segment_abcxyz", "horizon_mois", "segment_abc", "segment_xyz", "mape_naive",
            "meilleur_algo", "mape_best_algo", "mape_dp", "fva_algo_pts", "fva_humain_pts",
            "fva_total_pts", verdict(F.col("fva_humain_pts")).alias("verdict_humain"),
        )
    )


def segment_alerts(perf: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per raised flag of the segment performance table.

    CRITIQUE from 1.5 times the signal limit, or from twice the MAPE target; else ELEVEE.
    """
    signal, mape, target = F.abs("tracking_signal"), F.col("mape"), F.col("mape_cible")
    limit = settings.tracking_signal_limit * settings.critical_factor

    def alert(kind: str, text: Column, advice: str, critical: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("type_alerte"),
            text.alias("description_alerte"),
            F.lit(advice).alias("recommandation"),
            F.when(critical, CRITICALITY[0]).otherwise(CRITICALITY[1]).alias("criticite"),
        )

    drift = alert(
        ALERT_TYPES[0],
        F.format_string("Tracking signal %.2f", rounded(F.col("tracking_signal"), 2)),
        "Corriger le biais cumulé",
        signal >= limit,
    )
    missed = alert(
        ALERT_TYPES[1],
        F.format_string("MAPE %.2f pour une cible de %.2f", rounded(mape, 2), target),
        "Recalibrer le modèle",
        mape >= target * 2,
    )
    raised = F.array_compact(
        F.array(F.when(F.col("flag_derive"), drift), F.when(F.col("flag_mape_hors_cible"), missed))
    )
    return perf.select("algorithme", "segment_abcxyz", F.inline(raised)).withColumns(
        {"responsable": F.lit(OWNER), "statut_alerte": F.lit(STATUS_OPEN)}
    )
