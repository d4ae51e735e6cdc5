"""Drift alerts on product performance, and their text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracast.config import Settings
from veracast.functions.numeric import rounded, steady

# The published wording of an alert (severity, algorithm, tracking signal).
ALERT_TEXT = (
    "Alerte de niveau %s détectée sur l'algorithme %s. "
    "Le Tracking Signal est à %.2f. "
    "Actions recommandées:\n"
    "- Isoler les produits affectés et examiner les données récentes\n"
    "- Vérifier la saisonnalité et les biais cumulés\n"
    "- Recalibrer le modèle ou désactiver temporairement"
)


def drift_alerts(perf: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows at or over a limit. CRITICAL from 1.5 times the signal limit, else HIGH.

    A missing MAPE never raises an alert by itself. The signal is bounded by the number of
    months, so windows of 1 and 3 months can only alert through MAPE. Filter and projection,
    no shuffle.
    """
    signal = steady(F.abs("tracking_signal"))
    limit = settings.tracking_signal_limit
    raised = (signal >= limit) | (steady(F.col("mape")) >= settings.mape_red)
    return perf.filter(raised).select(
        "product_id",
        "algo_name",
        "analytical_window_months",
        "tracking_signal",
        F.lit(True).alias("alert_flag"),
        F.when(signal >= limit * settings.critical_factor, "CRITICAL")
        .otherwise("HIGH")
        .alias("severity"),
        F.lit(None).cast("string").alias("recommendation_text"),
        F.lit(None).cast("string").alias("model_source"),
    )


def with_alert_text(alerts: DataFrame) -> DataFrame:
    """Fill the recommendation from the fixed wording, as a column expression."""
    signal = rounded(F.coalesce(F.col("tracking_signal"), F.lit(0.0)), 2)
    return alerts.withColumns(
        {
            "recommendation_text": F.format_string(ALERT_TEXT, "severity", "algo_name", signal),
            "model_source": F.lit("fallback"),
        }
    )
