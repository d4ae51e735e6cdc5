"""Run summary, report rows and the dashboard specification, all as DataFrames."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracast.config import Settings
from veracast.functions.numeric import rounded, steady
from veracast.schemas import GOLD_TABLES, contract

REPORT_TYPES = ("monthly_1page", "monthly_detailed")
SPEC_KEYS = ("pages", "visuals", "measures", "slicers", "thresholds", "tables_used")

# The keys that a specification must have (above), headings of the report text.
REPORT_TEXT = (
    "# Rapport d'audit des prévisions — %s\n\n"
    "## Synthèse Exécutive\n"
    "Données évaluées sur %d fenêtres analytiques.\n\n"
    "## Analyse des Performances\nVoir les tables Gold pour le détail.\n\n"
    "## Plan d'Action\nConsulter les alertes et recommandations.\n"
)


def worst_by(perf: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` values of ``column`` with the highest mean MAPE in each window.

    Values without any MAPE are not ranked; ties go by name. ``row_number() <= k`` lets Spark
    keep only ``k`` candidates per map task and window before it shuffles, so the few window
    lengths do not turn into a few giant sort tasks.
    """
    order = Window.partitionBy("analytical_window_months").orderBy(
        steady(F.col("mean_mape")).desc(), F.col(column)
    )
    return (
        perf.groupBy("analytical_window_months", column)
        .agg(F.avg("mape").alias("mean_mape"))
        .filter(F.col("mean_mape").isNotNull())
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= k)
    )


def _ranked_list(perf: DataFrame, column: str, k: int, name: str) -> DataFrame:
    entries = F.array_sort(F.collect_list(F.struct("position", column)))
    return (
        worst_by(perf, column, k)
        .groupBy("analytical_window_months")
        .agg(entries.getField(column).alias(name))
    )


def _counts(df: DataFrame, label: str, name: str) -> DataFrame:
    """Label counts per window as a map; the labels are a closed list."""
    counted = df.groupBy("analytical_window_months", label).agg(F.count(F.lit(1)).alias("n"))
    entries = F.array_sort(F.collect_list(F.struct(label, "n")))
    return counted.groupBy("analytical_window_months").agg(
        F.map_from_entries(entries).alias(name)
    )


def run_summary(perf: DataFrame, fva: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row per window: mean MAPE and bias, worst products and algorithms, counts."""
    key = "analytical_window_months"
    nothing = F.create_map().cast("map<string,bigint>")
    return (
        perf.groupBy(key)
        .agg(
            rounded(F.avg("mape"), 2).alias("global_mape"),
            rounded(F.avg("bias"), 2).alias("global_bias"),
        )
        .join(_ranked_list(perf, "product_id", 10, "worst_products_top10"), key, "left")
        .join(_ranked_list(perf, "algo_name", 3, "worst_algorithms_top3"), key, "left")
        .join(_counts(alerts, "severity", "alerts_by_severity"), key, "left")
        .join(_counts(fva, "fva_flag", "fva_distribution"), key, "left")
        .withColumns(
            {
                "worst_products_top10": F.coalesce(
                    "worst_products_top10", F.array().cast("array<string>")
                ),
                "worst_algorithms_top3": F.coalesce(
                    "worst_algorithms_top3", F.array().cast("array<string>")
                ),
                "alerts_by_severity": F.coalesce("alerts_by_severity", nothing),
                "fva_distribution": F.coalesce("fva_distribution", nothing),
            }
        )
    )


def report_rows(perf: DataFrame) -> DataFrame:
    """Two report texts that state how many windows were evaluated."""
    windows = F.size(F.collect_set("analytical_window_months"))
    return (
        perf.agg(windows.alias("n_windows"))
        .withColumn("report_type", F.explode(F.array(*[F.lit(t) for t in REPORT_TYPES])))
        .select(
            "report_type",
            F.format_string(REPORT_TEXT, "report_type", "n_windows").alias("report_markdown"),
            F.lit("global").alias("scope"),
            F.lit(None).cast("int").alias("analytical_window_months"),
            F.lit("fallback").alias("model_source"),
        )
    )


def _strings(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _published_columns(kinds: tuple[str, ...]) -> dict[str, list[str]]:
    """Columns of the given types of each KPI table, from its contract."""
    return {
        table: [f.name for f in contract(table).fields if f.dataType.simpleString() in kinds]
        for table in GOLD_TABLES[:7]
    }


def dashboard_spec(summary: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One JSON row describing a dashboard over the published tables, derived from their contracts.

    A page per table; a visual per table with a number to show; the distinct numbers as measures;
    the text and window columns that several tables share as slicers.
    """
    numbers = _published_columns(("double",))
    keys = _published_columns(("string", "int"))
    shared = Counter(c for columns in keys.values() for c in columns)
    measures = sorted({c for columns in numbers.values() for c in columns})
    slicers = sorted(c for c, n in shared.items() if n > 1 and c != "run_id")

    def visual(table: str) -> Column:
        by_window = "analytical_window_months" in keys[table]
        kind = F.lit("by_window" if by_window else "total")
        return F.struct(F.lit(table).alias("name"), kind.alias("type"))

    spec = F.struct(
        _strings(*GOLD_TABLES[:7]).alias("pages"),
        F.array(*[visual(table) for table in GOLD_TABLES[:7] if numbers[table]]).alias("visuals"),
        _strings(*measures).alias("measures"),
        _strings(*slicers).alias("slicers"),
        F.struct(
            F.lit(settings.tracking_signal_limit).alias("tracking_signal_abs"),
            F.lit(settings.mape_red).alias("mape_red"),
        ).alias("thresholds"),
        _strings(*GOLD_TABLES[:7]).alias("tables_used"),
        F.array_sort(F.collect_set("analytical_window_months")).alias("windows"),
    )
    return summary.agg(F.to_json(spec).alias("spec_json")).select(
        "spec_json", F.lit("global").alias("scope"), F.lit("fallback").alias("model_source")
    )


def missing_spec_keys(spec: DataFrame) -> DataFrame:
    """The mandatory keys a spec lacks; text that is not a JSON object lacks them all."""
    keys = F.coalesce(F.json_object_keys("spec_json"), F.array().cast("array<string>"))
    return spec.withColumn("missing_keys", F.array_except(_strings(*SPEC_KEYS), keys))
