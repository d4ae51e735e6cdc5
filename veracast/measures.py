"""BI measures: an aggregate under a filter context is an aggregate grouped by dimensions.

``by=()`` is the grand total. Inputs: P segment performance, F segment value added, A segment
alerts, S Silver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracast.config import SEGMENT_PLANNER, Settings
from veracast.functions.numeric import pct, ratio, ratio_or, rounded

Dims = Sequence[str]

# Texts, colours, limits and weights shown by the dashboard.
DRIFT_ALERT, DRIFT_OK = "⚠ ALERTE — %d dérive(s) détectée(s)", "✓ Stable"
THEIL_TEXTS = (
    "Excellent — bien meilleur que naïf",
    "Bon — meilleur que naïf",
    "Neutre — équivalent au naïf",
    "⚠ Insuffisant — pire que naïf",
)
VERDICT_TEXTS = (
    "✓ Humain surperforme — conserver les corrections",
    "→ Humain neutre — évaluer la pertinence",
    "⚠ Humain dégrade légèrement — former le DP",
    "✗ Humain dégrade significativement — bloquer les overrides",
)
HEAT_BANDS = ((-5, "#1A7340"), (0, "#4CAF50"), (5, "#FF9800"), (10, "#F44336"))
HEAT_WORST = "#8B0000"
CERTIFICATION_WEIGHTS = {"A": 0.6, "B": 0.3, "C": 0.1}
LEAD_TIME_TEXTS = (
    (10, "⚠ Lead Time long dégrade le MAPE de %.1f pts"),
    (5, "→ Lead Time long impacte modérément le MAPE (+%.1f pts)"),
    (0, "Lead Time long : impact faible sur MAPE (+%.1f pts)"),
)
LEAD_TIME_OK = "✓ Lead Time sans impact significatif sur le MAPE"
RUPTURE_TEXT = "⚠ Les ruptures gonflent le MAPE de %.1f pts — écart opérationnel"
RUPTURE_OK = "✓ Les ruptures n'impactent pas significativement le MAPE"
STATUS_TEXTS = {
    "n_critical": "🔴 CRITIQUE — %d alerte(s) critique(s)",
    "n_high": "🟠 ATTENTION — %d alerte(s) élevée(s)",
    "n_open": "🟡 SURVEILLANCE — %d alerte(s) en cours",
}
STATUS_OK = "🟢 NOMINAL — Aucune alerte"
ALL_HORIZONS, ALL_SEGMENTS = "Tous horizons", "Tous segments"
ALL_ALGORITHMS = "Tous algorithmes"
REFRESH_FORMAT = "dd/MM/yyyy HH:mm"
BENCHMARK_TEXT = "%s | MAPE = %.1f%% | Cible = %.1f%% | Écart = %.1f pts"
TARGET_MET, TARGET_MISSED = "✓ Cible atteinte", "✗ Hors cible"
SUMMARY_TEXT = (
    "%d SKUs | %d algorithmes | MAPE global = %.1f%% | %d alerte(s) | Mis à jour : %s"
)


def measure(df: DataFrame, measures: Mapping[str, Column], by: Dims = ()) -> DataFrame:
    """Evaluate named aggregates in the context of ``by``."""
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in measures.items()])


def _rows() -> Column:
    return F.count(F.lit(1))


def _share(condition: Column) -> Column:
    return pct(F.count_if(condition), _rows())


def basic_kpis(perf: DataFrame, by: Dims = ()) -> DataFrame:
    weight = F.col("nb_observations")
    return measure(
        perf,
        {
            "mape_mean": F.avg("mape"),
            "mape_weighted": ratio(F.sum(F.col("mape") * weight), F.sum(weight)),
            "wape_mean": F.avg("wape"),
            "mae_mean": F.avg("mae"),
            "rmse_mean": F.avg("rmse"),
            "bias_mean": F.avg("biais_pct"),
            "bias_abs_mean": F.avg(F.abs("biais_pct")),
            "smape_mean": F.avg("smape"),
            "observations": F.sum(weight),
            "tracking_signal_mean": F.avg("tracking_signal"),
            "tracking_signal_abs": F.abs(F.avg("tracking_signal")),
            "theil_u_mean": F.avg("theil_u"),
        },
        by,
    )


def drift(perf: DataFrame, by: Dims = ()) -> DataFrame:
    n = F.count_if("flag_derive")
    text = F.when(n > 0, F.format_string(DRIFT_ALERT, n)).otherwise(DRIFT_OK)
    return measure(
        perf, {"n_drifts": n, "drift_rate_pct": _share(F.col("flag_derive")), "status": text}, by
    )


def theil(perf: DataFrame, by: Dims = ()) -> DataFrame:
    """A missing U has no interpretation (null)."""
    u, mean = F.col("theil_u"), F.avg("theil_u")
    excellent, good, neutral, poor = THEIL_TEXTS
    return measure(
        perf,
        {
            "theil_u_mean": mean,
            "pct_better_than_naive": _share(u < 1),
            "interpretation": F.when(mean < 0.5, excellent)
            .when(mean < 1, good)
            .when(mean == 1, neutral)
            .when(mean > 1, poor),
            "best_theil_u": F.min(F.when(u > 0, u)),
        },
        by,
    )


def value_added(fva: DataFrame, by: Dims = ()) -> DataFrame:
    """Means, verdict on the mean human points (blank counts as 0) and share of gains."""
    human = F.coalesce(F.avg("fva_humain_pts"), F.lit(0.0))
    better, neutral, worse, bad = VERDICT_TEXTS
    return measure(
        fva,
        {
            "mape_naive_mean": F.avg("mape_naive"),
            "mape_best_mean": F.avg("mape_best_algo"),
            "mape_planner_mean": F.avg("mape_dp"),
            "fva_algo_mean": F.avg("fva_algo_pts"),
            "fva_human_mean": F.avg("fva_humain_pts"),
            "fva_total_mean": F.avg("fva_total_pts"),
            "verdict": F.when(human > 2, better)
            .when(human >= 0, neutral)
            .when(human >= -2, worse)
            .otherwise(bad),
            "pct_segments_positive": _share(F.col("fva_humain_pts") > 0),
        },
        by,
    )


def best_algorithm(fva: DataFrame, by: Dims = ()) -> DataFrame:
    """Algorithm of the lowest best-MAPE in the context; ties go to the first name."""
    named = F.when(
        F.col("meilleur_algo").isNotNull() & F.col("mape_best_algo").isNotNull(),
        F.struct("mape_best_algo", "meilleur_algo"),
    )
    return measure(fva, {"best_algorithm": F.min(named)["meilleur_algo"]}, by)


def _target_in_context(by: Dims) -> Column:
    """The target ignores every filter except the ABC class."""
    return F.avg("mape_cible").over(Window.partitionBy(*[c for c in by if c == "segment_abc"]))


def heat_colour(gap: Column) -> Column:
    chain = F
    for limit, colour in HEAT_BANDS:
        chain = chain.when(gap <= limit, colour)
    return chain.otherwise(HEAT_WORST)


def segment_heatmap(perf: DataFrame) -> DataFrame:
    """Per algorithm and segment: its MAPE, the whole segment's MAPE, target, gap, colour.

    The windows run over the performance table, which has one row per algorithm and segment.
    """
    segment = Window.partitionBy("segment_abcxyz")
    return (
        perf.withColumns(
            {
                "mape_segment": F.avg("mape").over(segment),
                "target": _target_in_context(["segment_abc"]),
            }
        )
        .groupBy("algorithme", "segment_abc", "segment_abcxyz")
        .agg(
            F.avg("mape").alias("mape_mean"),
            F.max("mape_segment").alias("mape_segment"),
            F.max("target").alias("target"),
        )
        .withColumn("gap", F.col("mape_mean") - F.col("target"))
        .withColumn("colour", heat_colour(F.col("gap")))
    )


def certification(
    perf: DataFrame, by: Dims = (), settings: Settings = Settings()
) -> DataFrame:
    """Share of rows of each ABC class within its target, and the weighted score."""
    shares = {}
    for abc, target in settings.mape_targets.items():
        inside = F.col("segment_abc") == abc
        shares[f"pct_{abc.lower()}_on_target"] = pct(
            F.count_if(inside & (F.col("mape") <= target)), F.count_if(inside)
        )
    score = F.lit(0.0)
    for abc, weight in CERTIFICATION_WEIGHTS.items():
        score = score + F.col(f"pct_{abc.lower()}_on_target") * weight
    return measure(perf, shares, by).withColumn("certification_score", score)


def lead_times(
    silver: DataFrame, by: Dims = (), settings: Settings = Settings()
) -> DataFrame:
    """Mean stage lengths and the share of products that ever exceed the long limit.

    Products are folded first, so neither of the two product counts is a distinct count.
    """
    stages = {
        "lt_besoins": "lt_besoins_jours",
        "lt_fabrication": "lt_fabrication_jours",
        "lt_liberation": "lt_liberation_jours",
        "lt_diffusion": "lt_diffusion_jours",
        "lt_total": "lt_total_jours",
    }
    folded = silver.groupBy(*by, "sku_id").agg(
        *[F.sum(c).alias(f"sum_{n}") for n, c in stages.items()],
        *[F.count(c).alias(f"n_{n}") for n, c in stages.items()],
        F.max("lt_total_jours").alias("longest"),
    )
    means = {
        f"{n}_mean": ratio(F.sum(f"sum_{n}"), F.sum(f"n_{n}")) for n in stages
    }
    long = F.count_if(F.col("longest") > settings.long_lead_time_days)
    return measure(folded, {**means, "pct_sku_long": pct(long, F.count("sku_id"))}, by)


def _by_silver_condition(
    perf: DataFrame, silver: DataFrame, condition: Column, by: Dims
) -> DataFrame:
    """MAPE over segments that have Silver rows with, and without, the condition.

    A filter on Silver reaches the performance table through the segment, so Silver is folded
    to one row per segment in one pass and both averages come from one join with it.
    """
    segments = silver.groupBy("segment_abcxyz").agg(
        F.bool_or(condition).alias("_with"), F.bool_or(~condition).alias("_without")
    )
    mape = F.col("mape")
    return measure(
        perf.join(segments, "segment_abcxyz", "left"),
        {
            "mape_with": F.avg(F.when(F.col("_with"), mape)),
            "mape_without": F.avg(F.when(F.col("_without"), mape)),
        },
        by,
    ).withColumn("difference", F.col("mape_with") - F.col("mape_without"))


def mape_by_lead_time(
    perf: DataFrame, silver: DataFrame, by: Dims = (), settings: Settings = Settings()
) -> DataFrame:
    gap = F.col("difference")
    text = F
    for limit, template in LEAD_TIME_TEXTS:
        text = text.when(gap > limit, F.format_string(template, rounded(gap, 1)))
    long = F.col("lt_total_jours") > settings.long_lead_time_days
    return _by_silver_condition(perf, silver, long, by).select(
        *by,
        F.col("mape_with").alias("mape_long"),
        F.col("mape_without").alias("mape_short"),
        "difference",
        text.otherwise(LEAD_TIME_OK).alias("impact"),
    )


def mape_by_rupture(perf: DataFrame, silver: DataFrame, by: Dims = ()) -> DataFrame:
    gap = F.col("difference")
    text = F.when(gap > 5, F.format_string(RUPTURE_TEXT, rounded(gap, 1))).otherwise(RUPTURE_OK)
    return _by_silver_condition(perf, silver, F.col("flag_rupture"), by).select(
        *by, "mape_with", "mape_without", "difference", text.alias("impact")
    )


def rupture_rate(silver: DataFrame, by: Dims = ()) -> DataFrame:
    days = _rows() * 30
    return measure(
        silver, {"rupture_rate_pct": ratio_or(F.sum("nb_ruptures"), days, 0.0) * 100}, by
    )


def alert_counts(alerts: DataFrame, by: Dims = ()) -> DataFrame:
    counts = measure(
        alerts,
        {
            "n_open": F.count_if(F.col("statut_alerte") == "OUVERTE"),
            "n_critical": F.count_if(F.col("criticite") == "CRITIQUE"),
            "n_high": F.count_if(F.col("criticite") == "ELEVEE"),
            "pct_tracking_signal": _share(F.col("type_alerte") == "TRACKING_SIGNAL"),
            "pct_mape": _share(F.col("type_alerte") == "MAPE_HORS_CIBLE"),
        },
        by,
    )
    status = F
    for name, template in STATUS_TEXTS.items():
        status = status.when(F.col(name) > 0, F.format_string(template, name))
    return counts.withColumn("global_status", status.otherwise(STATUS_OK))


def monitoring(silver: DataFrame, perf: DataFrame) -> DataFrame:
    """One row: last refresh, products in Silver, algorithms other than the planner."""
    refreshed = F.to_timestamp(F.max("date_traitement"), "yyyy-MM-dd HH:mm:ss")
    algorithms = perf.agg(
        F.countDistinct(
            F.when(F.col("algorithme") != SEGMENT_PLANNER, F.col("algorithme"))
        ).alias("n")
    )
    return silver.agg(
        F.date_format(refreshed, REFRESH_FORMAT).alias("last_refresh"),
        F.countDistinct("sku_id").alias("n_sku"),
    ).withColumn("n_algorithms", algorithms.scalar())


def selected_or(column: str, default) -> Column:
    """The column's value where the context holds exactly one, else ``default``."""
    c = F.col(column)
    single = (F.min(c) == F.max(c)) & (F.count(c) == _rows())
    return F.when(single, F.max(c)).otherwise(default)


def selected_values(perf: DataFrame, by: Dims = ()) -> DataFrame:
    horizon = F.col("_horizon")
    months = F.concat(horizon.cast("string"), F.lit(" mois"))
    # Selected columns may also be dimensions, hence the copies.
    copies = perf.withColumns(
        {"_s": F.col("segment_abcxyz"), "_a": F.col("algorithme"), "_h": F.col("horizon_mois")}
    )
    return measure(
        copies,
        {
            "_horizon": selected_or("_h", -1),
            "segment": selected_or("_s", ALL_SEGMENTS),
            "algorithm": selected_or("_a", ALL_ALGORITHMS),
        },
        by,
    ).select(
        *by,
        F.when(horizon == -1, ALL_HORIZONS).otherwise(months).alias("horizon"),
        "segment",
        "algorithm",
        F.concat(
            F.lit("Performance "),
            "algorithm",
            F.lit(" | Segment "),
            "segment",
            F.when(horizon > 0, F.concat(F.lit(" | Horizon "), months)).otherwise(""),
        ).alias("title"),
    )


def benchmark_line(perf: DataFrame, by: Dims = ()) -> DataFrame:
    """MAPE against the target of the context's ABC class (of all classes at grand total)."""
    mape, target = F.col("mape_mean"), F.col("target")
    line = F.format_string(
        BENCHMARK_TEXT,
        F.when(mape <= target, TARGET_MET).otherwise(TARGET_MISSED),
        rounded(mape, 1),
        rounded(target, 1),
        rounded(F.abs(mape - target), 1),
    )
    return (
        perf.withColumn("_target", _target_in_context(by))
        .groupBy(*by)
        .agg(F.avg("mape").alias("mape_mean"), F.max("_target").alias("target"))
        .withColumn("benchmark", line)
    )


def executive_summary(silver: DataFrame, perf: DataFrame, alerts: DataFrame) -> DataFrame:
    """The dashboard's header line; its parts are one-row subqueries, not joins."""
    mape = perf.agg(F.avg("mape").alias("m")).scalar()
    n_open = alerts.agg(F.count_if(F.col("statut_alerte") == "OUVERTE").alias("n")).scalar()
    return (
        monitoring(silver, perf)
        .withColumns({"_mape": mape, "_open": n_open})
        .select(
            F.format_string(
                SUMMARY_TEXT,
                "n_sku",
                "n_algorithms",
                rounded(F.col("_mape"), 1),
                "_open",
                "last_refresh",
            ).alias("summary")
        )
    )
