from __future__ import annotations

import datetime as dt
import math
import random

import pandas as pd
import pytest

from veracast import measures
from veracast.operators import segment_kpis as kpis

SILVER = (
    "sku_id string, periode date, algorithme string, forecast_qty double, "
    "ventes_reelles_qty double, segment_abc string, segment_xyz string, segment_abcxyz string"
)


def month(i: int) -> dt.date:
    return dt.date(2023 + i // 12, i % 12 + 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for s in range(12):
        abc, xyz = ("A", "X") if s < 4 else ("B", "Y") if s < 9 else (None, None)
        for m in range(14):
            if rng.random() < 0.2:
                continue
            actual = None if m > 11 else float(rng.choice([0, 5, 8, 12, 20]))
            for algo in ("Prophet", "ETS", "Expert_DP"):
                forecast = float(rng.randint(0, 25))
                out.append((f"s{s}", month(m), algo, forecast, actual, abc, xyz, abc and abc + xyz))
    return out


def brute_force(rows):
    df = pd.DataFrame(rows, columns=[c.split()[0] for c in SILVER.split(", ")])
    months = df.drop_duplicates(["sku_id", "periode"]).sort_values(["sku_id", "periode"])
    months["naive"] = months.groupby("sku_id")["ventes_reelles_qty"].shift(1)
    df = df.merge(months[["sku_id", "periode", "naive"]], on=["sku_id", "periode"])
    return df[df.ventes_reelles_qty > 0]


def test_performance_against_brute_force(spark, rows):
    df = brute_force(rows)
    got = kpis.segment_performance(spark.createDataFrame(rows, SILVER)).toPandas()
    assert len(got) == 9
    for _, r in got.iterrows():
        same = df[(df.algorithme == r.algorithme) & (df.segment_abcxyz.fillna("-") == (r.segment_abcxyz or "-"))]
        f, a = same.forecast_qty, same.ventes_reelles_qty
        error = f - a
        naive = (same.naive - a).abs()
        assert r.nb_observations == len(same)
        assert r.mape == pytest.approx((error.abs() / a * 100).mean(), abs=1e-4)
        assert r.wape == pytest.approx(error.abs().sum() / a.sum() * 100, abs=1e-4)
        assert r.biais == pytest.approx(error.mean(), abs=1e-4)
        assert r.biais_pct == pytest.approx(error.sum() / a.sum() * 100, abs=1e-4)
        assert r.smape == pytest.approx((error.abs() / ((f + a) / 2) * 100).mean(), abs=1e-4)
        assert r.theil_u == pytest.approx(
            math.sqrt((error**2).mean()) / math.sqrt((naive**2).mean()), abs=1e-4
        )
        assert r.tracking_signal == pytest.approx(error.sum() / error.abs().mean(), abs=1e-4)
        assert r.volatilite_actuals == pytest.approx(a.std())


def test_value_added_against_brute_force(spark, rows):
    df = brute_force(rows)
    got = kpis.segment_value_added(spark.createDataFrame(rows, SILVER)).toPandas()
    assert sorted(got.segment_abcxyz.fillna("-")) == ["-", "AX", "BY"]
    for _, r in got.iterrows():
        same = df[df.segment_abcxyz.fillna("-") == (r.segment_abcxyz or "-")]
        known = same.dropna(subset=["naive"])
        naive = ((known.naive - known.ventes_reelles_qty).abs() / known.ventes_reelles_qty * 100).mean()
        assert r.mape_naive == pytest.approx(naive, abs=1e-4)
        if not r.segment_abcxyz:
            assert r.meilleur_algo is None and r.verdict_humain == kpis.VERDICTS[3]
            continue
        mape = (
            ((same.forecast_qty - same.ventes_reelles_qty).abs() / same.ventes_reelles_qty * 100)
            .groupby(same.algorithme).mean()
        )
        models = mape.drop("Expert_DP")
        assert r.meilleur_algo == models.idxmin()
        assert r.fva_humain_pts == pytest.approx(models.min() - mape["Expert_DP"], abs=2e-4)
        assert r.fva_algo_pts == pytest.approx(naive - models.min(), abs=2e-4)
        assert r.fva_total_pts == pytest.approx(naive - mape["Expert_DP"], abs=2e-4)


def test_value_added_keeps_ties(spark):
    rows = [
        ("s", month(m), algo, 12.0, 10.0, "A", "X", "AX")
        for m in range(3) for algo in ("ETS", "Prophet", "Expert_DP")
    ]
    got = kpis.segment_value_added(spark.createDataFrame(rows, SILVER)).collect()
    assert sorted(r.meilleur_algo for r in got) == ["ETS", "Prophet"]
    assert {r.verdict_humain for r in got} == {"HUMAIN_NEUTRE"}


def test_verdict_bands(spark):
    df = spark.createDataFrame([(2.1,), (2.0,), (0.0,), (-0.1,), (-2.0,), (-2.1,), (None,)], "p double")
    from pyspark.sql import functions as F

    got = [r[0] for r in df.select(kpis.verdict(F.col("p"))).collect()]
    best, neutral, slight, bad = kpis.VERDICTS
    assert got == [best, neutral, neutral, slight, slight, bad, bad]


PERF = (
    "algorithme string, segment_abc string, segment_abcxyz string, horizon_mois int, mape double, "
    "mape_cible double, tracking_signal double, theil_u double, nb_observations bigint, "
    "flag_derive boolean, flag_mape_hors_cible boolean"
)


@pytest.fixture(scope="module")
def perf(spark):
    rows = [
        ("ETS", "A", "AX", 1, 8.0, 10.0, 9.5, 0.4, 10, True, False),
        ("ETS", "B", "BY", 1, 45.0, 20.0, -6.5, 1.2, 30, True, True),
        ("Expert_DP", "A", "AX", 1, 12.0, 10.0, 1.0, None, 20, False, True),
        ("Expert_DP", "C", "CZ", 1, 40.0, 40.0, 1.0, 0.0, 5, False, False),
    ]
    return spark.createDataFrame(rows, PERF)


def test_segment_alerts(perf):
    got = sorted(
        (r.algorithme, r.segment_abcxyz, r.type_alerte, r.criticite)
        for r in kpis.segment_alerts(perf).collect()
    )
    assert got == [
        ("ETS", "AX", "TRACKING_SIGNAL", "CRITIQUE"),
        ("ETS", "BY", "MAPE_HORS_CIBLE", "CRITIQUE"),
        ("ETS", "BY", "TRACKING_SIGNAL", "ELEVEE"),
        ("Expert_DP", "AX", "MAPE_HORS_CIBLE", "ELEVEE"),
    ]


def test_drift_and_theil_measures(perf):
    drift = measures.drift(perf).first()
    assert (drift.n_drifts, drift.drift_rate_pct) == (2, 50.0)
    assert drift.status == "⚠ ALERTE — 2 dérive(s) détectée(s)"
    assert measures.drift(perf.filter("NOT flag_derive")).first().status == "✓ Stable"
    theil = measures.theil(perf).first()
    assert theil.pct_better_than_naive == 50.0 and theil.best_theil_u == 0.4
    assert theil.interpretation == "Bon — meilleur que naïf"


def test_certification(perf):
    row = measures.certification(perf).first()
    assert (row.pct_a_on_target, row.pct_b_on_target, row.pct_c_on_target) == (50.0, 0.0, 100.0)
    assert row.certification_score == pytest.approx(40.0)
    empty = measures.certification(perf.limit(0)).first()
    assert empty.certification_score == 0.0


def test_heatmap_colours(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(g,) for g in (-5.0, -4.9, 0.0, 5.0, 10.0, 10.1)], "g double")
    got = [r[0] for r in df.select(measures.heat_colour(F.col("g"))).collect()]
    assert got == ["#1A7340", "#4CAF50", "#4CAF50", "#FF9800", "#F44336", "#8B0000"]


def test_selected_values(perf):
    total = measures.selected_values(perf).first()
    assert (total.horizon, total.segment, total.algorithm) == ("1 mois", "Tous segments", "Tous algorithmes")
    assert total.title == "Performance Tous algorithmes | Segment Tous segments | Horizon 1 mois"
    mixed = perf.unionByName(perf.selectExpr("* EXCEPT (horizon_mois)", "2 AS horizon_mois"))
    row = measures.selected_values(mixed, ["segment_abcxyz"]).filter("segment_abcxyz = 'BY'").first()
    assert (row.horizon, row.segment, row.algorithm) == ("Tous horizons", "BY", "ETS")
    assert row.title == "Performance ETS | Segment BY"


def test_alert_status_priority(spark):
    schema = "statut_alerte string, criticite string, type_alerte string"
    cases = {
        "🔴 CRITIQUE — 1 alerte(s) critique(s)": [("OUVERTE", "CRITIQUE", "TRACKING_SIGNAL"), ("OUVERTE", "ELEVEE", "X")],
        "🟠 ATTENTION — 1 alerte(s) élevée(s)": [("FERMEE", "ELEVEE", "X")],
        "🟡 SURVEILLANCE — 1 alerte(s) en cours": [("OUVERTE", "BASSE", "X")],
        "🟢 NOMINAL — Aucune alerte": [],
    }
    for text, rows in cases.items():
        assert measures.alert_counts(spark.createDataFrame(rows, schema)).first().global_status == text


def test_conditions_reach_performance_through_the_segment(spark, perf):
    silver = spark.createDataFrame(
        [("s1", "AX", 95, True), ("s2", "AX", 20, False), ("s3", "BY", 120, False), ("s4", None, 99, True)],
        "sku_id string, segment_abcxyz string, lt_total_jours bigint, flag_rupture boolean",
    )
    row = measures.mape_by_lead_time(perf, silver).first()
    assert row.mape_long == pytest.approx((8 + 45 + 12) / 3)
    assert row.mape_short == pytest.approx(10.0)
    assert row.impact == "⚠ Lead Time long dégrade le MAPE de 11.7 pts"
    row = measures.mape_by_rupture(perf, silver).first()
    assert (row.mape_with, row.impact) == (10.0, measures.RUPTURE_OK)


def test_lead_time_share_of_products(spark):
    stages = "lt_besoins_jours, lt_fabrication_jours, lt_liberation_jours, lt_diffusion_jours"
    silver = spark.createDataFrame(
        [("a", 90, 1), ("a", 40, 1), ("b", 80, 1), ("c", None, None)], "sku_id string, t bigint, d bigint"
    ).selectExpr(
        "sku_id", *[f"{'t' if i == 0 else 'd'} AS {c}" for i, c in enumerate(stages.split(", "))],
        "t + 3 * d AS lt_total_jours",
    )
    row = measures.lead_times(silver).first()
    assert row.pct_sku_long == pytest.approx(100 / 3)
    assert row.lt_total_mean == pytest.approx((93 + 43 + 83) / 3)


def test_benchmark_line(perf):
    row = measures.benchmark_line(perf, ["segment_abc"]).filter("segment_abc = 'A'").first()
    assert row.benchmark == "✓ Cible atteinte | MAPE = 10.0% | Cible = 10.0% | Écart = 0.0 pts"


def test_verdict_of_blank_points_counts_as_zero(spark):
    fva = spark.createDataFrame(
        [("AX", 1.0, None, None, None, None, None, None)],
        "segment_abcxyz string, mape_naive double, mape_best_algo double, mape_dp double, "
        "fva_algo_pts double, fva_humain_pts double, fva_total_pts double, meilleur_algo string",
    )
    row = measures.value_added(fva).first()
    assert row.verdict.startswith("→ Humain neutre") and row.pct_segments_positive == 0.0
    assert measures.best_algorithm(fva).first().best_algorithm is None
