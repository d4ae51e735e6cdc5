"""ANSI SQL that recomputes every catalogue query from the given tables, for another engine.

The statements restate the rules independently of the DataFrame code: windows by joining a list
of lengths, best rows by ``row_number``, the cumulative revenue by one global window. They are
only for checking and run at small scale.
"""

from __future__ import annotations

import re


def _r(expr: str, digits: int = 6) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def _rows(*columns: str) -> str:
    return ", ".join(f"{_r(c)} AS {c.split('.')[-1]}" for c in columns)


def _forecast(model: int) -> str:
    return f"""
      CASE WHEN qty = 0 AND mi % 2 = 0 THEN 0.0
           ELSE CAST(GREATEST(0, FLOOR((
             CASE WHEN qty > 0 THEN qty ELSE gross END
             * (1000 + (k % 4 + 1) * 5 * (1 + (k + {model}) % 3)
                     * (CASE WHEN k % 7 = 0 THEN 3 ELSE 1 END)
                     * ((k * 31 + mi * 17 + {model} * 13) % 21 - 10)
                     + ((k + 2 * {model}) % 5 - 2) * 60 * (CASE WHEN k % 7 = 0 THEN 3 ELSE 1 END))
             + 500) / 1000)) AS DOUBLE) END"""


_FORECASTS = "\n    UNION ALL ".join(
    f"SELECT k, m, '{name}' AS algo, {_forecast(model)} AS forecast FROM demand {where}"
    for name, model, where in (
        ("Prophet", 1, ""),
        ("ARIMAX", 2, ""),
        ("ETS", 3, ""),
        ("Expert_DP", 4, "WHERE n_reviewed > 0"),
    )
)

_MONTH_TEXT = """CASE WHEN n_returned > 0 THEN strftime(m, '%m/%Y')
         WHEN billed > 0 THEN strftime(m, '%Y-%m') ELSE strftime(m, '%Y-%m-%d') END"""

_FEEDS = f"""
demand AS (
  SELECT l_partkey AS k, CAST(date_trunc('month', l_shipdate) AS DATE) AS m,
         CAST(year(l_shipdate) * 12 + month(l_shipdate) AS BIGINT) AS mi,
         CAST(SUM(l_quantity) AS BIGINT) AS gross,
         CAST(SUM(CASE WHEN l_returnflag = 'R' AND l_linestatus <> 'F' THEN 0
                       ELSE l_quantity END) AS BIGINT) AS qty,
         SUM(CASE WHEN l_returnflag = 'R' AND l_linestatus <> 'F' THEN 0
                  ELSE CAST(l_extendedprice AS DECIMAL(12,2))
                       * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2))) END) AS value,
         CAST(SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS BIGINT) AS billed,
         COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
         COUNT(*) FILTER (WHERE l_returnflag <> 'N') AS n_reviewed
  FROM lineitem GROUP BY 1, 2, 3),
anchor AS (SELECT MAX(m) AS last_m, MAX(mi) AS last_mi FROM demand),
history AS (SELECT *, LAG(qty) OVER (PARTITION BY k ORDER BY m) AS previous FROM demand),
fc AS ({_FORECASTS}),
audit AS (
  SELECT CAST(d.k AS VARCHAR) AS sku_id, d.m AS date_month, CAST(d.qty AS DOUBLE) AS actual_qty,
         f.algo AS algo_name, f.forecast AS forecast_qty
  FROM demand d JOIN fc f ON f.k = d.k AND f.m = d.m
  UNION ALL
  SELECT CAST(k AS VARCHAR), m, CAST(qty AS DOUBLE), 'naive', CAST(previous AS DOUBLE)
  FROM history WHERE previous IS NOT NULL),
exec_windows AS (SELECT CAST(UNNEST([1, 3, 6, 12]) AS INTEGER) AS w),
full_windows AS (SELECT CAST(UNNEST(range(1, 25)) AS INTEGER) AS w),
errors AS (
  SELECT sku_id AS product_id, algo_name, date_month, actual_qty, forecast_qty,
         actual_qty - forecast_qty AS signed_error, ABS(actual_qty - forecast_qty) AS abs_error,
         (actual_qty - forecast_qty) * (actual_qty - forecast_qty) AS squared_error,
         CASE WHEN actual_qty <> 0 THEN ABS(actual_qty - forecast_qty) / actual_qty END AS ape,
         CASE WHEN ABS(actual_qty) + ABS(forecast_qty) > 0
              THEN 2 * ABS(actual_qty - forecast_qty) / (ABS(actual_qty) + ABS(forecast_qty))
              END AS smape_element,
         actual_qty = 0 AS is_zero_actual
  FROM audit)"""


def _perf(windows: str) -> str:
    return f"""
  SELECT e.product_id, e.algo_name, x.w AS analytical_window_months,
         AVG(e.ape) * 100 AS mape,
         SUM(e.abs_error) / NULLIF(SUM(e.actual_qty), 0) * 100 AS wape,
         SQRT(AVG(e.squared_error)) AS rmse, AVG(e.abs_error) AS mae,
         AVG(e.smape_element) * 100 AS smape, AVG(e.signed_error) AS bias,
         CASE WHEN AVG(e.abs_error) > 0 THEN SUM(e.signed_error) / AVG(e.abs_error) ELSE 0 END
           AS tracking_signal,
         CAST(NULL AS DOUBLE) AS theils_u, COUNT(*) AS n_obs
  FROM errors e, anchor a, {windows} x
  WHERE e.date_month <= a.last_m AND e.date_month >= a.last_m - to_months(x.w - 1)
  GROUP BY 1, 2, 3"""


_GOLD = f"""
perf AS ({_perf("exec_windows")}),
best_mape AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id, analytical_window_months
    ORDER BY {_r("mape", 9)} ASC NULLS LAST, algo_name) AS rn FROM perf) WHERE rn = 1),
master AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_size <= 40 THEN p_size + 15 END AS days FROM part),
impact0 AS (
  SELECT b.product_id, b.analytical_window_months,
         CAST(COALESCE(t.days, 45) AS INTEGER) AS lead_time_days,
         CASE WHEN t.days IS NULL THEN 'default' ELSE 'masterdata' END AS lead_time_days_source,
         LEAST(1.0, GREATEST(0.0, COALESCE(b.wape / 100, 0))) AS vol
  FROM best_mape b LEFT JOIN master t ON t.product_id = b.product_id),
impact AS (
  SELECT *, CASE WHEN {_r("vol", 9)} < 0.15 THEN 'LOW' WHEN {_r("vol", 9)} < 0.25 THEN 'MEDIUM'
                 WHEN {_r("vol", 9)} < 0.35 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_severity FROM impact0),
fva AS (
  SELECT *, CASE WHEN fva_value > 0 THEN 'Positive' WHEN fva_value = 0 THEN 'Neutral'
                 WHEN fva_value < 0 THEN 'Negative' ELSE 'Unknown' END AS fva_flag
  FROM (
    SELECT b.product_id, b.analytical_window_months, n.wape AS naive_error_metric,
           b.wape AS algo_error_metric, p.wape AS planner_error_metric,
           {_r("b.wape - p.wape", 4)} AS fva_value, b.n_obs
    FROM (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (
            PARTITION BY product_id, analytical_window_months
            ORDER BY {_r("wape", 9)} ASC NULLS LAST, algo_name) AS rn
            FROM perf WHERE algo_name NOT IN ('naive', 'Expert_DP')) WHERE rn = 1) b
    LEFT JOIN perf n ON n.product_id = b.product_id AND n.algo_name = 'naive'
         AND n.analytical_window_months = b.analytical_window_months
    LEFT JOIN perf p ON p.product_id = b.product_id AND p.algo_name = 'Expert_DP'
         AND p.analytical_window_months = b.analytical_window_months)),
alerts AS (
  SELECT product_id, algo_name, analytical_window_months, tracking_signal, TRUE AS alert_flag,
         CASE WHEN {_r("ABS(tracking_signal)", 9)} >= 9 THEN 'CRITICAL' ELSE 'HIGH' END AS severity
  FROM perf WHERE {_r("ABS(tracking_signal)", 9)} >= 6 OR {_r("mape", 9)} >= 30)"""

_SILVER = f"""
raw_act AS (
  SELECT CAST(k AS VARCHAR) AS sku_id, {_MONTH_TEXT} AS periode, m,
         CAST(NULLIF(qty, 0) AS DOUBLE) AS ventes_reelles_qty, value AS ventes_reelles_valeur
  FROM demand
  UNION ALL
  SELECT CAST(k AS VARCHAR), {_MONTH_TEXT}, m, CAST(gross AS DOUBLE), value
  FROM demand WHERE n_returned > 0),
act AS (
  SELECT sku_id, m AS periode, COALESCE(ventes_reelles_qty, 0) AS ventes_reelles_qty,
         COALESCE(ventes_reelles_valeur, 0) AS ventes_reelles_valeur
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sku_id, m
          ORDER BY ventes_reelles_qty NULLS LAST, ventes_reelles_valeur NULLS LAST) AS rn
        FROM raw_act) WHERE rn = 1),
raw_fc AS (
  SELECT f.k, f.m, {_MONTH_TEXT.replace("strftime(m", "strftime(f.m")} AS periode, f.algo, f.forecast
  FROM fc f JOIN demand d ON d.k = f.k AND d.m = f.m
  UNION ALL
  SELECT k, m, {_MONTH_TEXT}, 'Unknown_Model', CAST(gross AS DOUBLE)
  FROM demand WHERE n_returned > 0
  UNION ALL
  SELECT d.k, CAST(d.m + to_months(x.n) AS DATE), strftime(d.m + to_months(x.n), '%Y-%m'),
         'ETS', CAST(d.qty AS DOUBLE)
  FROM demand d, anchor a, (SELECT UNNEST([1, 2, 3])::INTEGER AS n) x WHERE d.m = a.last_m),
raw_forecasts AS (
  SELECT CAST(f.k AS VARCHAR) AS sku_id, f.m, f.periode, f.algo AS algorithme,
         f.forecast AS forecast_qty, p.p_type AS dci, p.p_brand AS atc4
  FROM raw_fc f LEFT JOIN part p ON p.p_partkey = f.k),
raw_lt AS (
  SELECT CAST(k AS VARCHAR) AS sku_id, {_MONTH_TEXT} AS periode, m,
         15 + k % 60 AS lt_besoins_jours, 5 + gross % 15 AS lt_fabrication_jours,
         CASE WHEN n_reviewed > 0 THEN 7 + (k + mi) % 7 END AS lt_liberation_jours,
         1 + k % 5 AS lt_diffusion_jours FROM demand),
lt AS (
  SELECT sku_id, m AS periode, lt_besoins_jours, lt_fabrication_jours,
         COALESCE(lt_liberation_jours, 0) AS lt_liberation_jours, lt_diffusion_jours,
         lt_besoins_jours + lt_fabrication_jours + COALESCE(lt_liberation_jours, 0)
           + lt_diffusion_jours AS lt_total_jours FROM raw_lt),
profile AS (
  SELECT c.sku_id, SUM(c.ventes_reelles_valeur) AS ca_total_12m,
         AVG(c.ventes_reelles_qty) AS moyenne_ventes,
         STDDEV_SAMP(c.ventes_reelles_qty) AS ecart_type_ventes, COUNT(*) AS nb_periodes
  FROM act c, anchor a WHERE c.periode >= a.last_m - to_months(12) GROUP BY 1),
abc0 AS (
  SELECT *, RANK() OVER (ORDER BY ca_total_12m DESC) AS rang_ca,
         SUM(ca_total_12m) OVER (ORDER BY ca_total_12m DESC, sku_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ca_cumul,
         SUM(ca_total_12m) OVER () AS ca_total FROM profile),
seg AS (
  SELECT *, segment_abc || segment_xyz AS segment_abcxyz,
         CASE segment_abc WHEN 'A' THEN 10.0 WHEN 'B' THEN 20.0 ELSE 40.0 END AS mape_cible_pct
  FROM (
    SELECT *, CASE WHEN ca_cumul * 100 <= ca_total * 80 THEN 'A'
                   WHEN ca_cumul * 100 <= ca_total * 95 THEN 'B' ELSE 'C' END AS segment_abc,
           CASE WHEN {_r("cv", 9)} < 0.5 THEN 'X' WHEN {_r("cv", 9)} <= 1 THEN 'Y' ELSE 'Z' END AS segment_xyz
    FROM (SELECT *, CASE WHEN moyenne_ventes > 0 THEN ecart_type_ventes / moyenne_ventes
                         ELSE 99.0 END AS cv FROM abc0))),
silver AS (
  SELECT f.sku_id, f.m AS periode, f.algorithme, COALESCE(f.forecast_qty, 0) AS forecast_qty,
         c.ventes_reelles_qty, c.ventes_reelles_valeur,
         f.forecast_qty - c.ventes_reelles_qty AS ecart_qty,
         CASE WHEN c.ventes_reelles_qty > 0
              THEN (f.forecast_qty - c.ventes_reelles_qty) / c.ventes_reelles_qty * 100
              END AS ecart_pct,
         s.segment_abc, s.segment_xyz, s.segment_abcxyz, s.mape_cible_pct, s.cv, s.ca_total_12m,
         t.lt_besoins_jours, t.lt_fabrication_jours, t.lt_liberation_jours,
         t.lt_diffusion_jours, t.lt_total_jours,
         d.n_returned AS nb_ruptures, CAST(d.gross AS DOUBLE) AS qty_commandee,
         CAST(d.billed AS DOUBLE) AS qty_facturee,
         COALESCE(d.n_returned > 0, FALSE) AS flag_rupture, f.dci, f.atc4,
         '2002-01-31 08:30:00' AS date_traitement, 'order lines' AS source_fichier
  FROM raw_forecasts f
  LEFT JOIN act c ON c.sku_id = f.sku_id AND c.periode = f.m
  LEFT JOIN lt t ON t.sku_id = f.sku_id AND t.periode = f.m
  LEFT JOIN demand d ON CAST(d.k AS VARCHAR) = f.sku_id AND d.m = f.m
  LEFT JOIN seg s ON s.sku_id = f.sku_id
  WHERE f.algorithme <> 'Unknown_Model')"""

_SEGMENT = f"""
sku_month AS (SELECT DISTINCT sku_id, periode, ventes_reelles_qty FROM silver),
sku_naive AS (
  SELECT sku_id, periode, LAG(ventes_reelles_qty) OVER (PARTITION BY sku_id ORDER BY periode) AS naive
  FROM sku_month),
gs_rows AS (
  SELECT s.algorithme, s.segment_abc, s.segment_xyz, s.segment_abcxyz, 1 AS horizon_mois,
         s.forecast_qty AS f, s.ventes_reelles_qty AS a, n.naive
  FROM silver s JOIN sku_naive n ON n.sku_id = s.sku_id AND n.periode = s.periode
  WHERE s.ventes_reelles_qty > 0),
gs0 AS (
  SELECT algorithme, segment_abc, segment_xyz, segment_abcxyz, horizon_mois,
         AVG(ABS(f - a) / a * 100) AS mape,
         AVG(CASE WHEN f + a > 0 THEN ABS(f - a) / ((f + a) / 2) * 100 END) AS smape,
         SUM(ABS(f - a)) / NULLIF(SUM(a), 0) * 100 AS wape, AVG(ABS(f - a)) AS mad,
         SQRT(AVG((f - a) * (f - a))) AS rmse, AVG(f - a) AS biais,
         SUM(f - a) / NULLIF(SUM(a), 0) * 100 AS biais_pct,
         SQRT(AVG((f - a) * (f - a))) / NULLIF(SQRT(AVG((naive - a) * (naive - a))), 0) AS theil_u,
         COUNT(*) AS nb_observations, AVG(a) AS volume_moyen_actuals,
         STDDEV_SAMP(a) AS volatilite_actuals, SUM(f - a) AS cumul_erreurs_signees,
         CASE WHEN AVG(ABS(f - a)) > 0 THEN SUM(f - a) / AVG(ABS(f - a)) ELSE 0 END AS ts
  FROM gs_rows GROUP BY 1, 2, 3, 4, 5),
gs AS (
  SELECT algorithme, segment_abc, segment_xyz, segment_abcxyz, horizon_mois,
         {_r("mape", 4)} AS mape, {_r("smape", 4)} AS smape, {_r("wape", 4)} AS wape,
         {_r("mad", 4)} AS mae, {_r("rmse", 4)} AS rmse, {_r("biais", 4)} AS biais,
         {_r("biais_pct", 4)} AS biais_pct, {_r("theil_u", 4)} AS theil_u, nb_observations,
         volume_moyen_actuals, volatilite_actuals, mad, cumul_erreurs_signees,
         {_r("ts", 4)} AS tracking_signal, {_r("ABS(ts)", 9)} > 6 AS flag_derive,
         CASE segment_abc WHEN 'A' THEN 10.0 WHEN 'B' THEN 20.0 ELSE 40.0 END AS mape_cible,
         {_r("mape", 9)} > (CASE segment_abc WHEN 'A' THEN 10.0 WHEN 'B' THEN 20.0 ELSE 40.0 END)
           AS flag_mape_hors_cible
  FROM gs0),
gs_naive AS (
  SELECT segment_abcxyz, segment_abc, segment_xyz, horizon_mois,
         {_r("AVG(ABS(naive - a) / a * 100)", 4)} AS mape_naive
  FROM gs_rows WHERE naive IS NOT NULL GROUP BY 1, 2, 3, 4),
gs_best AS (
  SELECT * FROM (SELECT segment_abcxyz, horizon_mois, algorithme, mape,
      RANK() OVER (PARTITION BY segment_abcxyz, horizon_mois ORDER BY mape) AS rang
    FROM gs WHERE algorithme <> 'Expert_DP') WHERE rang = 1),
gs_fva0 AS (
  SELECT n.*, b.algorithme AS meilleur_algo, b.mape AS mape_best_algo, p.mape AS mape_dp,
         {_r("n.mape_naive - b.mape", 4)} AS fva_algo_pts,
         {_r("b.mape - p.mape", 4)} AS fva_humain_pts,
         {_r("n.mape_naive - p.mape", 4)} AS fva_total_pts
  FROM gs_naive n
  LEFT JOIN gs_best b ON b.segment_abcxyz = n.segment_abcxyz
  LEFT JOIN gs p ON p.algorithme = 'Expert_DP'
       AND p.segment_abcxyz = n.segment_abcxyz),
gs_fva AS (
  SELECT *, CASE WHEN fva_humain_pts > 2 THEN 'HUMAIN_SURPERFORME'
                 WHEN fva_humain_pts >= 0 THEN 'HUMAIN_NEUTRE'
                 WHEN fva_humain_pts >= -2 THEN 'HUMAIN_DEGRADE_LEGEREMENT'
                 ELSE 'HUMAIN_DEGRADE_SIGNIFICATIVEMENT' END AS verdict_humain FROM gs_fva0),
gs_alerts AS (
  SELECT algorithme, segment_abcxyz, 'TRACKING_SIGNAL' AS type_alerte,
         'Tracking signal ' || printf('%.2f', {_r("tracking_signal", 2)}) AS description_alerte,
         'Corriger le biais cumulé' AS recommandation,
         CASE WHEN ABS(tracking_signal) >= 9 THEN 'CRITIQUE' ELSE 'ELEVEE' END AS criticite,
         'Demand Planner' AS responsable, 'OUVERTE' AS statut_alerte
  FROM gs WHERE flag_derive
  UNION ALL
  SELECT algorithme, segment_abcxyz, 'MAPE_HORS_CIBLE',
         'MAPE ' || printf('%.2f', {_r("mape", 2)}) || ' pour une cible de '
           || printf('%.2f', CAST(mape_cible AS DOUBLE)),
         'Recalibrer le modèle',
         CASE WHEN mape >= 2 * mape_cible THEN 'CRITIQUE' ELSE 'ELEVEE' END,
         'Demand Planner', 'OUVERTE'
  FROM gs WHERE flag_mape_hors_cible),
cond AS (
  SELECT segment_abcxyz, bool_or(lt_total_jours > 90) AS has_long,
         bool_or(lt_total_jours <= 90) AS has_short, bool_or(flag_rupture) AS has_rupture,
         bool_or(NOT flag_rupture) AS no_rupture FROM silver GROUP BY 1)"""

_BACKTEST = f"""
numbered AS (
  SELECT CAST(k AS VARCHAR) AS sku, m, CAST(qty AS DOUBLE) AS q, k, n_returned,
         ROW_NUMBER() OVER (PARTITION BY k ORDER BY m) AS pos,
         COUNT(*) OVER (PARTITION BY k) AS n FROM demand),
train AS (
  SELECT sku, AVG(q) AS mean_q, MAX_BY(q, pos) AS last_q, regr_slope(q, pos) AS slope,
         regr_intercept(q, pos) AS intercept
  FROM numbered WHERE pos <= n - 6 AND n - 6 >= 12 GROUP BY 1),
holdout AS (
  SELECT x.sku AS Material_ID, x.m AS Sales_Date, x.q AS Actual_Qty, x.pos, x.k,
         GREATEST(0, t.mean_q) AS Forecast_Mean, GREATEST(0, t.last_q) AS Forecast_Naive,
         GREATEST(0, t.intercept + t.slope * x.pos) AS forecast_trend
  FROM numbered x JOIN train t ON t.sku = x.sku WHERE x.pos > x.n - 6),
bt_planner AS (
  SELECT CAST(k AS VARCHAR) AS Material_ID, m AS Sales_Date, {_forecast(1)} AS System_Forecast_Qty,
         {_forecast(4)} AS Planner_Forecast_Qty, 'planner' AS Modified_By_User_ID,
         CAST(m AS TIMESTAMP) AS Modification_Timestamp,
         CASE WHEN n_returned > 0 THEN 'returns' ELSE 'review' END AS Reason_Code
  FROM demand WHERE n_reviewed > 0),
bt0 AS (
  SELECT h.Material_ID, h.Sales_Date, h.Actual_Qty, p.System_Forecast_Qty, p.Planner_Forecast_Qty,
         h.Forecast_Mean, h.Forecast_Naive,
         CAST(5 + t.p_size % 15 AS BIGINT) AS Mfg_LeadTime_Days,
         CAST(15 + t.p_partkey % 60 AS BIGINT) AS Proc_LeadTime_Days,
         CASE WHEN h.Actual_Qty = 0 THEN 0
              ELSE (p.Planner_Forecast_Qty - h.Actual_Qty) / h.Actual_Qty END AS ep,
         CASE WHEN h.Actual_Qty = 0 THEN 0
              ELSE (h.Forecast_Mean - h.Actual_Qty) / h.Actual_Qty END AS em,
         p.Modified_By_User_ID, p.Modification_Timestamp, p.Reason_Code
  FROM holdout h LEFT JOIN bt_planner p
       ON p.Material_ID = h.Material_ID AND p.Sales_Date = h.Sales_Date
  LEFT JOIN part t ON CAST(t.p_partkey AS VARCHAR) = h.Material_ID),
bt AS (
  SELECT *, Mfg_LeadTime_Days + Proc_LeadTime_Days AS total_days,
         CASE WHEN {_r("ep", 9)} < -0.20 THEN 'HIGH' ELSE 'LOW' END AS flag_p,
         CASE WHEN {_r("em", 9)} < -0.20 THEN 'HIGH' ELSE 'LOW' END AS flag_m FROM bt0)"""

_ORIGINS = """
origins AS (
  SELECT x.sku, x.m AS origin_month, x.pos AS o, x.q AS last_q, AVG(t.q) AS mean_q,
         regr_slope(t.q, t.pos) AS slope, regr_intercept(t.q, t.pos) AS intercept
  FROM numbered x JOIN numbered t ON t.sku = x.sku AND t.pos <= x.pos
  WHERE x.pos >= 12 AND x.n - x.pos BETWEEN 6 AND 29 GROUP BY 1, 2, 3, 4),
ahead AS (
  SELECT x.sku AS sku_id, o.origin_month, CAST(x.pos - o.o AS INTEGER) AS steps, x.m AS date_month,
         x.q AS actual_qty, GREATEST(0, o.mean_q) AS forecast_mean,
         GREATEST(0, o.last_q) AS forecast_naive,
         GREATEST(0, o.intercept + o.slope * x.pos) AS forecast_line
  FROM origins o JOIN numbered x ON x.sku = o.sku AND x.pos BETWEEN o.o + 1 AND o.o + 6)"""

_PERF_COLUMNS = f"""product_id, algo_name, analytical_window_months,
  {_rows("mape", "wape", "rmse", "mae", "smape", "bias", "tracking_signal")}, theils_u, n_obs"""

_ALERT_TEXT = """'Alerte de niveau ' || severity || ' détectée sur l''algorithme ' || algo_name
  || '. Le Tracking Signal est à ' || printf('%.2f', {ts}) || '. Actions recommandées:' || chr(10)
  || '- Isoler les produits affectés et examiner les données récentes' || chr(10)
  || '- Vérifier la saisonnalité et les biais cumulés' || chr(10)
  || '- Recalibrer le modèle ou désactiver temporairement'""".format(ts=_r("tracking_signal", 2))

_REPORT_TEXT = """'# Rapport d''audit des prévisions — ' || t || chr(10) || chr(10)
  || '## Synthèse Exécutive' || chr(10) || 'Données évaluées sur ' || n
  || ' fenêtres analytiques.' || chr(10) || chr(10)
  || '## Analyse des Performances' || chr(10) || 'Voir les tables Gold pour le détail.'
  || chr(10) || chr(10) || '## Plan d''Action' || chr(10)
  || 'Consulter les alertes et recommandations.' || chr(10)"""


def _same(table: str, condition: str) -> str:
    """Whether the segment of ``g`` has such a row in another table."""
    return (
        f"EXISTS (SELECT 1 FROM {table} x WHERE ({condition})"
        " AND x.segment_abcxyz IS NOT DISTINCT FROM g.segment_abcxyz)"
    )


def _fmt1(expr: str) -> str:
    return f"printf('%.1f', {_r(expr, 1)})"


def _worst(column: str, k: int) -> str:
    return f"""
  SELECT analytical_window_months, {column}, mean_mape, position FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY analytical_window_months
        ORDER BY {_r("mean_mape", 9)} DESC, {column}) AS position
    FROM (SELECT analytical_window_months, {column}, AVG(mape) AS mean_mape
          FROM perf GROUP BY 1, 2) WHERE mean_mape IS NOT NULL) WHERE position <= {k}"""


def _leaderboard(segment: str, source: str) -> str:
    return f"""
  SELECT analytical_window_months, segment_abcxyz, algo_name,
         {_rows("avg_mape", "avg_wape", "avg_rmse", "avg_bias")}, count_products,
         CAST(DENSE_RANK() OVER (PARTITION BY analytical_window_months, segment_abcxyz
              ORDER BY {_r("avg_mape", 9)} ASC NULLS LAST) AS INTEGER) AS rank_mape
  FROM (SELECT p.analytical_window_months, {segment} AS segment_abcxyz, p.algo_name,
               AVG(p.mape) AS avg_mape, AVG(p.wape) AS avg_wape, AVG(p.rmse) AS avg_rmse,
               AVG(p.bias) AS avg_bias, COUNT(DISTINCT p.product_id) AS count_products
        FROM {source} GROUP BY 1, 2, 3)"""


def _json_counts(table: str, label: str) -> str:
    return f"""(SELECT analytical_window_months, '{{' || string_agg('"' || {label} || '":' || n, ','
      ORDER BY {label}) || '}}' AS j FROM (SELECT analytical_window_months, {label}, COUNT(*) AS n
      FROM {table} GROUP BY 1, 2) GROUP BY 1)"""


_SILVER_COLUMNS = f"""sku_id, periode, algorithme,
  {_rows("forecast_qty", "ventes_reelles_qty")},
  CAST(ventes_reelles_valeur AS DOUBLE) AS ventes_reelles_valeur,
  {_rows("ecart_qty", "ecart_pct")}, segment_abc, segment_xyz, segment_abcxyz,
  {_rows("mape_cible_pct", "cv")}, CAST(ca_total_12m AS DOUBLE) AS ca_total_12m,
  lt_besoins_jours, lt_fabrication_jours, lt_liberation_jours, lt_diffusion_jours, lt_total_jours,
  nb_ruptures, {_rows("qty_commandee", "qty_facturee")}, flag_rupture, dci, atc4,
  date_traitement, source_fichier"""

_HEAT = """CASE WHEN gap <= -5 THEN '#1A7340' WHEN gap <= 0 THEN '#4CAF50'
  WHEN gap <= 5 THEN '#FF9800' WHEN gap <= 10 THEN '#F44336' ELSE '#8B0000' END"""


def _selects() -> dict[str, str]:
    audit = "sku_id, date_month, actual_qty, algo_name, forecast_qty"
    return {
        "align_month": """
  SELECT sku_id, m AS periode, ventes_reelles_qty,
         CAST(ventes_reelles_valeur AS DOUBLE) AS ventes_reelles_valeur FROM raw_act""",
        "normalize_inputs": """
  SELECT sku_id, CAST(date_month + INTERVAL 14 DAY AS DATE) AS periode, algo_name, actual_qty,
         forecast_qty, date_month FROM audit""",
        "input_profile": """
  SELECT COUNT(*) AS n_rows, COUNT(DISTINCT sku_id) AS n_products,
         COUNT(DISTINCT date_month) AS n_months FROM audit""",
        "algo_whitelist": """
  SELECT sku_id, periode, algorithme, forecast_qty, dci, atc4 FROM raw_forecasts
  WHERE algorithme IN ('Prophet', 'ARIMAX', 'ETS', 'Expert_DP')""",
        "algo_census": """
  SELECT COUNT(*) FILTER (WHERE algorithme <> 'Unknown_Model') AS rows_kept,
         COUNT(*) FILTER (WHERE algorithme = 'Unknown_Model') AS rows_rejected
  FROM raw_forecasts""",
        "month_census": """
  SELECT COUNT(m) AS rows_with_month, CAST(0 AS BIGINT) AS rows_without_month,
         COUNT(*) FILTER (WHERE m IS NULL) AS rows_unparseable
  FROM (SELECT CASE WHEN sku_id LIKE '%7' THEN NULL ELSE m END AS m FROM raw_act)""",
        "lake_roundtrip": """
  SELECT sku_id, periode, ventes_reelles_qty,
         CAST(ventes_reelles_valeur AS DOUBLE) AS ventes_reelles_valeur FROM raw_act""",
        "managed_table": """
  SELECT sku_id, COUNT(*) AS n_rows, SUM(ventes_reelles_qty) AS qty FROM raw_act GROUP BY 1""",
        "csv_fallback": """
  SELECT sku_id, periode, ventes_reelles_qty,
         CAST(ventes_reelles_valeur AS DOUBLE) AS ventes_reelles_valeur,
         UNNEST(['copy', 'lake']) AS branch FROM raw_act""",
        "csv_quarantine": """
  SELECT sku_id, state, COUNT(*) AS n_rows,
         SUM(CASE WHEN state = 'loaded' THEN ventes_reelles_qty END) AS qty
  FROM (SELECT *, CASE WHEN CAST(sku_id AS BIGINT) % 19 = 0 THEN 'number of fields'
                       WHEN CAST(sku_id AS BIGINT) % 17 = 0 THEN 'ventes_reelles_qty: double'
                       ELSE 'loaded' END AS state FROM raw_act)
  GROUP BY 1, 2""",
        "raw_load_audit": """
  SELECT sku_id, periode, ventes_reelles_qty,
         CAST(ventes_reelles_valeur AS DOUBLE) AS ventes_reelles_valeur,
         TIMESTAMP '2002-01-31 08:30:00' AS Sys_LoadDate, 'loader' AS Sys_LoadedBy,
         'monthly load' AS Sys_Reason FROM raw_act""",
        "perf_published": f"""
  SELECT {_PERF_COLUMNS}, CAST((SELECT last_m FROM anchor) AS TIMESTAMP) AS date_max_window,
         'a run' AS run_id, TIMESTAMP '2002-01-31 08:30:00' AS generated_at FROM perf""",
        "fva_without_algorithms": f"""
  SELECT product_id, analytical_window_months, {_rows("naive_error_metric", "algo_error_metric",
         "planner_error_metric", "fva_value")}, fva_flag, n_obs FROM fva WHERE FALSE""",
        "volatility_fallback": f"""
  SELECT b.product_id, b.analytical_window_months, 45 AS lead_time_days,
         'default' AS lead_time_days_source, 'rmse' AS volatility_metric_name,
         {_r("LEAST(1.0, GREATEST(0.0, COALESCE(b.rmse, 0)))")} AS volatility_metric_value,
         {_r("45 * LEAST(1.0, GREATEST(0.0, COALESCE(b.rmse, 0)))", 2)} AS safety_stock_days_required,
         CASE WHEN v < 0.15 THEN 'LOW' WHEN v < 0.25 THEN 'MEDIUM' WHEN v < 0.35 THEN 'HIGH'
              ELSE 'CRITICAL' END AS risk_severity,
         v >= 0.25 AS stockout_risk_flag
  FROM (SELECT *, {_r("LEAST(1.0, GREATEST(0.0, COALESCE(rmse, 0)))", 9)} AS v FROM best_mape) b""",
        "dashboard_spec": """
  SELECT CAST(0 AS INTEGER) AS n_missing_keys,
         '[' || string_agg(w, ',' ORDER BY w) || ']' AS windows, 'global' AS scope
  FROM (SELECT DISTINCT analytical_window_months AS w FROM perf)""",
        "dedup_key": """
  SELECT sku_id, m AS periode, ventes_reelles_qty,
         CAST(ventes_reelles_valeur AS DOUBLE) AS ventes_reelles_valeur
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sku_id, m
          ORDER BY ventes_reelles_qty NULLS LAST, ventes_reelles_valeur NULLS LAST) AS rn
        FROM raw_act) WHERE rn = 1""",
        "fill_defaults": """
  SELECT sku_id, periode, lt_besoins_jours, lt_fabrication_jours,
         COALESCE(lt_liberation_jours, 0) AS lt_liberation_jours, lt_diffusion_jours
  FROM raw_lt""",
        "max_month": "SELECT MAX(date_month) AS max_month FROM audit",
        "window_filter": f"""
  SELECT {audit} FROM audit, anchor
  WHERE date_month BETWEEN last_m - to_months(5) AND last_m""",
        "window_assign": f"""
  SELECT {audit}, w AS analytical_window_months FROM audit, anchor, exec_windows
  WHERE date_month <= last_m AND date_month >= last_m - to_months(w - 1)""",
        "error_detail": f"""
  SELECT product_id, algo_name, date_month, w AS analytical_window_months, actual_qty,
         forecast_qty, {_rows("signed_error", "abs_error", "squared_error", "ape")},
         is_zero_actual
  FROM errors, anchor, exec_windows
  WHERE date_month <= last_m AND date_month >= last_m - to_months(w - 1)""",
        "perf_product": f"SELECT {_PERF_COLUMNS} FROM perf",
        "perf_union_windows": f"SELECT {_PERF_COLUMNS} FROM perf",
        "perf_incremental": f"SELECT {_PERF_COLUMNS} FROM ({_perf('full_windows')})",
        "perf_product_full24": f"SELECT {_PERF_COLUMNS} FROM ({_perf('full_windows')})",
        "perf_product_theil": f"""
  SELECT product_id, 'moving_average' AS algo_name, w AS analytical_window_months,
         {_r("AVG(ABS(a - f) / NULLIF(a, 0)) * 100")} AS mape,
         {_r("SUM(ABS(a - f)) / NULLIF(SUM(CASE WHEN TRUE THEN a END), 0) * 100")} AS wape,
         {_r("SQRT(AVG((a - f) * (a - f)))")} AS rmse, {_r("AVG(ABS(a - f))")} AS mae,
         {_r("AVG(2 * ABS(a - f) / NULLIF(ABS(a) + ABS(f), 0)) * 100")} AS smape,
         {_r("AVG(a - f)")} AS bias,
         {_r("CASE WHEN AVG(ABS(a - f)) > 0 THEN SUM(a - f) / AVG(ABS(a - f)) ELSE 0 END")}
           AS tracking_signal,
         {_r("SQRT(AVG((a - f) * (a - f))) / NULLIF(SQRT(AVG((naive - a) * (naive - a))), 0)")}
           AS theils_u, COUNT(*) AS n_obs
  FROM (SELECT CAST(k AS VARCHAR) AS product_id, m, CAST(qty AS DOUBLE) AS a,
               AVG(qty) OVER (PARTITION BY k ORDER BY m
                 ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS f,
               CAST(previous AS DOUBLE) AS naive FROM history), anchor, exec_windows
  WHERE m <= last_m AND m >= last_m - to_months(w - 1) GROUP BY 1, 2, 3""",
        "best_algo_wape": f"""
  SELECT {_PERF_COLUMNS} FROM (SELECT *, ROW_NUMBER() OVER (
      PARTITION BY product_id, analytical_window_months
      ORDER BY {_r("wape", 9)} ASC NULLS LAST, algo_name) AS rn FROM perf) WHERE rn = 1""",
        "best_algo_mape": f"SELECT {_PERF_COLUMNS} FROM best_mape",
        "best_mape_top5": """
  SELECT algorithme, segment_abcxyz, mape FROM gs
  ORDER BY mape ASC NULLS LAST, algorithme, segment_abcxyz LIMIT 5""",
        "leaderboard_all": _leaderboard("'ALL'", "perf p"),
        "leaderboard_segment": _leaderboard(
            "s.segment_abcxyz", "perf p LEFT JOIN seg s ON s.sku_id = p.product_id"
        ),
        "fva_product": f"""
  SELECT product_id, analytical_window_months,
         {_rows("naive_error_metric", "algo_error_metric", "planner_error_metric")},
         fva_value, fva_flag, n_obs FROM fva""",
        "drift_alerts": f"""
  SELECT product_id, algo_name, analytical_window_months, {_rows("tracking_signal")},
         alert_flag, severity FROM alerts""",
        "alert_text": f"""
  SELECT product_id, algo_name, analytical_window_months, {_rows("tracking_signal")},
         alert_flag, severity, {_ALERT_TEXT} AS recommendation_text,
         'fallback' AS model_source FROM alerts""",
        "leadtime_impact": f"""
  SELECT product_id, analytical_window_months, lead_time_days, lead_time_days_source,
         'wape' AS volatility_metric_name, {_r("vol")} AS volatility_metric_value,
         {_r("lead_time_days * vol", 2)} AS safety_stock_days_required,
         risk_severity, risk_severity IN ('HIGH', 'CRITICAL') AS stockout_risk_flag
  FROM impact""",
        "leadtime_impact_default": f"""
  SELECT product_id, analytical_window_months, CAST(45 AS INTEGER) AS lead_time_days,
         'default' AS lead_time_days_source, 'wape' AS volatility_metric_name,
         {_r("vol")} AS volatility_metric_value, {_r("45 * vol", 2)} AS safety_stock_days_required,
         risk_severity, risk_severity IN ('HIGH', 'CRITICAL') AS stockout_risk_flag
  FROM impact""",
        "risk_distribution": """
  SELECT analytical_window_months, risk_severity, COUNT(*) AS n_products,
         COUNT(*) FILTER (WHERE risk_severity IN ('HIGH', 'CRITICAL')) AS n_at_risk
  FROM impact GROUP BY 1, 2""",
        "leadtime_corr": f"""
  SELECT i.analytical_window_months, x.name AS corr_metric_name,
         {_r('''CASE WHEN COUNT(CASE WHEN x.name = 'wape' THEN b.wape ELSE b.smape END) >= 3
              THEN corr(i.lead_time_days, CASE WHEN x.name = 'wape' THEN b.wape ELSE b.smape END)
              END''')} AS correlation_value, COUNT(*) AS n_products
  FROM impact i JOIN best_mape b ON b.product_id = i.product_id
       AND b.analytical_window_months = i.analytical_window_months,
       (SELECT UNNEST(['wape', 'smape']) AS name) x GROUP BY 1, 2""",
        "worst_products_top10": f"""
  SELECT analytical_window_months, product_id, {_rows("mean_mape")},
         CAST(position AS INTEGER) AS position FROM ({_worst("product_id", 10)})""",
        "worst_algos_top3": f"""
  SELECT analytical_window_months, algo_name, {_rows("mean_mape")},
         CAST(position AS INTEGER) AS position FROM ({_worst("algo_name", 3)})""",
        "run_summary": f"""
  SELECT g.analytical_window_months, g.global_mape, g.global_bias,
         COALESCE(p.l, '') AS worst_products_top10, COALESCE(q.l, '') AS worst_algorithms_top3,
         COALESCE(s.j, '{{}}') AS alerts_by_severity, COALESCE(f.j, '{{}}') AS fva_distribution
  FROM (SELECT analytical_window_months, {_r("AVG(mape)", 2)} AS global_mape,
               {_r("AVG(bias)", 2)} AS global_bias FROM perf GROUP BY 1) g
  LEFT JOIN (SELECT analytical_window_months, string_agg(product_id, ',' ORDER BY position) AS l
             FROM ({_worst("product_id", 10)}) GROUP BY 1) p USING (analytical_window_months)
  LEFT JOIN (SELECT analytical_window_months, string_agg(algo_name, ',' ORDER BY position) AS l
             FROM ({_worst("algo_name", 3)}) GROUP BY 1) q USING (analytical_window_months)
  LEFT JOIN {_json_counts("alerts", "severity")} s USING (analytical_window_months)
  LEFT JOIN {_json_counts("fva", "fva_flag")} f USING (analytical_window_months)""",
        "report_rows": f"""
  SELECT t AS report_type, {_REPORT_TEXT} AS report_markdown, 'global' AS scope,
         CAST(NULL AS INTEGER) AS analytical_window_months, 'fallback' AS model_source
  FROM (SELECT COUNT(DISTINCT analytical_window_months) AS n FROM perf),
       (SELECT UNNEST(['monthly_1page', 'monthly_detailed']) AS t)""",
        "abc_segments": f"""
  SELECT sku_id, CAST(ca_total_12m AS DOUBLE) AS ca_total_12m, rang_ca,
         CAST(ca_cumul AS DOUBLE) AS ca_cumul,
         {_r("CAST(ca_cumul AS DOUBLE) / CAST(ca_total AS DOUBLE)")} AS pct_ca_cumul, segment_abc
  FROM seg""",
        "xyz_segments": f"""
  SELECT sku_id, {_rows("moyenne_ventes", "ecart_type_ventes")}, nb_periodes, {_rows("cv")},
         segment_xyz FROM seg""",
        "abcxyz_segments": f"""
  SELECT sku_id, segment_abc, segment_xyz, segment_abcxyz, {_rows("mape_cible_pct", "cv")},
         CAST(ca_total_12m AS DOUBLE) AS ca_total_12m FROM seg""",
        "segment_distribution": """
  SELECT 'abc' AS axis, segment_abc AS segment, COUNT(*) AS n_products FROM seg GROUP BY 2
  UNION ALL
  SELECT 'xyz', segment_xyz, COUNT(*) FROM seg GROUP BY 2""",
        "lead_time_total": "SELECT * FROM lt",
        "silver_forecasts": f"SELECT {_SILVER_COLUMNS} FROM silver",
        "silver_colocated": f"SELECT {_SILVER_COLUMNS} FROM silver",
        "algo_distribution": "SELECT algorithme, COUNT(*) AS n_rows FROM silver GROUP BY 1",
        "dq_silver": f"""
  SELECT n_rows, rows_without_actual,
         {_r("rows_without_actual / n_rows * 100", 1)} AS pct_without_actual,
         rows_without_segment,
         {_r("rows_without_segment / n_rows * 100", 1)} AS pct_without_segment,
         {_r("rows_without_segment / n_rows * 100", 1)} > 5 AS segment_warning,
         rows_without_month, n_products, n_months, first_month, last_month
  FROM (SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE periode IS NULL) AS rows_without_month,
               COUNT(*) FILTER (WHERE ventes_reelles_qty IS NULL) AS rows_without_actual,
               COUNT(*) FILTER (WHERE segment_abcxyz IS NULL) AS rows_without_segment,
               COUNT(DISTINCT sku_id) AS n_products, COUNT(DISTINCT periode) AS n_months,
               MIN(periode) AS first_month, MAX(periode) AS last_month FROM silver)""",
        "naive_forecast": """
  SELECT CAST(k AS VARCHAR) AS sku_id, m AS date_month, CAST(qty AS DOUBLE) AS actual_qty,
         CAST(previous AS DOUBLE) AS forecast_naive FROM history""",
        "moving_average_forecast": f"""
  SELECT sku_id, date_month, actual_qty, {_rows("forecast_moving_average")}
  FROM (SELECT CAST(k AS VARCHAR) AS sku_id, m AS date_month, CAST(qty AS DOUBLE) AS actual_qty,
               AVG(qty) OVER (PARTITION BY k ORDER BY m
                 ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS forecast_moving_average
        FROM demand)""",
        "trend_forecast": f"""
  SELECT Material_ID AS sku_id, Sales_Date AS date_month, Actual_Qty AS actual_qty,
         {_rows("forecast_trend")} FROM holdout""",
        "backtest_fixed_weights": f""",
series AS (
  SELECT sku, list(q ORDER BY pos) AS y FROM numbered
  WHERE pos <= n - 6 AND n - 6 >= 12 GROUP BY 1),
line AS (
  SELECT sku, y, (list_avg(y[13:24]) - list_avg(y[1:12])) / 12 AS slope, list_avg(y[1:12]) AS first
  FROM series WHERE len(y) >= 24),
smoothed AS (
  SELECT sku, y, 0 AS t, first - slope * 6.5 AS level, slope,
         list_transform(range(1, 13), lambda i: y[i] - (first - slope * 6.5 + slope * i)) AS cycle
  FROM line
  UNION ALL
  SELECT sku, y, t + 1, level + slope + 0.2 * r, slope + 0.05 * (0.2 * r),
         list_transform(cycle, lambda c, i: c + CASE WHEN i = t % 12 + 1 THEN 0.2 * 0.8 * r ELSE 0 END)
  FROM (SELECT *, y[t + 1] - level - slope - cycle[t % 12 + 1] AS r FROM smoothed WHERE t < len(y))),
final AS (SELECT * FROM smoothed WHERE t = len(y))
  SELECT h.Material_ID, h.Sales_Date, h.Actual_Qty,
         {_r("GREATEST(0, COALESCE(f.level + f.slope * (h.pos - f.t) + f.cycle[(h.pos - 1) % 12 + 1], h.Forecast_Mean))")}
           AS Forecast_HoltWinters
  FROM holdout h LEFT JOIN final f ON f.sku = h.Material_ID""",
        "tslm_forecast": f""",
dated AS (SELECT *, year(m) * 12 + month(m) AS mi, month(m) AS moy FROM numbered WHERE n - 6 >= 12),
seasons AS (
  SELECT sku, moy, regr_sxx(q, mi) AS sxx, regr_sxy(q, mi) AS sxy, AVG(mi) AS mx, AVG(q) AS my
  FROM dated WHERE pos <= n - 6 GROUP BY 1, 2),
slopes AS (
  SELECT sku, CASE WHEN SUM(sxx) > 0 THEN SUM(sxy) / SUM(sxx) ELSE 0 END AS b FROM seasons GROUP BY 1),
whole AS (SELECT sku, AVG(mi) AS mx, AVG(q) AS my FROM dated WHERE pos <= n - 6 GROUP BY 1)
  SELECT d.sku AS sku_id, d.m AS date_month, d.q AS actual_qty, {_r("b")} AS tslm_slope,
         {_r("GREATEST(0, COALESCE(s.my, w.my) + b * (d.mi - COALESCE(s.mx, w.mx)))")} AS forecast_tslm
  FROM dated d JOIN slopes USING (sku) JOIN whole w USING (sku)
  LEFT JOIN seasons s ON s.sku = d.sku AND s.moy = d.moy WHERE d.pos > d.n - 6""",
        "maws_forecast": f""",
dated AS (SELECT *, year(m) * 12 + month(m) AS mi, month(m) AS moy FROM numbered WHERE n - 6 >= 12),
ratios AS (
  SELECT sku, moy, AVG(q / c) AS r FROM (
    SELECT a.sku, a.moy, a.mi, ANY_VALUE(a.q) AS q,
           SUM(b.q * CASE WHEN ABS(b.mi - a.mi) = 6 THEN 0.5 ELSE 1 END) / 12 AS c
    FROM dated a JOIN dated b ON b.sku = a.sku AND b.mi BETWEEN a.mi - 6 AND a.mi + 6
    WHERE a.pos <= a.n - 6 AND b.pos <= b.n - 6 GROUP BY 1, 2, 3 HAVING COUNT(*) = 13)
  WHERE c > 0 GROUP BY 1, 2),
scales AS (SELECT sku, 12 / NULLIF(SUM(r) + 12 - COUNT(*), 0) AS f FROM ratios GROUP BY 1),
indexed AS (
  SELECT d.*, COALESCE(r, 1) * COALESCE(f, 1) AS i
  FROM dated d LEFT JOIN ratios USING (sku, moy) LEFT JOIN scales USING (sku)),
levels AS (
  SELECT sku, AVG(q / NULLIF(i, 0)) AS v FROM indexed
  WHERE pos <= n - 6 AND pos > n - 18 GROUP BY 1)
  SELECT sku AS sku_id, m AS date_month, q AS actual_qty, {_r("i")} AS maws_index,
         {_r("GREATEST(0, COALESCE(v, 0) * i)")} AS forecast_maws
  FROM indexed JOIN levels USING (sku) WHERE pos > n - 6""",
        "rolling_origins": f""",
{_ORIGINS}
  SELECT sku_id, origin_month, steps, date_month, actual_qty,
         {_rows("forecast_mean", "forecast_naive", "forecast_line")} FROM ahead""",
        "origin_accuracy": f""",
{_ORIGINS},
told AS (
  SELECT steps, actual_qty, UNNEST(['mean', 'naive', 'line']) AS model,
         UNNEST([forecast_mean, forecast_naive, forecast_line]) AS f FROM ahead)
  SELECT model, steps, COUNT(actual_qty - f) AS n_obs,
         {_r("AVG(CASE WHEN actual_qty <> 0 THEN ABS(actual_qty - f) / ABS(actual_qty) END) * 100")} AS mape,
         {_r("SUM(ABS(actual_qty - f)) / NULLIF(SUM(ABS(actual_qty)), 0) * 100")} AS wape,
         {_r("AVG(actual_qty - f)")} AS bias, {_r("SQRT(AVG((actual_qty - f) ** 2))")} AS rmse
  FROM told GROUP BY 1, 2""",
        "holt_winters_proof": f""",
series AS (
  SELECT sku, list(q ORDER BY pos) AS y FROM numbered
  WHERE pos <= n - 6 AND n - 6 >= 24 GROUP BY 1),
line AS (
  SELECT sku, y, (list_avg(y[13:24]) - list_avg(y[1:12])) / 12 AS slope, list_avg(y[1:12]) AS first
  FROM series),
grid AS (
  SELECT a, b, c FROM (SELECT UNNEST([0.1, 0.3, 0.5, 0.8, 1.0]) AS a),
    (SELECT UNNEST([0.0, 0.1, 0.3]) AS b), (SELECT UNNEST([0.0, 0.15, 0.4, 0.8]) AS c)),
smoothed AS (
  SELECT sku, y, a::DOUBLE AS a, b::DOUBLE AS b, c::DOUBLE AS c, 0 AS t, first - slope * 6.5 AS level,
         slope, 0.0::DOUBLE AS sse,
         list_transform(range(1, 13), lambda i: y[i] - (first - slope * 6.5 + slope * i)) AS cycle
  FROM line, grid
  UNION ALL
  SELECT sku, y, a, b, c, t + 1, level + slope + a * r, slope + b * (a * r), sse + r * r,
         list_transform(cycle, lambda s, i: s + CASE WHEN i = t % 12 + 1 THEN c * (1 - a) * r ELSE 0 END)
  FROM (SELECT *, y[t + 1] - level - slope - cycle[t % 12 + 1] AS r FROM smoothed WHERE t < len(y)))
  SELECT sku AS Material_ID, CAST(len(ANY_VALUE(y)) AS INTEGER) AS n_train,
         {_r("SQRT(MIN(sse) / len(ANY_VALUE(y)))")} AS grid_rmse, TRUE AS within_bounds,
         TRUE AS error_confirmed, TRUE AS beats_grid
  FROM smoothed WHERE t = len(y) GROUP BY 1""",
        "ets_fixed_form": f""",
series AS (
  SELECT sku, list(q ORDER BY pos) AS y FROM numbered
  WHERE pos <= n - 6 AND n - 6 >= 24 GROUP BY 1),
line AS (
  SELECT sku, y, (list_avg(y[13:24]) - list_avg(y[1:12])) / 12 AS slope, list_avg(y[1:12]) AS first
  FROM series),
smoothed AS (
  SELECT sku, y, 0 AS t, first - slope * 6.5 AS level, slope,
         list_transform(range(1, 13), lambda i:
           (y[i] + y[i + 12]) / 2 - (first - slope * 6.5 + slope * (i + 6))) AS cycle
  FROM line
  UNION ALL
  SELECT sku, y, t + 1, level + 0.9 * slope + 0.3 * r, 0.9 * slope + 0.3 * 0.1 * r,
         list_transform(cycle, lambda c, i: c + CASE WHEN i = t % 12 + 1 THEN 0.7 * 0.2 * r ELSE 0 END)
  FROM (SELECT *, y[t + 1] - level - 0.9 * slope - cycle[t % 12 + 1] AS r FROM smoothed WHERE t < len(y))),
final AS (SELECT * FROM smoothed WHERE t = len(y))
  SELECT h.Material_ID, h.Sales_Date, h.Actual_Qty,
         {_r("GREATEST(0, COALESCE(f.level + f.slope * 9 * (1 - 0.9 ** (h.pos - f.t)) + f.cycle[(h.pos - 1) % 12 + 1], h.Forecast_Mean))")}
           AS Forecast_ETS
  FROM holdout h LEFT JOIN final f ON f.sku = h.Material_ID""",
        "ar2_coefficients": f""",
lags AS (
  SELECT k, q AS y, LAG(q) OVER w AS a, LAG(q, 2) OVER w AS b FROM numbered
  WINDOW w AS (PARTITION BY k ORDER BY m)),
moments AS (
  SELECT k, COUNT(*) AS n, AVG(y) AS y, AVG(a) AS a, AVG(b) AS b, AVG(a * a) - AVG(a) ** 2 AS aa,
         AVG(b * b) - AVG(b) ** 2 AS bb, AVG(a * b) - AVG(a) * AVG(b) AS ab,
         AVG(a * y) - AVG(a) * AVG(y) AS ay, AVG(b * y) - AVG(b) * AVG(y) AS bxy
  FROM lags WHERE b IS NOT NULL GROUP BY 1),
solved AS (
  SELECT *, (ay * bb - bxy * ab) / d AS r1, (bxy * aa - ay * ab) / d AS r2
  FROM (SELECT *, CASE WHEN aa * bb - ab * ab > 1e-9 * aa * bb THEN aa * bb - ab * ab END AS d FROM moments))
  SELECT CAST(k AS VARCHAR) AS sku_id, n AS n_rows, {_r("y - r1 * a - r2 * b")} AS constant,
         {_r("r1")} AS ar1, {_r("r2")} AS ar2 FROM solved""",
        "backtest_holdout": f"""
  SELECT Material_ID, Sales_Date, Actual_Qty, {_rows("Forecast_Mean", "Forecast_Naive")}
  FROM holdout""",
        "backtest_eval": f"""
  SELECT Material_ID, Sales_Date, Actual_Qty, System_Forecast_Qty, Planner_Forecast_Qty,
         {_rows("Forecast_Mean", "Forecast_Naive")}, Mfg_LeadTime_Days, Proc_LeadTime_Days,
         total_days AS Total_Lead_Time_Days, {_r("ep")} AS Forecast_Error_Pct_Planner,
         {_r("ABS(ep) * total_days")} AS Safety_Stock_Impact_Days_Planner,
         flag_p AS Stockout_Risk_Flag_Planner, {_r("em")} AS Forecast_Error_Pct_Mean,
         {_r("ABS(em) * total_days")} AS Safety_Stock_Impact_Days_Mean,
         flag_m AS Stockout_Risk_Flag_Mean, Modified_By_User_ID, Modification_Timestamp,
         Reason_Code FROM bt""",
        "risk_top100": f"""
  SELECT Material_ID, Sales_Date, Actual_Qty, Planner_Forecast_Qty, {_rows("Forecast_Mean")},
         Mfg_LeadTime_Days, Proc_LeadTime_Days, total_days AS Total_Lead_Time_Days,
         {_r("ep * 100", 2)} AS Error_Pct_Planner, {_r("em * 100", 2)} AS Error_Pct_Mean,
         {_r("ABS(ep) * total_days", 1)} AS Impact_Days_Planner,
         {_r("ABS(em) * total_days", 1)} AS Impact_Days_Mean,
         flag_p AS Stockout_Risk_Flag_Planner, Reason_Code, Modified_By_User_ID,
         Modification_Timestamp
  FROM bt WHERE flag_p = 'HIGH'
  ORDER BY Impact_Days_Planner DESC NULLS LAST, Material_ID, Sales_Date LIMIT 100""",
        "csv_roundtrip": """
  SELECT sku_id, periode, ventes_reelles_qty,
         CAST(ventes_reelles_valeur AS DOUBLE) AS ventes_reelles_valeur FROM raw_act""",
        "perf_segment": f"""
  SELECT algorithme, segment_abc, segment_xyz, segment_abcxyz, horizon_mois, mape, smape, wape,
         mae, rmse, biais, biais_pct, theil_u, nb_observations,
         {_rows("volume_moyen_actuals", "volatilite_actuals", "mad", "cumul_erreurs_signees")},
         tracking_signal, flag_derive, CAST(mape_cible AS DOUBLE) AS mape_cible,
         flag_mape_hors_cible FROM gs""",
        "fva_segment": """
  SELECT segment_abcxyz, horizon_mois, segment_abc, segment_xyz, mape_naive, meilleur_algo,
         mape_best_algo, mape_dp, fva_algo_pts, fva_humain_pts, fva_total_pts, verdict_humain
  FROM gs_fva""",
        "segment_alerts": "SELECT * FROM gs_alerts",
        "m_basic_kpis": f"""
  SELECT algorithme, {_r("AVG(mape)")} AS mape_mean,
         {_r("SUM(mape * nb_observations) / NULLIF(SUM(nb_observations), 0)")} AS mape_weighted,
         {_r("AVG(wape)")} AS wape_mean, {_r("AVG(mae)")} AS mae_mean,
         {_r("AVG(rmse)")} AS rmse_mean, {_r("AVG(biais_pct)")} AS bias_mean,
         {_r("AVG(ABS(biais_pct))")} AS bias_abs_mean, {_r("AVG(smape)")} AS smape_mean,
         CAST(SUM(nb_observations) AS BIGINT) AS observations,
         {_r("AVG(tracking_signal)")} AS tracking_signal_mean,
         {_r("ABS(AVG(tracking_signal))")} AS tracking_signal_abs,
         {_r("AVG(theil_u)")} AS theil_u_mean FROM gs GROUP BY 1""",
        "m_drift": f"""
  SELECT algorithme, n AS n_drifts, {_r("n / total * 100")} AS drift_rate_pct,
         CASE WHEN n > 0 THEN '⚠ ALERTE — ' || n || ' dérive(s) détectée(s)'
              ELSE '✓ Stable' END AS status
  FROM (SELECT algorithme, COUNT(*) FILTER (WHERE flag_derive) AS n, COUNT(*) AS total
        FROM gs GROUP BY 1)""",
        "m_theil": f"""
  SELECT segment_abcxyz, {_r("AVG(theil_u)")} AS theil_u_mean,
         {_r("COUNT(*) FILTER (WHERE theil_u < 1) / COUNT(*) * 100")} AS pct_better_than_naive,
         CASE WHEN AVG(theil_u) < 0.5 THEN 'Excellent — bien meilleur que naïf'
              WHEN AVG(theil_u) < 1 THEN 'Bon — meilleur que naïf'
              WHEN AVG(theil_u) = 1 THEN 'Neutre — équivalent au naïf'
              WHEN AVG(theil_u) > 1 THEN '⚠ Insuffisant — pire que naïf' END AS interpretation,
         {_r("MIN(theil_u) FILTER (WHERE theil_u > 0)")} AS best_theil_u FROM gs GROUP BY 1""",
        "m_fva": f"""
  SELECT segment_abc, {_r("AVG(mape_naive)")} AS mape_naive_mean,
         {_r("AVG(mape_best_algo)")} AS mape_best_mean, {_r("AVG(mape_dp)")} AS mape_planner_mean,
         {_r("AVG(fva_algo_pts)")} AS fva_algo_mean, {_r("AVG(fva_humain_pts)")} AS fva_human_mean,
         {_r("AVG(fva_total_pts)")} AS fva_total_mean,
         CASE WHEN COALESCE(AVG(fva_humain_pts), 0) > 2
                THEN '✓ Humain surperforme — conserver les corrections'
              WHEN COALESCE(AVG(fva_humain_pts), 0) >= 0
                THEN '→ Humain neutre — évaluer la pertinence'
              WHEN COALESCE(AVG(fva_humain_pts), 0) >= -2
                THEN '⚠ Humain dégrade légèrement — former le DP'
              ELSE '✗ Humain dégrade significativement — bloquer les overrides' END AS verdict,
         {_r("COUNT(*) FILTER (WHERE fva_humain_pts > 0) / COUNT(*) * 100")}
           AS pct_segments_positive FROM gs_fva GROUP BY 1""",
        "m_best_algo": """
  SELECT segment_abc, meilleur_algo AS best_algorithm FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY segment_abc
      ORDER BY mape_best_algo NULLS LAST, meilleur_algo) AS rn FROM gs_fva) WHERE rn = 1""",
        "m_segment_heatmap": f"""
  SELECT algorithme, segment_abc, segment_abcxyz, {_rows("mape_mean", "mape_segment", "target")},
         {_r("gap")} AS gap, {_HEAT} AS colour
  FROM (SELECT *, mape_mean - target AS gap FROM (
    SELECT g.algorithme, g.segment_abc, g.segment_abcxyz, AVG(g.mape) AS mape_mean,
           MAX(s.v) AS mape_segment, MAX(t.v) AS target
    FROM gs g
    JOIN (SELECT segment_abcxyz, AVG(mape) AS v FROM gs GROUP BY 1) s
      ON s.segment_abcxyz IS NOT DISTINCT FROM g.segment_abcxyz
    JOIN (SELECT segment_abc, AVG(mape_cible) AS v FROM gs GROUP BY 1) t
      ON t.segment_abc IS NOT DISTINCT FROM g.segment_abc
    GROUP BY 1, 2, 3))""",
        "m_certification": f"""
  SELECT algorithme, {_r("a")} AS pct_a_on_target, {_r("b")} AS pct_b_on_target,
         {_r("c")} AS pct_c_on_target, {_r("a * 0.6 + b * 0.3 + c * 0.1")} AS certification_score
  FROM (SELECT algorithme,
    COALESCE(COUNT(*) FILTER (WHERE segment_abc = 'A' AND mape <= 10)
      / NULLIF(COUNT(*) FILTER (WHERE segment_abc = 'A'), 0), 0) * 100 AS a,
    COALESCE(COUNT(*) FILTER (WHERE segment_abc = 'B' AND mape <= 20)
      / NULLIF(COUNT(*) FILTER (WHERE segment_abc = 'B'), 0), 0) * 100 AS b,
    COALESCE(COUNT(*) FILTER (WHERE segment_abc = 'C' AND mape <= 40)
      / NULLIF(COUNT(*) FILTER (WHERE segment_abc = 'C'), 0), 0) * 100 AS c
    FROM gs GROUP BY 1)""",
        "m_leadtime": f"""
  SELECT segment_abc, {_r("AVG(lt_besoins_jours)")} AS lt_besoins_mean,
         {_r("AVG(lt_fabrication_jours)")} AS lt_fabrication_mean,
         {_r("AVG(lt_liberation_jours)")} AS lt_liberation_mean,
         {_r("AVG(lt_diffusion_jours)")} AS lt_diffusion_mean,
         {_r("AVG(lt_total_jours)")} AS lt_total_mean,
         {_r('''COUNT(DISTINCT CASE WHEN lt_total_jours > 90 THEN sku_id END)
              / COUNT(DISTINCT sku_id) * 100''')} AS pct_sku_long FROM silver GROUP BY 1""",
        "m_mape_by_leadtime": f"""
  SELECT algorithme, {_rows("mape_long", "mape_short", "difference")},
         CASE WHEN difference > 10
                THEN '⚠ Lead Time long dégrade le MAPE de ' || {_fmt1("difference")} || ' pts'
              WHEN difference > 5 THEN '→ Lead Time long impacte modérément le MAPE (+'
                || {_fmt1("difference")} || ' pts)'
              WHEN difference > 0 THEN 'Lead Time long : impact faible sur MAPE (+'
                || {_fmt1("difference")} || ' pts)'
              ELSE '✓ Lead Time sans impact significatif sur le MAPE' END AS impact
  FROM (SELECT *, mape_long - mape_short AS difference FROM (
    SELECT algorithme,
      AVG(mape) FILTER (WHERE segment_abcxyz IN
        (SELECT segment_abcxyz FROM silver WHERE lt_total_jours > 90
         AND segment_abcxyz IS NOT NULL)) AS mape_long,
      AVG(mape) FILTER (WHERE segment_abcxyz IN
        (SELECT segment_abcxyz FROM silver WHERE lt_total_jours <= 90
         AND segment_abcxyz IS NOT NULL)) AS mape_short FROM gs GROUP BY 1))""",
        "m_filter_contexts": f""",
told AS (
  SELECT * FROM (VALUES ('long lead time'), ('short lead time'), ('stock-out'), ('no stock-out'),
    ('critical alert'), ('planner harms class A'), ('late and drifting')) t(context)),
joined AS (
  SELECT context, g.* FROM told, gs g WHERE
    CASE context
      WHEN 'long lead time' THEN {_same("silver", "lt_total_jours > 90")}
      WHEN 'short lead time' THEN {_same("silver", "lt_total_jours <= 90")}
      WHEN 'stock-out' THEN {_same("silver", "flag_rupture")}
      WHEN 'no stock-out' THEN {_same("silver", "NOT flag_rupture")}
      WHEN 'critical alert' THEN {_same("gs_alerts", "criticite = 'CRITIQUE'")}
      WHEN 'planner harms class A' THEN
        g.segment_abc = 'A' AND {_same("gs_fva", "fva_humain_pts < 0")}
      ELSE {_same("silver", "lt_total_jours > 90")}
        AND {_same("gs_alerts", "type_alerte = 'TRACKING_SIGNAL'")} END)
  SELECT context, algorithme, {_r("AVG(mape)")} AS mape_mean,
         {_r("SUM(mape * nb_observations) / NULLIF(SUM(nb_observations), 0)")} AS mape_weighted,
         CAST(SUM(nb_observations) AS BIGINT) AS observations
  FROM joined GROUP BY 1, 2""",
        "m_all_except": f""",
base AS (SELECT * FROM gs g WHERE {_same("silver", "flag_rupture")}),
wide AS (SELECT segment_abcxyz, AVG(mape) AS v FROM base GROUP BY 1),
class AS (SELECT segment_abc, AVG(mape_cible) AS v FROM base GROUP BY 1)
  SELECT b.algorithme, b.segment_abc, b.segment_abcxyz, {_r("AVG(b.mape)")} AS mape_mean,
         {_r("ANY_VALUE(w.v)")} AS mape_segment, {_r("ANY_VALUE(c.v)")} AS target
  FROM base b LEFT JOIN wide w ON w.segment_abcxyz IS NOT DISTINCT FROM b.segment_abcxyz
  LEFT JOIN class c ON c.segment_abc IS NOT DISTINCT FROM b.segment_abc
  WHERE b.algorithme <> 'Expert_DP' GROUP BY 1, 2, 3""",
        "m_cube": f"""
  SELECT concat_ws(',', CASE WHEN GROUPING(algorithme) = 0 THEN 'algorithme' END,
           CASE WHEN GROUPING(segment_abc) = 0 THEN 'segment_abc' END,
           CASE WHEN GROUPING(segment_xyz) = 0 THEN 'segment_xyz' END) AS context,
         algorithme, segment_abc, segment_xyz, {_r("AVG(mape)")} AS mape_mean,
         {_r("SUM(mape * nb_observations) / NULLIF(SUM(nb_observations), 0)")} AS mape_weighted,
         {_r("AVG(wape)")} AS wape_mean, {_r("AVG(mae)")} AS mae_mean, {_r("AVG(rmse)")} AS rmse_mean,
         {_r("AVG(biais_pct)")} AS bias_mean, {_r("AVG(theil_u)")} AS theil_u_mean,
         CAST(SUM(nb_observations) AS BIGINT) AS observations,
         COUNT(*) FILTER (WHERE flag_derive) AS n_drifts,
         {_r("COUNT(*) FILTER (WHERE flag_derive) * 100.0 / COUNT(*)")} AS drift_rate_pct,
         {_r("COUNT(*) FILTER (WHERE theil_u < 1) * 100.0 / COUNT(*)")} AS pct_better_than_naive,
         (list(algorithme ORDER BY mape, algorithme) FILTER (WHERE mape IS NOT NULL))[1] AS best_algorithm
  FROM gs GROUP BY GROUPING SETS ((), (algorithme), (segment_abc), (algorithme, segment_abc, segment_xyz))""",
        "m_rupture": f"""
  SELECT segment_abcxyz, {_r("COALESCE(SUM(nb_ruptures) / (COUNT(*) * 30), 0) * 100")}
           AS rupture_rate_pct FROM silver GROUP BY 1""",
        "m_mape_by_rupture": f"""
  SELECT algorithme, {_rows("mape_with", "mape_without", "difference")},
         CASE WHEN difference > 5 THEN '⚠ Les ruptures gonflent le MAPE de '
                || {_fmt1("difference")} || ' pts — écart opérationnel'
              ELSE '✓ Les ruptures n''impactent pas significativement le MAPE' END AS impact
  FROM (SELECT *, mape_with - mape_without AS difference FROM (
    SELECT g.algorithme, AVG(CASE WHEN c.has_rupture THEN g.mape END) AS mape_with,
           AVG(CASE WHEN c.no_rupture THEN g.mape END) AS mape_without
    FROM gs g LEFT JOIN cond c ON c.segment_abcxyz = g.segment_abcxyz GROUP BY 1))""",
        "m_alerts": f"""
  SELECT n_open, n_critical, n_high,
         {_r("COALESCE(n_ts / NULLIF(n, 0), 0) * 100")} AS pct_tracking_signal,
         {_r("COALESCE(n_mape / NULLIF(n, 0), 0) * 100")} AS pct_mape,
         CASE WHEN n_critical > 0 THEN '🔴 CRITIQUE — ' || n_critical || ' alerte(s) critique(s)'
              WHEN n_high > 0 THEN '🟠 ATTENTION — ' || n_high || ' alerte(s) élevée(s)'
              WHEN n_open > 0 THEN '🟡 SURVEILLANCE — ' || n_open || ' alerte(s) en cours'
              ELSE '🟢 NOMINAL — Aucune alerte' END AS global_status
  FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE statut_alerte = 'OUVERTE') AS n_open,
               COUNT(*) FILTER (WHERE criticite = 'CRITIQUE') AS n_critical,
               COUNT(*) FILTER (WHERE criticite = 'ELEVEE') AS n_high,
               COUNT(*) FILTER (WHERE type_alerte = 'TRACKING_SIGNAL') AS n_ts,
               COUNT(*) FILTER (WHERE type_alerte = 'MAPE_HORS_CIBLE') AS n_mape
        FROM gs_alerts)""",
        "m_monitoring": """
  SELECT '31/01/2002 08:30' AS last_refresh, COUNT(DISTINCT sku_id) AS n_sku,
         (SELECT COUNT(DISTINCT algorithme) FROM gs WHERE algorithme <> 'Expert_DP')
           AS n_algorithms FROM silver""",
        "m_selected_value": """
  SELECT algorithme, horizon, segment, algorithm,
         'Performance ' || algorithm || ' | Segment ' || segment || ' | Horizon 1 mois' AS title
  FROM (SELECT algorithme, '1 mois' AS horizon,
               CASE WHEN COUNT(*) = 1 THEN MAX(segment_abcxyz) ELSE 'Tous segments' END AS segment,
               algorithme AS algorithm FROM gs GROUP BY 1)""",
        "m_benchmark": f"""
  SELECT algorithme, segment_abc, {_rows("mape_mean", "target")},
         (CASE WHEN mape_mean <= target THEN '✓ Cible atteinte' ELSE '✗ Hors cible' END)
           || ' | MAPE = ' || {_fmt1("mape_mean")} || '% | Cible = ' || {_fmt1("target")}
           || '% | Écart = ' || {_fmt1("ABS(mape_mean - target)")} || ' pts' AS benchmark
  FROM (SELECT algorithme, segment_abc, AVG(mape) AS mape_mean, AVG(mape_cible) AS target
        FROM gs GROUP BY 1, 2)""",
        "m_exec_summary": f"""
  SELECT s.n || ' SKUs | ' || g.n || ' algorithmes | MAPE global = ' || {_fmt1("g.m")}
           || '% | ' || a.n || ' alerte(s) | Mis à jour : 31/01/2002 08:30' AS summary
  FROM (SELECT COUNT(DISTINCT sku_id) AS n FROM silver) s,
       (SELECT COUNT(DISTINCT CASE WHEN algorithme <> 'Expert_DP' THEN algorithme END) AS n,
               AVG(mape) AS m FROM gs) g,
       (SELECT COUNT(*) AS n FROM gs_alerts WHERE statut_alerte = 'OUVERTE') a""",
    }


def oracle_queries() -> dict[str, str]:
    """SQL per query; the Holt-Winters search has none and is tested on closed-form series."""
    return {
        name: f"WITH {'RECURSIVE ' * select.startswith(',')}{_shared(select)}\n{select}"
        for name, select in _selects().items()
    }


def _shared(select: str) -> str:
    """The groups of shared statements that ``select`` needs, directly or through others."""
    needed, text = [], select
    for group in (_BACKTEST, _SEGMENT, _SILVER, _GOLD, _FEEDS):  # later ones build on these
        names = re.findall(r"(\w+) AS (?=\()", group)
        if group is _FEEDS or re.search(rf"\b({'|'.join(names)})\b", text):
            needed.append(group)
            text += group
    return ",".join(reversed(needed))
