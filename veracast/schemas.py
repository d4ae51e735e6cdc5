"""Table contracts: ordered, typed columns, checked on the driver without running a job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Column names and order are the contract other tools read.
RAW_FORECASTS = (
    "sku_id string, periode string, algorithme string, forecast_qty double, "
    "dci string, atc4 string"
)
RAW_ACTUALS = (
    "sku_id string, periode string, ventes_reelles_qty double, "
    "ventes_reelles_valeur decimal(18,4)"
)
RAW_LEAD_TIMES = (
    "sku_id string, periode string, lt_besoins_jours bigint, lt_fabrication_jours bigint, "
    "lt_liberation_jours bigint, lt_diffusion_jours bigint"
)
RAW_SUPPLY_CHAIN = (
    "sku_id string, periode string, nb_ruptures bigint, qty_commandee double, "
    "qty_facturee double"
)
SILVER = (
    "sku_id string, periode date, algorithme string, "
    "forecast_qty double, ventes_reelles_qty double, ventes_reelles_valeur decimal(18,4), "
    "ecart_qty double, ecart_pct double, "
    "segment_abc string, segment_xyz string, segment_abcxyz string, "
    "mape_cible_pct double, cv double, ca_total_12m decimal(28,4), "
    "lt_besoins_jours bigint, lt_fabrication_jours bigint, lt_liberation_jours bigint, "
    "lt_diffusion_jours bigint, lt_total_jours bigint, "
    "nb_ruptures bigint, qty_commandee double, qty_facturee double, flag_rupture boolean, "
    "dci string, atc4 string, date_traitement string, source_fichier string"
)
_AUDIT = "date_max_window timestamp, run_id string, generated_at timestamp"

CONTRACTS: dict[str, str] = {
    "forecasts_clean": SILVER,
    "error_detail": (
        "product_id string, algo_name string, date_month date, analytical_window_months int, "
        "actual_qty double, forecast_qty double, signed_error double, abs_error double, "
        "squared_error double, ape double, is_zero_actual boolean, " + _AUDIT
    ),
    "performance": (
        "product_id string, algo_name string, analytical_window_months int, mape double, "
        "wape double, rmse double, mae double, smape double, bias double, "
        "tracking_signal double, theils_u double, n_obs bigint, " + _AUDIT
    ),
    "forecast_value_added": (
        "product_id string, analytical_window_months int, naive_error_metric double, "
        "algo_error_metric double, planner_error_metric double, fva_value double, "
        "fva_flag string, n_obs bigint, " + _AUDIT
    ),
    "drift_alerts": (
        "product_id string, algo_name string, analytical_window_months int, "
        "tracking_signal double, alert_flag boolean, severity string, "
        "recommendation_text string, model_source string, " + _AUDIT
    ),
    "leaderboard": (
        "analytical_window_months int, segment_abcxyz string, algo_name string, "
        "avg_mape double, avg_wape double, avg_rmse double, avg_bias double, "
        "count_products bigint, rank_mape int, " + _AUDIT
    ),
    "leadtime_impact": (
        "product_id string, analytical_window_months int, lead_time_days int, "
        "lead_time_days_source string, volatility_metric_name string, "
        "volatility_metric_value double, safety_stock_days_required double, "
        "stockout_risk_flag boolean, risk_severity string, " + _AUDIT
    ),
    "leadtime_correlation": (
        "analytical_window_months int, corr_metric_name string, correlation_value double, "
        "n_products bigint, " + _AUDIT
    ),
    "dashboard_spec": (
        "spec_json string, scope string, model_source string, run_id string, "
        "generated_at timestamp"
    ),
    "reports": (
        "report_type string, report_markdown string, scope string, "
        "analytical_window_months int, model_source string, run_id string, "
        "generated_at timestamp"
    ),
    "segment_performance": (
        "algorithme string, segment_abc string, segment_xyz string, segment_abcxyz string, "
        "horizon_mois int, mape double, smape double, wape double, mae double, rmse double, "
        "biais double, biais_pct double, theil_u double, nb_observations bigint, "
        "volume_moyen_actuals double, volatilite_actuals double, mad double, "
        "cumul_erreurs_signees double, tracking_signal double, flag_derive boolean, "
        "mape_cible double, flag_mape_hors_cible boolean"
    ),
    "segment_value_added": (
        "segment_abcxyz string, horizon_mois int, segment_abc string, segment_xyz string, "
        "mape_naive double, meilleur_algo string, mape_best_algo double, mape_dp double, "
        "fva_algo_pts double, fva_humain_pts double, fva_total_pts double, "
        "verdict_humain string"
    ),
    "segment_alerts": (
        "algorithme string, segment_abcxyz string, type_alerte string, "
        "description_alerte string, recommandation string, criticite string, "
        "responsable string, statut_alerte string"
    ),
    "backtest_evaluation": (
        "Material_ID string, Sales_Date date, Actual_Qty double, System_Forecast_Qty double, "
        "Planner_Forecast_Qty double, Forecast_Prophet double, Forecast_HoltWinters double, "
        "Mfg_LeadTime_Days bigint, Proc_LeadTime_Days bigint, Total_Lead_Time_Days bigint, "
        "Forecast_Error_Pct_Planner double, Safety_Stock_Impact_Days_Planner double, "
        "Stockout_Risk_Flag_Planner string, Forecast_Error_Pct_Prophet double, "
        "Safety_Stock_Impact_Days_Prophet double, Stockout_Risk_Flag_Prophet string, "
        "Modified_By_User_ID string, Modification_Timestamp timestamp, Reason_Code string"
    ),
}

# The nine tables the product-grain audit publishes.
GOLD_TABLES = (
    "error_detail",
    "performance",
    "forecast_value_added",
    "drift_alerts",
    "leaderboard",
    "leadtime_impact",
    "leadtime_correlation",
    "dashboard_spec",
    "reports",
)


def contract(table: str) -> StructType:
    if table not in CONTRACTS:
        raise ValueError(f"no contract for table {table!r}; known: {sorted(CONTRACTS)}")
    return StructType.fromDDL(CONTRACTS[table])


def column_names(ddl: str) -> list[str]:
    return StructType.fromDDL(ddl).fieldNames()


def require_columns(df: DataFrame, required: Iterable[str], table: str) -> DataFrame:
    """Presence check for inputs; types and extra columns are the reader's business."""
    missing = sorted(set(required).difference(df.columns))
    if missing:
        raise ValueError(f"{table}: missing columns {missing}; present: {sorted(df.columns)}")
    return df


def conform(df, table: str):
    """Exactly the contract's columns, in its order and types; anything else is an error.

    Safe widening (int to bigint) is applied, a lossy cast is refused. A pandas frame is
    checked and reordered by name only.
    """
    schema = contract(table)
    names = schema.fieldNames()
    missing = [c for c in names if c not in df.columns]
    extra = [c for c in df.columns if c not in names]
    if missing or extra:
        raise ValueError(f"{table}: contract broken, missing={missing} extra={extra}")
    return df.to(schema) if isinstance(df, DataFrame) else df[names]
