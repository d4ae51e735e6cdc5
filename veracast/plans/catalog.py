"""Every operator as a named query over the given tables: ``(spark, sf_dir) -> DataFrame``.

Results are prepared for comparison with another engine: doubles are rounded after dropping
binary noise, decimals become doubles, run identity and timestamps of the run are left out.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, TimestampType

from veracast import contexts, measures
from veracast.context import stamp_raw_load
from veracast.config import WINDOWS_EXEC, WINDOWS_FULL, Settings
from veracast.functions.arima import arima
from veracast.functions.forecasters import holt_winters
from veracast.functions.loess import stlf
from veracast.functions.numeric import rounded
from veracast.functions.statespace import ets, fixed_form
from veracast.operators import accuracy, alerts, backtest, baselines, clean, fits, horizons
from veracast.operators import leadtime, monthly_state, origins, seasonal, segment_kpis
from veracast.operators import segmentation, silver, summary, value_added
from veracast.schemas import RAW_ACTUALS, conform
from veracast.plans import colocated, orderbook
from veracast.sources import lake, quarantine
from veracast.sources.scratch import fresh_path, stage, stage_in_buckets

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = Settings()
# The processing time is an input of the Silver build; a constant keeps the result repeatable.
PROCESSED_AT = dt.datetime(2002, 1, 31, 8, 30)
QUERIES: dict[str, Query] = {}
# The operators as a user calls them, before their results are prepared for comparison.
BUILDS: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    def shown(field):
        if isinstance(field.dataType, DoubleType):
            value = F.col(field.name)
            # Most quantities are whole: there is nothing to round, and a decimal takes long to make.
            whole = (value == F.rint(value)) & (F.abs(value) < 1e15)
            return F.when(whole, value + 0.0).otherwise(rounded(value, 6)).alias(field.name)
        if isinstance(field.dataType, DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, TimestampType):
            # Wall-clock time, whatever the session's time zone.
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select(*[shown(field) for field in df.schema.fields])


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(spark, sf_dir))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    BUILDS[build.__name__] = build
    return run


# -- shared inputs -----------------------------------------------------------------------


def _staged_performance(spark, sf_dir):
    """For queries that read the performance table more than once."""
    return stage(_performance(spark, sf_dir), "performance")


def _raw_actuals(spark, sf_dir):
    return orderbook.raw_actuals(orderbook.monthly_demand(spark, sf_dir))


def _raw_forecasts(spark, sf_dir):
    return orderbook.raw_forecasts(orderbook.monthly_demand(spark, sf_dir), spark, sf_dir)


def _raw_lead_times(spark, sf_dir):
    return orderbook.raw_lead_times(orderbook.monthly_demand(spark, sf_dir))


def _performance(spark, sf_dir):
    rows = orderbook.audit_rows(spark, sf_dir)
    return accuracy.performance(rows, orderbook.last_month(spark, sf_dir), WINDOWS_EXEC)


def _profile(spark, sf_dir):
    actuals = silver.clean_actuals(_raw_actuals(spark, sf_dir))
    return segmentation.sales_profile(actuals, SETTINGS, orderbook.last_month(spark, sf_dir))


def _segments(spark, sf_dir):
    return segmentation.abcxyz_segments(_profile(spark, sf_dir), SETTINGS)


# Silver's columns that the segment KPIs read.
SEGMENT_INPUT = (
    "sku_id", "periode", "algorithme", "forecast_qty", "ventes_reelles_qty", "segment_abc",
    "segment_xyz", "segment_abcxyz",
)
# The same with the naive forecast at hand, for which products and months are needed otherwise.
SEGMENT_ROWS = (*[c for c in SEGMENT_INPUT if c not in silver.MONTH_KEY], silver.NAIVE)


def _silver(spark, sf_dir, columns=None):
    buckets = orderbook.bucket_count(spark, sf_dir)
    return silver.build_silver(
        orderbook.raw_tables(spark, sf_dir),
        PROCESSED_AT,
        "order lines",
        SETTINGS,
        keep=lambda df, label: stage_in_buckets(df, label, buckets, "sku_id"),
        columns=columns,
        in_place=True,
    )


def _staged_silver(spark, sf_dir, columns=None):
    """For queries that read Silver, or some columns of it, more than once."""
    return stage(_silver(spark, sf_dir, columns), "silver")


def _impact(spark, sf_dir):
    return leadtime.leadtime_impact(
        _performance(spark, sf_dir), orderbook.master_lead_time(spark, sf_dir), SETTINGS
    )


def _segment_perf(spark, sf_dir):
    return segment_kpis.segment_performance(_silver(spark, sf_dir, SEGMENT_ROWS), SETTINGS)


def _evaluation(spark, sf_dir):
    demand = stage(orderbook.monthly_demand(spark, sf_dir), "demand")
    holdout = backtest.holdout_forecasts(
        orderbook.backtest_sales(spark, sf_dir, demand),
        {"Forecast_Mean": backtest.mean_column, "Forecast_Naive": backtest.last_column},
        SETTINGS,
        one_row_per_date=True,
    )
    return backtest.evaluate_backtest(
        holdout,
        orderbook.backtest_planner(spark, sf_dir, demand),
        orderbook.backtest_master(spark, sf_dir),
        model="Forecast_Mean",
        settings=SETTINGS,
    )


# -- cleaning and windows ----------------------------------------------------------------


@query
def align_month(spark, sf_dir):
    return clean.align_month(_raw_actuals(spark, sf_dir))


@query
def normalize_inputs(spark, sf_dir):
    rows = orderbook.audit_rows(spark, sf_dir).select(
        "sku_id",
        F.date_add("date_month", 14).alias("periode"),
        F.col("algo_name").alias("algorithme"),
        F.col("actual_qty").alias("ventes_reelles_qty"),
        "forecast_qty",
    )
    return clean.normalize_inputs(rows)


@query
def input_profile(spark, sf_dir):
    return clean.input_profile(orderbook.audit_rows(spark, sf_dir))


@query
def algo_whitelist(spark, sf_dir):
    return clean.known_algorithms(
        _raw_forecasts(spark, sf_dir), SETTINGS.valid_algorithms
    )


@query
def algo_census(spark, sf_dir):
    return clean.algorithm_census(
        _raw_forecasts(spark, sf_dir), SETTINGS.valid_algorithms
    )


@query
def month_census(spark, sf_dir):
    """A month text in no accepted format, for the products whose number ends with 7."""
    broken = F.when(F.col("sku_id").endswith("7"), F.lit("no month")).otherwise(F.col("periode"))
    return clean.month_census(_raw_actuals(spark, sf_dir).withColumn("periode", broken))


@query
def dedup_key(spark, sf_dir):
    aligned = clean.align_month(_raw_actuals(spark, sf_dir))
    return clean.one_row_per_key(aligned, ["sku_id", "periode"])


@query
def fill_defaults(spark, sf_dir):
    raw = _raw_lead_times(spark, sf_dir)
    return clean.fill_defaults(raw, dict.fromkeys(silver.STAGES, 0))


@query
def max_month(spark, sf_dir):
    return horizons.max_month(orderbook.audit_rows(spark, sf_dir))


@query
def window_filter(spark, sf_dir):
    rows = orderbook.audit_rows(spark, sf_dir)
    return horizons.window_filter(rows, orderbook.last_month(spark, sf_dir), 6)


@query
def window_assign(spark, sf_dir):
    rows = orderbook.audit_rows(spark, sf_dir)
    return horizons.assign_windows(rows, orderbook.last_month(spark, sf_dir), WINDOWS_EXEC)


# -- product-grain accuracy --------------------------------------------------------------


@query
def error_detail(spark, sf_dir):
    rows = orderbook.audit_rows(spark, sf_dir)
    return accuracy.error_detail(rows, orderbook.last_month(spark, sf_dir), WINDOWS_EXEC)


@query
def perf_product(spark, sf_dir):
    return _performance(spark, sf_dir)


@query
def perf_product_theil(spark, sf_dir):
    """Theil's U against the previous observed month, switched on."""
    actuals = baselines.naive_forecast(orderbook.monthly_actuals(spark, sf_dir))
    rows = actuals.select(
        "sku_id",
        "date_month",
        F.lit("moving_average").alias("algo_name"),
        "actual_qty",
        F.avg("actual_qty").over(baselines.trailing(3)).alias("forecast_qty"),
        "forecast_naive",
    )
    return accuracy.performance(
        rows, orderbook.last_month(spark, sf_dir), WINDOWS_EXEC, naive_column="forecast_naive"
    )


@query
def perf_product_full24(spark, sf_dir):
    rows = orderbook.audit_rows(spark, sf_dir)
    # A part's month has a line at least, and a row for each algorithm. Parquet knows its rows.
    most = orderbook.table(spark, sf_dir, "lineitem").count() * (len(orderbook.MODELS) + 1)
    return accuracy.performance_all_windows(
        rows,
        orderbook.last_month(spark, sf_dir),
        max(WINDOWS_FULL),
        accuracy.task_count(spark, most),
    )


@query
def perf_incremental(spark, sf_dir):
    """All windows from stored states: history, a draft of the newest month, then that month again."""
    rows = stage(orderbook.audit_rows(spark, sf_dir), "audit-rows")
    anchor = orderbook.last_month(spark, sf_dir)
    newest = F.col("date_month") == anchor
    draft = rows.where(newest).withColumn("forecast_qty", F.col("forecast_qty") + 100)
    path = fresh_path(spark, "month-states")
    for part in (rows.where(~newest), draft, rows.where(newest)):
        monthly_state.load_months(part, path)
    states = monthly_state.stored_states(spark, path)
    return monthly_state.performance_of_states(states, anchor, WINDOWS_FULL)


@query
def perf_union_windows(spark, sf_dir):
    rows = orderbook.audit_rows(spark, sf_dir)
    return accuracy.performance_by_union(rows, orderbook.last_month(spark, sf_dir), WINDOWS_EXEC)


@query
def best_algo_wape(spark, sf_dir):
    return accuracy.best_algorithm(_performance(spark, sf_dir), "wape")


@query
def best_algo_mape(spark, sf_dir):
    return accuracy.best_algorithm(_performance(spark, sf_dir), "mape")


@query
def best_mape_top5(spark, sf_dir):
    """The five best rows of the segment performance table."""
    perf = _segment_perf(spark, sf_dir)
    return (
        perf.orderBy(F.col("mape").asc_nulls_last(), "algorithme", "segment_abcxyz")
        .limit(5)
        .select("algorithme", "segment_abcxyz", "mape")
    )


@query
def leaderboard_all(spark, sf_dir):
    return accuracy.leaderboard(_performance(spark, sf_dir), one_row_per_product=True)


@query
def leaderboard_segment(spark, sf_dir):
    segments = _segments(spark, sf_dir).select(
        F.col("sku_id").alias("product_id"), "segment_abcxyz"
    )
    perf = _performance(spark, sf_dir).join(segments, "product_id", "left")
    return accuracy.leaderboard(perf, one_row_per_product=True)


@query
def fva_product(spark, sf_dir):
    return value_added.forecast_value_added(_performance(spark, sf_dir))


@query
def drift_alerts(spark, sf_dir):
    return alerts.drift_alerts(_performance(spark, sf_dir), SETTINGS).drop(
        "recommendation_text", "model_source"
    )


@query
def alert_text(spark, sf_dir):
    raised = alerts.drift_alerts(_performance(spark, sf_dir), SETTINGS)
    return alerts.with_alert_text(raised)


@query
def leadtime_impact(spark, sf_dir):
    return _impact(spark, sf_dir)


@query
def leadtime_impact_default(spark, sf_dir):
    """Without master data every product uses the default lead time."""
    return leadtime.leadtime_impact(_performance(spark, sf_dir), None, SETTINGS)


@query
def volatility_fallback(spark, sf_dir):
    """Without a WAPE column the next preferred metric sizes the stock."""
    perf = _performance(spark, sf_dir).drop("wape", "smape")
    return leadtime.leadtime_impact(perf, None, SETTINGS)


@query
def fva_without_algorithms(spark, sf_dir):
    """Only baselines and the planner: a typed empty table."""
    perf = _performance(spark, sf_dir)
    return value_added.forecast_value_added(perf.where("algo_name IN ('naive', 'Expert_DP')"))


@query
def perf_published(spark, sf_dir):
    """The performance table as it is published: stamped and held to its contract."""
    month = orderbook.last_month(spark, sf_dir)
    stamps = {
        "run_id": F.lit("a run"),
        "generated_at": F.lit(PROCESSED_AT).cast("timestamp"),
        "date_max_window": (month if isinstance(month, Column) else F.lit(month)).cast("timestamp"),
    }
    return conform(_performance(spark, sf_dir).withColumns(stamps), "performance")


@query
def risk_distribution(spark, sf_dir):
    return leadtime.risk_distribution(_impact(spark, sf_dir))


@query
def leadtime_corr(spark, sf_dir):
    impact = leadtime.leadtime_impact(
        _performance(spark, sf_dir),
        orderbook.master_lead_time(spark, sf_dir),
        SETTINGS,
        keep_metrics=True,
    )
    return leadtime.leadtime_correlation(impact)


@query
def worst_products_top10(spark, sf_dir):
    return summary.worst_by(_performance(spark, sf_dir), "product_id", 10)


@query
def worst_algos_top3(spark, sf_dir):
    return summary.worst_by(_performance(spark, sf_dir), "algo_name", 3)


@query
def run_summary(spark, sf_dir):
    perf = _staged_performance(spark, sf_dir)
    rows = summary.run_summary(
        perf, value_added.forecast_value_added(perf), alerts.drift_alerts(perf, SETTINGS)
    )
    as_json = ("alerts_by_severity", "fva_distribution")
    as_text = ("worst_products_top10", "worst_algorithms_top3")
    return rows.withColumns(
        {c: F.to_json(c) for c in as_json} | {c: F.concat_ws(",", c) for c in as_text}
    )


@query
def dashboard_spec(spark, sf_dir):
    """Mandatory keys that the specification lacks, and the windows it names."""
    perf = _staged_performance(spark, sf_dir)
    overview = summary.run_summary(
        perf, value_added.forecast_value_added(perf), alerts.drift_alerts(perf, SETTINGS)
    )
    spec = summary.missing_spec_keys(summary.dashboard_spec(overview, SETTINGS))
    windows = F.get_json_object("spec_json", "$.windows").alias("windows")
    return spec.select(F.size("missing_keys").alias("n_missing_keys"), windows, "scope")


@query
def report_rows(spark, sf_dir):
    return summary.report_rows(_performance(spark, sf_dir))


# -- segmentation and Silver -------------------------------------------------------------


@query
def abc_segments(spark, sf_dir):
    return segmentation.abc_segments(_profile(spark, sf_dir), SETTINGS).select(
        "sku_id", "ca_total_12m", "rang_ca", "ca_cumul", "pct_ca_cumul", "segment_abc"
    )


@query
def xyz_segments(spark, sf_dir):
    return segmentation.xyz_segments(_profile(spark, sf_dir), SETTINGS).select(
        "sku_id", "moyenne_ventes", "ecart_type_ventes", "nb_periodes", "cv", "segment_xyz"
    )


@query
def abcxyz_segments(spark, sf_dir):
    return _segments(spark, sf_dir).select(
        "sku_id", "segment_abc", "segment_xyz", "segment_abcxyz", "mape_cible_pct", "cv",
        "ca_total_12m",
    )


@query
def segment_distribution(spark, sf_dir):
    return segmentation.segment_distribution(_segments(spark, sf_dir))


@query
def lead_time_total(spark, sf_dir):
    return silver.clean_lead_times(_raw_lead_times(spark, sf_dir))


@query
def silver_forecasts(spark, sf_dir):
    return _silver(spark, sf_dir)


@query
def silver_colocated(spark, sf_dir):
    """Silver from feeds in buckets of product and month; they are dropped when it is staged."""
    prefix = colocated.fresh_prefix()
    try:
        raw = orderbook.raw_tables(spark, sf_dir)
        # Lead times come once per product month.
        buckets = colocated.bucket_count(raw.lead_times.count())
        colocated.save_feeds(raw, prefix, buckets)
        built = colocated.silver_of_feeds(
            spark, prefix, buckets, PROCESSED_AT, "order lines", SETTINGS
        )
        return stage(built, "silver-colocated")
    finally:
        colocated.drop_feeds(spark, prefix)


@query
def algo_distribution(spark, sf_dir):
    return silver.algorithm_distribution(_silver(spark, sf_dir, ("algorithme",)))


@query
def dq_silver(spark, sf_dir):
    read = ("sku_id", "periode", "ventes_reelles_qty", "segment_abcxyz")
    return silver.quality_report(_staged_silver(spark, sf_dir, read))


# -- baselines and back-test -------------------------------------------------------------


@query
def naive_forecast(spark, sf_dir):
    return baselines.naive_forecast(orderbook.monthly_actuals(spark, sf_dir))


@query
def moving_average_forecast(spark, sf_dir):
    return baselines.moving_average_forecast(orderbook.monthly_actuals(spark, sf_dir))


@query
def trend_forecast(spark, sf_dir):
    return baselines.trend_forecast(
        orderbook.monthly_actuals(spark, sf_dir),
        SETTINGS.holdout_months,
        SETTINGS.min_train_months,
    )


@query
def backtest_holdout(spark, sf_dir):
    return backtest.holdout_forecasts(
        orderbook.backtest_sales(spark, sf_dir),
        {"Forecast_Mean": backtest.mean_column, "Forecast_Naive": backtest.last_column},
        SETTINGS,
        one_row_per_date=True,
    )


@query
def backtest_holt_winters(spark, sf_dir):
    return backtest.holdout_forecasts(
        orderbook.backtest_sales(spark, sf_dir),
        {"Forecast_HoltWinters": holt_winters(SETTINGS.season_months)},
        SETTINGS,
        one_row_per_date=True,
    )


@query
def backtest_fixed_weights(spark, sf_dir):
    """The smoothing itself, with given weights instead of a search."""
    smoothed = holt_winters(SETTINGS.season_months, weights=(0.2, 0.05, 0.2))
    return backtest.holdout_forecasts(
        orderbook.backtest_sales(spark, sf_dir),
        {"Forecast_HoltWinters": smoothed},
        SETTINGS,
        one_row_per_date=True,
    )


@query
def backtest_eval(spark, sf_dir):
    return _evaluation(spark, sf_dir)


@query
def risk_top100(spark, sf_dir):
    return backtest.top_stockout_risks(_evaluation(spark, sf_dir), "Forecast_Mean", 100)


@query
def tslm_forecast(spark, sf_dir):
    return seasonal.tslm_forecast(
        orderbook.monthly_actuals(spark, sf_dir),
        SETTINGS.holdout_months,
        SETTINGS.min_train_months,
    )


@query
def maws_forecast(spark, sf_dir):
    return seasonal.maws_forecast(
        orderbook.monthly_actuals(spark, sf_dir),
        SETTINGS.holdout_months,
        SETTINGS.min_train_months,
    )


def _origins(spark, sf_dir):
    return origins.rolling_origins(
        orderbook.monthly_actuals(spark, sf_dir),
        max(WINDOWS_FULL),
        SETTINGS.holdout_months,
        SETTINGS.min_train_months,
    )


@query
def rolling_origins(spark, sf_dir):
    return _origins(spark, sf_dir)


@query
def origin_accuracy(spark, sf_dir):
    return origins.accuracy_by_steps(_origins(spark, sf_dir))


@query
def holt_winters_fit(spark, sf_dir):
    return fits.holt_winters_fit(
        orderbook.backtest_sales(spark, sf_dir), SETTINGS, one_row_per_date=True
    )


# Weights that the fit is held against; none of them is where it starts from, but for (0, 0, 0).
PROOF_GRID = ((0.1, 0.3, 0.5, 0.8, 1.0), (0.0, 0.1, 0.3), (0.0, 0.15, 0.4, 0.8))


@query
def holt_winters_proof(spark, sf_dir):
    """The fit's weights against the error of a grid that it didn't search."""
    return fits.holt_winters_proof(
        orderbook.backtest_sales(spark, sf_dir), PROOF_GRID, SETTINGS, one_row_per_date=True
    )


def _backtest(spark, sf_dir, name, forecaster):
    return backtest.holdout_forecasts(
        orderbook.backtest_sales(spark, sf_dir), {name: forecaster}, SETTINGS, one_row_per_date=True
    )


@query
def ets_fixed_form(spark, sf_dir):
    """Damped trend and additive season with given weights."""
    form = fixed_form("ADA", (0.3, 0.1, 0.2, 0.9), SETTINGS.season_months)
    return _backtest(spark, sf_dir, "Forecast_ETS", form)


@query
def ets_fit(spark, sf_dir):
    return fits.ets_fit(
        orderbook.backtest_sales(spark, sf_dir), SETTINGS, one_row_per_date=True
    )


@query
def backtest_ets(spark, sf_dir):
    return _backtest(spark, sf_dir, "Forecast_ETS", ets(SETTINGS.season_months))


@query
def backtest_arima(spark, sf_dir):
    return _backtest(spark, sf_dir, "Forecast_ARIMA", arima)


@query
def arima_orders(spark, sf_dir):
    return fits.arima_orders(
        orderbook.backtest_sales(spark, sf_dir), SETTINGS, one_row_per_date=True
    )


@query
def ar2_coefficients(spark, sf_dir):
    return fits.ar2_coefficients(orderbook.monthly_actuals(spark, sf_dir))


@query
def backtest_stlf(spark, sf_dir):
    return _backtest(spark, sf_dir, "Forecast_STLF", stlf(SETTINGS.season_months))


# -- sources and sinks -------------------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    """Raw actuals written as CSV by all tasks and read back with a declared schema."""
    path = fresh_path(spark, "csv-roundtrip")
    lake.write_csv(_raw_actuals(spark, sf_dir), path)
    return lake.read_csv(spark, path, RAW_ACTUALS)


@query
def lake_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "lake-roundtrip")
    lake.write_table(_raw_actuals(spark, sf_dir), path)
    return lake.read_table(spark, path)


@query
def managed_table(spark, sf_dir):
    """A managed table bucketed by product, grouped by it; dropped when its result is staged."""
    name = f"raw_actuals_{uuid.uuid4().hex}"
    lake.save_managed(_raw_actuals(spark, sf_dir), name, bucket_by=(8, "sku_id"))
    totals = lake.read_catalog(spark, name).groupBy("sku_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("ventes_reelles_qty").alias("qty")
    )
    try:
        return stage(totals, "managed-totals")
    finally:
        spark.sql(f"DROP TABLE {name}")


@query
def csv_fallback(spark, sf_dir):
    """The CSV copy's rows where the lake has no table, and the lake's once they are loaded."""
    copy, table = fresh_path(spark, "csv-copy"), fresh_path(spark, "csv-loaded")
    lake.write_csv(_raw_actuals(spark, sf_dir), copy)

    def read(branch):
        rows = lake.read_table(spark, table, csv_fallback=copy, schema=RAW_ACTUALS)
        return rows.withColumn("branch", F.lit(branch))

    from_copy = read("copy")
    lake.load_csv_to_lake(spark, copy, table, RAW_ACTUALS)
    return from_copy.unionByName(read("lake"))


@query
def csv_quarantine(spark, sf_dir):
    """Rows with a quantity that is none, or a field too many, per product beside the loaded ones."""
    raw = _raw_actuals(spark, sf_dir)
    k = F.col("sku_id").cast("long")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw.columns]
    fields[2] = F.when(k % 17 == 0, F.lit("n/a")).otherwise(fields[2])
    line = F.concat_ws(",", *fields, F.when(k % 19 == 0, F.lit("more")))
    copy = fresh_path(spark, "csv-raw")
    raw.select(line.alias("value")).write.text(copy)
    table, bad = fresh_path(spark, "csv-good"), fresh_path(spark, "csv-bad")
    quarantine.load_csv_checked(
        spark, copy, table, bad, RAW_ACTUALS, most_rejected=0.5, header=False
    )
    good = lake.read_table(spark, table).select(
        "sku_id", F.lit("loaded").alias("state"), "ventes_reelles_qty"
    )
    apart = lake.read_table(spark, bad).select(
        F.split("row_text", ",")[0].alias("sku_id"),
        F.col("reason").alias("state"),
        F.lit(None).cast("double").alias("ventes_reelles_qty"),
    )
    return good.unionByName(apart).groupBy("sku_id", "state").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("ventes_reelles_qty").alias("qty")
    )


@query
def raw_load_audit(spark, sf_dir):
    return stamp_raw_load(_raw_actuals(spark, sf_dir), PROCESSED_AT, "loader", "monthly load")


# -- segment grain and BI measures -------------------------------------------------------


@query
def perf_segment(spark, sf_dir):
    return _segment_perf(spark, sf_dir)


@query
def fva_segment(spark, sf_dir):
    return segment_kpis.segment_value_added(_silver(spark, sf_dir, SEGMENT_ROWS), SETTINGS)


@query
def segment_alerts(spark, sf_dir):
    return segment_kpis.segment_alerts(_segment_perf(spark, sf_dir), SETTINGS)


@query
def m_basic_kpis(spark, sf_dir):
    return measures.basic_kpis(_segment_perf(spark, sf_dir), ["algorithme"])


@query
def m_drift(spark, sf_dir):
    return measures.drift(_segment_perf(spark, sf_dir), ["algorithme"])


@query
def m_theil(spark, sf_dir):
    return measures.theil(_segment_perf(spark, sf_dir), ["segment_abcxyz"])


@query
def m_fva(spark, sf_dir):
    fva = segment_kpis.segment_value_added(_silver(spark, sf_dir, SEGMENT_ROWS), SETTINGS)
    return measures.value_added(fva, ["segment_abc"])


@query
def m_best_algo(spark, sf_dir):
    fva = segment_kpis.segment_value_added(_silver(spark, sf_dir, SEGMENT_ROWS), SETTINGS)
    return measures.best_algorithm(fva, ["segment_abc"])


@query
def m_segment_heatmap(spark, sf_dir):
    return measures.segment_heatmap(_segment_perf(spark, sf_dir))


@query
def m_certification(spark, sf_dir):
    return measures.certification(_segment_perf(spark, sf_dir), ["algorithme"], SETTINGS)


@query
def m_leadtime(spark, sf_dir):
    read = ("sku_id", "segment_abc", *silver.STAGES, "lt_total_jours")
    return measures.lead_times(_silver(spark, sf_dir, read), ["segment_abc"], SETTINGS)


@query
def m_mape_by_leadtime(spark, sf_dir):
    rows = _staged_silver(spark, sf_dir, (*SEGMENT_ROWS, "lt_total_jours"))
    perf = segment_kpis.segment_performance(rows, SETTINGS)
    return measures.mape_by_lead_time(perf, rows, ["algorithme"], SETTINGS)


def _model(spark, sf_dir):
    """The tables that filters travel between."""
    rows = _staged_silver(spark, sf_dir, (*SEGMENT_ROWS, "lt_total_jours", "flag_rupture"))
    totals = stage(segment_kpis.segment_totals(rows), "segment-totals")
    perf = segment_kpis.performance_of_totals(totals, SETTINGS)
    return {
        "silver": rows,
        "performance": perf,
        "fva": segment_kpis.value_added_of_totals(totals, SETTINGS),
        "alerts": segment_kpis.segment_alerts(perf, SETTINGS),
    }


def _contexts():
    late, day = SETTINGS.long_lead_time_days, "lt_total_jours"
    top = contexts.Context(by=("algorithme",))
    return {
        "long lead time": top.where("silver", day, lambda c: c > late),
        "short lead time": top.where("silver", day, lambda c: c <= late),
        "stock-out": top.where("silver", "flag_rupture", lambda c: c),
        "no stock-out": top.where("silver", "flag_rupture", lambda c: ~c),
        "critical alert": top.where("alerts", "criticite", lambda c: c == "CRITIQUE"),
        "planner harms class A": top.where("performance", "segment_abc", lambda c: c == "A").where(
            "fva", "fva_humain_pts", lambda c: c < 0
        ),
        "late and drifting": top.where("silver", day, lambda c: c > late).where(
            "alerts", "type_alerte", lambda c: c == "TRACKING_SIGNAL"
        ),
    }


@query
def m_filter_contexts(spark, sf_dir):
    """The basic measures of the performance table under filters on it and on other tables."""
    model, out = _model(spark, sf_dir), None
    for name, context in _contexts().items():
        found = context.value(model, "performance", measures.basic_kpis).select(
            F.lit(name).alias("context"), "algorithme", "mape_mean", "mape_weighted", "observations"
        )
        out = found if out is None else out.unionByName(found)
    return out


@query
def m_all_except(spark, sf_dir):
    """A filtered context's MAPE beside its whole segment's, and the target of its class."""
    model = _model(spark, sf_dir)
    dims = ("algorithme", "segment_abc", "segment_abcxyz")
    context = (
        contexts.Context(by=dims)
        .where("silver", "flag_rupture", lambda c: c)
        .where("performance", "algorithme", lambda c: c != "Expert_DP")
    )

    def mean(column, name):
        return lambda rows, by: measures.measure(rows, {name: F.avg(column)}, by)

    out = context.value(model, "performance", mean("mape", "mape_mean"))
    for kept, column, name in (
        ("segment_abcxyz", "mape", "mape_segment"),
        ("segment_abc", "mape_cible", "target"),
    ):
        wider = context.all_except("performance", kept)
        inner = wider.value(model, "performance", mean(column, name))
        out = contexts.beside(out, dims, inner, wider.by)
    return out


@query
def m_cube(spark, sf_dir):
    """The measures of a dashboard for four sets of slicers."""
    dims = ["algorithme", "segment_abc", "segment_xyz"]
    return contexts.cube(_segment_perf(spark, sf_dir), dims, [[], dims[:1], dims[1:2], dims])


@query
def m_rupture(spark, sf_dir):
    read = ("segment_abcxyz", "nb_ruptures")
    return measures.rupture_rate(_silver(spark, sf_dir, read), ["segment_abcxyz"])


@query
def m_mape_by_rupture(spark, sf_dir):
    rows = _staged_silver(spark, sf_dir, (*SEGMENT_ROWS, "flag_rupture"))
    perf = segment_kpis.segment_performance(rows, SETTINGS)
    return measures.mape_by_rupture(perf, rows, ["algorithme"])


@query
def m_alerts(spark, sf_dir):
    raised = segment_kpis.segment_alerts(_segment_perf(spark, sf_dir), SETTINGS)
    return measures.alert_counts(raised)


@query
def m_monitoring(spark, sf_dir):
    rows = _staged_silver(spark, sf_dir, ("sku_id", *SEGMENT_ROWS, "date_traitement"))
    perf = stage(segment_kpis.segment_performance(rows, SETTINGS), "segment-performance")
    return measures.monitoring(rows, perf)


@query
def m_selected_value(spark, sf_dir):
    return measures.selected_values(_segment_perf(spark, sf_dir), ["algorithme"])


@query
def m_benchmark(spark, sf_dir):
    return measures.benchmark_line(_segment_perf(spark, sf_dir), ["algorithme", "segment_abc"])


@query
def m_exec_summary(spark, sf_dir):
    rows = _staged_silver(spark, sf_dir, ("sku_id", *SEGMENT_ROWS, "date_traitement"))
    perf = stage(segment_kpis.segment_performance(rows, SETTINGS), "segment-performance")
    return measures.executive_summary(rows, perf, segment_kpis.segment_alerts(perf, SETTINGS))
