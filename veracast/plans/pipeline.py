"""From raw feeds to published tables. Each table is written once and read back where needed.

Jobs per run: one to find the newest month, one write per table. Nothing is counted for logging
and no table-sized result visits the driver.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracast.config import Settings
from veracast.context import RunContext
from veracast.functions.forecasters import Forecaster, holt_winters
from veracast.operators import accuracy, alerts, backtest, baselines, clean, horizons, leadtime
from veracast.operators import segment_kpis, summary, value_added
from veracast.operators.silver import RawTables, build_silver
from veracast.schemas import (
    GOLD_TABLES,
    RAW_ACTUALS,
    RAW_FORECASTS,
    RAW_LEAD_TIMES,
    RAW_SUPPLY_CHAIN,
    conform,
    contract,
)
from veracast.sources.lake import LAKE_FORMAT, read_table, write_output, write_table
from veracast.sources.scratch import run_folder, stage

# Columns that readers filter by; each becomes a level of folders.
PARTITIONS = {"forecasts_clean": ("periode",), "error_detail": ("analytical_window_months",)}


def write_silver(
    raw: RawTables,
    base: str,
    processed_at: dt.datetime,
    source: str,
    settings: Settings = Settings(),
    fmt: str = LAKE_FORMAT,
) -> DataFrame:
    """Build Silver, write it under ``base`` and return the stored table."""
    silver = conform(build_silver(raw, processed_at, source, settings), "forecasts_clean")
    path = os.path.join(base, "forecasts_clean")
    write_table(silver, path, fmt, partition_by=PARTITIONS["forecasts_clean"])
    return _stored(silver.sparkSession, path, fmt, "forecasts_clean")


def _stored(spark: SparkSession, path: str, fmt: str, name: str) -> DataFrame:
    """A written table with its contract's types and order of columns."""
    reader = spark.read.format(fmt)
    stored = reader.schema(contract(name)) if fmt == "parquet" else reader
    return stored.load(path).select(*contract(name).fieldNames())


def _audit_input(silver: DataFrame) -> DataFrame:
    wanted = [c for c in ("periode", *clean.AUDIT_COLUMNS, *clean.CANONICAL_NAMES) if c in silver.columns]
    rows = clean.normalize_inputs(silver.select(*wanted))
    missing = clean.missing_audit_columns(rows)
    if missing:
        raise ValueError(f"audit input lacks {missing}")
    return rows.select(*(["periode"] if "periode" in rows.columns else []), *clean.AUDIT_COLUMNS)


def run_gold(
    spark: SparkSession,
    silver: DataFrame,
    base: str,
    settings: Settings | None = None,
    master_lead_time: DataFrame | None = None,
    anchor: str = "data",
    add_naive: bool = False,
    by_segment: bool = False,
    output_mode: str = "auto",
    fmt: str = LAKE_FORMAT,
    theils_u: bool = False,
) -> dict[str, DataFrame]:
    """Write the nine product-grain tables and return them by name; all empty for empty input.

    ``anchor`` picks the newest month of the data or of the actuals. ``add_naive`` adds the
    naive forecast Silver's whitelist cannot contain. ``by_segment`` ranks the leaderboard
    within Silver's segments instead of over ``ALL``. ``theils_u`` compares every algorithm with
    the naive forecast of its product. Tables other tables derive from are
    always kept in the lake format, and read back instead of being computed twice.
    """
    settings = settings or Settings.from_env()
    rows = _audit_input(silver)
    newest = horizons.max_month(rows, anchor).first()["max_month"]
    run = RunContext(newest)
    tables: dict[str, DataFrame] = {}

    def publish(name: str, df: DataFrame, window_anchor: bool = True) -> DataFrame:
        stamped = conform(run.stamp(df, window_anchor), name)
        path = os.path.join(base, name)
        if output_mode == "local":
            # CSV for the reader, plus the lake copy the following tables are derived from.
            path = os.path.join(base, "_lake", name)
            write_table(stamped, path, fmt, partition_by=PARTITIONS.get(name, ()))
            tables[name] = _stored(spark, path, fmt, name)
            write_output(tables[name], name, base, output_mode, fmt)
        else:
            write_table(stamped, path, fmt, partition_by=PARTITIONS.get(name, ()))
            tables[name] = _stored(spark, path, fmt, name)
        return tables[name]

    if newest is None:
        # Nothing to audit: earlier results must not pass for those of this run.
        for name in GOLD_TABLES:
            anchored = "date_max_window" in contract(name).fieldNames()
            publish(name, spark.createDataFrame([], contract(name)), anchored)
        return tables
    if add_naive:
        # The naive rows lie in months the data already has, so they cannot move the anchor.
        # Each branch keeps a stored month to filter by: its own, so that scans can skip.
        naive = baselines.naive_rows(rows)
        if "periode" in rows.columns:
            naive = naive.withColumn("periode", F.col("date_month"))
        rows = rows.unionByName(naive)
    publish("error_detail", accuracy.error_detail(rows, newest, settings.windows))
    # Nested windows repeat a row in the detail; months added up from the newest do not.
    if theils_u:
        kpis = accuracy.performance(
            baselines.with_previous_actual(rows), newest, settings.windows, "forecast_naive"
        )
    else:
        kpis = accuracy.performance_all_windows(rows, newest, settings.windows)
    perf = publish("performance", kpis)
    fva = publish("forecast_value_added", value_added.forecast_value_added(perf))
    raised = publish("drift_alerts", alerts.with_alert_text(alerts.drift_alerts(perf, settings)))

    ranked = perf
    if by_segment:
        segments = silver.groupBy(F.col("sku_id").alias("product_id")).agg(
            F.max("segment_abcxyz").alias("segment_abcxyz")
        )
        ranked = perf.join(segments, "product_id", "left")
    publish("leaderboard", accuracy.leaderboard(ranked, one_row_per_product=True))

    impact = leadtime.leadtime_impact(perf, master_lead_time, settings, keep_metrics=True)
    publish("leadtime_impact", impact.drop("wape", "smape"))
    publish("leadtime_correlation", leadtime.leadtime_correlation(impact))
    overview = summary.run_summary(perf, fva, raised)
    publish("dashboard_spec", summary.dashboard_spec(overview, settings), window_anchor=False)
    publish("reports", summary.report_rows(perf), window_anchor=False)
    return tables


def run_segment_gold(
    spark: SparkSession,
    silver: DataFrame,
    base: str,
    settings: Settings | None = None,
    fmt: str = LAKE_FORMAT,
) -> dict[str, DataFrame]:
    """Write the three segment-grain tables the BI measures read."""
    settings = settings or Settings()
    tables: dict[str, DataFrame] = {}

    def publish(name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(base, name)
        write_table(conform(df, name), path, fmt)
        tables[name] = spark.read.format(fmt).load(path)
        return tables[name]

    totals = stage(segment_kpis.segment_totals(silver), "segment-totals")  # a few dozen rows
    perf = publish("segment_performance", segment_kpis.performance_of_totals(totals, settings))
    publish("segment_value_added", segment_kpis.value_added_of_totals(totals, settings))
    publish("segment_alerts", segment_kpis.segment_alerts(perf, settings))
    return tables


def publish_backtest(
    sales: DataFrame,
    planner: DataFrame,
    master: DataFrame,
    base: str,
    settings: Settings | None = None,
    judged: Forecaster | None = None,
    fmt: str = LAKE_FORMAT,
) -> DataFrame:
    """Write the back-test under ``base`` and return the stored table.

    The contract's judged model is an external one: pass it as a forecaster. Without it that
    model's columns are null and only the planner is judged.
    """
    settings = settings or Settings()
    models = {"Forecast_HoltWinters": holt_winters(settings.season_months)}
    if judged:
        models["Forecast_Prophet"] = judged
    held = backtest.holdout_forecasts(sales, models, settings)
    if not judged:
        held = held.withColumn("Forecast_Prophet", F.lit(None).cast("double"))
    rows = backtest.evaluate_backtest(held, planner, master, "Forecast_Prophet", settings)
    path = os.path.join(base, "backtest_evaluation")
    write_table(conform(rows, "backtest_evaluation"), path, fmt)
    return _stored(sales.sparkSession, path, fmt, "backtest_evaluation")


@dataclass(frozen=True)
class Paths:
    """Where the raw feeds lie and the results go: ``raw``/name, else ``csv``/name.csv."""

    raw: str
    lake: str
    csv: str | None = None


def read_raw(spark: SparkSession, paths: Paths, fmt: str = LAKE_FORMAT) -> RawTables:
    """The four feeds from the lake, each from its CSV copy where the lake lacks it."""

    def feed(name: str, ddl: str) -> DataFrame:
        fallback = os.path.join(paths.csv, f"{name}.csv") if paths.csv else None
        return read_table(spark, os.path.join(paths.raw, name), fmt, fallback, ddl)

    return RawTables(
        feed("forecasts", RAW_FORECASTS),
        feed("actuals", RAW_ACTUALS),
        feed("lead_times", RAW_LEAD_TIMES),
        feed("supply_chain", RAW_SUPPLY_CHAIN),
    )


def run(
    spark: SparkSession,
    paths: Paths,
    settings: Settings | None = None,
    processed_at: dt.datetime | None = None,
    source: str = "raw feeds",
    backtest_inputs: tuple[DataFrame, DataFrame, DataFrame] | None = None,
    fmt: str = LAKE_FORMAT,
    **gold,
) -> dict[str, DataFrame]:
    """All tables from paths: Silver, the nine audit tables, three for segments, the back-test.

    ``gold`` goes to ``run_gold`` (anchor, add_naive, by_segment, output_mode, theils_u, ...);
    ``backtest_inputs`` are sales, planner forecasts and lead times. What the run stages is removed
    at its end.
    """
    with run_folder(spark):
        raw = read_raw(spark, paths, fmt)
        when = processed_at or dt.datetime.now()
        silver = write_silver(raw, paths.lake, when, source, settings or Settings(), fmt)
        tables = {"forecasts_clean": silver}
        tables |= run_gold(spark, silver, paths.lake, settings, fmt=fmt, **gold)
        tables |= run_segment_gold(spark, silver, paths.lake, settings, fmt)
        if backtest_inputs:
            name = "backtest_evaluation"
            tables[name] = publish_backtest(*backtest_inputs, paths.lake, settings, fmt=fmt)
    return tables
