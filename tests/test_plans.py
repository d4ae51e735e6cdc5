"""The physical plans the design relies on."""

from __future__ import annotations

import dataclasses
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from veracast.config import WINDOWS_EXEC
from veracast.operators import accuracy, horizons, leadtime, segment_kpis, summary
from veracast.operators import clean, silver
from veracast.plans import catalog, pipeline
from veracast.sources import lake
from veracast.sources.scratch import stage, stage_in_buckets

PYTHON_ALLOWED = {
    "backtest_holt_winters",
    "backtest_fixed_weights",
    "holt_winters_fit",
    "holt_winters_proof",
    "ets_fixed_form",
    "ets_fit",
    "backtest_ets",
    "arima_orders",
    "backtest_arima",
    "backtest_stlf",
}


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    """Silver as it lies in the lake."""
    return stage(catalog._silver(spark, sf_dir), "silver-plans")


@pytest.fixture(scope="module")
def rows(stored):
    return clean.normalize_inputs(stored)


ANCHOR = dt.date(2001, 11, 1)


def test_month_range_reaches_the_scan(rows):
    text = plan(horizons.window_filter(rows, ANCHOR, 6))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", text).group(1)
    assert "GreaterThanOrEqual(periode,2001-06-01)" in pushed
    assert "LessThan(periode,2001-12-01)" in pushed


def test_performance_reads_silver_once_and_shuffles_once(rows):
    df = accuracy.performance(rows, ANCHOR, WINDOWS_EXEC)
    text = plan(df)
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 1
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text
    columns = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "lt_besoins_jours" not in columns and "dci" not in columns
    union = plan(accuracy.performance_by_union(rows, ANCHOR, WINDOWS_EXEC))
    assert union.count("FileScan") == len(WINDOWS_EXEC)


def test_all_windows_sort_months_not_windows(rows):
    text = plan(accuracy.performance_all_windows(rows, ANCHOR))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_top_k_is_cut_before_the_shuffle(spark, rows):
    perf = stage(accuracy.performance(rows, ANCHOR, WINDOWS_EXEC), "perf-plans")
    text = plan(summary.worst_by(perf, "product_id", 10))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 10, Partial", text)


def test_naive_needs_no_self_join(stored):
    text = plan(segment_kpis.segment_performance(stored))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert plan(segment_kpis.segment_value_added(stored)).count("FileScan") == 1


def test_unused_feeds_are_not_joined(spark, sf_dir):
    """Forecasts with segments only: lead times and supply chain drop out of the plan."""
    text = optimized(catalog._silver(spark, sf_dir).select("sku_id", "forecast_qty", "segment_abc"))
    # What is left: part attributes, staged actuals and segments.
    assert text.count("LeftOuter") == 3


@pytest.mark.parametrize("name", sorted(catalog.BUILDS))
def test_no_product_joins_and_no_python_in_the_hot_path(spark, sf_dir, stored, name, monkeypatch):
    monkeypatch.setattr(catalog, "_silver", lambda *_: stored)
    monkeypatch.setattr(catalog, "_staged_silver", lambda *_: stored)
    text = plan(catalog.BUILDS[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON_ALLOWED:
        assert "Python" not in text


@pytest.mark.parametrize("name", ["abc_segments", "abcxyz_segments", "segment_distribution"])
def test_only_range_totals_meet_in_one_task(spark, sf_dir, name):
    """Single-task windows see one row per range; products never do."""
    text = plan(catalog.BUILDS[name](spark, sf_dir))
    lines = text.splitlines()
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert single
    for i in single:
        below = "\n".join(lines[i + 1 : i + 3])
        assert "HashAggregate(keys=[_range" in below


def test_gold_detail_with_naive_rows_still_prunes_months(spark, stored, tmp_path, monkeypatch):
    """Stored months partition Silver; both branches of the detail filter on them."""
    path = str(tmp_path / "silver")
    lake.write_table(stored, path, partition_by=pipeline.PARTITIONS["forecasts_clean"])
    silver = spark.read.parquet(path)
    seen = {}
    plain = accuracy.error_detail

    def keep(rows, anchor, windows):
        seen["text"] = plan(plain(rows, anchor, windows))
        return plain(rows, anchor, windows)

    monkeypatch.setattr(accuracy, "error_detail", keep)
    pipeline.run_gold(spark, silver, str(tmp_path / "gold"), add_naive=True)
    filters = re.findall(r"PartitionFilters: \[([^\]]*)", seen["text"])
    assert any("periode" in f and ">=" in f for f in filters)


def test_correlation_reads_performance_once_without_a_join(spark, stored):
    perf = stage(
        accuracy.performance(clean.normalize_inputs(stored), ANCHOR, WINDOWS_EXEC), "perf-plans"
    )
    impact = leadtime.leadtime_impact(perf, keep_metrics=True)
    text = plan(leadtime.leadtime_correlation(impact))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_segment_tables_read_silver_once(spark, stored, tmp_path, monkeypatch):
    made = []
    plain = segment_kpis.segment_totals
    monkeypatch.setattr(
        segment_kpis, "segment_totals", lambda silver: made.append(1) or plain(silver)
    )
    pipeline.run_segment_gold(spark, stored, str(tmp_path))
    assert len(made) == 1


def test_silver_shuffles_forecasts_twice(spark, sf_dir):
    """Without broadcasts: once for their month, once for the segments of their product."""
    raw = catalog.orderbook.raw_tables(spark, sf_dir)
    raw = silver.RawTables(
        *[stage(getattr(raw, f.name), f"raw-{f.name}") for f in dataclasses.fields(raw)]
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(silver.build_silver(raw, catalog.PROCESSED_AT, "plans"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "algorithme" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-|*"))
    above, exchanges = depth, 0
    for line in reversed(lines[:scan]):  # up the tree, over the ancestors only
        own = len(line) - len(line.lstrip(" :+-|*"))
        if own < above:
            above, exchanges = own, exchanges + ("Exchange" in line)
    assert exchanges == 2


def test_folded_forecasts_are_the_clean_ones(spark, sf_dir):
    raw = catalog.orderbook.raw_tables(spark, sf_dir).forecasts
    wide = silver.forecasts_by_month(raw).select("sku_id", "periode", F.inline("forecasts"))
    plain = silver.clean_forecasts(raw).select(*wide.columns)
    assert wide.exceptAll(plain).isEmpty() and plain.exceptAll(wide).isEmpty()


def test_some_columns_of_silver_are_those_of_the_whole(spark, sf_dir):
    """Quantities fold by hashing where no other column of their feed is wanted."""
    raw = catalog.orderbook.raw_tables(spark, sf_dir)
    whole = silver.build_silver(raw, catalog.PROCESSED_AT, "plans")
    for columns in (catalog.SEGMENT_INPUT, ("sku_id", "algorithme", "flag_rupture"), ("dci", "qty_facturee")):
        some = silver.build_silver(raw, catalog.PROCESSED_AT, "plans", columns=columns)
        assert sorted(some.columns) == sorted(columns)
        plain = whole.select(*some.columns)
        assert some.exceptAll(plain).isEmpty() and plain.exceptAll(some).isEmpty()
    text = plan(silver.forecasts_by_month(raw.forecasts, attributes=False))
    assert "SortAggregate" not in text and "ObjectHash" not in text


def test_a_month_without_a_quantity_keeps_its_row(spark):
    rows = [("a", "2020-01", "ETS", None, "d", "t"), ("a", "2020-01", "ARIMAX", 3.0, "d", "t"),
            ("a", "2020-01", "ARIMAX", None, "c", "t")]
    raw = spark.createDataFrame(
        rows, "sku_id string, periode string, algorithme string, forecast_qty double, dci string, atc4 string"
    )
    wide = silver.forecasts_by_month(raw, attributes=False).select(F.inline("forecasts"))
    assert sorted(map(tuple, wide.collect())) == [("ARIMAX", 3.0), ("ETS", 0.0)]


def test_tasks_of_all_windows_grow_with_the_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(accuracy, "ROWS_PER_TASK", 1_000)
    least = spark.sparkContext.defaultParallelism
    assert accuracy.task_count(spark, 10) == least and accuracy.task_count(spark, 100_001) == 101
    many = accuracy.performance_all_windows(rows, ANCHOR, 24, accuracy.task_count(spark, 100_001))
    assert many.rdd.getNumPartitions() == 101
    usual = accuracy.performance_all_windows(rows, ANCHOR)
    assert many.exceptAll(usual).isEmpty() and many.count() == usual.count()


def test_feeds_in_buckets_fold_and_join_in_place(spark, sf_dir):
    """Above the staged demand nothing is shuffled by product or month, whatever may be broadcast."""
    raw = catalog.orderbook.raw_tables(spark, sf_dir)
    assert "hashpartitioning" not in plan(silver.forecasts_by_month(raw.forecasts, in_place=True))
    buckets = catalog.orderbook.bucket_count(spark, sf_dir)
    keep = lambda df, label: stage_in_buckets(df, label, buckets, "sku_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = silver.build_silver(raw, catalog.PROCESSED_AT, "plans", keep=keep, in_place=True)
        text = plan(built)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(sku_id" in text and "periode" not in "".join(
        line for line in text.splitlines() if "Exchange" in line
    )
    plain = silver.build_silver(raw, catalog.PROCESSED_AT, "plans")
    assert built.exceptAll(plain).isEmpty() and plain.exceptAll(built).isEmpty()


def test_buckets_grow_with_the_lines(spark, sf_dir, monkeypatch):
    lines = catalog.orderbook.table(spark, sf_dir, "lineitem").count()
    assert catalog.orderbook.bucket_count(spark, sf_dir) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(catalog.orderbook, "LINES_PER_BUCKET", 100)
    assert catalog.orderbook.bucket_count(spark, sf_dir) == -(-lines // 100)


def test_naive_forecast_of_months_is_that_of_rows(spark, sf_dir):
    """Known before months part into rows, it needs neither their products nor a shuffle of them."""
    made = catalog._silver(spark, sf_dir, catalog.SEGMENT_ROWS)
    assert not {"sku_id", "periode"} & set(made.columns)
    assert "hashpartitioning(sku_id" not in plan(segment_kpis.segment_performance(made))
    found = catalog.comparable(segment_kpis.segment_performance(made))
    of_rows = catalog.comparable(segment_kpis.segment_performance(catalog._silver(spark, sf_dir, catalog.SEGMENT_INPUT)))
    assert sorted(map(str, found.collect())) == sorted(map(str, of_rows.collect()))


def test_forecasts_with_attributes_fold_alike_in_place(spark):
    rows = [("a", "2020-01", "ETS", 2.0, "d", None), ("a", "01/2020", "ETS", 2.0, "c", "t"),
            ("a", "2020-01", "ETS", None, "b", "s"), ("a", "2020-01", "ARIMAX", None, "d", "t"),
            ("a", "2020-01", "ARIMAX", None, None, "t"), ("b", None, "STLF", -1.0, None, None),
            ("b", "2020-02", "Unknown", 1.0, "d", "t")]
    raw = spark.createDataFrame(
        rows, "sku_id string, periode string, algorithme string, forecast_qty double, dci string, atc4 string"
    )
    found, plain = (
        sorted(silver.forecasts_by_month(raw, in_place=p).select("sku_id", F.inline("forecasts")).collect(), key=str)
        for p in (True, False)
    )
    assert found == plain
    assert [tuple(r) for r in found] == [
        ("a", "ARIMAX", 0.0, "d", "t"), ("a", "ETS", 2.0, "c", "t"), ("b", "STLF", -1.0, None, None)
    ]


def test_whole_values_are_compared_as_they_are(spark):
    values = [-0.0, 3.0, 1e14, 0.1234565, -2.0000005, 1e18, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.v for r in catalog.comparable(df).orderBy("i").collect()]
    assert got == [0.0, 3.0, 1e14, 0.123457, -2.000001, 1e18, None] and str(got[0]) == "0.0"
    assert "CASE WHEN ((v" in optimized(catalog.comparable(df))
