from __future__ import annotations

import datetime as dt
import json
import random
from pathlib import Path

import pytest

from veracast import schemas
from veracast.config import WINDOWS_FULL, Settings
from veracast.operators import summary
from veracast.plans import catalog, orderbook, pipeline
from veracast.sources import lake, scratch

SILVER = (
    "sku_id string, algorithme string, periode timestamp, ventes_reelles_qty double, "
    "forecast_qty double, segment_abcxyz string, horizon_mois bigint"
)


@pytest.fixture(scope="module")
def silver(spark):
    rng = random.Random(42)
    noise = {"A1": (10, 40), "A2": (40, 10), "naive": (50, 50), "Expert_DP": (25, 25)}
    rows = []
    for i, sku in enumerate(("P1", "P2")):
        for algo, spread in noise.items():
            for m in range(1, 13):
                actual = float(rng.randrange(80, 200))
                forecast = actual + rng.randrange(-spread[i], spread[i])
                rows.append((sku, algo, dt.datetime(2023, m, 1), actual, forecast, "AX" if i == 0 else "BY", 1))
    return spark.createDataFrame(rows, SILVER)


@pytest.fixture(scope="module")
def gold(spark, silver, tmp_path_factory):
    return pipeline.run_gold(spark, silver, str(tmp_path_factory.mktemp("gold")), Settings())


@pytest.mark.parametrize("name", schemas.GOLD_TABLES)
def test_contract_of_every_table(gold, name):
    assert gold[name].columns == schemas.contract(name).fieldNames()
    assert not gold[name].isEmpty() or name == "drift_alerts"


def test_audit_columns_are_shared_and_present(gold):
    stamps = set()
    for df in gold.values():
        stamps |= {tuple(r) for r in df.select("run_id", "generated_at").distinct().collect()}
    assert len(stamps) == 1 and None not in stamps.pop()
    anchors = gold["leadtime_impact"].select("date_max_window").distinct().collect()
    assert [r[0] for r in anchors] == [dt.datetime(2023, 12, 1)]


def test_grain_and_domains(gold):
    windows = {1, 3, 6, 12}
    assert {r[0] for r in gold["error_detail"].select("analytical_window_months").distinct().collect()} == windows
    impact = gold["leadtime_impact"].toPandas()
    assert not impact.duplicated(["product_id", "analytical_window_months"]).any()
    assert set(impact.risk_severity) <= {"LOW", "MEDIUM", "HIGH", "CRITICAL"}
    corr = gold["leadtime_correlation"].toPandas()
    assert set(corr.groupby("analytical_window_months").size()) == {2}
    assert corr.correlation_value.isna().all()  # two products only
    board = gold["leaderboard"].toPandas()
    assert board.rank_mape.min() == 1 and set(board.segment_abcxyz) == {"ALL"}
    assert set(gold["drift_alerts"].toPandas().severity) <= {"HIGH", "CRITICAL"}


def test_reports_and_spec(gold):
    reports = gold["reports"].collect()
    assert {r.report_type for r in reports} == set(summary.REPORT_TYPES)
    assert all("sur 4 fenêtres" in r.report_markdown and "# " in r.report_markdown for r in reports)
    spec = json.loads(gold["dashboard_spec"].first().spec_json)
    assert set(summary.SPEC_KEYS) <= set(spec) and spec["windows"] == [1, 3, 6, 12]
    assert summary.missing_spec_keys(gold["dashboard_spec"]).first().missing_keys == []


def test_missing_spec_keys(spark):
    df = spark.createDataFrame([('{"pages": 1}',), ("no json",)], "spec_json string")
    first, second = (r.missing_keys for r in summary.missing_spec_keys(df).collect())
    assert first == list(summary.SPEC_KEYS[1:]) and second == list(summary.SPEC_KEYS)


def test_options_full_windows_naive_rows_segments_and_csv(spark, silver, tmp_path):
    rows = silver.filter("algorithme <> 'naive'")
    out = pipeline.run_gold(
        spark, rows, str(tmp_path), Settings(windows=WINDOWS_FULL), anchor="actuals",
        add_naive=True, by_segment=True, output_mode="local",
    )
    windows = {r[0] for r in out["performance"].select("analytical_window_months").distinct().collect()}
    assert windows == set(range(1, 25))
    assert out["forecast_value_added"].filter("naive_error_metric IS NOT NULL").count() > 0
    assert {r[0] for r in out["leaderboard"].select("segment_abcxyz").distinct().collect()} == {"AX", "BY"}
    text = lake.read_csv(spark, str(tmp_path / "leaderboard"))
    assert text.columns == out["leaderboard"].columns and text.count() == out["leaderboard"].count()


def test_empty_and_incomplete_input(spark, silver, tmp_path):
    pipeline.run_gold(spark, silver, str(tmp_path), Settings())
    empty = pipeline.run_gold(spark, silver.limit(0), str(tmp_path), Settings())
    assert set(empty) == set(schemas.GOLD_TABLES)
    for name, df in empty.items():  # also no rows of the run before
        assert df.isEmpty() and df.columns == schemas.contract(name).fieldNames()
    with pytest.raises(ValueError, match="forecast_qty"):
        pipeline.run_gold(spark, silver.drop("forecast_qty"), str(tmp_path))


def test_raw_feeds_to_segment_gold(spark, sf_dir, tmp_path):
    stored = pipeline.write_silver(
        orderbook.raw_tables(spark, sf_dir), str(tmp_path), catalog.PROCESSED_AT, "order lines"
    )
    assert stored.columns == schemas.contract("forecasts_clean").fieldNames()
    assert stored.count() == stored.select("sku_id", "periode", "algorithme").distinct().count()
    assert stored.filter("ventes_reelles_qty IS NULL").count() > 0  # future months survive
    tables = pipeline.run_segment_gold(spark, stored, str(tmp_path))
    for name, df in tables.items():
        assert df.columns == schemas.contract(name).fieldNames() and not df.isEmpty()


class TestSources:
    def test_observed_count_and_fallback(self, spark, tmp_path):
        df = spark.range(7).selectExpr("id", "cast(id as string) AS name")
        assert lake.write_table(df, str(tmp_path / "t")) == 7
        lake.write_csv(df, str(tmp_path / "c"))
        found = lake.read_table(spark, str(tmp_path / "no"), csv_fallback=str(tmp_path / "c"), schema=df.schema)
        assert found.dtypes == df.dtypes and found.count() == 7
        with pytest.raises(Exception, match="no"):
            lake.read_table(spark, str(tmp_path / "no")).count()

    def test_csv_to_lake_and_modes(self, spark, tmp_path):
        df = spark.range(3)
        lake.write_csv(df, str(tmp_path / "c"))
        target = str(tmp_path / "t")
        assert lake.load_csv_to_lake(spark, str(tmp_path / "c"), target, "id bigint") == 3
        assert lake.load_csv_to_lake(spark, str(tmp_path / "c"), target, mode="append") == 3
        with pytest.raises(Exception):
            lake.load_csv_to_lake(spark, str(tmp_path / "missing"), target)
        with pytest.raises(ValueError):
            lake.write_output(df, "x", str(tmp_path), mode="fax")

    def test_single_file_for_small_tables_only(self, spark, tmp_path):
        df = spark.range(0, 50, 1, 6)
        lake.write_single_csv(df, str(tmp_path / "one"), "leaderboard")
        assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1
        with pytest.raises(ValueError, match="grows"):
            lake.write_single_csv(df, str(tmp_path / "two"), "performance")

    def test_bucketed_table_groups_without_a_shuffle(self, spark):
        df = spark.range(100).selectExpr("cast(id % 9 as string) AS sku_id", "id AS q")
        lake.save_managed(df, "bucketed_sales", bucket_by=(4, "sku_id"))
        grouped = lake.read_catalog(spark, "bucketed_sales").groupBy("sku_id").sum("q")
        assert grouped.count() == 9
        assert "Exchange hashpartitioning" not in grouped._jdf.queryExecution().executedPlan().toString()
        spark.sql("DROP TABLE bucketed_sales")

    def test_shared_folder_follows_the_session(self, spark):
        folder = spark.conf.get("spark.checkpoint.dir")
        assert scratch.fresh_path(spark, "x").startswith(folder)
        assert scratch.stage(spark.range(3), "y").count() == 3
        assert list(Path(folder).glob("y-*"))

    def test_a_run_removes_what_it_staged(self, spark):
        with scratch.run_folder(spark) as folder:
            assert scratch.stage(spark.range(3), "y").count() == 3
            assert list(Path(folder).glob("y-*"))
        assert not Path(folder).exists()
        assert not scratch.fresh_path(spark, "z").startswith(folder)

    def test_a_cluster_needs_the_setting(self, monkeypatch):
        class Conf:
            def get(self, name, default=None):
                return default

        class Context:
            applicationId = "app"
            getConf = staticmethod(Conf)

            def __init__(self, master):
                self.master = master

        class Session:
            conf = Conf()

            def __init__(self, master):
                self.sparkContext = Context(master)

        for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                scratch.shared_folder(Session(master))
        local = scratch.shared_folder(Session("local[2]"))
        assert local == scratch.shared_folder(Session("local[2]"))


def test_from_paths_to_all_tables(spark, sf_dir, tmp_path):
    """Three feeds in the lake, one only as CSV; every contract holds and nothing is left behind."""
    raw = orderbook.raw_tables(spark, sf_dir)
    for name in ("forecasts", "actuals", "lead_times"):
        lake.write_table(getattr(raw, name), str(tmp_path / "raw" / name))
    lake.write_csv(raw.supply_chain, str(tmp_path / "csv" / "supply_chain.csv"))
    paths = pipeline.Paths(str(tmp_path / "raw"), str(tmp_path / "lake"), str(tmp_path / "csv"))
    before = set(Path(scratch.shared_folder(spark)).glob("*"))
    tables = pipeline.run(
        spark,
        paths,
        Settings(),
        catalog.PROCESSED_AT,
        backtest_inputs=(
            orderbook.backtest_sales(spark, sf_dir),
            orderbook.backtest_planner(spark, sf_dir),
            orderbook.backtest_master(spark, sf_dir),
        ),
        add_naive=True,
        theils_u=True,
    )
    assert set(tables) == set(schemas.CONTRACTS)
    for name, df in tables.items():
        assert df.columns == schemas.contract(name).fieldNames() and not df.isEmpty()
    assert set(Path(scratch.shared_folder(spark)).glob("*")) == before
    assert tables["performance"].filter("theils_u IS NOT NULL").count() > 0
    assert (tmp_path / "lake" / "forecasts_clean" / "periode=2001-01-01").exists()
    judged = tables["backtest_evaluation"]
    assert judged.filter("Forecast_HoltWinters IS NULL OR Forecast_Prophet IS NOT NULL").isEmpty()


def test_windows_do_not_change_the_kpis(spark, silver, tmp_path):
    """The running frame takes any list of windows."""
    few = pipeline.run_gold(spark, silver, str(tmp_path / "a"), Settings(windows=(2, 5, 12)))
    many = pipeline.run_gold(spark, silver, str(tmp_path / "b"), Settings(windows=WINDOWS_FULL))
    kept = ["product_id", "algo_name", "analytical_window_months", "mape", "n_obs"]
    a = few["performance"].select(*kept)
    b = many["performance"].select(*kept).filter("analytical_window_months IN (2, 5, 12)")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
