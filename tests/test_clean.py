from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest

from veracast import schemas
from veracast.config import WINDOWS_EXEC, WINDOWS_FULL, Settings
from veracast.context import stamp_raw_load
from veracast.operators import clean
from veracast.operators.silver import quality_report


def test_month_formats(spark):
    texts = ["2024-03-17", "2024-03", "03/2024", " 2024-03 ", "2024/03/17", "13/2024", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "periode string")
    months = [r.periode for r in clean.align_month(df).collect()]
    march = dt.date(2024, 3, 1)
    assert months == [march] * 4 + [None] * 4


def test_only_whole_month_texts_are_months(spark):
    """A cast reads more than the accepted formats; the patterns of a date are no longer used."""
    texts = ["2024-3-17", "2024-03-1T", "2024-03\n", "2024-02-30", "+024-03-11", "2024-00", "00/2024",
             "2024-03-17T", "2024-03-17 x", "12024-03", "03/12024", "2024", "\u0662024-03", ""]
    df = spark.createDataFrame([(t,) for t in texts], "periode string")
    aligned = clean.align_month(df)
    assert [r.periode for r in aligned.collect()] == [None] * len(texts)
    assert "gettimestamp" not in aligned._jdf.queryExecution().optimizedPlan().toString()


def test_month_of_a_date_column(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 17),)], "periode date")
    assert clean.align_month(df).first().periode == dt.date(2024, 3, 1)


def test_one_row_per_key_keeps_whole_smallest_row(spark):
    rows = [("a", 2.0, 1), ("a", 1.0, 9), ("a", 1.0, 3), ("b", None, 5), ("b", 0.0, 1)]
    df = spark.createDataFrame(rows, "k string, q double, n int")
    for partitions in (1, 5):
        got = clean.one_row_per_key(df.repartition(partitions), ["k"])
        assert got.columns == ["k", "q", "n"]
        assert sorted(map(tuple, got.collect())) == [("a", 1.0, 3), ("b", 0.0, 1)]


def test_month_census_counts_what_cleaning_would_lose(spark):
    rows = [("2001-01",), ("03/2002",), (None,), ("next month",), ("2001-13",)]
    row = clean.month_census(spark.createDataFrame(rows, "periode string")).first()
    assert tuple(row) == (2, 1, 2)


def test_one_row_per_key_folds_a_hot_key_before_the_shuffle(spark):
    df = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) AS k", "cast(id as double) AS q"
    )
    got = clean.one_row_per_key(df, ["k"])
    assert got.filter("k = 'hot'").collect()[0].q == 0.0
    assert got.count() == df.select("k").distinct().count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") >= 1


def test_whitelist_and_census(spark):
    rows = [("Prophet",), ("Expert_DP",), ("prophet",), ("Other",), (None,)]
    df = spark.createDataFrame(rows, "algorithme string")
    assert [r[0] for r in clean.known_algorithms(df).collect()] == ["Prophet", "Expert_DP"]
    assert tuple(clean.algorithm_census(df).first()) == (2, 3)


def test_normalize_keeps_existing_canonical_names(spark):
    df = spark.createDataFrame(
        [("s", dt.date(2024, 5, 20), "A", 1.0, 2.0)],
        "sku_id string, periode date, algorithme string, ventes_reelles_qty double, "
        "forecast_qty double",
    )
    out = clean.normalize_inputs(df)
    assert out.first().date_month == dt.date(2024, 5, 1)
    assert clean.missing_audit_columns(out) == []
    assert clean.missing_audit_columns(out.drop("forecast_qty")) == ["forecast_qty"]


def test_required_columns_are_named(spark):
    df = spark.createDataFrame([(1,)], "sku_id int")
    with pytest.raises(ValueError, match=r"raw.*missing columns \['periode'\]"):
        schemas.require_columns(df, ["sku_id", "periode"], "raw")


class TestContract:
    def good(self, spark):
        return spark.createDataFrame([], schemas.contract("leaderboard"))

    def test_reorders(self, spark):
        df = self.good(spark)
        shuffled = df.select(*reversed(df.columns))
        assert schemas.conform(shuffled, "leaderboard").columns == df.columns

    def test_missing_and_extra(self, spark):
        with pytest.raises(ValueError, match="missing=.*rank_mape"):
            schemas.conform(self.good(spark).drop("rank_mape"), "leaderboard")
        with pytest.raises(ValueError, match="extra=.*extra_col"):
            schemas.conform(self.good(spark).selectExpr("*", "1 AS extra_col"), "leaderboard")

    def test_unknown_table(self, spark):
        with pytest.raises(ValueError, match="no contract"):
            schemas.conform(self.good(spark), "nope")

    def test_wrong_type_is_refused(self, spark):
        df = self.good(spark).drop("avg_mape").selectExpr("*", "'x' AS avg_mape")
        with pytest.raises(Exception, match="avg_mape"):
            schemas.conform(df, "leaderboard").collect()

    def test_pandas_frame(self):
        names = schemas.contract("reports").fieldNames()
        frame = pd.DataFrame(columns=list(reversed(names)))
        assert list(schemas.conform(frame, "reports").columns) == names


def test_published_tables_and_silver_width():
    assert len(schemas.GOLD_TABLES) == 9
    assert len(schemas.contract("forecasts_clean").fieldNames()) == 27
    assert len(schemas.contract("backtest_evaluation").fieldNames()) == 19


def test_settings(monkeypatch):
    settings = Settings()
    assert WINDOWS_EXEC == (1, 3, 6, 12)
    assert WINDOWS_FULL == tuple(range(1, 25))
    assert settings.mape_targets == {"A": 10.0, "B": 20.0, "C": 40.0}
    monkeypatch.delenv("ANALYTICAL_WINDOWS_MODE", raising=False)
    assert Settings.from_env().windows == WINDOWS_EXEC
    monkeypatch.setenv("ANALYTICAL_WINDOWS_MODE", "full")
    assert Settings.from_env().windows == WINDOWS_FULL


def test_raw_load_audit(spark):
    out = stamp_raw_load(spark.range(1), dt.datetime(2024, 1, 2), "loader", "initial").first()
    assert (out.Sys_LoadDate, out.Sys_LoadedBy, out.Sys_Reason) == (
        dt.datetime(2024, 1, 2), "loader", "initial",
    )


def test_quality_report_of_empty_silver(spark):
    empty = spark.createDataFrame([], schemas.contract("forecasts_clean"))
    row = quality_report(empty).first()
    assert (row.n_rows, row.pct_without_actual, row.segment_warning) == (0, None, False)
