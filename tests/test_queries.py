"""Every catalogue query against its SQL in another engine, on whole tables."""

from __future__ import annotations

import pytest
from engine_check import connect, differences

import __spark_entry__ as driver
from veracast.plans import catalog
from veracast.plans.checks import oracle_queries
from veracast.sources.scratch import stage

SQL = oracle_queries()
# Their optima have no SQL; tests/test_models.py checks them, and holt_winters_proof has some.
WITHOUT_SQL = {
    "backtest_holt_winters",
    "holt_winters_fit",
    "ets_fit",
    "backtest_ets",
    "arima_orders",
    "backtest_arima",
    "backtest_stlf",
}


@pytest.fixture(scope="module")
def engine(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def shared_silver(spark, sf_dir):
    """Silver is the input of half the queries; build it once for this module."""
    built = stage(catalog._silver(spark, sf_dir), "silver-test")
    patch = pytest.MonkeyPatch()
    patch.setattr(catalog, "_silver", lambda *_: built)
    patch.setattr(catalog, "_staged_silver", lambda *_: built)
    yield built
    patch.undo()


def test_every_query_has_sql_or_is_listed():
    assert set(catalog.QUERIES) == set(SQL) | WITHOUT_SQL
    assert set(catalog.QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, engine, shared_silver, name):
    found = differences(driver.queries()[name](spark, sf_dir), engine, SQL[name])
    assert not found, found[:3]


def test_entry_has_rows_and_stable_schema(spark):
    first, second = driver.entry(spark), driver.entry(spark)
    assert first.schema == second.schema
    assert not first.isEmpty()


def test_holt_winters_covers_the_same_holdout_rows(spark, sf_dir):
    key = ["Material_ID", "Sales_Date"]
    smoothed = driver.queries()["backtest_holt_winters"](spark, sf_dir).cache()
    plain = driver.queries()["backtest_holdout"](spark, sf_dir).select(*key)
    assert smoothed.select(*key).exceptAll(plain).isEmpty()
    assert plain.exceptAll(smoothed.select(*key)).isEmpty()
    assert smoothed.filter("Forecast_HoltWinters < 0 OR Forecast_HoltWinters IS NULL").isEmpty()
