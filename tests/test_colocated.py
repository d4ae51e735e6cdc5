"""Feeds in buckets: the same Silver, and no exchange between the feeds."""

from __future__ import annotations

import datetime as dt
import re

import pytest

from veracast.operators import silver
from veracast.operators.clean import align_month, as_aligned
from veracast.plans import colocated, orderbook
from veracast.plans.catalog import comparable

AT = dt.datetime(2002, 1, 31, 8, 30)


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    prefix = colocated.fresh_prefix()
    raw = orderbook.raw_tables(spark, sf_dir)
    colocated.save_feeds(raw, prefix, buckets=4)
    yield prefix, raw
    colocated.drop_feeds(spark, prefix)


def test_same_rows(spark, stored):
    prefix, raw = stored
    built = comparable(colocated.silver_of_feeds(spark, prefix, 4, AT, "s")).collect()
    plain = comparable(silver.build_silver(raw, AT, "s")).collect()
    assert sorted(map(str, built)) == sorted(map(str, plain))


def test_feeds_meet_without_exchange(spark, stored):
    prefix, _ = stored
    own = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feeds = colocated.read_feeds(spark, prefix)
        key = silver.MONTH_KEY
        joined = (
            silver.forecasts_by_month(feeds.forecasts)
            .join(silver.clean_actuals(feeds.actuals), key, "left")
            .join(silver.clean_lead_times(feeds.lead_times), key, "left")
            .join(silver.clean_supply_chain(feeds.supply_chain), key, "left")
        )
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
        assert len(re.findall(r"Bucketed: true", plan)) == 4
        whole = colocated.silver_of_feeds(spark, prefix, 4, AT, "s")
        plan = whole._jdf.queryExecution().executedPlan().toString()
        # Only the segments of products, and the rows that meet them, move.
        assert "hashpartitioning(sku_id" in plan and "hashpartitioning(periode" not in plan
        assert not re.search(r"hashpartitioning\(sku_id#\d+, periode", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)


def test_mark_keeps_the_column(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 17))], "sku_id string, periode date")
    dated = align_month(df)
    assert dated.first().periode == dt.date(2020, 1, 1)
    assert align_month(as_aligned(dated)).schema == as_aligned(dated).schema
    assert "trunc" not in align_month(as_aligned(df))._jdf.queryExecution().optimizedPlan().toString()


def test_buckets_grow_with_the_feeds():
    """A fixed number would leave a whole table of any size to as many tasks."""
    small, large = colocated.bucket_count(1_000), colocated.bucket_count(180_000_000)
    assert small == 8 and 180_000_000 / large <= colocated.ROWS_PER_BUCKET
