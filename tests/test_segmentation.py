from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

from veracast.operators import segmentation as seg

PROFILE = (
    "sku_id string, ca_total_12m decimal(28,4), moyenne_ventes double, "
    "ecart_type_ventes double, nb_periodes bigint"
)


def profile(spark, revenues):
    rows = [
        (sku, None if value is None else Decimal(value), 10.0, 1.0, 5)
        for sku, value in revenues.items()
    ]
    return spark.createDataFrame(rows, PROFILE)


def brute_force(revenues):
    order = sorted(revenues, key=lambda s: (revenues[s] is None, -(revenues[s] or 0), s))
    total = sum(v or 0 for v in revenues.values())
    out, running = {}, 0
    for sku in order:
        value = revenues[sku]
        running += value or 0
        higher = sum(1 for v in revenues.values() if v is not None and (value is None or v > value))
        label = "C"
        if total > 0:
            label = "A" if running * 100 <= total * 80 else "B" if running * 100 <= total * 95 else "C"
        out[sku] = (higher + 1, running, label)
    return out


def computed(spark, revenues, ranges):
    """With adaptive coalescing off, every range keeps its own partition."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = seg.abc_segments(profile(spark, revenues)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return {r.sku_id: (r.rang_ca, int(r.ca_cumul), r.segment_abc) for r in rows}


@pytest.mark.parametrize("ranges", [1, 7, 16])
def test_hot_revenue_values_spread_over_ranges(spark, ranges):
    rng = random.Random(ranges)
    revenues = {f"s{i:04d}": rng.randint(1, 5000) for i in range(200)}
    # One revenue shared by a third of the products and one by another fifth.
    revenues |= {f"t{i:04d}": 700 for i in range(180)}
    revenues |= {f"z{i:04d}": 0 for i in range(100)}
    assert computed(spark, revenues, ranges) == brute_force(revenues)


def test_everything_tied(spark):
    revenues = {f"s{i:03d}": 50 for i in range(60)}
    got = computed(spark, revenues, 9)
    assert got == brute_force(revenues)
    assert {rank for rank, _, _ in got.values()} == {1}


def test_missing_and_negative_revenue(spark):
    revenues = {"a": 100, "b": None, "c": -20, "d": 60, "e": None}
    assert computed(spark, revenues, 4) == brute_force(revenues)


def test_no_sales_at_all(spark):
    assert {v[2] for v in computed(spark, {"a": 0, "b": 0}, 2).values()} == {"C"}


def test_exact_boundary_belongs_to_the_better_class(spark):
    got = computed(spark, {"a": 80, "b": 15, "c": 5}, 2)
    assert [got[s][2] for s in "abc"] == ["A", "B", "C"]


def test_xyz_cuts(spark):
    rows = [
        ("x", Decimal(1), 100.0, 49.9, 9), ("edge", Decimal(1), 100.0, 50.0, 9),
        ("y", Decimal(1), 100.0, 100.0, 9), ("z", Decimal(1), 100.0, 100.1, 9),
        ("one", Decimal(1), 100.0, None, 1), ("unsold", Decimal(1), 0.0, 0.0, 9),
    ]
    got = {r.sku_id: r for r in seg.xyz_segments(spark.createDataFrame(rows, PROFILE)).collect()}
    assert {s: r.segment_xyz for s, r in got.items()} == {
        "x": "X", "edge": "Y", "y": "Y", "z": "Z", "one": "Z", "unsold": "Z",
    }
    assert got["unsold"].cv == 99.0 and got["one"].cv is None


def test_lookback_is_thirteen_calendar_months(spark):
    rows = [
        ("s", dt.date(2023 + m // 12, m % 12 + 1, 1), 1.0, Decimal(1)) for m in range(0, 24)
    ]
    actuals = spark.createDataFrame(
        rows,
        "sku_id string, periode date, ventes_reelles_qty double, "
        "ventes_reelles_valeur decimal(18,4)",
    )
    assert seg.sales_profile(actuals).first().nb_periodes == 13


def test_targets_and_distribution(spark):
    segments = seg.abcxyz_segments(profile(spark, {"a": 80, "b": 15, "c": 5}))
    got = {r.sku_id: (r.segment_abcxyz, r.mape_cible_pct) for r in segments.collect()}
    assert got == {"a": ("AX", 10.0), "b": ("BX", 20.0), "c": ("CX", 40.0)}
    counts = [tuple(r) for r in seg.segment_distribution(segments).collect()]
    assert counts == [("abc", "A", 1), ("abc", "B", 1), ("abc", "C", 1), ("xyz", "X", 3)]
