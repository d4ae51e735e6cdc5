"""Headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each job runs into the no-op sink (every row is produced, none is sent to the driver), once to
warm up and then ``$BENCH_RUNS`` times; the median counts. Building the plan, including any job
an operator runs itself, is inside the clock. As in the pipeline, Silver and the performance
table are built and timed first, stored, and read back by the jobs that derive from them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from veracast.plans import catalog, pipeline
from veracast.sources.scratch import fresh_path, stage

FROM_ORDER_TABLES = (
    "dedup_key",
    "abcxyz_segments",
    "silver_forecasts",
    "perf_product",
    "perf_union_windows",
    "perf_product_full24",
    "naive_forecast",
    "trend_forecast",
    "backtest_holdout",
    "backtest_holt_winters",
    "backtest_eval",
    "risk_top100",
)
FROM_STORED_PERFORMANCE = (
    "fva_product",
    "drift_alerts",
    "leaderboard_all",
    "leadtime_impact",
    "leadtime_corr",
    "worst_products_top10",
    "run_summary",
)
FROM_STORED_SILVER = (
    "dq_silver",
    "perf_segment",
    "fva_segment",
    "m_leadtime",
    "m_mape_by_leadtime",
    "m_exec_summary",
)


def seconds(job: Callable[[], None], runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("veracast-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="veracast-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found: dict[str, float] = {}

    def record(name: str, job: Callable[[], None]) -> None:
        found[name] = seconds(job, runs)
        print(f"{name:24s} {found[name]:7.3f}s", file=sys.stderr, flush=True)

    def drain(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    def run(names: tuple[str, ...]) -> None:
        for name in names:
            record(name, lambda: drain(catalog.BUILDS[name](spark, folder)))

    run(FROM_ORDER_TABLES)
    perf = stage(catalog._performance(spark, folder), "bench-performance")
    catalog._performance = catalog._staged_performance = lambda *_: perf
    run(FROM_STORED_PERFORMANCE)
    silver = stage(catalog._silver(spark, folder), "bench-silver")
    catalog._silver = catalog._staged_silver = lambda *_: silver
    run(FROM_STORED_SILVER)
    record(
        "pipeline_gold",
        lambda: pipeline.run_gold(spark, silver, fresh_path(spark, "bench-gold"), add_naive=True),
    )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(found.values()), 3),
                "unit": "sec",
                "queries": found,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
