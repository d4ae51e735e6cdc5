"""Forecast-audit feeds derived from order lines and parts.

The order tables hold no forecasts, so the feeds derive them: demand is what each part shipped
per month, a forecast is that demand bent by an integer pattern of part, month and algorithm
(exact, so every engine gets the same number), and the imperfections a raw feed has (three
month formats, second deliveries, missing values, an unknown algorithm) come from the lines'
own flags. Every feed reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracast.operators.silver import RawTables
from veracast.sources.scratch import stage_in_buckets

# Labels of the derived forecasts by model number; no such model is fitted.
MODELS = ("Prophet", "ARIMAX", "ETS", "Expert_DP")
PLANNER = MODELS.index("Expert_DP") + 1
UNKNOWN_ALGORITHM = "Unknown_Model"

SKU = "cast(k as string) AS sku_id"
# Lines of a bucket of the staged demand; what a task sorts of them stays the same at any size.
LINES_PER_BUCKET = 250_000
FUTURE_MONTHS = 3
# The three spellings a raw month arrives in.
MONTH_TEXT = """CASE WHEN n_returned > 0 THEN date_format(m, 'MM/yyyy')
    WHEN billed > 0 THEN date_format(m, 'yyyy-MM') ELSE date_format(m, 'yyyy-MM-dd') END
    AS periode"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def last_month(spark: SparkSession, sf_dir: str) -> Column:
    """The newest shipping month as a scalar subquery over one column of the lines."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.agg(F.expr("trunc(cast(max(l_shipdate) as date), 'month')")).scalar()


def monthly_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part and month; partial sums fold a hot part before the shuffle."""
    cancelled = "l_returnflag = 'R' AND l_linestatus <> 'F'"
    # Price and discount have two decimals: whole 1/10000 units add up exactly, and a long
    # buffer aggregates about twice as fast as a wide decimal.
    revenue = (
        "cast(round(l_extendedprice * 100) as bigint)"
        " * (100 - cast(round(l_discount * 100) as bigint))"
    )
    totals = {
        "gross": "sum(cast(l_quantity as bigint))",
        "qty": f"sum(CASE WHEN {cancelled} THEN 0 ELSE cast(l_quantity as bigint) END)",
        "value": f"cast(sum(CASE WHEN {cancelled} THEN 0 ELSE {revenue} END) as decimal(18,0))"
        " * cast(0.0001 as decimal(4,4))",
        "billed": "sum(CASE WHEN l_linestatus = 'F' THEN cast(l_quantity as bigint) ELSE 0 END)",
        "n_returned": "count_if(l_returnflag = 'R')",
        "n_reviewed": "count_if(l_returnflag <> 'N')",
    }
    month = F.expr("trunc(cast(l_shipdate as date), 'month')")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("k"), month.alias("m"))
        .agg(*[F.expr(total).alias(name) for name, total in totals.items()])
        .withColumns(
            {
                "value": F.col("value").cast("decimal(18,4)"),
                "mi": F.expr("year(m) * 12 + month(m)"),
            }
        )
    )


def _forecast(model: str) -> str:
    """Demand times a per-mille factor, rounded half up, never negative; all in integers."""
    wild = "(CASE WHEN k % 7 = 0 THEN 3 ELSE 1 END)"
    noise = (
        f"(k % 4 + 1) * 5 * (1 + (k + {model}) % 3) * {wild}"
        f" * ((k * 31 + mi * 17 + {model} * 13) % 21 - 10)"
    )
    bias = f"((k + {model} * 2) % 5 - 2) * 60 * {wild}"
    base = "(CASE WHEN qty > 0 THEN qty ELSE gross END)"
    return (
        "cast(CASE WHEN qty = 0 AND mi % 2 = 0 THEN 0 ELSE "
        f"greatest(0, ({base} * (1000 + {noise} + {bias}) + 500) div 1000) END as double)"
    )


def _per_algorithm(demand: DataFrame, extra_name: str, extra: str) -> DataFrame:
    """One row per month and derived algorithm, plus ``extra_name`` where it has a value.

    The planner reviews a month only when some line was accepted or returned.
    """
    last = len(MODELS) + 1
    numbers = ", ".join(str(n) for n in range(1, last + 1))
    names = ", ".join(f"'{name}'" for name in (*MODELS, extra_name))
    return (
        demand.withColumn("extra", F.expr(extra))
        .withColumn("model", F.expr(f"explode(array({numbers}))"))
        .filter(f"(model <> {PLANNER} OR n_reviewed > 0) AND (model < {last} OR extra IS NOT NULL)")
        .withColumns(
            {
                "algo_name": F.expr(f"element_at(array({names}), model)"),
                "forecast_qty": F.expr(
                    f"CASE WHEN model < {last} THEN {_forecast('model')}"
                    " ELSE cast(extra as double) END"
                ),
            }
        )
    )


def monthly_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_demand(spark, sf_dir).selectExpr(
        SKU, "m AS date_month", "cast(qty as double) AS actual_qty"
    )


def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised input of the product-grain audit, with the naive forecast as an algorithm."""
    previous = "lag(qty) OVER (PARTITION BY k ORDER BY m)"
    return _per_algorithm(monthly_demand(spark, sf_dir), "naive", previous).selectExpr(
        SKU, "m AS date_month", "cast(qty as double) AS actual_qty", "algo_name", "forecast_qty"
    )


def _keys(demand: DataFrame) -> list[str]:
    """A raw row's product and month text; a staged demand has them, and its layout is by them."""
    return ["sku_id", "periode"] if "sku_id" in demand.columns else [SKU, MONTH_TEXT]


def raw_actuals(demand: DataFrame) -> DataFrame:
    """Months with returns are delivered twice, the second time with gross quantity.

    A month without sales arrives with a missing quantity.
    """
    return (
        demand
        .withColumn("delivery", F.expr("explode(sequence(1, if(n_returned > 0, 2, 1)))"))
        .selectExpr(
            *_keys(demand),
            "cast(if(delivery = 1, nullif(qty, 0), gross) as double) AS ventes_reelles_qty",
            "value AS ventes_reelles_valeur",
        )
    )


def raw_forecasts(demand: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four algorithms, one unknown label, and three future months without actuals.

    Parts join the months, and a month parts into its rows afterwards: for the models, for the
    unknown label, and in the newest month for those ahead, which are numbered after the others.
    """
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "k")
    parts = parts.selectExpr(SKU, "p_type", "p_brand")
    last, unknown = last_month(spark, sf_dir), len(MODELS) + 1
    names = [*MODELS, UNKNOWN_ALGORITHM, *["ETS"] * FUTURE_MONTHS]
    past = F.array(*[F.lit(n) for n in range(1, unknown + 1)])
    every = F.array(*[F.lit(n) for n in range(1, len(names) + 1)])
    return (
        demand.withColumns(dict(zip(("sku_id", "periode"), map(F.expr, _keys(demand)))))
        .join(parts, "sku_id", "left")
        .withColumn("model", F.explode(F.when(F.col("m") == last, every).otherwise(past)))
        .filter(f"model <> {PLANNER} OR n_reviewed > 0")
        .filter(f"model <> {unknown} OR (n_returned > 0 AND gross IS NOT NULL)")
        .selectExpr(
            "sku_id",
            f"CASE WHEN model <= {unknown} THEN periode"
            f" ELSE date_format(add_months(m, model - {unknown}), 'yyyy-MM') END AS periode",
            f"element_at(array({', '.join(map(repr, names))}), model) AS algorithme",
            f"CASE WHEN model < {unknown} THEN {_forecast('model')} WHEN model = {unknown}"
            " THEN cast(gross as double) ELSE cast(qty as double) END AS forecast_qty",
            "p_type AS dci",
            "p_brand AS atc4",
        )
    )


def raw_lead_times(demand: DataFrame) -> DataFrame:
    """Four stages per part and month; release days are unknown for unreviewed months."""
    return demand.selectExpr(
        *_keys(demand),
        "15 + k % 60 AS lt_besoins_jours",
        "5 + gross % 15 AS lt_fabrication_jours",
        "CASE WHEN n_reviewed > 0 THEN 7 + (k + mi) % 7 END AS lt_liberation_jours",
        "1 + k % 5 AS lt_diffusion_jours",
    )


def raw_supply_chain(demand: DataFrame) -> DataFrame:
    return demand.selectExpr(
        *_keys(demand),
        "n_returned AS nb_ruptures",
        "cast(gross as double) AS qty_commandee",
        "cast(billed as double) AS qty_facturee",
    )


def bucket_count(spark: SparkSession, sf_dir: str) -> int:
    """Buckets of the staged demand, a task each; Parquet knows how many lines there are."""
    lines = table(spark, sf_dir, "lineitem").count()
    return max(spark.sparkContext.defaultParallelism, -(-lines // LINES_PER_BUCKET))


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """The four raw feeds over one staged copy of the demand, so the lines are shuffled once.

    The copy lies in buckets of the product, which all feeds keep as a column, so what groups,
    windows or joins them by product, or by product and month, finds them laid out for it. The lines
    are folded first: a product has a row a month at most. Runs a job.
    """
    buckets = bucket_count(spark, sf_dir)
    demand = monthly_demand(spark, sf_dir).selectExpr("*", SKU, MONTH_TEXT)
    demand = stage_in_buckets(demand.repartition(buckets, "sku_id"), "demand", buckets, "sku_id")
    return RawTables(
        forecasts=raw_forecasts(demand, spark, sf_dir),
        actuals=raw_actuals(demand),
        lead_times=raw_lead_times(demand),
        supply_chain=raw_supply_chain(demand),
    )


def master_lead_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead time per product; parts above size 40 have none on file."""
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) AS product_id",
        "cast(CASE WHEN p_size <= 40 THEN p_size + 15 END as int) AS lead_time_days",
    )


def backtest_sales(
    spark: SparkSession, sf_dir: str, demand: DataFrame | None = None
) -> DataFrame:
    demand = monthly_demand(spark, sf_dir) if demand is None else demand
    return demand.selectExpr(
        "cast(k as string) AS Material_ID",
        "m AS Sales_Date",
        "cast(qty as double) AS Quantity_Sold",
    )


def backtest_planner(
    spark: SparkSession, sf_dir: str, demand: DataFrame | None = None
) -> DataFrame:
    """System and planner forecasts with their change log, for reviewed months."""
    demand = monthly_demand(spark, sf_dir) if demand is None else demand
    return (
        demand.filter("n_reviewed > 0")
        .selectExpr(
            "cast(k as string) AS Material_ID",
            "m AS Sales_Date",
            f"{_forecast('1')} AS System_Forecast_Qty",
            f"{_forecast(str(PLANNER))} AS Planner_Forecast_Qty",
            "'planner' AS Modified_By_User_ID",
            "cast(m as timestamp) AS Modification_Timestamp",
            "if(n_returned > 0, 'returns', 'review') AS Reason_Code",
        )
    )


def backtest_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) AS Material_ID",
        "cast(5 + p_size % 15 as bigint) AS Mfg_LeadTime_Days",
        "cast(15 + p_partkey % 60 as bigint) AS Proc_LeadTime_Days",
    )
