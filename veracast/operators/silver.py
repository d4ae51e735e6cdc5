"""The cleaned, joined table: one row per product, month and algorithm."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracast.config import Settings
from veracast.context import stamp_silver
from veracast.functions.numeric import ratio, rounded
from veracast.operators.clean import (
    align_month,
    fill_defaults,
    known_algorithms,
    nulls_last,
    one_row_per_key,
)
from veracast.operators.segmentation import abcxyz_segments, sales_profile
from veracast.schemas import (
    RAW_ACTUALS,
    RAW_FORECASTS,
    RAW_LEAD_TIMES,
    RAW_SUPPLY_CHAIN,
    SILVER,
    column_names,
    require_columns,
)
from veracast.sources.scratch import stage

STAGES = ("lt_besoins_jours", "lt_fabrication_jours", "lt_liberation_jours", "lt_diffusion_jours")
MONTH_KEY = ["sku_id", "periode"]
# Not a column of Silver, but one that can be asked for: the actual of the previous observed month.
NAIVE = "forecast_naive"


@dataclass(frozen=True)
class RawTables:
    forecasts: DataFrame
    actuals: DataFrame
    lead_times: DataFrame
    supply_chain: DataFrame


def clean_forecasts(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    df = require_columns(raw, column_names(RAW_FORECASTS), "raw forecasts")
    df = known_algorithms(align_month(df), settings.valid_algorithms)
    return fill_defaults(
        one_row_per_key(df, [*MONTH_KEY, "algorithme"]), {"forecast_qty": 0}
    )


def forecasts_by_month(
    raw: DataFrame,
    settings: Settings = Settings(),
    attributes: bool = True,
    in_place: bool = False,
) -> DataFrame:
    """The rows of ``clean_forecasts`` as one row per product and month, in ``forecasts``.

    The whitelist is closed, so each algorithm's smallest row is an aggregate of its own. All of
    them fold before one shuffle, on the key that the other feeds have too. Without ``attributes``
    a row's quantity alone is kept; it decides first which row is smallest, so it is a plain ``min``,
    by hashing and not by sorting.

    With attributes a row is compared as a struct, which sorts. Where ``in_place`` says that rows lie
    by product, so that a second grouping needs no exchange, they fold by hashing to a row for each
    pair of attributes first, and the structs compare those.
    """
    df = require_columns(raw, column_names(RAW_FORECASTS), "raw forecasts")
    df = known_algorithms(align_month(df), settings.valid_algorithms)
    rest = [c for c in column_names(RAW_FORECASTS) if c not in (*MONTH_KEY, "algorithme")]

    # A bit for each algorithm that a month has a row of, whatever its quantity.
    bits = {a: 1 << i for i, a in enumerate(settings.valid_algorithms)}
    bit = F.lit(0).cast("long")
    for algorithm, value in bits.items():
        bit = F.when(F.col("algorithme") == algorithm, F.lit(value).cast("long")).otherwise(bit)

    def least(algorithm: str) -> Column:
        own = F.min(F.when(F.col("_bit") == bits[algorithm], F.col("forecast_qty")))
        quantity = F.coalesce(own, F.lit(0.0)).alias("forecast_qty")
        kept = F.struct(F.lit(algorithm).alias("algorithme"), quantity)
        return F.when(F.bit_or("_bit").bitwiseAND(F.lit(bits[algorithm]).cast("long")) != 0, kept)

    def best(algorithm: str) -> Column:
        row = F.min(F.when(F.col("algorithme") == algorithm, nulls_last(rest)))
        quantity = F.coalesce(row.getField("forecast_qty"), F.lit(0.0)).alias("forecast_qty")
        others = [row.getField(c).alias(c) for c in rest if c != "forecast_qty"]
        kept = F.struct(F.lit(algorithm).alias("algorithme"), quantity, *others)
        return F.when(row.isNotNull(), kept)

    def least_of_pairs(algorithm: str) -> Column:
        pairs = F.col("_bits").bitwiseAND(F.lit(bits[algorithm]).cast("long")) != 0
        quantity = F.col(f"_least_{bits[algorithm]}")
        compared = F.struct(
            quantity.isNull().alias("_no"), quantity.alias("forecast_qty"), nulls_last(pair).alias("_pair")
        )
        row = F.min(F.when(pairs, compared))
        quantity = F.coalesce(row.getField("forecast_qty"), F.lit(0.0)).alias("forecast_qty")
        others = [row.getField("_pair").getField(c).alias(c) for c in pair]
        return F.when(row.isNotNull(), F.struct(F.lit(algorithm).alias("algorithme"), quantity, *others))

    one = best if attributes else least
    df = df if attributes and not in_place else df.withColumn("_bit", bit)
    if attributes and in_place:
        one, pair = least_of_pairs, [c for c in rest if c != "forecast_qty"]
        quantities = [
            F.min(F.when(F.col("_bit") == value, F.col("forecast_qty"))).alias(f"_least_{value}")
            for value in bits.values()
        ]
        df = df.groupBy(*MONTH_KEY, *pair).agg(F.bit_or("_bit").alias("_bits"), *quantities)
    every = F.array(*[one(a) for a in settings.valid_algorithms])
    return df.groupBy(*MONTH_KEY).agg(F.array_compact(every).alias("forecasts"))


def clean_actuals(raw: DataFrame) -> DataFrame:
    df = require_columns(raw, column_names(RAW_ACTUALS), "raw actuals")
    df = one_row_per_key(align_month(df), MONTH_KEY)
    return fill_defaults(df, {"ventes_reelles_qty": 0, "ventes_reelles_valeur": 0})


def clean_lead_times(raw: DataFrame) -> DataFrame:
    df = require_columns(raw, column_names(RAW_LEAD_TIMES), "raw lead times")
    df = one_row_per_key(align_month(df), MONTH_KEY)
    return with_total_lead_time(fill_defaults(df, dict.fromkeys(STAGES, 0)))


def clean_supply_chain(raw: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    df = require_columns(raw, column_names(RAW_SUPPLY_CHAIN), "raw supply chain")
    df = one_row_per_key(align_month(df), MONTH_KEY, wanted)
    defaults = {"nb_ruptures": 0, "qty_commandee": 0, "qty_facturee": 0}
    return fill_defaults(df, {c: d for c, d in defaults.items() if c in df.columns})


def with_total_lead_time(df: DataFrame) -> DataFrame:
    besoins, fabrication, liberation, diffusion = (F.col(c) for c in STAGES)
    return df.withColumn("lt_total_jours", besoins + fabrication + liberation + diffusion)


def gap_columns() -> dict[str, Column]:
    """Forecast minus actual; the percentage exists only where something was sold."""
    actual = F.col("ventes_reelles_qty")
    gap = F.col("forecast_qty") - actual
    return {
        "ecart_qty": gap,
        "ecart_pct": F.when(actual > 0, ratio(gap, actual) * 100),
        "flag_rupture": F.coalesce(F.col("nb_ruptures") > 0, F.lit(False)),
    }


def build_silver(
    raw: RawTables,
    processed_at: dt.datetime,
    source: str,
    settings: Settings = Settings(),
    keep: Callable[[DataFrame, str], DataFrame] = stage,
    columns: Sequence[str] | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Clean the four feeds and join them on (sku, month), keeping future forecasts.

    Each feed is one row per product and month before the joins, so no join can fan out and a
    product with very many raw rows is already folded. All four feeds fold on that key and join
    in the layout the folding leaves; a month's forecasts travel as one row and part at the end.
    So forecasts are shuffled twice: for their month, and for the segments of their product,
    which AQE broadcasts while they are small and splits by skew when they are not. The cleaned
    actuals feed both the segments and the join, so they are staged, by ``keep``. Runs the staging
    and the segmentation jobs.

    ``columns`` names the columns that are wanted, all of Silver's if it is missing. Feeds that give
    none of them are not read, and a feed of which only the first column is wanted folds by hashing.
    It may name ``forecast_naive`` too, which is found while a month still is one row: the lag of the
    actuals over the months of a product's forecasts.

    Feeds that lie in buckets of the product, with ``keep`` laying out the actuals alike, are folded
    and joined in place; ``in_place`` says that they do.
    """
    names = [*column_names(SILVER), NAIVE]
    wanted = names[:-1] if columns is None else [c for c in names if c in columns]
    attributes = "dci" in wanted or "atc4" in wanted
    supplies = [c for c in ("nb_ruptures", "qty_commandee", "qty_facturee") if c in wanted]
    if "flag_rupture" in wanted and "nb_ruptures" not in supplies:
        supplies = ["nb_ruptures", *supplies]
    actuals = keep(clean_actuals(raw.actuals), "actuals")
    segments = abcxyz_segments(sales_profile(actuals, settings), settings).select(
        "sku_id", "segment_abc", "segment_xyz", "segment_abcxyz", "mape_cible_pct", "cv",
        "ca_total_12m",
    )
    months = (
        forecasts_by_month(raw.forecasts, settings, attributes, in_place)
        .join(
            actuals.select(*MONTH_KEY, "ventes_reelles_qty", "ventes_reelles_valeur"),
            MONTH_KEY,
            "left",
        )
        .join(
            clean_lead_times(raw.lead_times).select(*MONTH_KEY, *STAGES, "lt_total_jours"),
            MONTH_KEY,
            "left",
        )
        .join(
            clean_supply_chain(raw.supply_chain, supplies).select(*MONTH_KEY, *supplies),
            MONTH_KEY,
            "left",
        )
    )
    if NAIVE in wanted:
        of_product = Window.partitionBy("sku_id").orderBy("periode")
        months = months.withColumn(NAIVE, F.lag("ventes_reelles_qty").over(of_product))
    joined = (
        months.join(segments, "sku_id", "left")
        .select("*", F.inline("forecasts"))
        .drop("forecasts")
        .withColumns({c: v for c, v in gap_columns().items() if c in wanted})
    )
    return stamp_silver(joined, source, processed_at).select(*wanted)


def quality_report(silver: DataFrame) -> DataFrame:
    """Coverage and completeness of Silver, one row.

    Every count folds to one row per month on the map side. The number of products is the only
    one that has to shuffle products, so it is a subquery over that single column.
    """
    products = silver.agg(F.countDistinct("sku_id").alias("n")).scalar()
    monthly = silver.groupBy("periode").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("ventes_reelles_qty").isNull()).alias("no_actual"),
        F.count_if(F.col("segment_abcxyz").isNull()).alias("no_segment"),
        F.count_if(F.col("periode").isNull()).alias("no_month"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    def share(part: str) -> Column:
        return rounded(ratio(total(part), total("n")) * 100, 1)

    return monthly.agg(
        total("n").alias("n_rows"),
        total("no_actual").alias("rows_without_actual"),
        share("no_actual").alias("pct_without_actual"),
        total("no_segment").alias("rows_without_segment"),
        share("no_segment").alias("pct_without_segment"),
        F.coalesce(share("no_segment") > 5, F.lit(False)).alias("segment_warning"),
        total("no_month").alias("rows_without_month"),
        F.count("periode").alias("n_months"),
        F.min("periode").alias("first_month"),
        F.max("periode").alias("last_month"),
    ).withColumn("n_products", products)


def algorithm_distribution(silver: DataFrame) -> DataFrame:
    return silver.groupBy("algorithme").agg(F.count(F.lit(1)).alias("n_rows")).orderBy("algorithme")
