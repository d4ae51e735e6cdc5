"""Filter contexts for measures: filters on any table, their removal, and many slicers at once.

A context holds filters, each on one column of one table, and the dimensions it is grouped by. A
table in a context keeps the rows that its own filters accept and whose segment still has rows in
every other filtered table: a filter travels from table to table through the segment, as a semi-join
with the segments that remain. Any measure of ``measures`` takes such a table and ``context.by``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracast.functions.numeric import pct, ratio

#: The column that all tables of the model share.
RELATION = "segment_abcxyz"
Model = Mapping[str, DataFrame]
Measure = Callable[[DataFrame, Sequence[str]], DataFrame]


@dataclass(frozen=True)
class Filter:
    table: str
    column: str
    accepts: Callable[[Column], Column]


@dataclass(frozen=True)
class Context:
    by: tuple[str, ...] = ()
    filters: tuple[Filter, ...] = ()

    def where(self, table: str, column: str, accepts: Callable[[Column], Column]) -> Context:
        """One more filter; all of them have to accept a row."""
        return replace(self, filters=(*self.filters, Filter(table, column, accepts)))

    def grouped(self, *by: str) -> Context:
        return replace(self, by=by)

    def all_except(self, table: str, *columns: str) -> Context:
        """Without the filters on ``table`` and without dimensions, but for those on ``columns``.

        Filters on other tables stay: they reach ``table`` through the relation, not as its own.
        """
        kept = tuple(f for f in self.filters if f.table != table or f.column in columns)
        return Context(tuple(c for c in self.by if c in columns), kept)

    def rows(self, model: Model, table: str) -> DataFrame:
        """The rows of ``table`` in this context."""

        def accepted(name: str) -> DataFrame:
            out = model[name]
            for f in self.filters:
                if f.table == name:
                    out = out.where(f.accepts(F.col(f.column)))
            return out

        found = accepted(table)
        for name in dict.fromkeys(f.table for f in self.filters if f.table != table):
            left = accepted(name).select(F.col(RELATION).alias("_segment")).distinct()
            found = found.join(left, found[RELATION].eqNullSafe(left["_segment"]), "left_semi")
        return found

    def value(self, model: Model, table: str, measure: Measure) -> DataFrame:
        return measure(self.rows(model, table), list(self.by))


def beside(outer: DataFrame, by: Sequence[str], inner: DataFrame, inner_by: Sequence[str]) -> DataFrame:
    """Measures of a context next to those of one with fewer dimensions, for each row of ``outer``.

    ``inner`` has at most a row per combination of its dimensions; missing ones give nulls.
    """
    if not inner_by:
        return outer.join(inner, F.lit(True), "left")
    renamed = inner.withColumnsRenamed({c: f"_{c}" for c in inner_by})
    same = F.lit(True)
    for c in inner_by:
        same = same & outer[c].eqNullSafe(renamed[f"_{c}"])
    return outer.join(renamed, same, "left").drop(*[f"_{c}" for c in inner_by])


# -- all slicers at once -----------------------------------------------------------------

#: Sums and counts that add up over any dimensions, and the best row as a least struct.
_STATES = {
    "n": "count(1)",
    "n_obs": "sum(nb_observations)",
    "mape_weight": "sum(mape * nb_observations)",
    **{f"s_{c}": f"sum({c})" for c in ("mape", "wape", "mae", "rmse", "biais_pct", "theil_u")},
    **{f"n_{c}": f"count({c})" for c in ("mape", "wape", "mae", "rmse", "biais_pct", "theil_u")},
    "n_drifts": "count_if(flag_derive)",
    "n_better": "count_if(theil_u < 1)",
    "best": "min(if(mape is null, null, struct(mape, algorithme)))",
}


def _merged(name: str, total: str) -> Column:
    return F.min(name) if total.startswith("min") else F.sum(name)


def cube(perf: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]]) -> DataFrame:
    """The measures of the performance table for each set of dimensions, from one scan.

    States are folded once to all ``dims`` and only their rows are repeated per set. ``context``
    names a row's set; dimensions outside of it are null.
    """
    states = perf.groupBy(*dims).agg(*[F.expr(total).alias(name) for name, total in _STATES.items()])
    # A copy tells a null of the data from a dimension that is left out.
    names = F.array_sort(F.filter(F.array(*[F.when(F.grouping(c) == 0, F.lit(c)) for c in dims]), F.isnotnull))
    folded = states.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims]).agg(
        F.array_join(names, ",").alias("context"),
        *[_merged(name, total).alias(name) for name, total in _STATES.items()],
    )

    def mean(column: str) -> Column:
        return ratio(F.col(f"s_{column}"), F.col(f"n_{column}"))

    return folded.select(
        "context",
        *dims,
        mean("mape").alias("mape_mean"),
        ratio(F.col("mape_weight"), F.col("n_obs")).alias("mape_weighted"),
        mean("wape").alias("wape_mean"),
        mean("mae").alias("mae_mean"),
        mean("rmse").alias("rmse_mean"),
        mean("biais_pct").alias("bias_mean"),
        mean("theil_u").alias("theil_u_mean"),
        F.col("n_obs").alias("observations"),
        F.col("n_drifts"),
        pct(F.col("n_drifts"), F.col("n")).alias("drift_rate_pct"),
        pct(F.col("n_better"), F.col("n")).alias("pct_better_than_naive"),
        F.col("best.algorithme").alias("best_algorithm"),
    )
