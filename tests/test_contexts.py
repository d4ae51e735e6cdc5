"""Filter contexts, cubes, stored month states and quarantined CSV rows."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from veracast import contexts, measures
from veracast.contexts import Context
from veracast.operators import accuracy, monthly_state
from veracast.sources import quarantine

PERF = (
    "algorithme string, segment_abc string, segment_xyz string, segment_abcxyz string, mape double,"
    " wape double, mae double, rmse double, biais_pct double, theil_u double, nb_observations long,"
    " flag_derive boolean, smape double, tracking_signal double, mape_cible double"
)


@pytest.fixture(scope="module")
def model(spark):
    perf = []
    for i, (algo, abc, xyz) in enumerate(itertools.product(("A1", "A2", "DP"), "ABC", "XYZ")):
        mape = None if i % 7 == 6 else float(i * 37 % 50)
        perf.append((algo, abc, xyz, abc + xyz, mape, i + 1.0, 2.0, 3.0 + i, -1.0 * i, i / 13, 5 + i, i % 4 == 0, 1.0, 0.5, 10.0))
    perf.append(("A1", None, None, None, 99.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, True, 1.0, 1.0, 40.0))
    silver = [("AX", 100, True), ("AX", 10, False), ("BY", 95, False), (None, 120, True), ("CZ", None, None)]
    alerts = [("AX", "CRITIQUE"), ("BY", "ELEVEE"), ("CZ", "CRITIQUE")]
    return {
        "performance": spark.createDataFrame(perf, PERF),
        "silver": spark.createDataFrame(silver, "segment_abcxyz string, lt long, stop boolean"),
        "alerts": spark.createDataFrame(alerts, "segment_abcxyz string, criticite string"),
    }


def segments(df):
    return {r.segment_abcxyz for r in df.select("segment_abcxyz").collect()}


def test_filters_travel_through_the_segment(model):
    late = Context().where("silver", "lt", lambda c: c > 90)
    assert segments(late.rows(model, "performance")) == {"AX", "BY", None}
    assert segments(late.rows(model, "alerts")) == {"AX", "BY"}
    both = late.where("alerts", "criticite", lambda c: c == "CRITIQUE")
    assert segments(both.rows(model, "performance")) == {"AX"}
    own = both.where("performance", "algorithme", lambda c: c == "A2")
    assert own.rows(model, "performance").count() == 1
    # A table's own filters and those of others meet, whatever is asked for.
    assert segments(own.rows(model, "silver")) == {"AX"} and own.rows(model, "silver").count() == 1
    assert late.where("alerts", "criticite", lambda c: c == "none").rows(model, "performance").isEmpty()


def test_any_measure_takes_a_context(model):
    context = Context(by=("algorithme",)).where("silver", "stop", lambda c: c)
    for measure in (measures.basic_kpis, measures.drift, measures.theil, measures.certification):
        found = context.value(model, "performance", measure)
        want = measure(model["performance"].where("segment_abcxyz = 'AX' OR segment_abcxyz IS NULL"), ["algorithme"])
        assert sorted(found.collect()) == sorted(want.collect())


def test_all_except_removes_filters_and_dimensions(model):
    context = (
        Context(by=("algorithme", "segment_abc"))
        .where("performance", "algorithme", lambda c: c != "DP")
        .where("performance", "segment_abc", lambda c: c == "A")
        .where("silver", "lt", lambda c: c > 90)
    )
    wider = context.all_except("performance", "segment_abc")
    assert wider.by == ("segment_abc",)
    assert segments(wider.rows(model, "performance")) == {"AX"}
    assert wider.rows(model, "performance").count() == 3
    none = context.all_except("performance")
    outer = context.value(model, "performance", lambda d, by: measures.measure(d, {"n": F.count("*")}, by))
    inner = none.value(model, "performance", lambda d, by: measures.measure(d, {"all": F.count("*")}, by))
    joined = contexts.beside(outer, context.by, inner, none.by).collect()
    assert {(r.algorithme, r.n, r["all"]) for r in joined} == {("A1", 1, 7), ("A2", 1, 7)}


SETS = [[], ["algorithme"], ["segment_abc"], ["algorithme", "segment_abc", "segment_xyz"]]
DIMS = ["algorithme", "segment_abc", "segment_xyz"]


def test_cube_equals_separate_measures(model):
    perf = model["performance"]
    found = contexts.cube(perf, DIMS, SETS)
    rows = {(r.context, *(r[d] for d in DIMS)): r for r in found.collect()}
    n = 0
    for by in SETS:
        name = ",".join(sorted(by))
        for measure in (measures.basic_kpis, measures.drift, measures.theil, lambda d, b: measures.best_algorithm(
            d.withColumns({"meilleur_algo": F.col("algorithme"), "mape_best_algo": F.col("mape")})
            .select(*[F.col(c) for c in b], "meilleur_algo", "mape_best_algo"), b)):
            for want in measure(perf, by).collect():
                got = rows[name, *(want[d] if d in by else None for d in DIMS)]
                for column in set(want.asDict()) & set(got.asDict()) - set(DIMS):
                    assert got[column] == pytest.approx(want[column]), (name, column)
                n += 1
    assert n == 4 * len(rows)


def test_cube_scans_once(model, tmp_path, spark):
    path = str(tmp_path / "perf")
    model["performance"].write.parquet(path)
    plan = contexts.cube(spark.read.parquet(path), DIMS, SETS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    # States are folded before they are repeated per set.
    assert plan.index("Expand") < plan.rindex("Aggregate")


# -- monthly states ----------------------------------------------------------------------

ROWS = "sku_id string, date_month date, algo_name string, actual_qty double, forecast_qty double"


def audit(n_months=9):
    for i, product, algo in itertools.product(range(n_months), ("p", "q"), ("x", "naive")):
        if (i + len(algo)) % 5:
            actual = None if i == 3 else float((i * 7 + ord(product)) % 11)
            yield product, dt.date(2021, 1 + i, 1), algo, actual, float(i + len(algo))


def test_month_by_month_equals_one_run(spark, tmp_path):
    rows, path = list(audit()), str(tmp_path / "states")
    frame = lambda part: spark.createDataFrame(part, ROWS)
    anchor, windows = dt.date(2021, 9, 1), [1, 3, 4, 6, 12]
    months = sorted({r[1] for r in rows})
    wrong = [(*r[:4], 1e6) for r in rows if r[1] == months[4]]
    monthly_state.load_months(frame(wrong), path)  # a draft that its month replaces
    for month in months:
        monthly_state.load_months(frame([r for r in rows if r[1] == month]), path)
    monthly_state.load_months(frame([]), path)
    states = monthly_state.stored_states(spark, path)
    found = monthly_state.performance_of_states(states, anchor, windows)
    want = accuracy.performance(frame(rows), anchor, windows)
    key = lambda r: (r.product_id, r.algo_name, r.analytical_window_months)
    for got, full in zip(sorted(found.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert got.asDict() == pytest.approx(full.asDict())


def test_windows_read_only_their_months(spark, tmp_path):
    path = str(tmp_path / "states")
    monthly_state.load_months(spark.createDataFrame(list(audit()), ROWS), path)
    states = monthly_state.stored_states(spark, path)
    found = monthly_state.performance_of_states(states, dt.date(2021, 9, 1), [1, 2])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(date_month" in plan
    assert sorted({r.date_month for r in states.inputFiles() and states.select("date_month").collect()})[0] == dt.date(2021, 1, 1)


def test_loads_without_rows_or_months(spark, tmp_path):
    path = str(tmp_path / "states")
    monthly_state.load_months(spark.createDataFrame([("p", None, "x", 1.0, 2.0)], ROWS), path)
    states = monthly_state.stored_states(spark, path)
    assert monthly_state.performance_of_states(states, dt.date(2021, 9, 1), [3]).collect() == []


# -- quarantine --------------------------------------------------------------------------

KIND = "name string, n int, day date, x double"


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(["name,n,day,x", *lines, ""]))


def test_bad_rows_are_kept_with_reason_and_file(spark, tmp_path):
    folder, table, bad = tmp_path / "csv", str(tmp_path / "t"), str(tmp_path / "bad")
    write(folder, "a.csv", "one,1,2020-01-31,1.5", "two,x,2020-01-31,", "three,3", 'fo"ur,,,')
    write(folder, "b.csv", "five,5,2020-02-30,y", "six,6,2020-01-01,1,more", "seven,99999999999,,2")
    found = quarantine.load_csv_checked(spark, str(folder), table, bad, KIND, most_rejected=0.9)
    assert (found.rows, found.rejected) == (2, 5) and found.rejected_share == pytest.approx(5 / 7)
    rows = {r.name: (r.n, r.day, r.x) for r in spark.read.parquet(table).collect()}
    assert rows == {"one": (1, dt.date(2020, 1, 31), 1.5), 'fo"ur': (None, None, None)}
    kept = {r.row_text: (r.reason, r.file) for r in spark.read.parquet(bad).collect()}
    assert kept == {
        "two,x,2020-01-31,": ("n: int", "a.csv"),
        "three,3": ("number of fields", "a.csv"),
        "five,5,2020-02-30,y": ("day: date; x: double", "b.csv"),
        "six,6,2020-01-01,1,more": ("number of fields", "b.csv"),
        "seven,99999999999,,2": ("n: int", "b.csv"),
    }


def test_too_many_bad_rows_leave_the_table(spark, tmp_path):
    folder, table, bad = tmp_path / "csv", tmp_path / "t", str(tmp_path / "bad")
    write(folder, "a.csv", "one,1,2020-01-31,1.5", "two,x,,")
    with pytest.raises(ValueError, match="1 of 2 rows"):
        quarantine.load_csv_checked(spark, str(folder), str(table), bad, KIND, most_rejected=0.4)
    assert not table.exists() and spark.read.parquet(bad).count() == 1
    write(folder, "a.csv")
    loaded = quarantine.load_csv_checked(spark, str(folder), str(table), bad, KIND)
    assert loaded == quarantine.Loaded(0, 0) and spark.read.parquet(str(table)).count() == 0


def test_states_are_shuffled_once(spark):
    rows = spark.createDataFrame(list(audit()), ROWS)
    dealt, plain = monthly_state.dealt_states(rows), monthly_state.month_states(rows)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "date_month" in plan.split("Exchange hashpartitioning(")[1].split(")")[0]

    def shown(df):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())

    assert shown(dealt) == shown(plain)
