"""The forecasting operators: cases worked out by hand, and queries against their DuckDB statements."""

import os
from datetime import date
from math import sqrt

import duckdb
import pytest

import __spark_entry__
from tidemark.functions import scalars
from tidemark.operators import evaluate, leakage, publish, quality
from tidemark.plans import queries as plans
from tidemark.sources import files

#: One query of each family of operators; the driver compares all of them.
COMPARED = (
    "demand_canon", "pickup_canon", "capacity_canon", "dq_demand", "dq_report", "booked_asof_grid", "asof_last_purchase", "leak_target_in_rolling", "calendar_features", "demand_rolling_mean",
    "pickup_windows", "floor_cap", "metrics_property", "vintage_score", "psi_year_on_year", "contributions", "stream_daily_demand",
)


def cell(x):
    return round(float(x), 4) + 0.0 if isinstance(x, float) or type(x).__name__ == "Decimal" else str(x)


@pytest.mark.parametrize("name", COMPARED)
def test_query_matches_its_statement(spark, small, name):
    base = duckdb.connect()
    for f in os.listdir(small):
        base.execute(f"create view {f.removesuffix('.parquet')} as select * from '{small}/{f}'")
    found = base.execute(plans.ORACLE[name])
    names = [x[0] for x in found.description]
    made = plans.QUERIES[name](spark, small)
    assert sorted(made.columns) == sorted(names)
    order = sorted(names)
    mine = sorted([tuple(cell(r[n]) for n in order) for r in made.collect()], key=str)
    other = sorted([tuple(cell(r[names.index(n)]) for n in order) for r in found.fetchall()], key=str)
    assert mine == other and mine


def test_entry_lists_every_statement(spark):
    made, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(made) and set(plans.QUERIES) <= set(made)


def errors(spark, pairs):
    return evaluate.by(spark.createDataFrame([("m", a, f) for a, f in pairs], "model string, actual double, forecast double"), "model").first()


def test_metrics(spark):
    r = errors(spark, [(100.0, 90.0), (100.0, 110.0), (100.0, 95.0), (100.0, 105.0)])
    assert (r.mae, r.wmape, r.mape, r.bias) == pytest.approx((7.5, 0.075, 7.5, 0)) and r.rmse == pytest.approx(sqrt(62.5))


def test_metrics_of_zero_actuals(spark):
    r = errors(spark, [(0.0, 10.0), (100.0, 90.0), (0.0, 5.0), (100.0, 110.0)])
    assert (r.mape, r.n_mape_excluded, r.mae, r.wmape, r.n_obs) == pytest.approx((10, 2, 8.75, 0.175, 4))
    r = errors(spark, [(0.0, 1.0), (0.0, 2.0), (0.0, 3.0)])
    assert r.mape is None and (r.n_mape_excluded, r.mae) == (3, 2)


def test_weekly_metrics(spark):
    rows = [("a", date(2026, 1, 5), 10.0, 12.0), ("a", date(2026, 1, 6), 20.0, 18.0), ("a", date(2026, 1, 12), 30.0, 27.0)]
    r = evaluate.weekly(spark.createDataFrame(rows, "property string, stay_date date, actual double, forecast double"), "property").first()
    assert r.n_obs == 2 and r.wmape == pytest.approx(3 / 60)


def test_floor_and_cap(spark):
    rows = [("a", date(2026, 1, 1), 120.0, 0.0, 100.0), ("a", date(2026, 1, 2), 80.0, 0.0, 100.0), ("a", date(2026, 1, 3), 100.0, 0.0, 90.0), ("a", date(2026, 1, 4), 50.0, 60.0, 90.0), ("a", date(2026, 1, 5), 50.0, None, None)]
    made = publish.floor_and_cap(spark.createDataFrame(rows, "property string, stay_date date, raw_forecast_rn double, current_booked_rn double, capacity double"))
    assert [r.final_forecast_rn for r in made.orderBy("stay_date").collect()] == [100, 80, 90, 60, None]
    assert sorted((r.kind, r.amount) for r in publish.alerts(made).collect()) == [("booked_floor", 10), ("capacity", 10), ("capacity", 20)]


def test_ambiguous_dates(spark):
    rows = spark.createDataFrame([("05/10/2026",), ("12/11/2026",), (None,)], "d string")
    assert [r.d for r in files.parse_dates(rows, "d").collect()] == [date(2026, 10, 5), date(2026, 11, 12), None]
    assert [r.d for r in files.parse_dates(rows, "d", prefer_day_first=False).collect()] == [date(2026, 5, 10), date(2026, 12, 11), None]


def test_duplicate_rows_fail_the_gate(spark):
    rows = spark.createDataFrame([("north", date(2026, 1, 1), 1.0)] * 2, "property string, stay_date date, room_nights double")
    issues = quality.demand_issues(rows)
    found = {r["check"]: (r.severity, r.records) for r in issues.collect()}
    assert found == {"duplicate_property_date": ("error", 2)}
    with pytest.raises(quality.CriticalDataError):
        quality.gate(issues)
    quality.gate(quality.demand_issues(rows.limit(1)))


def test_rolling_feature_that_holds_its_own_day(spark):
    rows = spark.createDataFrame([("a", date(2026, 1, d), float(d * d % 7)) for d in range(1, 20)], "property string, stay_date date, room_nights double")
    w = "over (partition by property order by stay_date rows between {} preceding and {})"
    own = rows.selectExpr("*", f"avg(room_nights) {w.format(2, 'current row')} as rolling_mean_3")
    honest = rows.selectExpr("*", f"avg(room_nights) {w.format(3, '1 preceding')} as rolling_mean_3")
    assert leakage.own_target(own, "rolling_mean_3", "mean", 3).first().includes_target
    assert not leakage.own_target(honest, "rolling_mean_3", "mean", 3).first().includes_target


def test_season(spark):
    r = spark.createDataFrame([(date(2026, 3, 7),)], "d date").select(scalars.season("d").alias("s")).first()
    assert r.s == "shoulder"


def test_detected_columns(spark):
    rows = spark.createDataFrame([("X", "2026-01-01", "10", "n")], "hotel_code string, business_date string, oficial_inventory string, notes string")
    assert files.detect_schema(rows, "capacity")
    with pytest.raises(files.SchemaDetectionError):
        files.detect_schema(spark.createDataFrame([("x",)], "only string"), "demand")
