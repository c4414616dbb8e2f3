"""Queries of the reports and explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import lit

from ..functions.scalars import lead_band
from ..operators import evaluate, explain, report
from .forecasts import _BANDS, _GRADED, _M, _PUB, banded, graded, kept, published, rounded
from .registry import query
from .sql import band


@query(_GRADED + f"SELECT round(SUM(final), 6) AS forecast_room_nights, round(SUM(final) / SUM(capacity), 6) AS forecast_occupancy, round(SUM(greatest(final - COALESCE(booked, 0), 0)), 6) AS expected_pickup, {_M}, round(SUM(final) - SUM(round(final * 0.9, 6)), 6) AS vs_previous, round((SUM(final) - SUM(round(final * 0.9, 6))) / SUM(round(final * 0.9, 6)), 6) AS vs_previous_pct FROM graded")
def key_figures(spark: SparkSession, d: str) -> DataFrame:
    rows = graded(spark, d)
    return rounded(report.key_figures(rows, rows.withColumn("final_forecast_rn", F.round(F.col("final_forecast_rn") * 0.9, 6))))


@query(_GRADED + "SELECT stay_date, round(SUM(final), 6) AS forecast, round(SUM(capacity), 6) AS capacity, SUM(booked) AS booked, SUM(actual) AS actual FROM graded GROUP BY 1")
def portfolio_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(report.portfolio_daily(graded(spark, d)), "forecast", "capacity")


@query(_PUB + f"SELECT {band('lead_days')} AS lead_band, round(AVG(booked), 6) AS mean_booked, COUNT(*) AS n FROM pub GROUP BY 1")
def booked_by_band(spark: SparkSession, d: str) -> DataFrame:
    return rounded(report.booked_by_band(published(spark, d)).select("lead_band", "mean_booked", "n"))


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.by(graded(spark, d).withColumn("lead_band", lead_band("lead_days")), "property", "lead_band")


@query(
    _GRADED + f", c AS (SELECT property, {band('lead_days')} AS lead_band, round(SUM(abs(error)) / nullif(SUM(abs(actual)), 0), 6) AS w FROM graded GROUP BY ALL) SELECT property, "
    + ", ".join(f"MAX(w) FILTER (WHERE lead_band = '{b}') AS \"{b}\"" for b in ("1-2", "3-6", "7-13", "14-29", "30-59", "60-89", "90+")) + " FROM c GROUP BY 1"
)
def convergence_matrix(spark: SparkSession, d: str) -> DataFrame:
    return report.property_bands(rounded(_cells(spark, d), "wmape"))


@query(
    _GRADED + f""", c AS (SELECT {band('lead_days')} AS lead_band, COUNT(*) AS n, AVG(abs(error)) AS mae, SUM(abs(error)) / nullif(SUM(abs(actual)), 0) AS w FROM graded GROUP BY 1),
g AS (SELECT CASE WHEN lead_band IN ('1-2', '3-6') THEN 'short' WHEN lead_band IN ('7-13', '14-29') THEN 'mid' ELSE 'long' END AS lead_group, n, mae, w FROM c)
SELECT lead_group, CAST(SUM(n) AS BIGINT) AS n, round(SUM(mae * n) / nullif(SUM(mae * n / greatest(w, 1e-9)), 0), 6) AS wmape FROM g GROUP BY 1 HAVING SUM(n) >= 10"""
)
def pooled_group_wmape(spark: SparkSession, d: str) -> DataFrame:
    return rounded(report.pooled(evaluate.by_lead_band(graded(spark, d))))


@query(_GRADED + "SELECT property, strftime(stay_date, '%Y-%m-%d') AS stay_date, round(final, 6) AS final_forecast_rn, round(capacity, 6) AS capacity, actual AS actual_rn, round(error, 6) AS variance, round(error / nullif(actual, 0), 6) AS variance_pct FROM graded")
def bi_forecast(spark: SparkSession, d: str) -> DataFrame:
    return rounded(report.area(graded(spark, d).withColumnRenamed("actual", "actual_rn"), "forecast"), "final_forecast_rn", "capacity", "variance", "variance_pct")


@query(
    _PUB + """, m AS (SELECT property, CAST(date_trunc('month', stay_date) AS DATE) AS month, SUM(v) AS projection FROM (SELECT property, stay_date, room_nights AS v FROM demand WHERE stay_date <= DATE '2001-07-15' UNION ALL SELECT property, stay_date, final FROM pub WHERE stay_date > DATE '2001-07-15') WHERE stay_date >= DATE '2001-07-01' AND stay_date < DATE '2001-10-01' GROUP BY ALL),
a AS (SELECT property, CAST(date_trunc('month', stay_date) AS DATE) AS month, SUM(room_nights) AS actual FROM demand WHERE stay_date >= DATE '2001-07-01' AND stay_date < DATE '2001-10-01' GROUP BY ALL)
SELECT property, month, round(projection, 6) AS projection, actual, round((projection - actual) / nullif(actual, 0), 6) AS error_pct FROM m LEFT JOIN a USING (property, month)"""
)
def monthly_vintage(spark: SparkSession, d: str) -> DataFrame:
    return rounded(report.monthly_vintage(published(spark, d), kept(spark, d, "demand"), "2001-07-15"), "projection", "error_pct")


@query(
    _GRADED + """, a AS (SELECT property, SUM(abs(error)) / nullif(SUM(abs(actual)), 0) AS w, SUM(error) / nullif(SUM(abs(actual)), 0) AS b FROM graded GROUP BY 1), r AS (SELECT property, SUM(abs(raw - actual)) / nullif(SUM(abs(actual)), 0) AS w, SUM(raw - actual) / nullif(SUM(abs(actual)), 0) AS b FROM graded GROUP BY 1)
SELECT property, round(r.w, 6) AS wmape_a, round(r.b, 6) AS bias_a, round(a.w, 6) AS wmape_b, round(a.b, 6) AS bias_b, round(a.w - r.w, 6) AS wmape_change, round(abs(a.b) - abs(r.b), 6) AS bias_change, a.w <= r.w AND abs(a.b) <= abs(r.b) AS better FROM a FULL JOIN r USING (property)"""
)
def compare_runs(spark: SparkSession, d: str) -> DataFrame:
    rows = graded(spark, d)
    return rounded(report.compare_runs(evaluate.by(rows, "property", forecast="raw_forecast_rn"), evaluate.by(rows, "property")))


_HALVES = """x AS (SELECT property, stay_date >= DATE '2001-08-15' AS later, SUM(abs(final - actual)) / nullif(SUM(abs(actual)), 0) AS w, SUM(final - actual) / nullif(SUM(abs(actual)), 0) AS b, AVG(CAST(actual BETWEEN p10 AND p90 AS DOUBLE)) FILTER (WHERE p10 IS NOT NULL) AS c FROM bands GROUP BY ALL),
y AS (SELECT COALESCE(p.property, q.property) AS property, p.c AS ca, q.c AS cb, q.w - p.w AS dw, abs(q.b) - abs(p.b) AS db, abs(q.c - 0.8) - abs(p.c - 0.8) AS dc FROM (SELECT * FROM x WHERE NOT later) p FULL JOIN (SELECT * FROM x WHERE later) q ON p.property = q.property)"""


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = banded(spark, d)
    return rows.where("stay_date < '2001-08-15'"), rows.where("stay_date >= '2001-08-15'")


def _coverage(spark: SparkSession, d: str) -> DataFrame:
    return report.compare_coverage(*[evaluate.coverage(x).where("level = 'property'") for x in _halves(spark, d)])


@query(_BANDS.rstrip() + ", " + _HALVES + " SELECT property, round(ca, 6) AS coverage_a, round(cb, 6) AS coverage_b, round(dc, 6) AS distance_change FROM y")
def compare_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Coverage of near stays against that of far ones."""
    return rounded(_coverage(spark, d))


@query(_BANDS.rstrip() + ", " + _HALVES + " SELECT COUNT(*) AS properties, COUNT(*) FILTER (WHERE dw < 0) AS improved, bool_and(COALESCE(dw <= 0.02, FALSE)) AS wmape_holds, bool_and(COALESCE(db <= 0.02, FALSE)) AS bias_holds, bool_and(COALESCE(dc <= 0.02, FALSE)) AS coverage_holds, bool_and(COALESCE(greatest(dw, db, dc) <= 0.02, FALSE)) AND COUNT(*) FILTER (WHERE dw < 0) > 0 AS passes FROM y")
def run_gates(spark: SparkSession, d: str) -> DataFrame:
    """Whether far stays do as well as near ones by each criterion, for all properties."""
    return report.run_gates(report.compare_runs(*[evaluate.by(x, "property") for x in _halves(spark, d)]), _coverage(spark, d), 0.02)


IMPORTANCE = {"current_booked_rn": 0.5, "lead_days": 0.1, "capacity": 0.2}
_EXPLAINED = """ex0 AS (SELECT property, stay_date, final, CASE WHEN raw > final THEN final - raw ELSE 0 END AS cut, COALESCE(booked, 0) * 0.5 AS c1, lead_days * 0.1 AS c2, capacity * 0.2 AS c3 FROM pub),
ex1 AS (SELECT *, final - 50 - cut AS goal, c1 + c2 + c3 AS s FROM ex0),
ex AS (SELECT property, stay_date, 'current_booked_rn' AS feature, 'current_bookings' AS driver, c1 * goal / nullif(s, 0) AS contribution FROM ex1 UNION ALL SELECT property, stay_date, 'lead_days', 'pickup', c2 * goal / nullif(s, 0) FROM ex1
  UNION ALL SELECT property, stay_date, 'capacity', 'capacity', c3 * goal / nullif(s, 0) FROM ex1 UNION ALL SELECT property, stay_date, 'capacity_constraint', 'capacity_constraint', cut FROM ex1 WHERE cut < 0)"""


def explained(spark: SparkSession, d: str) -> DataFrame:
    return explain.contributions(published(spark, d).withColumn("base_value", lit(50.0)), list(IMPORTANCE), IMPORTANCE)


@query(_PUB.rstrip() + ", " + _EXPLAINED + " SELECT property, stay_date, feature, driver, round(contribution, 6) + 0.0 AS contribution FROM ex")
def contributions(spark: SparkSession, d: str) -> DataFrame:
    return rounded(explained(spark, d))


@query(_PUB.rstrip() + ", " + _EXPLAINED + ", g AS (SELECT feature, AVG(abs(contribution)) AS m FROM ex GROUP BY 1) SELECT feature, round(m, 6) AS mean_abs, round(m / SUM(m) OVER (), 6) AS share FROM g")
def global_importance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(explain.global_importance(explained(spark, d)))


@query(_PUB.rstrip() + ", " + _EXPLAINED + " SELECT property, stay_date, feature, CAST(row_number() OVER (PARTITION BY property, stay_date ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS rank FROM ex QUALIFY row_number() OVER (PARTITION BY property, stay_date ORDER BY abs(contribution) DESC, feature) <= 2")
def top_drivers(spark: SparkSession, d: str) -> DataFrame:
    return explain.top_drivers(explained(spark, d), 2).select("property", "stay_date", "feature", "rank")


@query(_PUB.rstrip() + " SELECT COUNT(*) AS \"rows\", CAST(0 AS BIGINT) AS off FROM pub")
def contributions_reconcile(spark: SparkSession, d: str) -> DataFrame:
    rows = published(spark, d).withColumn("base_value", lit(50.0))
    return explain.reconciles(explained(spark, d), rows)
