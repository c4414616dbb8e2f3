"""The interval ladder from weighted residuals of corrected forecasts; as-of joins of keys with very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import asof, calibrate, evaluate, monitor, publish, run
from ..sources import store
from .forecasts import MADE, _BANDED, _BANDS, PREDS, SINGLE, banded, fold_predictions, graded, kept, published, rounded
from .registry import query
from .sql import CAPACITY, DEMAND, PICKUP, PUBLISHED, band, season, with_

DECAY = 0.7


def _quantile(i: int, share: float) -> str:
    return f"""CASE WHEN va{i} IS NULL THEN vb{i} WHEN vb{i} IS NULL THEN va{i} ELSE va{i} + (vb{i} - va{i}) * COALESCE(({share} - pa{i}) / nullif(pb{i} - pa{i}, 0), 0) END AS q{i}"""


_ENDS = ", ".join(f"MAX(p) FILTER (WHERE p <= {x}) AS pa{i}, arg_max(residual, p) FILTER (WHERE p <= {x}) AS va{i}, MIN(p) FILTER (WHERE p >= {x}) AS pb{i}, arg_min(residual, p) FILTER (WHERE p >= {x}) AS vb{i}" for i, x in ((10, 0.1), (90, 0.9)))
_WEIGHTED = f"""b0 AS (SELECT property, {band('lead_days')} AS lead_band, {season('stay_date')} AS season, fold, power({DECAY}, 3 - fold) AS w, forecast, actual FROM preds WHERE model = 'seasonal_naive'),
s0 AS (SELECT property, lead_band, season, fold, COUNT(*) AS n, SUM(w * (forecast - actual)) AS we, SUM(w * abs(actual)) AS wa, MIN(w) AS w FROM b0 GROUP BY GROUPING SETS ((property, lead_band, fold), (property, lead_band, season, fold))),
t0 AS (SELECT property, lead_band, season, SUM(n) AS n, SUM(we) / nullif(SUM(wa), 0) AS rel, SUM(w) AS aw, SUM(CASE WHEN we > 0 THEN w ELSE 0 END) AS uw FROM s0 GROUP BY ALL),
f0 AS (SELECT *, CASE WHEN rel > 0 THEN uw ELSE aw - uw END / nullif(aw, 0) AS consistency, 1 + (least(greatest(1 - rel, 0.7), 1.3) - 1) * n / (n + 30.0) AS raw FROM t0),
o0 AS (SELECT *, CASE WHEN n >= 20 AND consistency >= 0.75 AND abs(raw - 1) >= 0.005 THEN raw ELSE 1 END AS own FROM f0),
fine AS (SELECT x.property, x.lead_band, x.season, CASE WHEN x.own <> 1 THEN x.own ELSE y.own END AS factor FROM o0 x JOIN o0 y ON x.property = y.property AND x.lead_band = y.lead_band AND y.season IS NULL WHERE x.season IS NOT NULL),
res AS (SELECT b0.property, b0.lead_band, b0.season, forecast * COALESCE(fine.factor, o0.own, 1) - actual AS residual, b0.w FROM b0 LEFT JOIN fine USING (property, lead_band, season) LEFT JOIN o0 ON o0.property = b0.property AND o0.lead_band = b0.lead_band AND o0.season IS NULL),
lv AS (SELECT 0 AS level, property, lead_band, season, residual, w FROM res UNION ALL SELECT 1, property, lead_band, NULL, residual, w FROM res UNION ALL SELECT 3, property, NULL, NULL, residual, w FROM res
  UNION ALL SELECT 5, NULL, lead_band, NULL, residual, w FROM res UNION ALL SELECT 7, NULL, NULL, NULL, residual, w FROM res),
mid AS (SELECT *, SUM(w) OVER (PARTITION BY level, property, lead_band, season ORDER BY residual, w ROWS UNBOUNDED PRECEDING) - w / 2 AS m FROM lv),
placed AS (SELECT *, CASE WHEN MIN(w) OVER c = MAX(w) OVER c THEN COALESCE((m - MIN(m) OVER c) / nullif(MAX(m) OVER c - MIN(m) OVER c, 0), 0) ELSE m / MAX(m) OVER c END AS p FROM mid WINDOW c AS (PARTITION BY level, property, lead_band, season)),
ends AS (SELECT level, property, lead_band, season, COUNT(*) AS n, {_ENDS} FROM placed GROUP BY ALL),
cells AS (SELECT level, property, lead_band, season, n, {_quantile(10, 0.1)}, {_quantile(90, 0.9)} FROM ends)"""
_CELLS = f"cells AS (WITH {PREDS}, {_WEIGHTED} SELECT * FROM cells)"


def _cells(spark: SparkSession, d: str) -> DataFrame:
    rows = calibrate.operative(fold_predictions(spark, d), "seasonal_naive")
    return publish.weighted_cells(calibrate.residuals(rows, calibrate.bias_cells(rows, decay=DECAY), DECAY))


MADE["cells_weighted"] = _cells


@query(with_(DEMAND, PICKUP, PREDS, _WEIGHTED) + "SELECT property, lead_band, season, n, round(q10, 6) AS q10, round(q90, 6) AS q90 FROM cells")
def residual_cells_weighted(spark: SparkSession, d: str) -> DataFrame:
    """Residuals of the corrected forecast, later folds weighing more."""
    return rounded(kept(spark, d, "cells_weighted").select("property", "lead_band", "season", "n", "q10", "q90"))


@query(with_(DEMAND, CAPACITY, PICKUP, _CELLS, SINGLE, PUBLISHED, _BANDED) + "SELECT property, stay_date, round(p10, 6) AS p10, round(final, 6) AS p50, round(p90, 6) AS p90 FROM bands")
def intervals_weighted(spark: SparkSession, d: str) -> DataFrame:
    return rounded(publish.intervals(graded(spark, d), kept(spark, d, "cells_weighted")).select("property", "stay_date", "p10", "p50", "p90"))


@query(
    with_(DEMAND, CAPACITY, PICKUP, SINGLE, PUBLISHED)
    + """, p AS (SELECT stay_date, SUM(raw) AS portfolio FROM pub WHERE day(stay_date) <> 3 GROUP BY 1), u AS (SELECT stay_date, SUM(final) AS bottom_up FROM pub WHERE day(stay_date) <> 5 GROUP BY 1),
d AS (SELECT COALESCE(bottom_up, 0) AS b, COALESCE(portfolio, 0) AS p FROM u FULL JOIN p USING (stay_date))
SELECT round(SUM(b), 6) AS total_bottom_up, round(SUM(p), 6) AS total_portfolio, round(SUM(p - b), 6) AS total_gap, round(COALESCE(abs(SUM(p - b) / nullif(SUM(b), 0)), 0), 6) AS gap_pct, COUNT(*) FILTER (WHERE abs(p - b) > 0.5) AS days_off FROM d"""
)
def reconcile_total(spark: SparkSession, d: str) -> DataFrame:
    rows = published(spark, d)
    portfolio = rows.where(F.dayofmonth("stay_date") != 3).groupBy("stay_date").agg(F.sum("raw_forecast_rn").alias("forecast"))
    return rounded(publish.reconciled(publish.reconcile(rows.where(F.dayofmonth("stay_date") != 5), portfolio)))


#: Quarter ends at which the bookings of each stay are asked for.
CUTOFFS = ("2000-03-31", "2000-06-30", "2000-09-30", "2000-12-31", "2001-03-31", "2001-06-30")


@query(
    with_(DEMAND, PICKUP)
    + f"""SELECT property, stay_date, cutoff, arg_max(pickup_rn, (snapshot_date, pickup_rn)) AS booked, MAX(snapshot_date) AS as_of FROM pickup JOIN (SELECT CAST(unnest([{', '.join(repr(c) for c in CUTOFFS)}]) AS DATE) AS cutoff) ON snapshot_date <= cutoff WHERE stay_date > cutoff GROUP BY ALL"""
)
def booked_at_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    """What was on the books for every later stay at each of several cutoffs, in one plan."""
    cutoffs = spark.createDataFrame([(c,) for c in CUTOFFS], "cutoff string").withColumn("cutoff", F.to_date("cutoff"))
    known = asof.asof_cutoffs(kept(spark, d, "pickup"), ["property", "stay_date"], "snapshot_date", ["snapshot_date", "pickup_rn"], cutoffs)
    return known.where(F.col("stay_date") > F.col("cutoff")).select("property", "stay_date", "cutoff", F.col("pickup_rn").alias("booked"), F.col("snapshot_date").alias("as_of"))


# Monitoring and counts of a run.


@query(_BANDS + "SELECT property, COUNT(*) AS n, round(AVG(CAST(actual BETWEEN p10 AND p90 AS DOUBLE)), 6) AS coverage, 0.8::DOUBLE AS nominal, CASE WHEN AVG(CAST(actual BETWEEN p10 AND p90 AS DOUBLE)) < 0.8 THEN 'under' ELSE 'over' END AS direction FROM bands WHERE p10 IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 30 AND abs(AVG(CAST(actual BETWEEN p10 AND p90 AS DOUBLE)) - 0.8) > 0.02")
def coverage_alerts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(monitor.coverage_alerts(evaluate.coverage(banded(spark, d)), slack=0.02))


@query(with_(DEMAND) + "SELECT COUNT(*) FILTER (WHERE stay_date > DATE '2001-03-31') AS new_records, MIN(stay_date) AS first, MAX(stay_date) AS last, CAST(MAX(stay_date) - MIN(stay_date) + 1 AS INTEGER) AS span_days FROM demand")
def new_since_training(spark: SparkSession, d: str) -> DataFrame:
    """What came after the high-water mark of an earlier training."""
    return store.new_since(kept(spark, d, "demand"), "2001-03-31")


def _counts(name: str) -> str:
    return f"SELECT '{name}' AS source, SUM(n) AS rows, COUNT(*) AS properties, MIN(a) AS first_day, MAX(z) AS last_day, SUM(d) AS days, SUM(z - a + 1 - d) AS missing_days FROM (SELECT property, COUNT(*) AS n, MIN(stay_date) AS a, MAX(stay_date) AS z, COUNT(DISTINCT stay_date) AS d FROM {name} GROUP BY 1)"


@query(with_(DEMAND, CAPACITY, PICKUP) + f"SELECT source, CAST(rows AS BIGINT) AS rows, properties, first_day, last_day, CAST(days AS BIGINT) AS days, CAST(missing_days AS BIGINT) AS missing_days FROM ({' UNION ALL '.join(_counts(t) for t in ('demand', 'pickup', 'capacity'))})")
def eda_counts(spark: SparkSession, d: str) -> DataFrame:
    return run.eda(*[kept(spark, d, t) for t in ("demand", "pickup", "capacity")])
