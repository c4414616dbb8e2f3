"""Queries over forecasts: candidates, publication, evaluation, selection, calibration, monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import lit

from ..functions.metrics import NAMES
from ..functions.scalars import lead_band, r6, season as season_of
from ..operators import asof, backtest, calibrate, evaluate, models, monitor, publish, selection
from ..sources import canon
from ..sources.tables import settle
from .facts import CUTOFF, HORIZON
from .registry import query
from .sql import CAPACITY, DEMAND, FOLD_METRICS, FOLDS, ONE, PICKUP, PUBLISHED, band, metrics, predictions, scored, season, with_

PREDS, SINGLE = predictions(FOLDS), predictions(ONE)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """df with these columns rounded to six places; all doubles if none are named."""
    doubles = names or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: r6(c) for c in doubles})


_KEPT: dict[tuple, DataFrame] = {}


def kept(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A canonical fact or what many queries start from, written once as a table: plans that begin there are short. Facts are a
    row for each property and day (and lead), whatever the size of the tables they come from."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _KEPT:
        _KEPT[key] = settle((MADE.get(name) or getattr(canon, name))(spark, d), f"kept-{name}")
    return _KEPT[key]


def fold_predictions(spark: SparkSession, d: str) -> DataFrame:
    return kept(spark, d, "folds")


def _folds(spark: SparkSession, d: str) -> DataFrame:
    return selection.fold_predictions(kept(spark, d, "demand"), kept(spark, d, "pickup"), CUTOFF)


def published(spark: SparkSession, d: str) -> DataFrame:
    """The flagship forecast: naive points on the cutoff, as-of bookings, capacity, floor and cap."""
    demand = kept(spark, d, "demand")
    trained = asof.as_of(demand, CUTOFF).groupBy("property").count().where(F.col("count") >= selection.MIN_TRAIN).select("property")
    grid = asof.booked_on_grid(asof.request_grid(trained, CUTOFF, HORIZON), kept(spark, d, "pickup"), CUTOFF)
    made = models.seasonal_naive(demand, CUTOFF, grid).select("property", "stay_date", "lead_days", F.col("booked").alias("current_booked_rn"), F.col("forecast").alias("raw_forecast_rn"))
    return publish.floor_and_cap(publish.with_capacity(made, kept(spark, d, "capacity"), CUTOFF)).withColumn("forecast_date", lit(CUTOFF).cast("date"))


def graded(spark: SparkSession, d: str) -> DataFrame:
    """published with actuals, as columns actual and forecast."""
    return published(spark, d).join(kept(spark, d, "demand").select("property", "stay_date", F.col("room_nights").alias("actual")), ["property", "stay_date"]).withColumn("forecast", F.col("final_forecast_rn"))


def banded(spark: SparkSession, d: str) -> DataFrame:
    return kept(spark, d, "banded")


def _banded(spark: SparkSession, d: str) -> DataFrame:
    """graded with p10, p50 and p90 from the folds' residuals."""
    return publish.intervals(graded(spark, d), kept(spark, d, "cells"))


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return publish.residual_cells(calibrate.residuals(calibrate.operative(fold_predictions(spark, d), "seasonal_naive")))


#: Intermediate results that many queries start from.
MADE = {"capacity": lambda spark, d: canon.capacity(spark, d, kept(spark, d, "demand")), "folds": _folds, "cells": _cells, "banded": _banded}


# Candidates.


@query(with_(DEMAND, PICKUP, SINGLE) + "SELECT property, stay_date, lead_days, round(forecast, 6) AS forecast FROM made WHERE model = 'seasonal_naive'")
def seasonal_naive(spark: SparkSession, d: str) -> DataFrame:
    demand = canon.demand(spark, d)
    return rounded(models.seasonal_naive(demand, CUTOFF, asof.request_grid(demand.select("property").distinct(), CUTOFF, HORIZON)))


@query(with_(DEMAND, PICKUP, SINGLE) + "SELECT level, property, season, CAST(bin AS INTEGER) AS bin, round(pickup, 6) AS pickup FROM curves")
def pickup_curves(spark: SparkSession, d: str) -> DataFrame:
    return rounded(models.pickup_curves(asof.remaining_pickup(kept(spark, d, "pickup"), kept(spark, d, "demand"), CUTOFF)).select("level", "property", "season", "bin", "pickup"))


@query(with_(DEMAND, PICKUP, SINGLE) + "SELECT property, stay_date, lead_days, round(forecast, 6) AS forecast FROM made WHERE model = 'pickup_curve'")
def curve_predict(spark: SparkSession, d: str) -> DataFrame:
    demand, pickup = kept(spark, d, "demand"), kept(spark, d, "pickup")
    grid = asof.booked_on_grid(asof.request_grid(demand.select("property").distinct(), CUTOFF, HORIZON), pickup, CUTOFF)
    return rounded(models.curve_pickup(grid, models.pickup_curves(asof.remaining_pickup(pickup, demand, CUTOFF))).select("property", "stay_date", "lead_days", "forecast"))


@query(
    with_(DEMAND)
    + f""", w AS (SELECT property, CAST(isodow(stay_date) - 1 AS INTEGER) AS dow, COUNT(*) AS n, AVG(room_nights) AS m FROM demand WHERE stay_date <= DATE '{CUTOFF}' AND DATE '{CUTOFF}' - stay_date < 84 GROUP BY ALL)
SELECT property, dow, round(m / AVG(m) OVER (PARTITION BY property), 6) AS factor FROM w QUALIFY COUNT(*) OVER (PARTITION BY property) = 7 AND MIN(n) OVER (PARTITION BY property) >= 3 AND SUM(n) OVER (PARTITION BY property) >= 21"""
)
def dow_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(models.dow_profile(canon.demand(spark, d), CUTOFF))


# Publication.

_PUB = with_(DEMAND, CAPACITY, PICKUP, SINGLE, PUBLISHED)


@query(_PUB + "SELECT property, stay_date, lead_days, booked AS current_booked_rn, round(raw, 6) AS raw_forecast_rn, round(capacity, 6) AS capacity, round(final, 6) AS final_forecast_rn, floored AS booked_floor_applied, capped AS capacity_constraint_applied FROM pub")
def floor_cap(spark: SparkSession, d: str) -> DataFrame:
    return rounded(published(spark, d).select("property", "stay_date", "lead_days", "current_booked_rn", "raw_forecast_rn", "capacity", "final_forecast_rn", "booked_floor_applied", "capacity_constraint_applied"), "raw_forecast_rn", "capacity", "final_forecast_rn")


@query(
    _PUB
    + """SELECT property, stay_date, kind, round(amount, 6) AS amount FROM (SELECT property, stay_date, 'booked_floor' AS kind, booked - raw AS amount FROM pub WHERE floored
UNION ALL SELECT property, stay_date, 'booked_over_capacity', capacity - booked FROM pub WHERE booked > capacity
UNION ALL SELECT property, stay_date, 'capacity', greatest(raw, COALESCE(booked, raw)) - capacity FROM pub WHERE capped)"""
)
def publication_alerts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(publish.alerts(published(spark, d)))


@query(_PUB + "SELECT property, stay_date, round(final / nullif(capacity, 0), 6) AS forecast_occupancy, COALESCE(final / nullif(capacity, 0) NOT BETWEEN 0 AND 1, FALSE) AS occupancy_out_of_range FROM pub")
def occupancy(spark: SparkSession, d: str) -> DataFrame:
    return rounded(publish.occupancy(published(spark, d)).select("property", "stay_date", "forecast_occupancy", "occupancy_out_of_range"))


@query(
    _PUB
    + """, p AS (SELECT stay_date, SUM(raw) AS portfolio FROM pub WHERE day(stay_date) <> 3 GROUP BY 1), u AS (SELECT stay_date, SUM(final) AS bottom_up FROM pub WHERE day(stay_date) <> 5 GROUP BY 1)
SELECT stay_date, round(COALESCE(bottom_up, 0), 6) AS bottom_up, round(COALESCE(portfolio, 0), 6) AS portfolio, round(COALESCE(portfolio, 0) - COALESCE(bottom_up, 0), 6) AS gap FROM u FULL JOIN p USING (stay_date)"""
)
def reconcile(spark: SparkSession, d: str) -> DataFrame:
    rows = published(spark, d)
    portfolio = rows.where(F.dayofmonth("stay_date") != 3).groupBy("stay_date").agg(F.sum("raw_forecast_rn").alias("forecast"))
    return rounded(publish.reconcile(rows.where(F.dayofmonth("stay_date") != 5), portfolio))


_RES = f"""res AS (SELECT property, {band('lead_days')} AS lead_band, {season('stay_date')} AS season, forecast - actual AS residual FROM preds WHERE model = 'seasonal_naive'),
cells AS (SELECT property, lead_band, season, COUNT(*) AS n, quantile_cont(residual, 0.1) AS q10, quantile_cont(residual, 0.9) AS q90, CAST(GROUPING(property, lead_band, season) AS INTEGER) AS level FROM res GROUP BY GROUPING SETS ((), (property), (lead_band), (property, lead_band), (property, lead_band, season)))"""


@query(with_(DEMAND, PICKUP, PREDS, _RES) + "SELECT property, lead_band, season, n, round(q10, 6) AS q10, round(q90, 6) AS q90 FROM cells")
def residual_cells(spark: SparkSession, d: str) -> DataFrame:
    rows = calibrate.residuals(calibrate.operative(fold_predictions(spark, d), "seasonal_naive"))
    return rounded(publish.residual_cells(rows).select("property", "lead_band", "season", "n", "q10", "q90"))


# The single-cutoff CTEs have the names of the folds' ones, so cells are taken from a subquery of their own.
_CELLS = f"cells AS (WITH {PREDS}, {_RES} SELECT * FROM cells)"
_BANDED = f"""picked AS (SELECT g.*, q.q10, q.q90 FROM graded g LEFT JOIN LATERAL (SELECT q10, q90 FROM cells c WHERE c.n >= 20 AND (
    (c.level = 0 AND c.property = g.property AND c.lead_band = {band('g.lead_days')} AND c.season = {season('g.stay_date')}) OR (c.level = 1 AND c.property = g.property AND c.lead_band = {band('g.lead_days')})
    OR (c.level = 3 AND c.property = g.property) OR (c.level = 5 AND c.lead_band = {band('g.lead_days')}) OR c.level = 7) ORDER BY c.level LIMIT 1) q ON TRUE),
bands AS (SELECT *, least(least(greatest(final - q90, 0), capacity), final) AS p10, greatest(least(greatest(final - q10, 0), capacity), final) AS p90 FROM picked)"""
_BANDS = with_(DEMAND, CAPACITY, PICKUP, _CELLS, SINGLE, PUBLISHED, _BANDED)


@query(_BANDS + "SELECT property, stay_date, round(p10, 6) AS p10, round(final, 6) AS p50, round(p90, 6) AS p90 FROM bands")
def intervals_ladder(spark: SparkSession, d: str) -> DataFrame:
    return rounded(banded(spark, d).select("property", "stay_date", "p10", "p50", "p90"))


@query(
    _BANDS
    + f"""SELECT CASE WHEN g = 3 THEN 'global' WHEN g = 1 THEN 'property' WHEN g = 2 THEN 'band' ELSE 'cell' END AS level, property, lead_band, n, coverage FROM (
  SELECT property, lead_band, COUNT(*) AS n, round(AVG(CAST(actual BETWEEN p10 AND p90 AS DOUBLE)), 6) AS coverage, GROUPING(property, lead_band) AS g FROM (SELECT *, {band('lead_days')} AS lead_band FROM bands WHERE p10 IS NOT NULL) GROUP BY GROUPING SETS ((), (property), (lead_band), (property, lead_band)))"""
)
def coverage_cells(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.coverage(banded(spark, d)))


@query(
    _BANDS
    + """, k AS (SELECT property, CAST(s AS INTEGER) AS step, COUNT(*) AS n, AVG(CAST(round((final - actual) / nullif(final - p10, 0) * 100, 6) <= s OR round((actual - final) / nullif(p90 - final, 0) * 100, 6) <= s AND actual > final OR actual = final AS DOUBLE)) AS x,
  SUM(CASE WHEN actual = final THEN 1 WHEN actual > final AND round((actual - final) / nullif(p90 - final, 0) * 100, 6) <= s THEN 1 WHEN actual < final AND round((final - actual) / nullif(final - p10, 0) * 100, 6) <= s THEN 1 ELSE 0 END) / COUNT(*) AS cov
  FROM bands, generate_series(60, 150) t(s) WHERE p10 IS NOT NULL GROUP BY ALL),
f AS (SELECT property, n, MAX(cov) FILTER (WHERE step = 100) AS now, MIN(step) FILTER (WHERE cov >= 0.8) AS reach, COALESCE(MAX(step) FILTER (WHERE cov < 0.8 AND step <= 100) + 1, 60) AS shrink FROM k GROUP BY ALL HAVING n >= 60)
SELECT property, n, round(1 + (CASE WHEN now < 0.8 THEN reach ELSE shrink END / 100.0 - 1) * n / (n + 30.0), 6) AS k FROM f WHERE CASE WHEN now < 0.8 THEN reach ELSE shrink END IS NOT NULL"""
)
def band_factors(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.band_factors(banded(spark, d)))


@query(
    """WITH r AS (SELECT p_brand AS cell, p_retailprice AS v, CAST(p_size AS DOUBLE) AS w FROM part),
m AS (SELECT cell, v, SUM(w) OVER (PARTITION BY cell ORDER BY v, w ROWS UNBOUNDED PRECEDING) - w / 2 AS m FROM r),
p AS (SELECT cell, v, COALESCE((m - MIN(m) OVER c) / nullif(MAX(m) OVER c - MIN(m) OVER c, 0), 0) AS p FROM m WINDOW c AS (PARTITION BY cell)),
b AS (SELECT cell, MAX(p) FILTER (WHERE p <= 0.9) AS pa, arg_max(v, (p, v)) FILTER (WHERE p <= 0.9) AS va, MIN(p) FILTER (WHERE p >= 0.9) AS pb, arg_min(v, (p, v)) FILTER (WHERE p >= 0.9) AS vb FROM p GROUP BY 1)
SELECT cell, round(CASE WHEN va IS NULL THEN vb WHEN vb IS NULL THEN va ELSE va + (vb - va) * COALESCE((0.9 - pa) / nullif(pb - pa, 0), 0) END, 6) AS quantile FROM b"""
)
def weighted_quantile(spark: SparkSession, d: str) -> DataFrame:
    rows = canon.table(spark, d, "part").select(F.col("p_brand").alias("cell"), F.col("p_retailprice").alias("v"), F.col("p_size").cast("double").alias("w"))
    return rounded(publish.weighted_quantiles(rows, ["cell"], "v", "w", 0.9))


# Evaluation.

_GRADED = with_(DEMAND, CAPACITY, PICKUP, SINGLE, PUBLISHED)
_M = metrics("actual", "final")


def shown(df: DataFrame, *keys: str) -> DataFrame:
    return rounded(df.select(*keys, *NAMES))


@query(_GRADED + f"SELECT {_M} FROM graded")
def metrics_global(spark: SparkSession, d: str) -> DataFrame:
    return shown(evaluate.by(graded(spark, d).withColumn("all", lit(1)), "all"))


@query(_GRADED + f"SELECT {band('lead_days')} AS lead_band, {_M} FROM graded GROUP BY 1")
def metrics_lead_band(spark: SparkSession, d: str) -> DataFrame:
    return shown(evaluate.by_lead_band(graded(spark, d)), "lead_band")


@query(_GRADED + f"SELECT property, {_M}, round(AVG(actual), 6) AS mean_actual, round(quantile_cont(actual, 0.1), 6) AS p10_actual, CAST(row_number() OVER (ORDER BY SUM(abs(error)) / nullif(SUM(abs(actual)), 0), property) AS INTEGER) AS rank FROM graded GROUP BY 1")
def metrics_property(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.by_property(graded(spark, d)).select("property", *NAMES, "mean_actual", "p10_actual", "rank"))


@query(_GRADED + f", w AS (SELECT property, date_trunc('week', stay_date) AS week, SUM(actual) AS actual, SUM(final) AS final FROM graded GROUP BY ALL) SELECT property, {_M} FROM w GROUP BY 1")
def metrics_weekly(spark: SparkSession, d: str) -> DataFrame:
    return shown(evaluate.weekly(graded(spark, d), "property"), "property")


@query(
    _GRADED
    + f""", s AS (SELECT *, CAST(month(stay_date) AS VARCHAR) AS m, CAST(isodow(stay_date) - 1 AS VARCHAR) AS w, CASE WHEN isodow(stay_date) >= 6 THEN 'weekend' ELSE 'weekday' END AS t, {season('stay_date')} AS n FROM graded)
SELECT dimension, value, {_M} FROM (SELECT 'month' AS dimension, m AS value, actual, final FROM s UNION ALL SELECT 'dow', w, actual, final FROM s UNION ALL SELECT 'day_type', t, actual, final FROM s UNION ALL SELECT 'season', n, actual, final FROM s) GROUP BY 1, 2"""
)
def metrics_season(spark: SparkSession, d: str) -> DataFrame:
    return shown(evaluate.seasonality(graded(spark, d)), "dimension", "value")


@query(_GRADED + ", m AS (SELECT property, SUM(abs(error)) / nullif(SUM(abs(actual)), 0) AS wmape, SUM(error) / nullif(SUM(abs(actual)), 0) AS bias FROM graded GROUP BY 1) SELECT arg_min(property, wmape) AS best, arg_max(property, wmape) AS worst, round(stddev_samp(wmape), 6) AS wmape_std, round(arg_max(bias, wmape), 6) AS worst_bias FROM m")
def property_ranking(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.ranking(evaluate.by(graded(spark, d), "property")))


@query(_GRADED + """, m AS (SELECT CAST(isodow(stay_date) - 1 AS VARCHAR) AS "group", COUNT(*) AS n_obs, SUM(error) / nullif(SUM(abs(actual)), 0) AS bias FROM graded GROUP BY 1) SELECT "group", CASE WHEN bias < 0 THEN 'under' ELSE 'over' END AS direction, round(bias, 6) AS bias, n_obs FROM m WHERE n_obs >= 10 AND abs(bias) >= 0.05""")
def systematic_pattern(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.systematic(evaluate.by(graded(spark, d).withColumn("dow", F.weekday("stay_date")), "dow"), "dow"))


@query(
    with_(DEMAND, PICKUP, PREDS)
    + """, t AS (SELECT fold, stay_date, model, SUM(forecast) AS f, SUM(actual) AS a FROM preds GROUP BY ALL),
e AS (SELECT fold, stay_date, MAX(abs(f - a)) FILTER (WHERE model = 'seasonal_naive') - MAX(abs(f - a)) FILTER (WHERE model = 'pickup_curve') AS d FROM t GROUP BY ALL),
x AS (SELECT row_number() OVER (ORDER BY fold, stay_date) AS i, d - AVG(d) OVER () AS x, COUNT(*) OVER () AS n, AVG(d) OVER () AS mean FROM e WHERE d IS NOT NULL)
SELECT CAST(k AS INTEGER) AS lag, a.n, round(a.mean, 6) AS mean, round(COALESCE(SUM(a.x * b.x), 0) / MIN(a.n), 6) AS autocovariance FROM x a CROSS JOIN generate_series(0, 9) t(k) LEFT JOIN x b ON b.i = a.i - k GROUP BY k, a.n, a.mean"""
)
def dm_autocovariance(spark: SparkSession, d: str) -> DataFrame:
    panel = fold_predictions(spark, d).groupBy("fold", "stay_date", "model").agg(F.sum("forecast").alias("forecast"), F.sum("actual").alias("actual"))
    return rounded(evaluate.dm_moments(evaluate.loss_differences(panel, "seasonal_naive", "pickup_curve"), 10).select("lag", "n", "mean", "autocovariance"))


@query(
    _GRADED
    + """SELECT property, n > 0 AS evaluated, n AS n_obs, CASE WHEN property = 'EUROPE' THEN 'closed' WHEN n = 0 THEN 'no_actuals' END AS reason
FROM (SELECT k.property, CASE WHEN k.property = 'EUROPE' THEN 0 ELSE COUNT(g.actual) END AS n FROM (SELECT DISTINCT property FROM demand) k LEFT JOIN graded g ON g.property = k.property AND g.lead_days >= 60 AND g.property <> 'AFRICA' GROUP BY 1)"""
)
def evaluation_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Who takes part in the evaluation of far stays, and why others don't: one property is closed, one has no forecast there."""
    far = graded(spark, d).where("lead_days >= 60 and property <> 'AFRICA'")
    return evaluate.evaluated(canon.demand(spark, d), far, ("EUROPE",))


@query(
    with_(DEMAND)
    + """, c AS (SELECT * FROM (VALUES (DATE '2000-06-30'), (DATE '2000-12-31'), (DATE '2001-03-31')) t(cutoff)), h AS (SELECT property, cutoff, AVG(room_nights) AS f FROM demand, c WHERE stay_date <= cutoff AND stay_date > cutoff - 28 GROUP BY ALL)
SELECT property, cutoff, CAST(stay_date - cutoff AS INTEGER) AS lead_days, stay_date, round(f, 6) AS forecast, room_nights AS actual FROM h JOIN demand USING (property) WHERE stay_date - cutoff BETWEEN 1 AND 14"""
)
def multistep_at_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    demand = canon.demand(spark, d)

    def level(history: DataFrame, cutoff: str) -> DataFrame:
        recent = history.where(F.col("stay_date") > F.date_sub(lit(cutoff).cast("date"), 28)).groupBy("property").agg(F.avg("room_nights").alias("forecast"))
        return asof.request_grid(recent, cutoff, 14).drop("lead_days").join(recent, "property")

    return rounded(evaluate.at_cutoffs(demand, ["2000-06-30", "2000-12-31", "2001-03-31"], level).select("property", "cutoff", "lead_days", "stay_date", "forecast", "actual"), "forecast")


# Selection.


@query(with_(DEMAND, PICKUP, PREDS) + "SELECT property, fold, model, stay_date, lead_days, round(forecast, 6) AS forecast, actual FROM preds")
def fold_forecasts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fold_predictions(spark, d), "forecast").select("property", "fold", "model", "stay_date", "lead_days", "forecast", "actual")


@query(with_(DEMAND, PICKUP, PREDS, FOLD_METRICS) + "SELECT model, fold, property, n_obs, round(wmape, 6) AS wmape, round(bias, 6) AS bias, round(wmape_short, 6) AS wmape_short, round(wmape_long, 6) AS wmape_long FROM fm")
def fold_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(selection.fold_metrics(fold_predictions(spark, d)).select("model", "fold", "property", "n_obs", "wmape", "bias", "wmape_short", "wmape_long"))


@query(
    with_(DEMAND, PICKUP, PREDS)
    + f""", s AS (SELECT model, fold, stay_date, SUM(forecast) AS forecast, SUM(actual) AS actual, COUNT(DISTINCT property) AS n FROM preds GROUP BY ALL), c AS (SELECT * FROM s QUALIFY n = MAX(n) OVER (PARTITION BY model, fold)) SELECT model, fold, 'PORTFOLIO' AS property, {metrics()} FROM c GROUP BY 1, 2"""
)
def fold_portfolio(spark: SparkSession, d: str) -> DataFrame:
    return shown(selection.portfolio_rows(fold_predictions(spark, d)), "model", "fold", "property")


@query(with_(DEMAND, PICKUP, PREDS, FOLD_METRICS, scored()) + "SELECT model, round(wmape, 6) AS wmape, round(bias, 6) AS bias, round(stability, 6) AS stability, folds, round(composite, 6) AS composite, CAST(row_number() OVER (ORDER BY composite) AS INTEGER) AS rank FROM sc")
def champion_score(spark: SparkSession, d: str) -> DataFrame:
    return rounded(selection.ranked(selection.scores(selection.fold_metrics(fold_predictions(spark, d)))).select("model", "wmape", "bias", "stability", "folds", "composite", "rank"))


@query(
    with_(DEMAND, PICKUP, PREDS, FOLD_METRICS, scored("property"))
    + """, b AS (SELECT property, COUNT(*) AS models, arg_min(model, composite) AS winner, MIN(composite) AS best, MAX(composite) FILTER (WHERE model = 'pickup_curve') AS og, MAX(composite) FILTER (WHERE model = 'seasonal_naive') AS oi FROM sc WHERE folds >= 3 GROUP BY 1),
k AS (SELECT *, winner <> 'seasonal_naive' AND best >= 0.95 * oi AS keeps FROM b), c AS (SELECT *, CASE WHEN models < 2 THEN 'pickup_curve' WHEN keeps THEN 'seasonal_naive' ELSE winner END AS chosen, COALESCE(CASE WHEN keeps THEN oi ELSE best END < 0.95 * og, TRUE) AS clear FROM k)
SELECT property, CASE WHEN clear THEN chosen ELSE 'pickup_curve' END AS model, CASE WHEN models < 2 THEN 'too few folds' WHEN chosen = 'pickup_curve' THEN 'global champion' WHEN NOT clear THEN 'within the margin' WHEN keeps THEN 'incumbent' ELSE 'own champion' END AS reason FROM c"""
)
def property_selection(spark: SparkSession, d: str) -> DataFrame:
    metrics_ = selection.fold_metrics(fold_predictions(spark, d))
    incumbents = metrics_.select("property").distinct().withColumn("incumbent", lit("seasonal_naive"))
    return selection.by_property(metrics_, "pickup_curve", incumbents)


@query(
    with_(DEMAND, PICKUP, PREDS, FOLD_METRICS, scored())
    + """SELECT m.model, CAST(parsimony AS INTEGER) AS parsimony, round(wmape, 6) AS wmape, round(stability_range, 6) AS stability_range, m.model = 'seasonal_naive' AS is_champion,
  CASE WHEN mape IS NULL THEN 'no data' WHEN mape < 10 THEN 'excellent' WHEN mape < 20 THEN 'acceptable' WHEN mape < 25 THEN 'reasonable if seasonal' ELSE 'outside the references' END AS accuracy_band
FROM (VALUES ('seasonal_naive', 0), ('pickup_curve', 1), ('ets', 2), ('sarimax', 3), ('lightgbm', 4), ('xgboost', 5), ('catboost', 6)) m(model, parsimony) LEFT JOIN sc USING (model)"""
)
def benchmark_relational(spark: SparkSession, d: str) -> DataFrame:
    """The table with the two relational candidates run and the others not."""
    scored_ = selection.scores(selection.fold_metrics(fold_predictions(spark, d)))
    return rounded(selection.benchmark_table(scored_, "seasonal_naive").select("model", "parsimony", "wmape", "stability_range", "is_champion", "accuracy_band"))


@query(
    with_(DEMAND, PICKUP, PREDS, FOLD_METRICS)
    + """, q AS (SELECT property, quantile_cont(forecast, 0.25) FILTER (WHERE lead_days <= 30) AS near, quantile_cont(forecast, 0.25) FILTER (WHERE lead_days > 30) AS far FROM preds WHERE model = 'pickup_curve' GROUP BY 1),
l AS (SELECT property, model, AVG(wmape_long) AS wl FROM fm GROUP BY ALL), b AS (SELECT property, arg_min(model, wl) AS other, MIN(wl) AS least, MAX(wl) FILTER (WHERE model = 'pickup_curve') AS own FROM l WHERE wl IS NOT NULL GROUP BY 1)
SELECT property, COALESCE(far < 0.85 * near, FALSE) AS collapsed, CASE WHEN far < 0.85 * near AND other <> 'pickup_curve' AND least < 0.95 * own THEN other END AS replacement FROM q LEFT JOIN b USING (property)"""
)
def long_lead_replacement(spark: SparkSession, d: str) -> DataFrame:
    p = fold_predictions(spark, d)
    return selection.long_replacement(p, selection.fold_metrics(p), "pickup_curve")


# Backtest.

_STAYS = """days AS (SELECT stay_date, row_number() OVER (ORDER BY stay_date DESC) AS i FROM (SELECT DISTINCT stay_date FROM demand)), stays AS (SELECT stay_date FROM days WHERE i <= 56 AND (56 - i) % 7 = 0 ORDER BY stay_date DESC LIMIT 8),
asked AS (SELECT stay_date AS target, lead_days, CAST(stay_date - lead_days AS DATE) AS cutoff FROM stays, (VALUES (90), (60), (30), (14), (7), (3), (1)) t(lead_days)),
rk AS (SELECT property, target, lead_days, room_nights, row_number() OVER (PARTITION BY property, target, lead_days ORDER BY stay_date DESC) AS n FROM demand JOIN asked ON stay_date <= cutoff AND isodow(stay_date) = isodow(target) AND stay_date > cutoff - 364),
rev AS (SELECT property, target AS stay_date, lead_days, AVG(room_nights) AS forecast FROM rk WHERE n <= 4 GROUP BY ALL), act AS (SELECT property, stay_date, room_nights AS actual FROM demand JOIN stays USING (stay_date)),
revs AS (SELECT rev.*, actual FROM rev LEFT JOIN act USING (property, stay_date) UNION ALL SELECT property, stay_date, 0, actual, actual FROM act)"""


@query(with_(DEMAND, _STAYS) + "SELECT property, stay_date, lead_days, round(forecast, 6) AS forecast, actual FROM revs")
def backtest_revisions(spark: SparkSession, d: str) -> DataFrame:
    demand = canon.demand(spark, d)
    return rounded(backtest.revisions(demand, backtest.sampled_stays(demand)), "forecast").select("property", "stay_date", "lead_days", "forecast", "actual")


@query(with_(DEMAND, _STAYS) + "SELECT property, stay_date, " + ", ".join(f"round(MAX(forecast) FILTER (WHERE lead_days = {k}), 6) AS t_{k}" for k in backtest.LEADS) + ", MAX(actual) AS actual FROM revs GROUP BY 1, 2")
def revision_matrix(spark: SparkSession, d: str) -> DataFrame:
    demand = canon.demand(spark, d)
    return rounded(backtest.revision_matrix(backtest.revisions(demand, backtest.sampled_stays(demand))))


@query(
    with_(DEMAND, _STAYS)
    + f"""SELECT CASE GROUPING(property, lead_band) WHEN 3 THEN 'all' WHEN 2 THEN 'band' WHEN 1 THEN 'property' ELSE 'cell' END AS level, property, lead_band, {metrics()} FROM (SELECT *, {band('lead_days')} AS lead_band FROM revs WHERE lead_days > 0 AND actual IS NOT NULL) GROUP BY GROUPING SETS ((), (property), (lead_band), (property, lead_band))"""
)
def backtest_levels(spark: SparkSession, d: str) -> DataFrame:
    demand = canon.demand(spark, d)
    return shown(backtest.by_level(backtest.revisions(demand, backtest.sampled_stays(demand))), "level", "property", "lead_band")


@query(with_(DEMAND, _STAYS) + f"SELECT lead_days, {metrics()} FROM revs WHERE lead_days > 0 AND actual IS NOT NULL GROUP BY 1")
def backtest_by_lead(spark: SparkSession, d: str) -> DataFrame:
    demand = canon.demand(spark, d)
    return shown(backtest.by_lead(backtest.revisions(demand, backtest.sampled_stays(demand))), "lead_days")


# Calibration.


@query(
    with_(DEMAND, PICKUP, PREDS)
    + f""", b AS (SELECT property, {band('lead_days')} AS lead_band, {season('stay_date')} AS season, fold, power(0.7, 3 - fold) AS w, forecast - actual AS e, abs(actual) AS a FROM preds WHERE model = 'seasonal_naive'),
s AS (SELECT property, lead_band, season, fold, COUNT(*) AS n, SUM(w * e) AS we, SUM(w * a) AS wa, MIN(w) AS w FROM b GROUP BY GROUPING SETS ((property, lead_band, fold), (property, lead_band, season, fold))),
t AS (SELECT property, lead_band, season, SUM(n) AS n, SUM(we) / nullif(SUM(wa), 0) AS rel, SUM(w) AS aw, SUM(CASE WHEN we > 0 THEN w ELSE 0 END) AS uw FROM s GROUP BY ALL),
c AS (SELECT *, CASE WHEN rel > 0 THEN uw ELSE aw - uw END / nullif(aw, 0) AS consistency FROM t),
f AS (SELECT *, 1 + (least(greatest(1 - rel, 0.7), 1.3) - 1) * n / (n + 30.0) AS raw FROM c),
o AS (SELECT *, CASE WHEN n >= 20 AND consistency >= 0.75 AND abs(raw - 1) >= 0.005 THEN raw ELSE 1 END AS own FROM f)
SELECT x.property, x.lead_band, x.season, CAST(x.n AS BIGINT) AS n, round(x.rel, 6) AS rel, round(x.consistency, 6) AS consistency, round(CASE WHEN x.season IS NULL OR x.own <> 1 THEN x.own ELSE y.own END, 6) AS factor FROM o x JOIN o y ON y.property = x.property AND y.lead_band = x.lead_band AND y.season IS NULL"""
)
def bias_cells(spark: SparkSession, d: str) -> DataFrame:
    return rounded(calibrate.bias_cells(calibrate.operative(fold_predictions(spark, d), "seasonal_naive"), decay=0.7))


@query(
    _GRADED
    + """, g AS (SELECT property, COUNT(*) AS n, SUM(error) / nullif(SUM(abs(actual)), 0) AS rel, SUM(error) / nullif(AVG(abs(error)), 0) AS ts FROM graded WHERE (SELECT MAX(stay_date) FROM graded) - stay_date < 60 GROUP BY 1)
SELECT property, n, round(rel, 6) AS rel, round(ts, 6) AS tracking_signal, round(CASE WHEN n >= 10 AND ts IS NOT NULL THEN 1 + least(greatest(-rel, -0.2), 0.2) * least(abs(ts) / 4, 1) * n / (n + 10.0) ELSE 1 END, 6) AS factor FROM g"""
)
def level_factors(spark: SparkSession, d: str) -> DataFrame:
    return rounded(calibrate.level_factors(graded(spark, d)))


@query(
    with_(DEMAND, PICKUP, PREDS)
    + f""", w AS (SELECT property, fold, isodow(stay_date) AS dow, COUNT(*) AS n, AVG(room_nights) AS m FROM demand, folds WHERE stay_date <= cutoff AND cutoff - stay_date < 84 GROUP BY ALL),
p AS (SELECT property, fold, dow, m / AVG(m) OVER k AS factor FROM w WINDOW k AS (PARTITION BY property, fold) QUALIFY COUNT(*) OVER k = 7 AND MIN(n) OVER k >= 3 AND SUM(n) OVER k >= 21)
SELECT r.property, r.fold, stay_date, lead_days, round(forecast * COALESCE(factor, 1), 6) AS forecast FROM preds r LEFT JOIN p ON p.property = r.property AND p.fold = r.fold AND p.dow = isodow(stay_date) WHERE model = CASE WHEN lead_days > 30 THEN 'pickup_curve' ELSE 'seasonal_naive' END"""
)
def operative_folds(spark: SparkSession, d: str) -> DataFrame:
    rows = calibrate.operative(fold_predictions(spark, d), "seasonal_naive", "pickup_curve")
    folds = F.broadcast(spark.createDataFrame(selection.fold_cutoffs(CUTOFF), "fold int, cutoff string").withColumn("cutoff", F.to_date("cutoff")))  # four rows
    past = kept(spark, d, "demand").join(folds, F.col("stay_date") <= F.col("cutoff"))
    made = calibrate.with_profile(rows, models.profiles(past, ("fold",)))
    return rounded(made.select("property", "fold", "stay_date", "lead_days", "forecast"))


# Monitoring.


def detail(spark: SparkSession, d: str) -> DataFrame:
    rows = published(spark, d).withColumns({"p10_forecast": F.col("final_forecast_rn") * 0.8, "p90_forecast": F.col("final_forecast_rn") * 1.2})
    return monitor.vintage_detail(monitor.materialised(rows, canon.demand(spark, d), "2001-09-15"))


_DETAIL = f"det AS (SELECT *, {band('lead_days')} AS lead_band, actual BETWEEN final * 0.8 AND final * 1.2 AS in_band FROM graded WHERE stay_date <= DATE '2001-09-15')"


@query(_GRADED.rstrip() + ", " + _DETAIL + " SELECT property, stay_date, lead_days, lead_band, round(error, 6) AS error, round(error / nullif(actual, 0), 6) AS error_pct, in_band FROM det")
def vintage_detail(spark: SparkSession, d: str) -> DataFrame:
    return rounded(detail(spark, d).select("property", "stay_date", "lead_days", "lead_band", "error", "error_pct", "in_band"))


@query(
    _GRADED.rstrip() + ", " + _DETAIL
    + f""" SELECT CASE GROUPING(property, lead_band) WHEN 3 THEN 'global' WHEN 1 THEN 'property' ELSE 'band' END AS level, COALESCE(property, lead_band, 'all') AS name, {_M}, round(SUM(error) / nullif(AVG(abs(error)), 0), 6) AS tracking_signal, round(AVG(CAST(in_band AS DOUBLE)), 6) AS coverage FROM det GROUP BY GROUPING SETS ((), (property), (lead_band))"""
)
def vintage_score(spark: SparkSession, d: str) -> DataFrame:
    return rounded(monitor.vintage_score(detail(spark, d)).select("level", "name", *NAMES, "tracking_signal", "coverage"))


@query(_GRADED.rstrip() + ", " + _DETAIL + " SELECT property, COUNT(error) AS n, round(SUM(error) / nullif(AVG(abs(error)), 0), 6) AS tracking_signal FROM det GROUP BY 1")
def tracking_signal(spark: SparkSession, d: str) -> DataFrame:
    return rounded(monitor.tracking_signals(detail(spark, d)))


@query(
    """WITH r AS (SELECT o_orderkey AS seq, 'v' || (o_custkey % 50) AS vintage, o_orderdate AS timestamp, o_totalprice AS wmape FROM orders) SELECT vintage, seq, wmape FROM r WHERE timestamp <= TIMESTAMP '1999-12-31' QUALIFY row_number() OVER (PARTITION BY vintage ORDER BY timestamp DESC, seq) = 1"""
)
def track_record(spark: SparkSession, d: str) -> DataFrame:
    rows = canon.table(spark, d, "orders").select(F.col("o_orderkey").alias("seq"), F.concat(lit("v"), (F.col("o_custkey") % 50).cast("string")).alias("vintage"), F.col("o_orderdate").alias("timestamp"), F.col("o_totalprice").alias("wmape"))
    return monitor.track_record(rows, "1999-12-31").select("vintage", "seq", "wmape")


@query(
    """WITH r AS (SELECT o_orderkey AS seq, o_orderpriority AS champion, o_orderstatus AS mode FROM orders), a AS (SELECT seq, lag(champion) OVER (ORDER BY seq) AS p FROM r), b AS (SELECT seq, lag(champion) OVER (PARTITION BY mode ORDER BY seq) AS p FROM r)
SELECT seq, a.p AS any_mode, b.p AS own_mode FROM a JOIN b USING (seq)"""
)
def registry_memory(spark: SparkSession, d: str) -> DataFrame:
    rows = canon.table(spark, d, "orders").select(F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("champion"), F.col("o_orderstatus").alias("mode"))
    return monitor.memory_rule(rows, False).select("seq", F.col("previous").alias("any_mode")).join(monitor.memory_rule(rows, True).select("seq", F.col("previous").alias("own_mode")), "seq")


@query(_PUB + ", a AS (SELECT property, SUM(final) AS new_total, SUM(round(final * 0.97, 6)) AS old_total FROM pub WHERE day(stay_date) <> 7 GROUP BY 1) SELECT property, round(new_total, 6) AS new_total, round(old_total, 6) AS old_total, round(new_total - old_total, 6) AS delta, round(CASE WHEN old_total > 0 THEN (new_total - old_total) / old_total END, 6) AS delta_pct FROM a")
def forecast_revision(spark: SparkSession, d: str) -> DataFrame:
    now = published(spark, d)
    before = now.where(F.dayofmonth("stay_date") != 7).withColumn("final_forecast_rn", F.round(F.col("final_forecast_rn") * 0.97, 6))
    return rounded(monitor.revision(now, before))


@query(
    with_(DEMAND, PICKUP, PREDS)
    + """, m AS (SELECT model, 100 * AVG(abs(forecast - actual) / nullif(actual, 0)) AS mape, SUM(abs(forecast - actual)) / SUM(actual) AS wmape, SUM(forecast - actual) / SUM(actual) AS bias FROM preds GROUP BY 1),
v AS (SELECT x.metric, x.r AS reference, x.c AS current, CASE WHEN x.metric = 'bias' THEN abs(x.c) - abs(x.r) ELSE (x.c - x.r) / abs(x.r) END AS change FROM m r, m c, LATERAL (VALUES ('mape', r.mape, c.mape), ('wmape', r.wmape, c.wmape), ('bias', r.bias, c.bias)) x(metric, r, c) WHERE r.model = 'pickup_curve' AND c.model = 'seasonal_naive')
SELECT metric, round(reference, 6) AS reference, round(current, 6) AS current, round(change, 6) AS change, CASE WHEN change >= CASE WHEN metric = 'bias' THEN 0.10 ELSE 0.25 END THEN 'alert' WHEN change >= CASE WHEN metric = 'bias' THEN 0.05 ELSE 0.10 END THEN 'warning' ELSE 'info' END AS severity FROM v"""
)
def metric_drift(spark: SparkSession, d: str) -> DataFrame:
    p = evaluate.by(fold_predictions(spark, d), "model")
    return rounded(monitor.metric_drift(p.where("model = 'pickup_curve'"), p.where("model = 'seasonal_naive'")))


@query(with_(DEMAND) + f""", r AS (SELECT AVG(room_nights) AS m, stddev_samp(room_nights) AS s FROM demand WHERE stay_date <= DATE '{CUTOFF}'), c AS (SELECT AVG(room_nights) AS m FROM demand WHERE stay_date > DATE '{CUTOFF}')
SELECT 'room_nights' AS feature, round(abs((c.m - r.m) / nullif(r.s, 0)), 6) AS shift, CASE WHEN abs((c.m - r.m) / r.s) >= 0.25 THEN 'alert' WHEN abs((c.m - r.m) / r.s) >= 0.1 THEN 'warning' ELSE 'info' END AS severity FROM r, c""")
def mean_shift(spark: SparkSession, d: str) -> DataFrame:
    demand = canon.demand(spark, d)
    return rounded(monitor.mean_shift(asof.as_of(demand, CUTOFF), demand.where(F.col("stay_date") > lit(CUTOFF).cast("date")), "room_nights"))


@query(
    with_(DEMAND)
    + f""", r AS (SELECT property, room_nights AS v FROM demand WHERE stay_date > DATE '{CUTOFF}' - 455 AND stay_date <= DATE '{CUTOFF}' - 365), c AS (SELECT property, room_nights AS v FROM demand WHERE stay_date > DATE '{CUTOFF}' - 90 AND stay_date <= DATE '{CUTOFF}'),
e AS (SELECT property, list_distinct(quantile_cont(v, [0, 0.2, 0.4, 0.6, 0.8, 1])) AS l, COUNT(*) AS n FROM r GROUP BY 1), i AS (SELECT property, n, list_slice(list_sort(l), 2, len(l) - 1) AS inner_edges FROM e WHERE len(l) >= 3),
b AS (SELECT property, CAST(k AS INTEGER) AS bin, n, inner_edges FROM i, LATERAL (SELECT unnest(generate_series(0, len(inner_edges))) AS k)),
x AS (SELECT b.property, b.bin, b.n, (SELECT COUNT(*) FROM c WHERE c.property = b.property) AS m, (SELECT COUNT(*) FROM r WHERE r.property = b.property AND len(list_filter(b.inner_edges, lambda z: z < r.v)) = b.bin) AS rc, (SELECT COUNT(*) FROM c WHERE c.property = b.property AND len(list_filter(b.inner_edges, lambda z: z < c.v)) = b.bin) AS cc FROM b),
p AS (SELECT property, n AS n_reference, m AS n_current, SUM((greatest(cc, 0.5) / m - greatest(rc, 0.5) / n) * ln((greatest(cc, 0.5) / m) / (greatest(rc, 0.5) / n))) AS psi FROM x GROUP BY ALL)
SELECT property, n_reference, n_current, round(psi, 6) AS psi, CASE WHEN psi >= 0.5 THEN 'alert' WHEN psi >= 0.3 THEN 'warning' ELSE 'info' END AS severity FROM p WHERE n_current >= 14"""
)
def psi_year_on_year(spark: SparkSession, d: str) -> DataFrame:
    return rounded(monitor.demand_drift(canon.demand(spark, d), CUTOFF))


@query(
    with_(PICKUP)
    + """, r AS (SELECT lead_days, AVG(pickup_rn) AS r FROM pickup WHERE year(stay_date) = 1999 GROUP BY 1), c AS (SELECT lead_days, AVG(pickup_rn) AS c FROM pickup WHERE year(stay_date) = 2000 GROUP BY 1), g AS (SELECT COUNT(*) AS leads, AVG(abs((c - r) / nullif(r, 0))) AS shift FROM r JOIN c USING (lead_days))
SELECT leads, round(shift, 6) AS shift, CASE WHEN shift >= 0.35 THEN 'alert' WHEN shift >= 0.15 THEN 'warning' ELSE 'info' END AS severity FROM g"""
)
def pickup_curve_drift(spark: SparkSession, d: str) -> DataFrame:
    pickup = canon.pickup(spark, d)
    return rounded(monitor.curve_drift(pickup.where(F.year("stay_date") == 1999), pickup.where(F.year("stay_date") == 2000)))


@query(
    with_(DEMAND, CAPACITY)
    + """, z AS (SELECT property, stay_date, room_nights, capacity, quantile_cont(room_nights, 0.5) OVER a AS m, stddev_samp(room_nights) OVER a AS s, COUNT(*) OVER a AS n, COUNT(*) OVER e AS total, stddev_samp(room_nights) OVER e AS gs, AVG(room_nights) OVER e AS gm, AVG(capacity) OVER e AS gc, AVG(room_nights) OVER x AS nx, COUNT(*) OVER x AS nn
  FROM demand JOIN capacity USING (property, stay_date) WINDOW a AS (PARTITION BY property ORDER BY stay_date RANGE BETWEEN INTERVAL 28 DAYS PRECEDING AND INTERVAL 28 DAYS FOLLOWING), e AS (PARTITION BY property), x AS (PARTITION BY property ORDER BY stay_date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING)),
y AS (SELECT *, (room_nights - m) / nullif(CASE WHEN s > 0 THEN s ELSE gs END, 0) AS zscore FROM z WHERE n >= greatest(3, least(14, total)))
SELECT property, stay_date, room_nights, round(zscore, 6) AS zscore, CASE WHEN room_nights > 1.05 * capacity THEN 'data_error' WHEN capacity < 0.7 * gc THEN 'structural' WHEN isodow(stay_date) >= 6 AND zscore > 0 THEN 'seasonality' WHEN month(stay_date) IN (12, 1, 2) AND zscore > 0 THEN 'seasonality'
  WHEN nn >= 3 AND zscore > 0 AND nx > 1.15 * gm THEN 'structural' ELSE 'event' END AS category FROM y WHERE abs(zscore) >= 2.5"""
)
def outliers_local(spark: SparkSession, d: str) -> DataFrame:
    return rounded(monitor.outliers(canon.demand(spark, d), canon.capacity(spark, d), threshold=2.5), "zscore")


@query(with_(DEMAND) + f"SELECT property, CAST(DATE '1996-01-01' - MIN(stay_date) + 1 AS INTEGER) AS history_days FROM demand WHERE stay_date <= DATE '1996-01-01' GROUP BY 1 HAVING DATE '1996-01-01' - MIN(stay_date) + 1 < 365")
def cold_start(spark: SparkSession, d: str) -> DataFrame:
    return publish.cold_start(canon.demand(spark, d), "1996-01-01")
