"""Queries of whole runs: sources as read, corrections in order, the published table, reports by property, drift."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import lit

from ..functions.metrics import NAMES
from ..functions.scalars import r6
from ..operators import asof, calibrate, candidates, evaluate, features, holidays, leakage, monitor, publish, quality, report
from ..sources import canon, files
from .facts import CUTOFF, HORIZON, NAMED
from .forecasts import _BANDS, _GRADED, _M, _PUB, PREDS, banded, fold_predictions, graded, kept, published, rounded
from .registry import query
from .sql import DEMAND, PICKUP, band, with_

# Sources as read.

_RAW = """WITH raw AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderpriority END AS property,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 50 = 3 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d, CAST(o_orderdate AS DATE) AS day,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 40 = 7 THEN 'x' ELSE CAST(o_orderkey % 60 - 2 AS VARCHAR) END AS lead, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey % 30 - 1 AS DOUBLE) END AS rn FROM orders)"""


def _raw(spark: SparkSession, d: str) -> DataFrame:
    """A source of bookings as a file might hold it: empty rows, unreadable dates and leads."""
    k = F.col("o_orderkey")
    full = k % 97 != 0
    return canon.table(spark, d, "orders").select(
        F.when(full, F.col("o_orderpriority")).alias("hotel"), F.when(full, F.when(k % 50 == 3, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("stay"),
        F.when(full, F.when(k % 40 == 7, "x").otherwise((k % 60 - 2).cast("string"))).alias("lead"), F.when(full, (F.col("o_custkey") % 30 - 1).cast("double")).alias("otb"),
    )


@query(
    _RAW
    + """, f AS (SELECT *, k % 97 <> 0 AS full_row, CASE WHEN d = 'soon' THEN NULL ELSE day END AS read, TRY_CAST(lead AS DOUBLE) AS l FROM raw)
SELECT "check", severity, COUNT(*) AS records FROM (
  SELECT 'empty_rows' AS "check", 'warning' AS severity FROM f WHERE NOT full_row
  UNION ALL SELECT 'negative_rn', 'error' FROM f WHERE full_row AND rn < 0 UNION ALL SELECT 'missing_dates', 'error' FROM f WHERE full_row AND read IS NULL
  UNION ALL SELECT 'invalid_lead', 'error' FROM f WHERE full_row AND l IS NULL UNION ALL SELECT 'negative_lead', 'error' FROM f WHERE full_row AND l < 0
  UNION ALL SELECT 'duplicate_snapshots', 'error' FROM (SELECT COUNT(*) OVER (PARTITION BY property, read, lead) AS n FROM f WHERE full_row) WHERE n > 1) GROUP BY 1, 2"""
)
def issues_as_read(spark: SparkSession, d: str) -> DataFrame:
    rows = _raw(spark, d)
    return files.detect_schema(rows, "pickup").issues(rows).select("check", "severity", "records")


@query(
    """WITH r AS (SELECT c_mktsegment AS property, c_acctbal AS capacity FROM customer)
SELECT 'negative_capacity' AS "check", 'error' AS severity, COUNT(*) AS records, array_to_string(list_sort(list_distinct(list(property))), ',') AS properties FROM r WHERE capacity < 0 HAVING COUNT(*) > 0"""
)
def dq_negative_capacity(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_add(lit(date(2000, 1, 1)), F.col("c_custkey").cast("int"))
    rows = canon.table(spark, d, "customer").select(F.col("c_mktsegment").alias("property"), day.alias("stay_date"), F.col("c_acctbal").alias("capacity"))
    return quality.capacity_issues(rows).where("check = 'negative_capacity'").select("check", "severity", "records", F.array_join("properties", ",").alias("properties"))


@query("""SELECT 'empty_source' AS "check", 'error' AS severity, CAST(0 AS BIGINT) AS records WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0)""")
def dq_empty_source(spark: SparkSession, d: str) -> DataFrame:
    rows = canon.table(spark, d, "orders").where("o_totalprice < 0").select(F.col("o_orderpriority").alias("property"), F.to_date("o_orderdate").alias("stay_date"), F.col("o_totalprice").alias("room_nights"))
    return quality.demand_issues(rows).select("check", "severity", "records")


# Leakage.


@query(with_(DEMAND) + f"SELECT MAX(stay_date) FILTER (WHERE stay_date <= DATE '{CUTOFF}') AS train_end, MIN(stay_date) FILTER (WHERE stay_date > DATE '{CUTOFF}') AS val_start, MIN(stay_date) FILTER (WHERE stay_date > DATE '{CUTOFF}') > MAX(stay_date) FILTER (WHERE stay_date <= DATE '{CUTOFF}') AS ordered FROM demand")
def leak_temporal_order(spark: SparkSession, d: str) -> DataFrame:
    rows = canon.demand(spark, d)
    return leakage.temporal_order(asof.as_of(rows, CUTOFF), rows.where(F.col("stay_date") > lit(CUTOFF).cast("date")))


@query(
    with_(DEMAND)
    + f""", a AS (SELECT property, AVG(room_nights) AS whole, AVG(room_nights) FILTER (WHERE stay_date <= DATE '{CUTOFF}') AS honest FROM demand GROUP BY 1), x AS (SELECT whole, honest FROM demand JOIN a USING (property) WHERE stay_date <= DATE '{CUTOFF}')
SELECT COUNT(*) AS "rows", COUNT(*) AS like_full, COUNT(*) FILTER (WHERE abs(whole - honest) <= 1e-8 + 1e-5 * abs(honest)) AS like_honest, COUNT(*) FILTER (WHERE abs(whole - honest) <= 1e-8 + 1e-5 * abs(honest)) < COUNT(*) AS leaks FROM x"""
)
def leak_whole_data(spark: SparkSession, d: str) -> DataFrame:
    """A property's mean over all days, days after the cutoff included, stored as a feature: the check finds it."""
    rows = canon.demand(spark, d)

    def mean(history: DataFrame) -> DataFrame:
        return history.drop("level").join(history.groupBy("property").agg(F.avg("room_nights").alias("level")), "property")

    return leakage.whole_data_feature(mean(rows), CUTOFF, mean, "level", ["property", "stay_date"])


@query(with_(PICKUP) + "SELECT COUNT(*) FILTER (WHERE stay_date - CAST(day(stay_date) AS INTEGER) > snapshot_date) AS future_reads FROM pickup")
def leak_future_reads(spark: SparkSession, d: str) -> DataFrame:
    rows = canon.pickup(spark, d).select(F.col("snapshot_date").alias("cutoff"), F.date_sub("stay_date", F.dayofmonth("stay_date")).alias("last_history"))
    return rows.agg(leakage.no_future_reads(rows))


# Features of the boosted trees.

_BACK = "(SELECT {} FROM demand d WHERE d.property = p.property AND d.stay_date BETWEEN p.snap - {} AND p.snap - {})"


@query(
    with_(DEMAND, PICKUP, NAMED)
    + f""", p AS (SELECT property, stay_date, lead_days, booked, CAST(stay_date - lead_days AS DATE) AS snap FROM (SELECT p.property, p.stay_date, lead_days, max(pickup_rn) AS booked, dense_rank() OVER (PARTITION BY p.property ORDER BY p.stay_date DESC) AS n
  FROM pickup p JOIN demand USING (property, stay_date) WHERE p.stay_date <= DATE '{CUTOFF}' AND snapshot_date <= DATE '{CUTOFF}' AND lead_days BETWEEN 1 AND {HORIZON} GROUP BY 1, 2, 3) WHERE n <= 365),
h AS (SELECT stay_date, CAST(MIN(abs(d - stay_date)) AS INTEGER) AS days FROM (SELECT DISTINCT stay_date FROM p), (SELECT DISTINCT d FROM keyed) GROUP BY 1)
SELECT property, p.stay_date, lead_days, {", ".join(f"{_BACK.format('MAX(room_nights)', k - 1, k - 1)} AS lag_{k}" for k in (1, 7, 14, 28))}, {", ".join(f"round({_BACK.format('AVG(room_nights)', k - 1, 0)}, 6) AS rolling_mean_{k}" for k in (7, 14, 28))},
  round({_BACK.format('stddev_samp(room_nights)', 27, 0)}, 6) AS rolling_std_28, CAST(isodow(p.stay_date) - 1 AS INTEGER) AS day_of_week, CAST(isodow(p.stay_date) >= 6 AS INTEGER) AS is_weekend, CAST(month(p.stay_date) AS INTEGER) AS month, CAST(quarter(p.stay_date) AS INTEGER) AS quarter,
  booked AS current_booked_rn, days AS days_to_nearest_holiday FROM p JOIN h USING (stay_date)"""
)
def tree_features(spark: SparkSession, d: str) -> DataFrame:
    demand, pickup = kept(spark, d, "demand"), kept(spark, d, "pickup")
    panel = features.panel(asof.remaining_pickup(pickup, demand, CUTOFF), HORIZON)
    made = candidates.tree_rows(panel, asof.as_of(demand, CUTOFF), holidays.holidays(spark, range(1995, 2002)))
    return rounded(made.select("property", "stay_date", *candidates.FEATURES), *[c for c in candidates.FEATURES if c.startswith("rolling")])


# Corrections in order: level, bias by band, limits, bands.


def _level(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("ASIA", 1.1), ("EUROPE", 0.9)], "property string, factor double")


_LEVEL = "CASE property WHEN 'ASIA' THEN 1.1 WHEN 'EUROPE' THEN 0.9 ELSE 1.0 END"


@query(_PUB + f"SELECT property, stay_date, {_LEVEL} AS level_correction_factor, round(raw * {_LEVEL}, 6) AS raw_forecast_rn FROM pub")
def level_applied(spark: SparkSession, d: str) -> DataFrame:
    return rounded(publish.apply_levels(published(spark, d), _level(spark)).select("property", "stay_date", "level_correction_factor", "raw_forecast_rn"))


@query(_PUB + f"""SELECT property, stay_date, CASE WHEN property = 'ASIA' AND month(stay_date) IN (6, 7, 8, 9) AND {band('lead_days')} = '7-13' THEN 1.2 WHEN {band('lead_days')} = '7-13' AND property = 'ASIA' THEN 1.1 WHEN {band('lead_days')} = '90+' AND property = 'AFRICA' THEN 0.8 ELSE 1.0 END AS bias_correction_factor FROM pub""")
def bias_applied(spark: SparkSession, d: str) -> DataFrame:
    cells = spark.createDataFrame([("ASIA", "7-13", "low", 1.2), ("ASIA", "7-13", None, 1.1), ("AFRICA", "90+", None, 0.8)], "property string, lead_band string, season string, factor double")
    return publish.apply_factors(published(spark, d), cells).select("property", "stay_date", "bias_correction_factor")


@query(
    _BANDS
    + """, k AS (SELECT *, CASE property WHEN 'ASIA' THEN least(greatest(1 + (1.4 - 1) * 200 / 230.0, 0.6), 1.5) WHEN 'EUROPE' THEN least(greatest(1 + (0.2 - 1) * 500 / 530.0, 0.6), 1.5) ELSE 1.0 END AS f FROM bands)
SELECT property, stay_date, round(f, 6) AS band_factor, round(least(greatest(final - (final - p10) * f, 0), capacity), 6) AS p10, round(least(greatest(final + (p90 - final) * f, 0), capacity), 6) AS p90 FROM k"""
)
def bands_calibrated(spark: SparkSession, d: str) -> DataFrame:
    factors = spark.createDataFrame([("ASIA", 1.4, 200), ("EUROPE", 0.2, 500), ("AFRICA", 3.0, 20)], "property string, k double, n int")
    return rounded(publish.calibrate_bands(banded(spark, d), factors).select("property", "stay_date", "band_factor", "p10", "p90"))


@query(_BANDS + "SELECT COUNT(*) FILTER (WHERE p10 > final OR final > p90) AS breaks FROM bands")
def percentile_order(spark: SparkSession, d: str) -> DataFrame:
    rows = banded(spark, d)
    return rows.agg(publish.percentile_order_breaks(rows))


def _table(spark: SparkSession, d: str) -> DataFrame:
    rows = banded(spark, d)
    named = rows.withColumnsRenamed({"p10": "p10_forecast", "p50": "p50_forecast", "p90": "p90_forecast"}).withColumns({"model_name": lit("seasonal_naive"), "model_version": lit("1")})
    return publish.forecast_table(publish.occupancy(named))


@query(
    _BANDS
    + f"""SELECT property, stay_date, DATE '{CUTOFF}' AS forecast_date, lead_days, booked AS current_booked_rn, round(final, 6) AS final_forecast_rn, round(p10, 6) AS p10_forecast, round(p90, 6) AS p90_forecast, 'seasonal_naive' AS model_name, round(final / nullif(capacity, 0), 6) AS forecast_occupancy, 'forecast_run_timestamp' AS missing_required FROM bands"""
)
def forecast_table(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_table(spark, d).select("property", "stay_date", "forecast_date", "lead_days", "current_booked_rn", "final_forecast_rn", "p10_forecast", "p90_forecast", "model_name", "forecast_occupancy", "missing_required"), "final_forecast_rn", "p10_forecast", "p90_forecast", "forecast_occupancy")


@query(
    _BANDS
    + """SELECT '' AS missing_columns, COUNT(*) FILTER (WHERE booked IS NULL OR capacity IS NULL OR p10 IS NULL OR p90 IS NULL) AS null_rows,
  COUNT(*) FILTER (WHERE day(stay_date) = 9 AND abs(final + 1 - least(CASE WHEN booked > raw THEN booked ELSE raw END, capacity)) > 1e-6) AS broken_rows FROM bands"""
)
def forecast_table_check(spark: SparkSession, d: str) -> DataFrame:
    """The check of a table whose forecasts of each ninth of a month are one too high."""
    rows = _table(spark, d).withColumn("final_forecast_rn", F.col("final_forecast_rn") + F.when(F.dayofmonth("stay_date") == 9, 1.0).otherwise(0.0))
    return quality.forecast_table_check(rows, [c for c in publish.REQUIRED if c != "forecast_run_timestamp"])


# Evaluation.


@query(
    with_(DEMAND)
    + """, w AS (SELECT CAST(k AS INTEGER) AS k, CAST(DATE '2000-01-01' + CAST(k AS INTEGER) * 30 AS DATE) AS train_start, CAST(DATE '2000-01-01' + 180 + CAST(k AS INTEGER) * 30 AS DATE) AS train_end, CAST(DATE '2000-01-01' + 240 + CAST(k AS INTEGER) * 30 AS DATE) AS val_end FROM generate_series(0, 20) t(k) WHERE DATE '2000-01-01' + 240 + CAST(k AS INTEGER) * 30 <= DATE '2001-01-01')
SELECT k, COUNT(*) FILTER (WHERE stay_date >= train_start AND stay_date < train_end) AS train_rows, COUNT(*) FILTER (WHERE stay_date >= train_end AND stay_date < val_end) AS val_rows FROM w, demand GROUP BY 1"""
)
def temporal_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = kept(spark, d, "demand")
    spans = evaluate.temporal_windows(date(2000, 1, 1), date(2000, 12, 31), 180, 60, step=30, expanding=False)
    flags = [F.struct(lit(k).alias("k"), *[((F.col("stay_date") >= lit(w[a])) & (F.col("stay_date") < lit(w[b]))).cast("long").alias(n) for a, b, n in (("train_start", "train_end", "t"), ("train_end", "val_end", "v"))]) for k, w in enumerate(spans)]
    return rows.select(F.explode(F.array(*flags)).alias("x")).groupBy(F.col("x.k").alias("k")).agg(F.sum("x.t").alias("train_rows"), F.sum("x.v").alias("val_rows"))


@query(_GRADED + f"SELECT property, {_M} FROM graded WHERE property NOT IN ('ASIA') GROUP BY 1")
def metrics_without_cold_start(spark: SparkSession, d: str) -> DataFrame:
    new = kept(spark, d, "demand").where("property = 'ASIA'").select("property")
    return rounded(evaluate.by(evaluate.without(graded(spark, d), new), "property").select("property", *NAMES))


@query(
    with_(DEMAND, PICKUP, PREDS)
    + """, t AS (SELECT fold, stay_date, model, SUM(forecast) AS f, SUM(actual) AS a FROM preds GROUP BY ALL),
e AS (SELECT fold, stay_date, MAX(abs(f - a)) FILTER (WHERE model = 'seasonal_naive') - MAX(abs(f - a)) FILTER (WHERE model = 'pickup_curve') AS d FROM t GROUP BY ALL),
x AS (SELECT row_number() OVER (ORDER BY fold, stay_date) AS i, d - AVG(d) OVER () AS x, COUNT(*) OVER () AS n, AVG(d) OVER () AS mean FROM e WHERE d IS NOT NULL),
c AS (SELECT k, a.n, a.mean, COALESCE(SUM(a.x * b.x), 0) / MIN(a.n) AS g FROM x a CROSS JOIN generate_series(0, 9) t(k) LEFT JOIN x b ON b.i = a.i - k GROUP BY k, a.n, a.mean),
v AS (SELECT n, mean, SUM(CASE WHEN k = 0 THEN g ELSE 2 * (1 - k / 10.0) * g END) AS v FROM c GROUP BY 1, 2)
SELECT n, round(CASE WHEN v > 0 THEN mean / sqrt(v / n) * sqrt(greatest(0, (n + 1 - 20 + 90.0 / n) / n)) END, 6) AS statistic FROM v"""
)
def dm_statistic(spark: SparkSession, d: str) -> DataFrame:
    panel = fold_predictions(spark, d).groupBy("fold", "stay_date", "model").agg(F.sum("forecast").alias("forecast"), F.sum("actual").alias("actual"))
    made = evaluate.diebold_mariano(panel, "seasonal_naive", "pickup_curve", 10)
    return rounded(spark.createDataFrame([(made["n"], made["statistic"])], "n long, statistic double"))


# Reports.


@query(_GRADED + "SELECT property, round(100 * AVG(abs(error) / nullif(actual, 0)), 6) AS mape, round(SUM(abs(error)) / nullif(SUM(abs(actual)), 0), 6) AS wmape, round(SUM(error) / nullif(SUM(abs(actual)), 0), 6) AS bias FROM graded GROUP BY 1")
def bi_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return rounded(report.area(evaluate.by(graded(spark, d), "property"), "accuracy"))


@query(_PUB + "SELECT property, strftime(stay_date, '%Y-%m-%d') AS stay_date, lead_days, booked AS current_booked_rn, round(greatest(final - COALESCE(booked, 0), 0), 6) AS expected_pickup_rn, round(greatest(final - COALESCE(booked, 0), 0) / nullif(booked + greatest(final - COALESCE(booked, 0), 0), 0), 6) AS pickup_pct FROM pub")
def bi_pickup(spark: SparkSession, d: str) -> DataFrame:
    rows = published(spark, d).withColumn("expected_pickup_rn", F.greatest(F.col("final_forecast_rn") - F.coalesce("current_booked_rn", lit(0.0)), lit(0.0)))
    return rounded(report.area(rows, "pickup"), "expected_pickup_rn", "pickup_pct")


@query(_BANDS + "SELECT stay_date, round(SUM(p10), 6) AS p10, round(SUM(p90), 6) AS p90, round(SUM(final), 6) AS forecast FROM bands GROUP BY 1")
def portfolio_bands(spark: SparkSession, d: str) -> DataFrame:
    return rounded(report.portfolio_daily(banded(spark, d)).select("stay_date", "p10", "p90", "forecast"))


@query(
    _BANDS
    + """, w AS (SELECT property, date_trunc('week', stay_date) AS week, SUM(actual) AS a, SUM(final) AS f FROM bands GROUP BY ALL), k AS (SELECT property, SUM(abs(f - a)) / nullif(SUM(abs(a)), 0) AS weekly FROM w GROUP BY 1)
SELECT property, COUNT(*) AS n_obs, round(SUM(abs(error)) / nullif(SUM(abs(actual)), 0), 6) AS wmape, round(MIN(weekly), 6) AS wmape_weekly, round(AVG(CASE WHEN p10 IS NOT NULL THEN CAST(actual BETWEEN p10 AND p90 AS DOUBLE) END), 6) AS coverage,
  property = 'ASIA' AS provisional, quantile_cont(actual, 0.1) < 10 AS few_nights FROM bands JOIN k USING (property) GROUP BY 1"""
)
def accuracy_table(spark: SparkSession, d: str) -> DataFrame:
    new = kept(spark, d, "demand").where("property = 'ASIA'").select("property").distinct()
    return rounded(report.accuracy_table(banded(spark, d), new).select("property", "n_obs", "wmape", "wmape_weekly", "coverage", "provisional", "few_nights"))


@query(_BANDS + "SELECT property, stay_date, round(final, 6) AS forecast, round(p10, 6) AS p10, round(p90, 6) AS p90, booked, actual, round(capacity, 6) AS capacity FROM bands")
def series_by_property(spark: SparkSession, d: str) -> DataFrame:
    return rounded(report.property_series(banded(spark, d)), "forecast", "p10", "p90", "capacity")


# Monitoring.


@query(
    with_(DEMAND, PICKUP)
    + f""", p AS (SELECT lead_days, AVG(pickup_rn) FILTER (WHERE year(stay_date) = 1999) AS r, AVG(pickup_rn) FILTER (WHERE year(stay_date) = 2000) AS c FROM pickup GROUP BY 1), g AS (SELECT AVG(abs((c - r) / nullif(r, 0))) AS s FROM p WHERE r IS NOT NULL AND c IS NOT NULL),
r AS (SELECT AVG(room_nights) AS m, stddev_samp(room_nights) AS s FROM demand WHERE stay_date <= DATE '{CUTOFF}'), c AS (SELECT AVG(room_nights) AS m FROM demand WHERE stay_date > DATE '{CUTOFF}')
SELECT kind, round(change, 6) AS change FROM (SELECT 'pickup_curve' AS kind, s AS change FROM g UNION ALL SELECT 'feature:room_nights', abs((c.m - r.m) / nullif(r.s, 0)) FROM r, c UNION ALL SELECT 'metric:' || k, v FROM (VALUES ('mape', 0.35), ('wmape', -0.1), ('bias', 0.04)) t(k, v))"""
)
def drift_suite(spark: SparkSession, d: str) -> DataFrame:
    demand, pickup = kept(spark, d, "demand"), kept(spark, d, "pickup")
    metrics = lambda *v: spark.createDataFrame([v], "mape double, wmape double, bias double")
    late = demand.where(F.col("stay_date") > lit(CUTOFF).cast("date"))
    made = monitor.drift_suite(metrics(10.0, 0.2, 0.02), metrics(13.5, 0.18, -0.06), (pickup.where(F.year("stay_date") == 1999), pickup.where(F.year("stay_date") == 2000)), (asof.as_of(demand, CUTOFF), late), ["room_nights"])
    return made.select("kind", r6("change").alias("change"))
