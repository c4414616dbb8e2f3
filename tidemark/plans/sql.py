"""The canonical facts in DuckDB SQL: what the oracles of the queries start from. Independent of the Spark code."""

DEMAND = """demand AS (
  SELECT r_name AS property, CAST(l_shipdate AS DATE) AS stay_date, SUM(l_quantity) AS room_nights
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL)"""
PICKUP = """booked_raw AS (
  SELECT r_name AS property, CAST(l_shipdate AS DATE) AS stay_date, CAST(o_orderdate AS DATE) AS snapshot_date,
         CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER) AS lead_days, SUM(l_quantity) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) BETWEEN 0 AND 365 GROUP BY ALL),
pickup AS (
  SELECT property, stay_date, snapshot_date, lead_days, SUM(rn) OVER (PARTITION BY property, stay_date ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING) AS pickup_rn FROM booked_raw)"""


def season(d: str) -> str:
    return f"CASE WHEN month({d}) IN (12, 1, 2) THEN 'high' WHEN month({d}) IN (6, 7, 8, 9) THEN 'low' ELSE 'shoulder' END"


def band(lead: str) -> str:
    return f"CASE WHEN {lead} <= 2 THEN '1-2' WHEN {lead} <= 6 THEN '3-6' WHEN {lead} <= 13 THEN '7-13' WHEN {lead} <= 29 THEN '14-29' WHEN {lead} <= 59 THEN '30-59' WHEN {lead} <= 89 THEN '60-89' ELSE '90+' END"


CAPACITY = f"""capacity AS (
  SELECT property, stay_date, CASE WHEN month(stay_date) = 9 AND day(stay_date) = 15 THEN 0.0
    ELSE CAST(ceil(round(p95 * CASE WHEN {season('stay_date')} = 'high' THEN 1.1 ELSE 1.0 END, 6)) AS DOUBLE) END AS capacity
  FROM demand JOIN (SELECT property, quantile_cont(room_nights, 0.95) AS p95 FROM demand GROUP BY 1) USING (property))"""


def metrics(a: str = "actual", f: str = "forecast") -> str:
    """The error metrics as select items."""
    return f"""COUNT(*) FILTER (WHERE {a} IS NOT NULL AND {f} IS NOT NULL) AS n_obs,
  COUNT(*) FILTER (WHERE {a} = 0 AND {f} IS NOT NULL) AS n_mape_excluded,
  round(100 * AVG(abs({f} - {a}) / nullif({a}, 0)), 6) AS mape,
  round(SUM(abs({f} - {a})) / nullif(SUM(abs({a})) FILTER (WHERE {f} IS NOT NULL), 0), 6) AS wmape,
  round(AVG(abs({f} - {a})), 6) AS mae, round(sqrt(AVG(({f} - {a}) * ({f} - {a}))), 6) AS rmse,
  round(SUM({f} - {a}) / nullif(SUM(abs({a})) FILTER (WHERE {f} IS NOT NULL), 0), 6) AS bias"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def predictions(folds: str, horizon: int = 90) -> str:
    """CTEs up to `preds` (property, fold, model, stay_date, lead_days, forecast, actual) for folds given as (fold, cutoff) values."""
    return f"""folds AS (SELECT * FROM (VALUES {folds}) t(fold, cutoff)),
trained AS (SELECT property, fold, cutoff FROM demand JOIN folds ON stay_date <= cutoff GROUP BY ALL HAVING COUNT(*) >= 60),
grid AS (SELECT property, fold, cutoff, CAST(cutoff + CAST(k AS INTEGER) AS DATE) AS stay_date, CAST(k AS INTEGER) AS lead_days FROM trained, generate_series(1, {horizon}) t(k)),
past AS (SELECT d.property, fold, isodow(stay_date) AS dow, room_nights, row_number() OVER (PARTITION BY d.property, fold, isodow(stay_date) ORDER BY stay_date DESC) AS n FROM demand d JOIN folds ON stay_date <= cutoff),
naive AS (SELECT property, fold, dow, AVG(room_nights) AS f FROM past WHERE n <= 4 GROUP BY ALL),
latest AS (SELECT property, fold, arg_max(room_nights, stay_date) AS f FROM demand JOIN folds ON stay_date <= cutoff GROUP BY ALL),
booked AS (SELECT g.property, g.fold, g.stay_date, arg_min(p.pickup_rn, p.lead_days) AS booked FROM grid g JOIN pickup p ON p.property = g.property AND p.stay_date = g.stay_date AND p.lead_days >= g.lead_days AND p.snapshot_date <= g.cutoff GROUP BY ALL),
rem0 AS (SELECT fold, p.property, p.stay_date, lead_days, room_nights - pickup_rn AS remaining FROM pickup p JOIN demand USING (property, stay_date) JOIN folds ON p.stay_date <= cutoff AND snapshot_date <= cutoff),
rem AS (SELECT r.*, {season('r.stay_date')} AS season, CASE WHEN lead_days < 3 THEN 0 WHEN lead_days < 7 THEN 1 WHEN lead_days < 14 THEN 2 WHEN lead_days < 21 THEN 3 WHEN lead_days < 30 THEN 4 WHEN lead_days < 45 THEN 5 WHEN lead_days < 60 THEN 6 WHEN lead_days < 90 THEN 7 ELSE 8 END AS bin
  FROM rem0 r JOIN (SELECT fold, MAX(stay_date) AS top FROM rem0 GROUP BY 1) USING (fold) WHERE lead_days >= 1 AND top - r.stay_date <= 1095),
enough AS (SELECT fold, property, season FROM rem GROUP BY ALL HAVING COUNT(DISTINCT stay_date) >= 30),
curves AS (
  SELECT fold, 'season' AS level, property, season, bin, AVG(remaining) AS pickup FROM rem JOIN enough USING (fold, property, season) GROUP BY ALL
  UNION ALL SELECT fold, 'property', property, NULL, bin, AVG(remaining) FROM rem GROUP BY ALL
  UNION ALL SELECT fold, 'global', NULL, NULL, bin, AVG(remaining) FROM rem GROUP BY ALL),
chosen AS (SELECT g.*, {season('g.stay_date')} AS season, CASE WHEN lead_days >= 30 AND EXISTS (SELECT 1 FROM enough e WHERE e.fold = g.fold AND e.property = g.property AND e.season = {season('g.stay_date')}) THEN 'season'
  WHEN EXISTS (SELECT 1 FROM rem e WHERE e.fold = g.fold AND e.property = g.property) THEN 'property' ELSE 'global' END AS level,
  CASE WHEN lead_days < 3 THEN 0 WHEN lead_days < 7 THEN 1 WHEN lead_days < 14 THEN 2 WHEN lead_days < 21 THEN 3 WHEN lead_days < 30 THEN 4 WHEN lead_days < 45 THEN 5 WHEN lead_days < 60 THEN 6 WHEN lead_days < 90 THEN 7 ELSE 8 END AS bin FROM grid g),
offers AS (SELECT c.property, c.fold, c.stay_date, c.lead_days, v.pickup, row_number() OVER (PARTITION BY c.property, c.fold, c.stay_date ORDER BY (v.bin = c.bin) DESC, abs(m.centre - c.lead_days) NULLS LAST, v.bin) AS n
  FROM chosen c JOIN curves v ON v.fold = c.fold AND v.level = c.level AND v.property IS NOT DISTINCT FROM CASE WHEN c.level <> 'global' THEN c.property END AND v.season IS NOT DISTINCT FROM CASE WHEN c.level = 'season' THEN c.season END
  JOIN (VALUES (0, 2.0), (1, 5.0), (2, 10.5), (3, 17.5), (4, 25.5), (5, 37.5), (6, 52.5), (7, 75.0), (8, NULL)) m(bin, centre) ON m.bin = v.bin),
made AS (
  SELECT g.property, g.fold, 'seasonal_naive' AS model, g.stay_date, g.lead_days, CAST(COALESCE(n.f, l.f) AS DOUBLE) AS forecast FROM grid g LEFT JOIN naive n ON n.property = g.property AND n.fold = g.fold AND n.dow = isodow(g.stay_date) JOIN latest l ON l.property = g.property AND l.fold = g.fold
  UNION ALL SELECT o.property, o.fold, 'pickup_curve', o.stay_date, o.lead_days, COALESCE(b.booked, 0) + greatest(o.pickup, 0) FROM offers o LEFT JOIN booked b ON b.property = o.property AND b.fold = o.fold AND b.stay_date = o.stay_date WHERE n = 1),
preds AS (SELECT m.*, d.room_nights AS actual FROM made m JOIN demand d USING (property, stay_date))"""


FOLDS = ", ".join(f"({i}, CAST(DATE '2001-06-30' - {90 * (4 - i)} AS DATE))" for i in range(4))
ONE = "(0, DATE '2001-06-30')"
FOLD_METRICS = """fm AS (SELECT model, fold, property, COUNT(*) AS n_obs, 100 * AVG(abs(forecast - actual) / nullif(actual, 0)) AS mape, SUM(abs(forecast - actual)) / nullif(SUM(abs(actual)), 0) AS wmape, AVG(abs(forecast - actual)) AS mae,
  sqrt(AVG((forecast - actual) ** 2)) AS rmse, SUM(forecast - actual) / nullif(SUM(abs(actual)), 0) AS bias,
  SUM(abs(forecast - actual)) FILTER (WHERE lead_days <= 30) / nullif(SUM(abs(actual)) FILTER (WHERE lead_days <= 30), 0) AS wmape_short, SUM(abs(forecast - actual)) FILTER (WHERE lead_days > 30) / nullif(SUM(abs(actual)) FILTER (WHERE lead_days > 30), 0) AS wmape_long
  FROM preds GROUP BY ALL)"""


def scored(keys: str = "") -> str:
    """scores by model (and keys) from fm."""
    k = keys + ", " if keys else ""
    return f"""sc AS (SELECT {k}model, AVG(mape) AS mape, AVG(wmape) AS wmape, AVG(bias) AS bias, COUNT(DISTINCT fold) AS folds, COALESCE(stddev_samp(wmape), 0) AS stability, MAX(wmape) - MIN(wmape) AS stability_range,
  COALESCE(0.65 * AVG(wmape_short) + 0.35 * AVG(wmape_long), AVG(wmape)) + 0.5 * abs(AVG(bias)) + 0.25 * COALESCE(stddev_samp(wmape), 0) AS composite FROM fm GROUP BY ALL)"""


#: The forecast published on the cutoff: naive points, bookings, capacity, floor and cap; with actuals.
PUBLISHED = """pub0 AS (SELECT m.property, m.stay_date, m.lead_days, m.forecast AS raw, b.booked, COALESCE(c.capacity, q.median, 100.0) AS capacity FROM made m LEFT JOIN booked b USING (property, fold, stay_date)
  LEFT JOIN (SELECT property, stay_date, MAX(capacity) AS capacity FROM capacity GROUP BY ALL) c USING (property, stay_date) LEFT JOIN (SELECT property, quantile_cont(capacity, 0.5) AS median FROM capacity WHERE stay_date <= DATE '2001-06-30' GROUP BY 1) q USING (property) WHERE model = 'seasonal_naive'),
pub AS (SELECT *, COALESCE(raw < booked, FALSE) AS floored, CASE WHEN raw < booked THEN booked ELSE raw END > capacity AS capped, least(CASE WHEN raw < booked THEN booked ELSE raw END, capacity) AS final FROM pub0),
graded AS (SELECT pub.*, room_nights AS actual, final - room_nights AS error FROM pub JOIN demand USING (property, stay_date))"""
