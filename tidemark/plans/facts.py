"""Queries over the canonical facts: quality, features, as-of joins, holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import lit

from ..functions import scalars as s
from ..functions.scalars import r6
from ..operators import asof, features, holidays, leakage, quality
from ..sources import canon
from .registry import query
from .sql import CAPACITY, DEMAND, PICKUP, band, season, with_

CUTOFF, HORIZON = "2001-06-30", 90


@query(with_(DEMAND) + "SELECT property, stay_date, room_nights FROM demand")
def demand_canon(spark: SparkSession, d: str) -> DataFrame:
    return canon.demand(spark, d)


@query(with_(PICKUP) + "SELECT property, stay_date, snapshot_date, lead_days, pickup_rn FROM pickup")
def pickup_canon(spark: SparkSession, d: str) -> DataFrame:
    return canon.pickup(spark, d)


@query(with_(DEMAND, CAPACITY) + "SELECT property, stay_date, capacity FROM capacity")
def capacity_canon(spark: SparkSession, d: str) -> DataFrame:
    return canon.capacity(spark, d)


@query(
    """SELECT REPLACE(l_returnflag || '-' || l_linestatus, '-', '_') AS grp, CAST(l_shipdate AS DATE) AS stay_date, SUM(l_quantity) AS rn, round(SUM(l_extendedprice), 2) AS revenue
FROM lineitem WHERE l_linestatus NOT LIKE 'X%' AND COALESCE(l_returnflag, '?') NOT IN ('Z') AND l_shipdate IS NOT NULL GROUP BY 1, 2"""
)
def upstream_demand_sql(spark: SparkSession, d: str) -> DataFrame:
    canon.table(spark, d, "lineitem").createOrReplaceTempView("upstream_lineitem")
    return spark.sql(
        "SELECT replace(l_returnflag || '-' || l_linestatus, '-', '_') AS grp, CAST(l_shipdate AS DATE) AS stay_date, SUM(l_quantity) AS rn, round(SUM(l_extendedprice), 2) AS revenue "
        "FROM upstream_lineitem WHERE l_linestatus NOT LIKE 'X%' AND COALESCE(l_returnflag, '?') NOT IN ('Z') AND l_shipdate IS NOT NULL GROUP BY 1, 2"
    )


@query("SELECT CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER) AS lead_days, SUM(l_quantity) AS rn, COUNT(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def upstream_pickup_sql(spark: SparkSession, d: str) -> DataFrame:
    lines, orders = canon.table(spark, d, "lineitem"), canon.table(spark, d, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.datediff("l_shipdate", "o_orderdate").alias("lead_days")).agg(F.sum("l_quantity").alias("rn"), F.count("*").alias("lines"))


@query("SELECT p_brand AS property, CAST(l_shipdate AS DATE) AS business_date, CAST(SUM(p_size) AS BIGINT) AS available_rooms FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_shipdate IS NOT NULL GROUP BY 1, 2")
def upstream_capacity_sql(spark: SparkSession, d: str) -> DataFrame:
    """Lines are counted by part and day before they meet the parts."""
    lines = canon.table(spark, d, "lineitem").where("l_shipdate is not null").groupBy(F.col("l_partkey").alias("p_partkey"), F.to_date("l_shipdate").alias("business_date")).agg(F.count("*").alias("n"))
    return lines.join(canon.table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("property"), "p_size"), "p_partkey").groupBy("property", "business_date").agg(F.sum(F.col("n") * F.col("p_size")).alias("available_rooms"))


# Date parsing, aliases, closed properties.


@query(
    """WITH t AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%-d/%-m/%Y') END AS txt FROM orders)
SELECT id, CAST(strptime(txt, '%d/%m/%Y') AS DATE) AS parsed FROM t"""
)
def parse_day_first(spark: SparkSession, d: str) -> DataFrame:
    from ..sources.files import parse_dates

    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "d/M/yyyy"))
    rows = canon.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), text.alias("txt"))
    return parse_dates(rows, "txt").select("id", F.col("txt").alias("parsed"))


@query(with_(DEMAND) + "SELECT CASE property WHEN 'EUROPE' THEN 'EMEA' WHEN 'MIDDLE EAST' THEN 'EMEA' ELSE property END AS property, COUNT(*) AS days, SUM(room_nights) AS rn FROM demand WHERE property <> 'ASIA' GROUP BY 1")
def aliases_and_closed(spark: SparkSession, d: str) -> DataFrame:
    from ..sources.files import apply_aliases, exclude_properties

    rows = exclude_properties(apply_aliases(canon.demand(spark, d), {"EUROPE": "EMEA", "MIDDLE EAST": "EMEA"}), ["ASIA"])
    return rows.groupBy("property").agg(F.count("*").alias("days"), F.sum("room_nights").alias("rn"))


# Quality.


@query(
    with_(DEMAND)
    + """, noisy AS (SELECT * FROM demand UNION ALL SELECT property, stay_date, -room_nights FROM demand WHERE day(stay_date) = 1)
, gaps AS (SELECT property, CAST(g AS DATE) AS stay_date FROM (SELECT property, unnest(generate_series(min(stay_date), max(stay_date), INTERVAL 1 DAY)) AS g FROM demand GROUP BY 1) x ANTI JOIN demand e ON e.property = x.property AND e.stay_date = CAST(g AS DATE))
SELECT "check", severity, COUNT(*) AS records, CAST(COUNT(DISTINCT property) AS BIGINT) AS n_properties, MIN(stay_date) AS first_date, MAX(stay_date) AS last_date FROM (
  SELECT 'duplicate_property_date' AS "check", 'error' AS severity, property, stay_date FROM (SELECT *, COUNT(*) OVER (PARTITION BY property, stay_date) AS n FROM noisy) WHERE n > 1
  UNION ALL SELECT 'negative_rn', 'error', property, stay_date FROM noisy WHERE room_nights < 0
  UNION ALL SELECT 'missing_dates', 'warning', property, stay_date FROM gaps) GROUP BY 1, 2"""
)
def dq_demand(spark: SparkSession, d: str) -> DataFrame:
    rows = canon.demand(spark, d)
    noisy = rows.union(rows.where(F.dayofmonth("stay_date") == 1).withColumn("room_nights", -F.col("room_nights")))
    return quality.demand_issues(noisy).select("check", "severity", "records", F.size("properties").cast("long").alias("n_properties"), F.array_min("dates").alias("first_date"), F.array_max("dates").alias("last_date"))


@query(
    with_(DEMAND, CAPACITY)
    + """SELECT "check", 'warning' AS severity, COUNT(*) AS records FROM (
  SELECT 'zero_capacity' AS "check" FROM capacity WHERE capacity = 0
  UNION ALL SELECT 'unexpected_capacity_change' FROM (SELECT capacity, lag(capacity) OVER (PARTITION BY property ORDER BY stay_date) AS p FROM capacity) WHERE (p = 0 AND capacity > 0) OR (p <> 0 AND abs(capacity - p) / p > 0.5)
  UNION ALL SELECT 'missing_dates' FROM (SELECT property, unnest(generate_series(min(stay_date), max(stay_date), INTERVAL 1 DAY)) AS g FROM demand GROUP BY 1) x ANTI JOIN demand e ON e.property = x.property AND e.stay_date = CAST(g AS DATE)) GROUP BY 1"""
)
def dq_capacity(spark: SparkSession, d: str) -> DataFrame:
    return quality.capacity_issues(canon.capacity(spark, d)).select("check", "severity", "records")


@query(
    with_(PICKUP)
    + """, noisy AS (SELECT property, stay_date, snapshot_date, lead_days + CASE WHEN day(stay_date) = 2 THEN 1 ELSE 0 END AS lead_days, pickup_rn FROM pickup UNION ALL SELECT * FROM pickup WHERE lead_days = 3)
SELECT "check", 'error' AS severity, COUNT(*) AS records FROM (
  SELECT 'duplicate_snapshots' AS "check" FROM (SELECT COUNT(*) OVER (PARTITION BY property, stay_date, snapshot_date) AS n FROM noisy) WHERE n > 1
  UNION ALL SELECT 'pickup_inconsistent' FROM noisy WHERE lead_days <> stay_date - snapshot_date) GROUP BY 1"""
)
def dq_pickup(spark: SparkSession, d: str) -> DataFrame:
    rows = canon.pickup(spark, d)
    noisy = rows.withColumn("lead_days", F.col("lead_days") + (F.dayofmonth("stay_date") == 2).cast("int")).union(rows.where("lead_days = 3"))
    return quality.pickup_issues(noisy).select("check", "severity", "records")


@query(
    with_(DEMAND, CAPACITY)
    + """SELECT 'rn_over_capacity' AS "check", CASE WHEN AVG(CAST(room_nights > capacity AS DOUBLE)) > 0.01 THEN 'error' ELSE 'warning' END AS severity, COUNT(*) FILTER (WHERE room_nights > capacity) AS records,
  array_to_string(list_sort(list_distinct(list(property) FILTER (WHERE room_nights > capacity))), ',') AS properties FROM demand JOIN capacity USING (property, stay_date)"""
)
def dq_rn_over_capacity(spark: SparkSession, d: str) -> DataFrame:
    return quality.over_capacity(canon.demand(spark, d), canon.capacity(spark, d)).select("check", "severity", "records", F.array_join("properties", ",").alias("properties"))


@query(
    with_(DEMAND, CAPACITY)
    + """, i AS (SELECT 'warning' AS severity, COUNT(*) AS records FROM capacity WHERE capacity = 0 HAVING COUNT(*) > 0
  UNION ALL SELECT 'warning', COUNT(*) FROM (SELECT capacity, lag(capacity) OVER (PARTITION BY property ORDER BY stay_date) AS p FROM capacity) WHERE (p = 0 AND capacity > 0) OR (p <> 0 AND abs(capacity - p) / p > 0.5) HAVING COUNT(*) > 0
  UNION ALL SELECT 'warning', COUNT(*) FROM (SELECT property, unnest(generate_series(min(stay_date), max(stay_date), INTERVAL 1 DAY)) AS g FROM demand GROUP BY 1) x ANTI JOIN demand e ON e.property = x.property AND e.stay_date = CAST(g AS DATE) HAVING COUNT(*) > 0)
SELECT CASE WHEN COUNT(*) FILTER (WHERE severity = 'error') > 0 THEN 'fail' WHEN COUNT(*) > 0 THEN 'warnings' ELSE 'pass' END AS status, COUNT(*) FILTER (WHERE severity = 'error') AS errors, COUNT(*) FILTER (WHERE severity = 'warning') AS warnings, CAST(COALESCE(SUM(records), 0) AS BIGINT) AS records FROM i"""
)
def dq_report(spark: SparkSession, d: str) -> DataFrame:
    return quality.report(quality.capacity_issues(canon.capacity(spark, d))).select("status", "errors", "warnings", "records")


# As-of and leakage.


@query(with_(DEMAND) + f"SELECT property, COUNT(*) AS days, MAX(stay_date) AS last_date FROM demand WHERE stay_date <= DATE '{CUTOFF}' GROUP BY 1")
def asof_frame(spark: SparkSession, d: str) -> DataFrame:
    return asof.as_of(canon.demand(spark, d), CUTOFF).groupBy("property").agg(F.count("*").alias("days"), F.max("stay_date").alias("last_date"))


@query(with_(DEMAND) + f"""SELECT COUNT(*) AS "rows", COUNT(stay_date) AS dated, COUNT(*) FILTER (WHERE stay_date > DATE '{CUTOFF}') AS future,
  array_to_string(list_slice(list_sort(list_distinct(list(CAST(stay_date AS VARCHAR)) FILTER (WHERE stay_date > DATE '{CUTOFF}'))), 1, 5), ',') AS sample FROM demand""")
def cutoff_guard(spark: SparkSession, d: str) -> DataFrame:
    return asof.future_rows(canon.demand(spark, d), CUTOFF).select("rows", "dated", "future", F.array_join(F.transform("sample", lambda x: x.cast("string")), ",").alias("sample"))


@query(
    with_(DEMAND, PICKUP)
    + f""", grid AS (SELECT property, CAST(DATE '{CUTOFF}' + CAST(k AS INTEGER) AS DATE) AS stay_date, CAST(k AS INTEGER) AS lead_days FROM (SELECT DISTINCT property FROM demand), generate_series(1, {HORIZON}) t(k))
SELECT g.property, g.stay_date, g.lead_days, arg_min(p.pickup_rn, p.lead_days) AS booked FROM grid g LEFT JOIN pickup p ON p.property = g.property AND p.stay_date = g.stay_date AND p.lead_days >= g.lead_days AND p.snapshot_date <= DATE '{CUTOFF}' GROUP BY ALL"""
)
def booked_asof_grid(spark: SparkSession, d: str) -> DataFrame:
    grid = asof.request_grid(canon.demand(spark, d).select("property").distinct(), CUTOFF, HORIZON)
    return asof.booked_on_grid(grid, canon.pickup(spark, d), CUTOFF)


@query(with_(PICKUP) + f"SELECT property, stay_date, arg_max(pickup_rn, snapshot_date) AS booked FROM pickup WHERE snapshot_date <= DATE '{CUTOFF}' GROUP BY 1, 2")
def booked_latest(spark: SparkSession, d: str) -> DataFrame:
    return asof.booked_latest(canon.pickup(spark, d), CUTOFF)


@query(with_(DEMAND, PICKUP) + f"SELECT p.property, p.stay_date, p.lead_days, p.pickup_rn AS booked, room_nights - pickup_rn AS remaining FROM pickup p JOIN demand USING (property, stay_date) WHERE p.stay_date <= DATE '{CUTOFF}' AND snapshot_date <= DATE '{CUTOFF}'")
def remaining_pickup(spark: SparkSession, d: str) -> DataFrame:
    return asof.remaining_pickup(canon.pickup(spark, d), canon.demand(spark, d), CUTOFF)


@query(
    """SELECT e.event_id, e.user_id, p.value AS last_value FROM events e ASOF LEFT JOIN (SELECT user_id, ts, arg_max(value, event_id) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) p ON e.user_id = p.user_id AND e.ts >= p.ts"""
)
def asof_last_purchase(spark: SparkSession, d: str) -> DataFrame:
    rows = canon.table(spark, d, "events")
    bought = rows.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max_by("value", "event_id").alias("last_value"))
    return asof.asof_join(rows.select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "ts", ["last_value"]).select("event_id", "user_id", "last_value")


@query(
    with_(DEMAND)
    + """, w AS (SELECT AVG(room_nights) OVER m0 AS m_own, AVG(room_nights) OVER m1 AS m_past, SUM(room_nights) OVER s0 AS s_own, SUM(room_nights) OVER s1 AS s_past FROM demand
  WINDOW m0 AS (PARTITION BY property ORDER BY stay_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), m1 AS (PARTITION BY property ORDER BY stay_date RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING),
  s0 AS (PARTITION BY property ORDER BY stay_date RANGE BETWEEN INTERVAL 13 DAYS PRECEDING AND CURRENT ROW), s1 AS (PARTITION BY property ORDER BY stay_date RANGE BETWEEN INTERVAL 14 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING))
, v AS (SELECT 'rolling_mean_7' AS feature, m_own AS stored, m_own AS own, m_past AS past FROM w UNION ALL SELECT 'rolling_sum_14', s_past, s_own, s_past FROM w)
SELECT feature, COUNT(*) FILTER (WHERE abs(stored - own) <= 1e-8 + 1e-5 * abs(own)) = COUNT(*) AND COUNT(*) FILTER (WHERE past IS NULL OR abs(stored - past) > 1e-8 + 1e-5 * abs(past)) > 0 AS includes_target FROM v WHERE stored IS NOT NULL GROUP BY 1"""
)
def leak_target_in_rolling(spark: SparkSession, d: str) -> DataFrame:
    """A mean that includes its own day, and a sum that doesn't: the check finds the first."""
    rows = canon.demand(spark, d)
    frame = lambda a, b: asof.range_frame("property", "stay_date", a, b)
    made = rows.withColumns({"rolling_mean_7": F.avg("room_nights").over(frame(-6, 0)), "rolling_sum_14": F.sum("room_nights").over(frame(-14, -1))})
    return leakage.scan_rolling(made).select("feature", "includes_target")


@query(
    with_(DEMAND)
    + f"""SELECT 'centred_7' AS feature, COUNT(*) FILTER (WHERE c IS NOT NULL) AS compared, COUNT(*) FILTER (WHERE abs(c - b) > 1e-8 + 1e-5 * abs(b)) AS differs_from_backward, TRUE AS includes_future FROM (SELECT
  AVG(room_nights) OVER (PARTITION BY property ORDER BY stay_date RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND INTERVAL 3 DAYS FOLLOWING) AS c,
  AVG(room_nights) OVER (PARTITION BY property ORDER BY stay_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS b, stay_date FROM demand)"""
)
def leak_centred_window(spark: SparkSession, d: str) -> DataFrame:
    rows = canon.demand(spark, d).withColumn("centred_7", F.avg("room_nights").over(asof.range_frame("property", "stay_date", -3, 3)))
    return leakage.centred(rows, "centred_7", 7)


# Calendar and holidays.


@query(
    with_(DEMAND)
    + f"""SELECT property, stay_date, CAST(isodow(stay_date) - 1 AS INTEGER) AS day_of_week, isodow(stay_date) >= 6 AS is_weekend, CAST(weekofyear(stay_date) AS INTEGER) AS week_of_year, CAST(month(stay_date) AS INTEGER) AS month,
  CAST(quarter(stay_date) AS INTEGER) AS quarter, CAST(year(stay_date) AS INTEGER) AS year, CAST(day(stay_date) AS INTEGER) AS day_of_month, CAST(last_day(stay_date) - stay_date AS INTEGER) AS days_to_month_end, {season('stay_date')} AS season,
  (month(stay_date) = 12 AND day(stay_date) = 25) OR (month(stay_date) = 1 AND day(stay_date) = 1) AS is_holiday FROM demand"""
)
def calendar_features(spark: SparkSession, d: str) -> DataFrame:
    days = spark.sql("SELECT make_date(y, m, dd) AS date FROM (SELECT explode(sequence(1994, 2002)) AS y), VALUES (12, 25), (1, 1) AS t(m, dd)")
    return features.calendar_features(canon.demand(spark, d).select("property", "stay_date"), holidays=days)


def _named(years: range, countries: tuple[str, ...] = ("CR", "US")) -> str:
    values = ", ".join(f"(DATE '{a}', '{n.replace(chr(39), chr(39) * 2)}', {k})" for a, n, k in holidays.holiday_rows(years, countries))
    return f"""named AS (SELECT d, strip_accents(lower(n)) AS n, k FROM (VALUES {values}) t(d, n, k)),
keyed AS (SELECT d, k, CASE WHEN n LIKE '%santo%' OR n LIKE '%easter%' THEN 'semana_santa' WHEN n LIKE '%navidad%' OR n LIKE '%christmas%' OR n LIKE '%ano nuevo%' OR n LIKE '%new year%' THEN 'fin_de_ano'
  WHEN n LIKE '%thanksgiving%' THEN 'thanksgiving' WHEN n LIKE '%memorial%' THEN 'memorial_day' WHEN n LIKE '%labor day%' THEN 'labor_day_us' WHEN n LIKE '%independence day%' OR n LIKE '%julio%' THEN 'independencia_us'
  WHEN n LIKE '%independencia%' THEN 'independencia_cr' WHEN n LIKE '%anexion%' THEN 'anexion' WHEN n LIKE '%madre%' OR n LIKE '%mother%' THEN 'dia_de_la_madre' ELSE trim(regexp_replace(n, '[^a-z0-9]+', '_', 'g'), '_') END AS key FROM named)"""


NAMED = _named(range(1995, 2002))
#: Holidays of the years around the facts, of all that could be.
_AROUND = "years AS (SELECT year(MIN(stay_date)) - 1 AS a, year(MAX(stay_date)) + 1 AS z FROM demand), around AS (SELECT keyed.* FROM keyed, years WHERE year(d) BETWEEN a AND z)"


@query(with_(DEMAND, _named(range(1980, 2021)), _AROUND) + " SELECT CAST(d + CAST(o AS INTEGER) AS DATE) AS date, arg_min(key, abs(o) * 100000 + k) AS key, CAST(MIN(abs(o)) AS INTEGER) AS distance FROM around, generate_series(-4, 4) t(o) GROUP BY 1")
def holiday_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows of the years that the facts cover, and one on either side."""
    return holidays.from_config(canon.demand(spark, d), {"countries": ("CR", "US")}).windows.drop("property")


@query(
    with_(DEMAND, _named(range(1980, 2021), ("US", "CR")), _AROUND)
    + """, w AS (SELECT CAST(d + CAST(o AS INTEGER) AS DATE) AS date, arg_min(key, abs(o) * 100000 + r * 10000 + k) AS key FROM (SELECT d, k, key, 0 AS r FROM around UNION ALL SELECT DATE '2000-03-10', 0, 'surf_final', 1), generate_series(-3, 3) t(o) GROUP BY 1)
SELECT 'US,CR' AS countries, 3 AS window_days, (SELECT COUNT(DISTINCT d) FROM around) AS n_holiday_dates, (SELECT COUNT(DISTINCT d) FROM (SELECT d FROM around UNION ALL SELECT DATE '2000-03-10')) AS n_dates,
  (SELECT COUNT(*) FROM w) AS n_window_days, 1 AS n_scoped_properties, (SELECT string_agg(key, ',' ORDER BY key) FROM (SELECT key FROM w UNION SELECT 'congress')) AS keys"""
)
def holiday_calendar(spark: SparkSession, d: str) -> DataFrame:
    """What the calendar of a configuration holds, for the years of the facts and with events."""
    made = holidays.from_config(canon.demand(spark, d), {"countries": ["US", "CR"], "window_days": 3}, _events(spark))
    return holidays.describe(made).withColumns({c: F.array_join(c, ",") for c in ("countries", "keys")})


def _events(spark: SparkSession) -> DataFrame:
    import datetime

    return spark.createDataFrame([("Surf final", datetime.date(2000, 3, 10), None), ("Congress", datetime.date(2000, 10, 25), "ASIA")], "event_name string, event_date date, property string")


@query(with_(DEMAND, NAMED) + "SELECT stay_date, CAST(MIN(abs(d - stay_date)) AS INTEGER) AS days_to_holiday FROM (SELECT DISTINCT stay_date FROM demand), (SELECT DISTINCT d FROM keyed) GROUP BY 1")
def days_to_holiday(spark: SparkSession, d: str) -> DataFrame:
    return holidays.days_to_nearest(canon.demand(spark, d).select("stay_date").distinct(), holidays.holidays(spark, range(1995, 2002)))


@query(
    with_(DEMAND, NAMED)
    + """, w AS (SELECT CAST(d + CAST(o AS INTEGER) AS DATE) AS stay_date, arg_min(key, abs(o) * 100000 + r * 10000 + k) AS key FROM (SELECT d, k, key, 0 AS r FROM keyed UNION ALL SELECT DATE '2000-03-10', 0, 'surf_final', 1), generate_series(-4, 4) t(o) GROUP BY 1),
own AS (SELECT 'ASIA' AS property, CAST(DATE '2000-10-25' + CAST(o AS INTEGER) AS DATE) AS stay_date, 'congress' AS key FROM generate_series(-4, 4) t(o))
SELECT property, stay_date, COALESCE(w.key, own.key) AS holiday_key FROM demand LEFT JOIN w USING (stay_date) LEFT JOIN own USING (property, stay_date)"""
)
def holiday_keys_with_events(spark: SparkSession, d: str) -> DataFrame:
    calendar = holidays.with_events(holidays.holidays(spark, range(1995, 2002)), _events(spark))
    return holidays.window_key(canon.demand(spark, d).select("property", "stay_date"), calendar)


@query(
    """SELECT o_orderkey AS id, CASE WHEN lead <= 2 THEN '1-2' WHEN lead <= 6 THEN '3-6' WHEN lead <= 13 THEN '7-13' WHEN lead <= 29 THEN '14-29' WHEN lead <= 59 THEN '30-59' WHEN lead <= 89 THEN '60-89' ELSE '90+' END AS lead_band,
  CASE WHEN m IS NULL THEN 'no data' WHEN m < 10 THEN 'excellent' WHEN m < 20 THEN 'acceptable' WHEN m < 25 THEN 'reasonable if seasonal' ELSE 'outside the references' END AS accuracy,
  CASE WHEN b > 0.001 THEN 'over' WHEN b < -0.001 THEN 'under' ELSE 'none' END AS direction, round(CAST(lead AS DOUBLE) / nullif(m, 0), 6) AS share
FROM (SELECT o_orderkey, CAST(o_orderkey % 120 - 5 AS INTEGER) AS lead, CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 31 END AS DOUBLE) AS m, (o_orderkey % 5 - 2) / 1000.0 AS b FROM orders)"""
)
def scalar_rules(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = canon.table(spark, d, "orders").select("o_orderkey", (key % 120 - 5).cast("int").alias("lead"), F.when(key % 7 != 0, (key % 31).cast("double")).alias("m"), ((key % 5 - 2) / 1000.0).alias("b"))
    return rows.select(key.alias("id"), s.lead_band("lead").alias("lead_band"), s.accuracy_band("m").alias("accuracy"), s.bias_direction("b").alias("direction"), r6(s.ratio(F.col("lead").cast("double"), "m")).alias("share"))


@query(
    """SELECT name, CASE WHEN name LIKE '%current_booked_rn%' OR name LIKE '%booked%' THEN 'current_bookings' WHEN name LIKE '%pickup%' OR name LIKE '%lead%' THEN 'pickup'
  WHEN name LIKE '%dow%' OR name LIKE '%month%' OR name LIKE '%lag\\_%' ESCAPE '\\' OR name LIKE '%season%' THEN 'seasonality' WHEN name LIKE '%capacity%' THEN 'capacity' WHEN name LIKE '%year%' OR name LIKE '%trend%' THEN 'trend' ELSE 'other' END AS driver
FROM (VALUES ('current_booked_rn'), ('pickup_last_7d'), ('lead_days'), ('same_dow_1w'), ('lag_7'), ('month'), ('capacity_change'), ('year'), ('rolling_mean_7'), ('trend_slope')) t(name)"""
)
def driver_names(spark: SparkSession, d: str) -> DataFrame:
    names = "current_booked_rn pickup_last_7d lead_days same_dow_1w lag_7 month capacity_change year rolling_mean_7 trend_slope".split()
    return spark.createDataFrame([(n,) for n in names], "name string").withColumn("driver", s.driver("name"))


# Features.

_W = "PARTITION BY property ORDER BY stay_date RANGE BETWEEN INTERVAL {} DAYS PRECEDING AND INTERVAL {} DAYS PRECEDING"


@query(with_(DEMAND) + "SELECT property, stay_date, " + ", ".join(f"MAX(room_nights) OVER ({_W.format(k, k)}) AS lag_{k}" for k in (1, 7, 14, 28, 365)) + " FROM demand")
def demand_lags(spark: SparkSession, d: str) -> DataFrame:
    return features.demand_features(canon.demand(spark, d)).select("property", "stay_date", *[f"lag_{k}" for k in features.LAGS])


@query(with_(DEMAND) + "SELECT property, stay_date, " + ", ".join(f"round(AVG(room_nights) OVER ({_W.format(k, 1)}), 6) AS rolling_mean_{k}" for k in (7, 14, 28, 56)) + f", round(AVG(room_nights) OVER ({_W.format(30, 1)}), 6) AS same_month_historical_mean FROM demand")
def demand_rolling_mean(spark: SparkSession, d: str) -> DataFrame:
    return features.demand_features(canon.demand(spark, d)).select("property", "stay_date", *[r6(f"rolling_mean_{k}").alias(f"rolling_mean_{k}") for k in features.MEANS], r6("same_month_historical_mean").alias("same_month_historical_mean"))


@query(with_(DEMAND) + f"SELECT property, stay_date, round(quantile_cont(room_nights, 0.5) OVER ({_W.format(28, 1)}), 6) AS rolling_median_28, round(stddev_samp(room_nights) OVER ({_W.format(28, 1)}), 6) AS rolling_std_28 FROM demand")
def demand_rolling_spread(spark: SparkSession, d: str) -> DataFrame:
    return features.demand_features(canon.demand(spark, d)).select("property", "stay_date", r6("rolling_median_28").alias("rolling_median_28"), r6("rolling_std_28").alias("rolling_std_28"))


@query(with_(DEMAND) + "SELECT property, stay_date, round(AVG(room_nights) OVER (PARTITION BY property ORDER BY stay_date ROWS UNBOUNDED PRECEDING), 6) AS expanding_mean FROM demand")
def demand_expanding_mean(spark: SparkSession, d: str) -> DataFrame:
    return features.expanding_mean(canon.demand(spark, d)).select("property", "stay_date", r6("expanding_mean").alias("expanding_mean"))


@query(
    """WITH e AS (SELECT event_type AS property, CAST(ts AS DATE) AS stay_date FROM events), s AS (SELECT property, max(stay_date) - min(stay_date) AS span FROM e GROUP BY 1 HAVING max(stay_date) - min(stay_date) < 365)
SELECT f AS feature, string_agg(property, ',' ORDER BY property) AS properties FROM s, (VALUES ('lag_365'), ('same_month_year')) t(f) GROUP BY 1"""
)
def missing_yearly_features(spark: SparkSession, d: str) -> DataFrame:
    short = canon.table(spark, d, "events").select(F.col("event_type").alias("property"), F.to_date("ts").alias("stay_date"))
    return features.missing_features(short).select("feature", F.array_join("properties", ",").alias("properties"))


@query(
    with_(DEMAND, CAPACITY)
    + """SELECT property, stay_date, capacity, lag(capacity) OVER w AS capacity_prev_day, capacity - lag(capacity) OVER w AS capacity_change,
  round(AVG(capacity) OVER (PARTITION BY property ORDER BY stay_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS capacity_rolling_mean_7, capacity - room_nights AS capacity_remaining, round(room_nights / nullif(capacity, 0), 6) AS capacity_utilization
FROM capacity JOIN demand USING (property, stay_date) WINDOW w AS (PARTITION BY property ORDER BY stay_date)"""
)
def capacity_features(spark: SparkSession, d: str) -> DataFrame:
    made = features.capacity_features(canon.capacity(spark, d), canon.demand(spark, d))
    return made.select("property", "stay_date", "capacity", "capacity_prev_day", "capacity_change", r6("capacity_rolling_mean_7").alias("capacity_rolling_mean_7"), "capacity_remaining", r6("capacity_utilization").alias("capacity_utilization"))


_INC = """, inc AS (SELECT *, COALESCE(pickup_rn - lag(pickup_rn) OVER w, 0) AS gain, CAST(snapshot_date - min(snapshot_date) OVER (PARTITION BY property, stay_date) AS INTEGER) AS pos FROM pickup WINDOW w AS (PARTITION BY property, stay_date ORDER BY snapshot_date))"""
_S = "PARTITION BY property, stay_date ORDER BY snapshot_date RANGE BETWEEN INTERVAL {} DAYS PRECEDING AND {}"


@query(
    with_(PICKUP) + _INC + " SELECT property, stay_date, snapshot_date, " + ", ".join(f"SUM(gain) OVER ({_S.format(k - 1, 'CURRENT ROW')}) AS pickup_last_{k}d" for k in (1, 3, 7, 14, 30))
    + f""", CASE WHEN pos >= 7 THEN SUM(gain) OVER ({_S.format(6, 'CURRENT ROW')}) - COALESCE(SUM(gain) OVER ({_S.format(13, 'INTERVAL 7 DAYS PRECEDING')}), 0) END AS pickup_acceleration,
  SUM(pickup_rn) OVER (PARTITION BY property, stay_date ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING) AS pickup_cumulative FROM inc"""
)
def pickup_windows(spark: SparkSession, d: str) -> DataFrame:
    return features.pickup_features(canon.pickup(spark, d)).select("property", "stay_date", "snapshot_date", *[f"pickup_last_{k}d" for k in features.PICKUP_DAYS], "pickup_acceleration", "pickup_cumulative")


@query(
    with_(PICKUP) + _INC
    + """, daily AS (SELECT a.property, a.stay_date, a.snapshot_date, a.pos, o, COALESCE(b.gain, 0) AS gain FROM inc a, generate_series(0, 6) t(o) LEFT JOIN inc b ON b.property = a.property AND b.stay_date = a.stay_date AND b.snapshot_date = CAST(a.snapshot_date - CAST(o AS INTEGER) AS DATE) WHERE o <= a.pos)
SELECT property, stay_date, snapshot_date, round(stddev_samp(gain), 6) AS pickup_volatility FROM daily GROUP BY 1, 2, 3"""
)
def pickup_volatility(spark: SparkSession, d: str) -> DataFrame:
    return features.pickup_features(canon.pickup(spark, d)).select("property", "stay_date", "snapshot_date", r6("pickup_volatility").alias("pickup_volatility"))


@query(with_(PICKUP) + "SELECT property, lead_days, round(AVG(pickup_rn), 6) AS same_lead_mean, round(quantile_cont(pickup_rn, 0.5), 6) AS same_lead_median, COUNT(*) AS same_lead_count FROM pickup GROUP BY 1, 2")
def pickup_same_lead(spark: SparkSession, d: str) -> DataFrame:
    return features.same_lead(canon.pickup(spark, d)).select("property", "lead_days", r6("same_lead_mean").alias("same_lead_mean"), r6("same_lead_median").alias("same_lead_median"), "same_lead_count")


@query(
    with_(DEMAND, PICKUP)
    + f"""SELECT property, stay_date, lead_days, booked, remaining FROM (SELECT p.property, p.stay_date, lead_days, max(pickup_rn) AS booked, max(room_nights - pickup_rn) AS remaining, dense_rank() OVER (PARTITION BY p.property ORDER BY p.stay_date DESC) AS n
  FROM pickup p JOIN demand USING (property, stay_date) WHERE p.stay_date <= DATE '{CUTOFF}' AND snapshot_date <= DATE '{CUTOFF}' AND lead_days BETWEEN 1 AND {HORIZON} GROUP BY 1, 2, 3) WHERE n <= 365"""
)
def training_panel(spark: SparkSession, d: str) -> DataFrame:
    return features.panel(asof.remaining_pickup(canon.pickup(spark, d), canon.demand(spark, d), CUTOFF), HORIZON)
