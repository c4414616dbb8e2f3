"""Features of a stay date: calendar, demand, capacity and pickup.

Demand and pickup windows run over calendar days (RANGE frames over the day number), so days without a
row need no dense grid; capacity windows run over rows. All frames of one source share one sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from ..functions.scalars import day_number, ratio, season

LAGS, MEANS = (1, 7, 14, 28, 365), (7, 14, 28, 56)
YEAR_SPAN = 365
PICKUP_DAYS = (1, 3, 7, 14, 30)
ACCELERATION, VOLATILITY = 7, 7


def calendar_features(df: DataFrame, date: str = "stay_date", holidays: DataFrame | None = None) -> DataFrame:
    """day_of_week (0: Monday), is_weekend, week_of_year (ISO), month, quarter, year, day_of_month,
    days_to_month_end, season; is_holiday if public holidays (column date) are given."""
    d = F.col(date)
    out = df.withColumns(
        {
            "day_of_week": F.weekday(d), "is_weekend": F.weekday(d) >= 5, "week_of_year": F.weekofyear(d), "month": F.month(d), "quarter": F.quarter(d), "year": F.year(d),
            "day_of_month": F.dayofmonth(d), "days_to_month_end": F.datediff(F.last_day(d), d), "season": season(d),
        }
    )
    if holidays is not None:
        days = holidays.select(F.col("date").alias(date)).distinct().withColumn("is_holiday", lit(True))
        out = out.join(days, date, "left").withColumn("is_holiday", F.coalesce("is_holiday", lit(False)))
    return out


def days(df: DataFrame) -> DataFrame:
    """One row for each property and day: repeated ones are averaged, rows without a date dropped."""
    return df.where("stay_date is not null").groupBy("property", "stay_date").agg(F.avg("room_nights").alias("room_nights"))


def demand_features(demand: DataFrame) -> DataFrame:
    """lag_<k>, rolling_mean_<w>, rolling_median_28, rolling_std_28, same_dow_<n>w, same_month_year,
    same_month_historical_mean. A property with less than a year of days has no yearly lag."""
    base = W.partitionBy("property").orderBy(day_number("stay_date"))
    back = lambda w: base.rangeBetween(-w, -1)
    v = F.col("room_nights")
    made: dict[str, Column] = {f"lag_{k}": F.max(v).over(base.rangeBetween(-k, -k)) for k in LAGS}
    made |= {f"rolling_mean_{w}": F.avg(v).over(back(w)) for w in MEANS}
    made |= {"rolling_median_28": F.percentile(v, 0.5).over(back(28)), "rolling_std_28": F.stddev_samp(v).over(back(28)), "same_month_historical_mean": F.avg(v).over(back(30))}
    every = W.partitionBy("property")
    long = F.datediff(F.max("stay_date").over(every), F.min("stay_date").over(every)) >= YEAR_SPAN
    made["lag_365"] = F.when(long, made["lag_365"])
    out = days(demand).withColumns(made)
    return out.withColumns({"same_dow_1w": F.col("lag_7"), "same_dow_2w": F.col("lag_14"), "same_dow_4w": F.col("lag_28"), "same_month_year": F.col("lag_365")})


def missing_features(demand: DataFrame) -> DataFrame:
    """feature, properties: the yearly features that short properties lack."""
    span = demand.where("stay_date is not null").groupBy("property").agg(F.datediff(F.max("stay_date"), F.min("stay_date")).alias("span")).where(F.col("span") < YEAR_SPAN)
    return span.select("property", F.explode(F.array(lit("lag_365"), lit("same_month_year"))).alias("feature")).groupBy("feature").agg(F.array_sort(F.collect_set("property")).alias("properties"))


def expanding_mean(demand: DataFrame) -> DataFrame:
    """Mean of all the property's days up to and with the row's."""
    return days(demand).withColumn("expanding_mean", F.avg("room_nights").over(W.partitionBy("property").orderBy("stay_date").rowsBetween(W.unboundedPreceding, 0)))


def capacity_features(capacity: DataFrame, demand: DataFrame) -> DataFrame:
    """capacity_prev_day, capacity_change, capacity_rolling_mean_7 (over rows), capacity_remaining, capacity_utilization."""
    w = W.partitionBy("property").orderBy("stay_date")
    out = capacity.withColumns({"capacity_prev_day": F.lag("capacity").over(w), "capacity_rolling_mean_7": F.avg("capacity").over(w.rowsBetween(-7, -1))})
    return out.join(demand, ["property", "stay_date"], "left").withColumns(
        {"capacity_change": F.col("capacity") - F.col("capacity_prev_day"), "capacity_remaining": F.col("capacity") - F.col("room_nights"), "capacity_utilization": ratio("room_nights", "capacity")}
    )


def pickup_features(pickup: DataFrame) -> DataFrame:
    """For each snapshot of a stay: pickup_last_<k>d (bookings gained in the last k days), acceleration (last
    seven days less the seven before; null in a stay's first week) and deceleration, volatility (standard
    deviation of the daily gains of up to seven days, days without a snapshot being 0; null below two), and
    pickup_cumulative (running sum of levels).

    Gains between snapshots are sums of daily gains, so sparse snapshots give exact sums."""
    stay = W.partitionBy("property", "stay_date")
    order = stay.orderBy(day_number("snapshot_date"))
    gain = F.col("pickup_rn") - F.lag("pickup_rn").over(order)
    rows = pickup.withColumns({"_gain": F.coalesce(gain, lit(0.0)), "_day": F.datediff("snapshot_date", F.min("snapshot_date").over(stay))})
    total = lambda a, b, c="_gain": F.coalesce(F.sum(c).over(order.rangeBetween(a, b)), lit(0.0))
    n = F.least(F.col("_day") + 1, lit(VOLATILITY))
    mean_square = total(-VOLATILITY + 1, 0, "_gain2") - total(-VOLATILITY + 1, 0) * total(-VOLATILITY + 1, 0) / n
    made = {f"pickup_last_{k}d": total(-k + 1, 0) for k in PICKUP_DAYS}
    made["pickup_acceleration"] = F.when(F.col("_day") >= ACCELERATION, total(-6, 0) - total(-13, -7))
    made["pickup_volatility"] = F.when(n >= 2, F.sqrt(F.greatest(mean_square, lit(0.0)) / (n - 1)))
    made["pickup_cumulative"] = F.sum("pickup_rn").over(order.rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("_gain2", F.col("_gain") * F.col("_gain")).withColumns(made).withColumn("pickup_deceleration", -F.col("pickup_acceleration")).drop("_gain", "_gain2", "_day")


def same_lead(pickup: DataFrame) -> DataFrame:
    """property, lead_days, same_lead_mean, same_lead_median, same_lead_count over all snapshots given."""
    return pickup.groupBy("property", "lead_days").agg(F.avg("pickup_rn").alias("same_lead_mean"), F.percentile("pickup_rn", 0.5).alias("same_lead_median"), F.count("pickup_rn").alias("same_lead_count"))


def panel(remaining: DataFrame, horizon: int, max_stays: int = 365) -> DataFrame:
    """Training rows of the tree models: leads up to the horizon, one row for each (property, stay, lead), the
    last max_stays stays of each property."""
    rows = remaining.where(F.col("lead_days").between(1, horizon)).groupBy("property", "stay_date", "lead_days").agg(F.max("booked").alias("booked"), F.max("remaining").alias("remaining"))
    return rows.withColumn("_n", F.dense_rank().over(W.partitionBy("property").orderBy(F.desc("stay_date")))).where(F.col("_n") <= max_stays).drop("_n")
