"""Evaluation: breakdowns of error, coverage of intervals, band factors, significance, temporal windows."""

from __future__ import annotations

import math
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from ..functions.metrics import error_metrics
from ..functions.scalars import band_order, lead_band, ratio, season, week_start


def by(df: DataFrame, *keys: str, actual: str = "actual", forecast: str = "forecast") -> DataFrame:
    """Metrics for each group; groups with a null key or without a pair are left out."""
    rows = df
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*keys).agg(*error_metrics(actual, forecast)).where("n_obs > 0")


def by_lead_band(df: DataFrame) -> DataFrame:
    return by(df.withColumn("lead_band", lead_band("lead_days")), "lead_band").withColumn("band_order", band_order("lead_band"))


def by_property(df: DataFrame) -> DataFrame:
    """With mean_actual, p10_actual and rank by wmape (ties by name)."""
    extra = df.where("actual is not null and forecast is not null").groupBy("property").agg(F.avg("actual").alias("mean_actual"), F.percentile("actual", 0.1).alias("p10_actual"))
    ranked = by(df, "property").join(extra, "property")
    return ranked.withColumn("rank", F.row_number().over(W.orderBy(F.asc_nulls_last("wmape"), "property")))  # a row for each property


def weekly(df: DataFrame, *keys: str) -> DataFrame:
    """Both sides summed over Monday-to-Sunday weeks (null: 0) before the error is measured."""
    sums = df.groupBy(*keys, week_start("stay_date").alias("week")).agg(F.coalesce(F.sum("actual"), lit(0.0)).alias("actual"), F.coalesce(F.sum("forecast"), lit(0.0)).alias("forecast"))
    return by(sums, *keys)


def ranking(metrics: DataFrame) -> DataFrame:
    """best, worst, wmape_std, worst_bias of a by-property table."""
    order = lambda c: F.struct(c, "property")
    return metrics.agg(F.min_by("property", order("wmape")).alias("best"), F.max_by("property", order("wmape")).alias("worst"), F.stddev_samp("wmape").alias("wmape_std"), F.max_by("bias", order("wmape")).alias("worst_bias"))


def seasonality(df: DataFrame) -> DataFrame:
    """dimension (month, dow, day_type, season), value and metrics, in one pass over grouping sets."""
    rows = df.withColumns({"month": F.month("stay_date"), "dow": F.weekday("stay_date"), "day_type": F.when(F.weekday("stay_date") >= 5, "weekend").otherwise("weekday"), "season": season("stay_date")})
    names = ["month", "dow", "day_type", "season"]
    sets = rows.groupingSets([[n] for n in names], *names).agg(*error_metrics(), *[F.grouping(n).alias(f"_{n}") for n in names])
    dimension, value = F.coalesce(*[F.when(F.col(f"_{n}") == 0, n) for n in names]), F.coalesce(*[F.when(F.col(f"_{n}") == 0, F.col(n).cast("string")) for n in names])
    return sets.withColumns({"dimension": dimension, "value": value}).where("n_obs > 0").drop(*names, *[f"_{n}" for n in names])


def systematic(breakdown: DataFrame, group: str, threshold: float = 0.05, min_obs: int = 10) -> DataFrame:
    """group, direction, bias of groups with enough observations and bias."""
    return breakdown.where((F.col("n_obs") >= min_obs) & (F.abs("bias") >= threshold)).select(F.col(group).cast("string").alias("group"), F.when(F.col("bias") < 0, "under").otherwise("over").alias("direction"), "bias", "n_obs")


def coverage(df: DataFrame) -> DataFrame:
    """level (global, property, band, cell), property, lead_band, n, coverage: share of actuals within [p10, p90]."""
    rows = df.where("actual is not null and p10 is not null and p90 is not null").withColumns({"lead_band": lead_band("lead_days"), "hit": F.col("actual").between(F.col("p10"), F.col("p90")).cast("double")})
    sets = rows.groupingSets([[], ["property"], ["lead_band"], ["property", "lead_band"]], "property", "lead_band").agg(F.count("*").alias("n"), F.avg("hit").alias("coverage"), F.grouping_id().alias("g"))
    level = F.element_at(F.array(lit("cell"), lit("property"), lit("band"), lit("global")), F.col("g").cast("int") + 1)
    return sets.select(level.alias("level"), "property", "lead_band", "n", "coverage")


def band_factors(df: DataFrame, nominal: float = 0.8, low: int = 60, high: int = 150, min_obs: int = 60, shrinkage: float = 30.0) -> DataFrame:
    """property, n, k: the factor (hundredths, low to high) on the half-widths around p50 at which a
    property's coverage meets nominal. Under-covered: the least k that reaches it (none: the property is left
    out). Over-covered: a hundredth above the largest k up to 1 that falls below it. Shrunk by n / (n + shrinkage).

    Each row is reduced to the least k that covers it, so a property costs a row for each step, not for each row and step."""
    rows = df.where("actual is not null and p10 is not null and p90 is not null")
    above = ratio(F.col("actual") - F.col("p50"), F.col("p90") - F.col("p50"))
    below = ratio(F.col("p50") - F.col("actual"), F.col("p50") - F.col("p10"))
    side = F.when(F.col("actual") > F.col("p50"), above).when(F.col("actual") < F.col("p50"), below).otherwise(0.0)
    need = F.when(side.isNotNull(), F.greatest(lit(low), F.ceil(F.round(side * 100, 6))))  # null: never covered
    counts = rows.groupBy("property", need.cast("int").alias("need")).agg(F.count("*").alias("c"))
    total = counts.groupBy("property").agg(F.sum("c").alias("n")).where(F.col("n") >= min_obs)
    spine = total.select("property", "n", F.explode(F.sequence(lit(low), lit(high))).alias("step"))
    upto = spine.join(counts.where(F.col("need") <= high), ["property"], "left").groupBy("property", "n", "step").agg((F.coalesce(F.sum(F.when(F.col("need") <= F.col("step"), F.col("c"))), lit(0)) / F.col("n")).alias("cov"))
    k = upto.groupBy("property", "n").agg(
        F.max(F.when(F.col("step") == 100, F.col("cov"))).alias("now"), F.min(F.when(F.col("cov") >= nominal, F.col("step"))).alias("reach"),
        F.coalesce(F.max(F.when((F.col("cov") < nominal) & (F.col("step") <= 100), F.col("step"))) + 1, lit(low)).alias("shrink"),
    )
    step = F.when(F.col("now") < nominal, F.col("reach")).otherwise(F.col("shrink"))
    return k.where(step.isNotNull()).select("property", "n", (1 + (step / 100 - 1) * F.col("n") / (F.col("n") + shrinkage)).alias("k"))


def loss_differences(panel: DataFrame, a: str, b: str) -> DataFrame:
    """fold, stay_date, d = |error of a| - |error of b| where both models have the day."""
    e = panel.where(F.col("model").isin(a, b)).groupBy("fold", "stay_date").agg(*[F.max(F.when(F.col("model") == m, F.abs(F.col("forecast") - F.col("actual")))).alias(f"_{k}") for k, m in enumerate((a, b))])
    return e.select("fold", "stay_date", (F.col("_0") - F.col("_1")).alias("d")).where("d is not null")


def dm_moments(differences: DataFrame, horizon: int) -> DataFrame:
    """lag, n, mean, autocovariance (over n) for the lags 0 to horizon - 1: one window for all lags."""
    order = W.partitionBy(lit(0)).orderBy("fold", "stay_date")  # one series: a number for each day of the folds
    mean = differences.agg(F.avg("d").alias("m"), F.count("*").alias("n"))
    rows = differences.crossJoin(F.broadcast(mean)).withColumn("x", F.col("d") - F.col("m"))
    rows = rows.withColumns({f"_{k}": F.col("x") * F.lag("x", k).over(order) for k in range(horizon)})
    lags = rows.select("n", "m", F.explode(F.array(*[F.struct(lit(k).alias("lag"), F.col(f"_{k}").alias("xy")) for k in range(horizon)])).alias("l"))
    return lags.groupBy(F.col("l.lag").alias("lag"), "n", F.col("m").alias("mean")).agg((F.coalesce(F.sum("l.xy"), lit(0.0)) / F.col("n")).alias("autocovariance")).where("lag < n")


def diebold_mariano(panel: DataFrame, a: str, b: str, horizon: int) -> dict:
    """statistic and two-sided p of equal accuracy: Bartlett weights up to lag horizon - 1, small-sample factor
    of Harvey, Leybourne and Newbold. None for fewer than 5 days or no variance."""
    moments = dm_moments(loss_differences(panel, a, b), horizon).orderBy("lag").collect()  # horizon rows
    if not moments or moments[0]["n"] < 5:
        return {"n": moments[0]["n"] if moments else 0, "statistic": None, "p": None}
    n, mean, h = moments[0]["n"], moments[0]["mean"], min(horizon, moments[0]["n"])
    variance = moments[0]["autocovariance"] + 2 * sum((1 - r["lag"] / h) * r["autocovariance"] for r in moments[1:h])
    if variance <= 0:
        return {"n": n, "statistic": None, "p": None}
    factor = max(0.0, (n + 1 - 2 * h + h * (h - 1) / n) / n)
    statistic = mean / math.sqrt(variance / n) * math.sqrt(factor)
    return {"n": n, "statistic": statistic, "p": 1 - math.erf(abs(statistic) / math.sqrt(2))}


def two_sided(z: Column) -> Column:
    """Probability of a standard normal value at least as far from 0, to 1.5e-7 (a rational approximation of erf)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = lit(0.0)
    for c in (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592):
        poly = (poly + c) * t
    return poly * F.exp(-x * x)


def dm_test(differences: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, n, horizon, statistic, p of differences (keys, fold, stay_date, d): diebold_mariano as one plan. Lags go up to the
    median number of days of a fold. A series is a number for each day of a key's folds, so it fits in an array."""
    sizes = differences.groupBy(*keys, "fold").agg(F.count_distinct("stay_date").alias("_days"), F.collect_list(F.struct("stay_date", "d")).alias("_part"))
    rows = sizes.groupBy(*keys).agg(F.median("_days").cast("int").alias("horizon"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("fold", F.array_sort("_part").alias("part")))), lambda x: x["part"])).alias("_all"))
    total = lambda a: F.aggregate(a, lit(0.0), lambda s, v: s + v)
    n = F.size("_all")
    rows = rows.withColumn("n", n.cast("long")).withColumn("_d", F.transform("_all", lambda x: x["d"]))
    rows = rows.withColumn("_mean", F.try_divide(total(F.col("_d")), F.col("n"))).withColumn("_x", F.transform("_d", lambda v: v - F.col("_mean")))
    h = F.least(F.col("horizon"), F.col("n").cast("int"))

    def covariance(k: Column) -> Column:
        """Over the n - k pairs that lie k days apart, divided by n."""
        size = n - k
        return total(F.zip_with(F.slice("_x", k + 1, size), F.slice("_x", lit(1), size), lambda a, b: a * b)) / F.nullif("n", lit(0))

    lags = F.when(h > 1, F.sequence(lit(1), h - 1)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("_h", h).withColumn("_v", covariance(lit(0)) + 2 * F.aggregate(lags, lit(0.0), lambda s, k: s + (1 - k / F.col("_h")) * covariance(k)))
    count, step = F.nullif("n", lit(0)), F.col("_h")
    small = F.sqrt(F.greatest((count + 1 - 2 * step + step * (step - 1) / count) / count, lit(0.0)))
    rows = rows.withColumn("statistic", F.when((count >= 5) & (F.col("_v") > 0), F.col("_mean") / F.sqrt(F.col("_v") / count) * small))
    return rows.select(*keys, "n", "horizon", "statistic", two_sided(F.col("statistic")).alias("p"))


def dm_horizon(panel: DataFrame, default: int = 30) -> int:
    """Median over folds of their different days."""
    seen = panel.groupBy("fold").agg(F.count_distinct("stay_date").alias("n")).agg(F.median("n").alias("m")).first()["m"]
    return int(seen) if seen else default


def temporal_windows(start: date, end: date, train_days: int, val_days: int, step: int | None = None, expanding: bool = True) -> list[dict]:
    """Training [train_start, train_end) and validation [train_end, val_end) windows up to end."""
    out, cut = [], start + timedelta(train_days)
    while cut + timedelta(val_days) <= end + timedelta(1):
        out.append({"train_start": start if expanding else cut - timedelta(train_days), "train_end": cut, "val_end": cut + timedelta(val_days)})
        cut += timedelta(step or val_days)
    return out


def in_window(df: DataFrame, window: dict, part: str, date_col: str = "stay_date") -> DataFrame:
    low, high = (window["train_start"], window["train_end"]) if part == "train" else (window["train_end"], window["val_end"])
    return df.where((F.col(date_col) >= lit(low)) & (F.col(date_col) < lit(high)))


def at_cutoffs(history: DataFrame, cutoffs: list[str], forecast_fn, date_col: str = "stay_date") -> DataFrame:
    """For each frozen cutoff forecast_fn(history up to it, cutoff) -> property, stay_date, forecast; with actuals."""
    from functools import reduce

    parts = []
    for c in cutoffs:
        made = forecast_fn(history.where(F.col(date_col) <= lit(c).cast("date")), c)
        parts.append(made.withColumn("cutoff", lit(c).cast("date")).withColumn("lead_days", F.datediff(date_col, "cutoff")))
    return reduce(DataFrame.unionByName, parts).join(history.select("property", date_col, F.col("room_nights").alias("actual")), ["property", date_col])


def without(df: DataFrame, properties: DataFrame) -> DataFrame:
    return df.join(properties.select("property").distinct(), "property", "left_anti")


def evaluated(known: DataFrame, graded: DataFrame, closed: tuple[str, ...] = ()) -> DataFrame:
    """property, evaluated, n_obs, reason (closed: left out by configuration, whether known or not; no_actuals: no graded row with
    an actual; null: evaluated) of each property."""
    shut = known.sparkSession.createDataFrame([(p,) for p in sorted(set(closed))], "property string")
    every = known.select("property").where("property is not null").union(shut).distinct()
    seen = graded.where("actual is not null").groupBy("property").agg(F.count("*").alias("n"))
    is_shut = F.col("property").isin(*closed) if closed else lit(False)
    made = every.join(seen, "property", "left").withColumn("n_obs", F.when(is_shut, 0).otherwise(F.coalesce("n", lit(0))).cast("long"))
    return made.select("property", (F.col("n_obs") > 0).alias("evaluated"), "n_obs", F.when(is_shut, "closed").when(F.col("n_obs") == 0, "no_actuals").alias("reason"))


def hit(p10: Column, p90: Column, actual: Column) -> Column:
    return actual.between(p10, p90)
