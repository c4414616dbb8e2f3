"""From raw forecasts to published ones: floor and cap, occupancy, reconciliation, intervals, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from ..functions.scalars import lead_band, ratio, season

LOW, HIGH, MIN_RESIDUALS = 0.1, 0.9, 20


def floor_and_cap(df: DataFrame) -> DataFrame:
    """final_forecast_rn = min(max(raw, booked), capacity), booked_floor_applied, capacity_constraint_applied.
    An unknown capacity gives no final forecast; unknown bookings set no floor."""
    raw, booked, cap = F.col("raw_forecast_rn"), F.col("current_booked_rn"), F.col("capacity")
    lifts = F.coalesce(raw < booked, lit(False))
    floored = F.when(lifts, booked).otherwise(raw)
    caps = F.coalesce(floored > cap, lit(False))
    return df.withColumns({"final_forecast_rn": F.when(cap.isNotNull(), F.when(caps, cap).otherwise(floored)), "booked_floor_applied": lifts, "capacity_constraint_applied": caps})


def alerts(published: DataFrame) -> DataFrame:
    """property, stay_date, kind, amount: floors, bookings over capacity and caps (one row each)."""
    raw, booked, cap = F.col("raw_forecast_rn"), F.col("current_booked_rn"), F.col("capacity")
    kinds = F.array_compact(
        F.array(
            F.when(F.col("booked_floor_applied"), F.struct(lit("booked_floor").alias("kind"), (booked - raw).alias("amount"))),
            F.when(booked > cap, F.struct(lit("booked_over_capacity").alias("kind"), (cap - booked).alias("amount"))),
            F.when(F.col("capacity_constraint_applied"), F.struct(lit("capacity").alias("kind"), (F.greatest(raw, F.coalesce(booked, raw)) - cap).alias("amount"))),
        )
    )
    return published.select("property", "stay_date", F.explode(kinds).alias("a")).select("property", "stay_date", "a.kind", "a.amount")


def occupancy(df: DataFrame) -> DataFrame:
    o = ratio("final_forecast_rn", "capacity")
    return df.withColumns({"forecast_occupancy": o, "occupancy_out_of_range": F.coalesce((o < 0) | (o > 1), lit(False))})


def reconcile(forecast: DataFrame, portfolio: DataFrame | None = None) -> DataFrame:
    """stay_date, bottom_up, portfolio, gap: property sums against an independent portfolio forecast (missing: 0). `reconciled` sums it up."""
    up = forecast.groupBy("stay_date").agg(F.sum("final_forecast_rn").alias("bottom_up"))
    if portfolio is None:
        return up.withColumns({"portfolio": F.col("bottom_up"), "gap": lit(0.0)})
    both = up.join(portfolio.select("stay_date", F.col("forecast").alias("portfolio")), "stay_date", "full_outer").na.fill(0.0, ["bottom_up", "portfolio"])
    return both.withColumn("gap", F.col("portfolio") - F.col("bottom_up"))


def reconciled(days: DataFrame) -> DataFrame:
    """total_bottom_up, total_portfolio, total_gap, gap_pct (share of the properties' total, 0 if that is 0), days_off (gaps of more
    than half a night): one row over `reconcile`."""
    g = days.agg(F.sum("bottom_up").alias("total_bottom_up"), F.sum("portfolio").alias("total_portfolio"), F.sum("gap").alias("total_gap"), F.count_if(F.abs("gap") > 0.5).alias("days_off"))
    return g.withColumn("gap_pct", F.coalesce(F.abs(ratio("total_gap", "total_bottom_up")), lit(0.0)))


def with_capacity(df: DataFrame, capacity: DataFrame, cutoff: str, default: float = 100.0) -> DataFrame:
    """df with capacity: the date's largest known one, else the property's median up to the cutoff, else default."""
    day = capacity.groupBy("property", "stay_date").agg(F.max("capacity").alias("_day"))
    median = capacity.where(F.col("stay_date") <= lit(cutoff).cast("date")).groupBy("property").agg(F.percentile("capacity", 0.5).alias("_median"))
    return df.join(day, ["property", "stay_date"], "left").join(median, "property", "left").withColumn("capacity", F.coalesce("_day", "_median", lit(default))).drop("_day", "_median")


def residual_cells(residuals: DataFrame) -> DataFrame:
    """property, lead_band, season (null: all), n, q10, q90 of residual at every level of the ladder, in one pass."""
    sets = residuals.groupingSets([[], ["property"], ["lead_band"], ["property", "lead_band"], ["property", "lead_band", "season"]], "property", "lead_band", "season")
    return sets.agg(F.count("residual").alias("n"), F.percentile("residual", LOW).alias("q10"), F.percentile("residual", HIGH).alias("q90"), F.grouping_id().alias("level"))


LADDER = ((0, ["property", "lead_band", "season"]), (1, ["property", "lead_band"]), (3, ["property"]), (5, ["lead_band"]), (7, []))


def weighted_cells(residuals: DataFrame, ranges: int | None = None) -> DataFrame:
    """residual_cells with weights: values sit at the middle of their cumulative weight, as a share of the last one's, and are interpolated;
    where all weights of a cell are equal it is the usual linear quantile. Nulls and weights of 0 don't count.

    Each residual is put into its cell of all five levels at once; cumulative weights are taken by ranges of the residual, so the
    cell of all of them is the work of many tasks, and the two values around a quantile are found by partial aggregation."""
    from .ordered import in_ranges, running_sum

    keys = ["level", "property", "lead_band", "season"]
    part = lambda level, on: F.struct(lit(level).cast("long").alias("level"), *[(F.col(k) if k in on else lit(None).cast("string")).alias(k) for k in keys[1:]])
    known = in_ranges(residuals.where("residual is not null and weight > 0"), "residual", ranges)
    rows = known.select("residual", "weight", "_range", F.explode(F.array(*[part(level, on) for level, on in LADDER])).alias("c")).select("c.*", "residual", "weight", "_range")
    placed = running_sum(rows, keys, "residual", ["weight"], "weight").withColumn("m", F.col("upto") - F.col("weight") / 2)
    ends = placed.groupBy(*keys).agg(F.count("*").alias("n"), F.min("m").alias("_first"), F.max("m").alias("_last"), (F.min("weight") == F.max("weight")).alias("_even"))
    same = F.col("l.level") == F.col("r.level")
    for k in keys[1:]:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    both = placed.alias("l").join(ends.alias("r"), same).select("l.*", "n", "_first", "_last", "_even")
    p = F.coalesce(F.when(F.col("_even"), ratio(F.col("m") - F.col("_first"), F.col("_last") - F.col("_first"))).otherwise(ratio("m", "_last")), lit(0.0))
    both = both.withColumn("p", p)
    point = F.struct("p", F.col("residual").alias("v"))
    ends_of = [f(F.when(c, point)).alias(f"_{x}{i}") for i, share in enumerate((LOW, HIGH)) for x, f, c in (("a", F.max, F.col("p") <= share), ("b", F.min, F.col("p") >= share))]
    found = both.groupBy(*keys, "n").agg(*ends_of)

    def between(i: int, share: float) -> Column:
        a, b = F.col(f"_a{i}"), F.col(f"_b{i}")
        mixed = a["v"] + (b["v"] - a["v"]) * F.coalesce(ratio(lit(share) - a["p"], b["p"] - a["p"]), lit(0.0))
        return F.when(a.isNull(), b["v"]).when(b.isNull(), a["v"]).otherwise(mixed)

    return found.select(*keys[1:], "n", between(0, LOW).alias("q10"), between(1, HIGH).alias("q90"), "level")


def intervals(df: DataFrame, cells: DataFrame, min_residuals: int = MIN_RESIDUALS) -> DataFrame:
    """df with p10, p50, p90 (p50 is the point): from the first level with enough residuals of (property, band,
    season), (property, band), property, band, all. p10 <= p50 <= p90 within 0 and the capacity; no residuals: null."""
    rows = df.withColumns({"lead_band": lead_band("lead_days"), "season": season("stay_date")})
    picks = []
    for level, keys in LADDER:
        cell = cells.where((F.col("level") == level) & (F.col("n") >= min_residuals)).select(*keys, F.struct("q10", "q90").alias(f"_q{level}"))
        rows = rows.join(cell, keys, "left") if keys else rows.join(F.broadcast(cell), lit(True), "left")
        picks.append(F.col(f"_q{level}"))
    q, point = F.coalesce(*picks), F.col("final_forecast_rn")
    inside = lambda c: F.least(F.greatest(c, lit(0.0)), F.coalesce(F.col("capacity"), c))
    low, high = inside(point - q["q90"]), inside(point - q["q10"])
    return rows.withColumns({"p10": F.when(q.isNotNull(), F.least(low, point)), "p50": point, "p90": F.when(q.isNotNull(), F.greatest(high, point)), "interval_missing": q.isNull()}).drop("lead_band", "season", *[f"_q{k}" for k, _ in LADDER])


def weighted_quantiles(df: DataFrame, keys: list[str], value: str, weight: str, share: float) -> DataFrame:
    """keys, quantile: values sit at the middle of their cumulative weight and are interpolated; with equal
    weights it is the usual linear quantile. Weights of 0 and nulls don't count."""
    rows = df.where((F.col(weight) > 0) & F.col(value).isNotNull())
    w = W.partitionBy(*keys)
    order = w.orderBy(value, weight).rowsBetween(W.unboundedPreceding, 0)
    middle = F.sum(weight).over(order) - F.col(weight) / 2
    placed = rows.select(*keys, F.col(value).alias("v"), middle.alias("m"))
    ends = W.partitionBy(*keys)
    at = F.coalesce(ratio(F.col("m") - F.min("m").over(ends), F.max("m").over(ends) - F.min("m").over(ends)), lit(0.0))
    placed = placed.withColumn("p", at)
    low, high = F.col("p") <= share, F.col("p") >= share
    found = placed.groupBy(*keys).agg(F.max(F.when(low, F.struct("p", "v"))).alias("a"), F.min(F.when(high, F.struct("p", "v"))).alias("b"))
    a, b = F.col("a"), F.col("b")
    mixed = a["v"] + (b["v"] - a["v"]) * F.coalesce(ratio(lit(share) - a["p"], b["p"] - a["p"]), lit(0.0))
    return found.select(*keys, F.when(a.isNull(), b["v"]).when(b.isNull(), a["v"]).otherwise(mixed).alias("quantile"))


def percentile_order_breaks(df: DataFrame) -> Column:
    return F.count_if((F.col("p10") > F.col("p50")) | (F.col("p50") > F.col("p90"))).alias("breaks")


def calibrate_bands(df: DataFrame, factors: DataFrame, shrinkage: float = 30.0, low: float = 0.6, high: float = 1.5, min_pool: int = 120) -> DataFrame:
    """df with its band widened or narrowed around p50 by the property's factor k (n observations), shrunk by
    n / (n + shrinkage) towards 1 and clipped; factors from fewer than min_pool observations don't apply."""
    k = 1 + (F.col("k") - 1) * F.col("n") / (F.col("n") + shrinkage)
    k = F.when(F.col("n") >= min_pool, F.least(F.greatest(k, lit(low)), lit(high))).otherwise(1.0)
    rows = df.join(factors.select("property", F.col("k"), F.col("n")), "property", "left").withColumn("band_factor", F.coalesce(k, lit(1.0)))
    cap = lambda c: F.least(F.greatest(c, lit(0.0)), F.coalesce(F.col("capacity"), c))
    return rows.withColumns({"p10": cap(F.col("p50") - (F.col("p50") - F.col("p10")) * F.col("band_factor")), "p90": cap(F.col("p50") + (F.col("p90") - F.col("p50")) * F.col("band_factor"))}).drop("k", "n")


def apply_factors(df: DataFrame, factors: DataFrame, value: str = "raw_forecast_rn", keys: tuple[str, ...] = ()) -> DataFrame:
    """df with value times the bias factor of its (property, lead band, season), else of its (property, lead
    band), else 1; bias_correction_factor says which. keys: further columns of both, such as the day of the run."""
    rows = df.withColumns({"lead_band": lead_band("lead_days"), "season": season("stay_date")})
    fine = factors.where("season is not null").select(*keys, "property", "lead_band", "season", F.col("factor").alias("_fine"))
    coarse = factors.where("season is null").select(*keys, "property", "lead_band", F.col("factor").alias("_coarse"))
    rows = rows.join(fine, [*keys, "property", "lead_band", "season"], "left").join(coarse, [*keys, "property", "lead_band"], "left")
    f = F.coalesce("_fine", "_coarse", lit(1.0))
    return rows.withColumns({"bias_correction_factor": f, value: F.col(value) * f}).drop("_fine", "_coarse", "lead_band", "season")


def apply_levels(df: DataFrame, levels: DataFrame, value: str = "raw_forecast_rn") -> DataFrame:
    """df with value times its property's level factor (1 if it has none), before band factors and limits; level_correction_factor says which."""
    rows = df.join(levels.select("property", F.col("factor").alias("_f")), "property", "left").withColumn("level_correction_factor", F.coalesce("_f", lit(1.0)))
    return rows.withColumn(value, F.col(value) * F.col("level_correction_factor")).drop("_f")


def cold_start(demand: DataFrame, cutoff: str, days: int = 365) -> DataFrame:
    """property, history_days of those with less history than a year at the cutoff."""
    seen = demand.where(F.col("stay_date") <= lit(cutoff).cast("date")).groupBy("property").agg((F.datediff(lit(cutoff).cast("date"), F.min("stay_date")) + 1).alias("history_days"))
    return seen.where(F.col("history_days") < days)


REQUIRED = ("property", "stay_date", "forecast_date", "lead_days", "current_booked_rn", "capacity", "raw_forecast_rn", "final_forecast_rn", "p10_forecast", "p50_forecast", "p90_forecast", "model_name", "model_version", "forecast_run_timestamp")
EXTENDED = ("historical_same_day_rn", "expected_pickup_rn", "pickup_rate", "forecast_occupancy", "forecast_bias", "confidence_level", "bias_correction_factor")


def forecast_table(df: DataFrame) -> DataFrame:
    """The published columns in order; missing required ones are null and listed in missing_required."""
    missing = [c for c in REQUIRED if c not in df.columns]
    there = [c for c in EXTENDED if c in df.columns]
    return df.select(*[F.col(c) if c in df.columns else lit(None).cast("string").alias(c) for c in REQUIRED], *there, lit(",".join(missing)).alias("missing_required"))
