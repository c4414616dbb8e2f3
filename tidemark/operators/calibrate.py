"""Corrections learnt from fold predictions and from published errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import lit

from ..functions.scalars import lead_band, ratio, season

MIN_OBS, SHRINKAGE, MAX_REL, MIN_CORRECTION, MIN_CONSISTENCY = 20, 30.0, 0.30, 0.005, 0.75


def operative(predictions: DataFrame, champion: str, long_model: str | None = None, split: int = 30) -> DataFrame:
    """The champion's rows; beyond the split those of long_model."""
    return predictions.where((F.col("model") == F.when(F.col("lead_days") > split, lit(long_model or champion)).otherwise(lit(champion))))


def with_profile(rows: DataFrame, profile: DataFrame) -> DataFrame:
    """rows with forecast times the weekday's factor of its property (1 if it has none); of its fold, if the profile has folds."""
    keys = ["property", "dow", *[k for k in ("fold",) if k in profile.columns]]
    return rows.withColumn("dow", F.weekday("stay_date")).join(profile, keys, "left").withColumn("forecast", F.col("forecast") * F.coalesce("factor", lit(1.0))).select(*rows.columns)


def residuals(rows: DataFrame, factors: DataFrame | None = None, decay: float = 1.0) -> DataFrame:
    """property, lead_band, season, residual (forecast * factor - actual), weight (decay to the power of the folds since)."""
    out = rows.withColumns({"lead_band": lead_band("lead_days"), "season": season("stay_date")})
    if factors is not None:  # the season's factor, else the band's: the same as the point is corrected by
        fine = factors.where("season is not null").select("property", "lead_band", "season", F.col("factor").alias("_fine"))
        coarse = factors.where("season is null").select("property", "lead_band", F.col("factor").alias("_coarse"))
        out = out.join(fine, ["property", "lead_band", "season"], "left").join(coarse, ["property", "lead_band"], "left").withColumn("forecast", F.col("forecast") * F.coalesce("_fine", "_coarse", lit(1.0)))
    last = out.agg(F.max("fold").alias("_last"))
    return out.crossJoin(F.broadcast(last)).select("property", "lead_band", "season", (F.col("forecast") - F.col("actual")).alias("residual"), F.pow(lit(decay), F.col("_last") - F.col("fold")).alias("weight"))


def factor(rel: Column, n: Column, consistency: Column, min_obs: int, shrinkage: float, max_rel: float, min_consistency: float) -> Column:
    """1 + (clipped 1 - rel, less 1) * n / (n + shrinkage); 1 if a gate fails or it is within half a percent."""
    raw = F.least(F.greatest(1 - rel, lit(1 - max_rel)), lit(1 + max_rel))
    f = 1 + (raw - 1) * n / (n + shrinkage)
    passes = (n >= min_obs) & (consistency >= min_consistency) & (F.abs(f - 1) >= MIN_CORRECTION)
    return F.when(F.coalesce(passes, lit(False)), f).otherwise(1.0)


def bias_cells(rows: DataFrame, decay: float = 1.0, by_season: bool = True, min_obs: int = MIN_OBS, shrinkage: float = SHRINKAGE, max_rel: float = MAX_REL, min_consistency: float = MIN_CONSISTENCY, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, property, lead_band, season (null: all), n, rel, consistency, factor.

    rel is the weighted bias over the weighted actuals; consistency the weighted share of folds whose bias
    has its sign (a fold bias of 0 counts as negative). A season's own factor applies if it isn't 1, else
    the band's. Folds are summed first, then cells: two small aggregations after one over the rows."""
    last = F.broadcast(rows.groupBy(*keys).agg(F.max("fold").alias("_last")))  # a row for each of the keys' values
    known = rows.where("actual is not null and forecast is not null")
    base = (known.join(last, list(keys)) if keys else known.crossJoin(last)).select(
        *keys, "property", lead_band("lead_days").alias("lead_band"), season("stay_date").alias("season"), "fold", F.pow(lit(decay), F.col("_last") - F.col("fold")).alias("w"), (F.col("forecast") - F.col("actual")).alias("e"), F.abs("actual").alias("a")
    )
    sums = [F.count("*").alias("n"), F.sum(F.col("w") * F.col("e")).alias("we"), F.sum(F.col("w") * F.col("a")).alias("wa"), F.first("w").alias("w")]
    sets = [["property", "lead_band", "fold"]] + ([["property", "lead_band", "season", "fold"]] if by_season else [])
    folds = base.groupingSets([[*keys, *g] for g in sets], *keys, "property", "lead_band", "season", "fold").agg(*sums)
    total = folds.groupBy(*keys, "property", "lead_band", "season").agg(
        F.sum("n").alias("n"), ratio(F.sum("we"), F.sum("wa")).alias("rel"), F.sum("w").alias("all_w"), F.sum(F.when(F.col("we") > 0, F.col("w")).otherwise(0.0)).alias("up_w")
    )
    consistency = ratio(F.when(F.col("rel") > 0, F.col("up_w")).otherwise(F.col("all_w") - F.col("up_w")), "all_w")
    cells = total.withColumn("consistency", consistency).withColumn("own", factor(F.col("rel"), F.col("n"), F.col("consistency"), min_obs, shrinkage, max_rel, min_consistency))
    bands = cells.where("season is null").select(*keys, "property", "lead_band", F.col("own").alias("band_factor"))
    return cells.join(bands, [*keys, "property", "lead_band"]).select(*keys, "property", "lead_band", "season", "n", "rel", "consistency", F.when(F.col("season").isNull() | (F.col("own") != 1), F.col("own")).otherwise(F.col("band_factor")).alias("factor"))


def level_factors(published: DataFrame, window: int = 60, trigger: float = 4.0, min_obs: int = 10, shrinkage: float = 10.0, max_rel: float = 0.20) -> DataFrame:
    """property, n, rel, tracking_signal, factor from published errors (property, stay_date, forecast, actual) of
    the last days: the correction grows with the tracking signal up to the trigger."""
    last = published.agg(F.max("stay_date").alias("_last"))
    rows = published.where("actual is not null and forecast is not null").crossJoin(F.broadcast(last)).where(F.datediff("_last", "stay_date") < window).withColumn("e", F.col("forecast") - F.col("actual"))
    g = rows.groupBy("property").agg(F.count("*").alias("n"), ratio(F.sum("e"), F.sum(F.abs("actual"))).alias("rel"), ratio(F.sum("e"), F.avg(F.abs("e"))).alias("tracking_signal"))
    raw = F.least(F.greatest(-F.col("rel"), lit(-max_rel)), lit(max_rel)) * F.least(F.abs("tracking_signal") / trigger, lit(1.0)) * F.col("n") / (F.col("n") + shrinkage)
    return g.withColumn("factor", F.when((F.col("n") >= min_obs) & F.col("tracking_signal").isNotNull(), 1 + raw).otherwise(1.0))
