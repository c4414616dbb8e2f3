"""Why a forecast is what it is: contributions that add up to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from ..functions.scalars import driver, ratio


def contributions(forecasts: DataFrame, features: list[str], importance: dict[str, float], base: str = "base_value", value: str = "final_forecast_rn", raw: str | None = "raw_forecast_rn") -> DataFrame:
    """property, stay_date, feature, driver, contribution: importance times value, scaled to add up to value - base.
    Where the capacity cut the forecast, that is a contribution of its own (negative) and the others add up
    to the rest; if all are 0 they share it evenly."""
    parts = F.array(*[F.struct(lit(f).alias("feature"), (F.coalesce(F.col(f).cast("double"), lit(0.0)) * importance[f]).alias("c")) for f in features])
    cut = F.when(F.col(raw) > F.col(value), F.col(value) - F.col(raw)).otherwise(0.0) if raw else lit(0.0)
    rows = forecasts.select("property", "stay_date", (F.col(value) - F.col(base) - cut).alias("_goal"), cut.alias("_cut"), parts.alias("_parts"))
    rows = rows.withColumn("_sum", F.aggregate("_parts", lit(0.0), lambda s, x: s + x["c"]))
    scaled = F.transform("_parts", lambda x: F.struct(x["feature"].alias("feature"), F.when(F.col("_sum") == 0, F.col("_goal") / len(features)).otherwise(x["c"] * F.try_divide(F.col("_goal"), F.col("_sum"))).alias("contribution")))
    capped = F.when(F.col("_cut") < 0, F.array(F.struct(lit("capacity_constraint").alias("feature"), F.col("_cut").alias("contribution")))).otherwise(F.array().cast("array<struct<feature: string, contribution: double>>"))
    made = rows.select("property", "stay_date", F.explode(F.concat(scaled, capped)).alias("x")).select("property", "stay_date", "x.feature", "x.contribution")
    return made.withColumn("driver", F.when(F.col("feature") == "capacity_constraint", "capacity_constraint").otherwise(driver("feature")))


def tree_contributions(forecasts: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """property, stay_date, lead_days, feature, driver, contribution of forecasts by boosted trees (with base and parts, the Shapley value
    of each feature in order). Where the trees' output is below 0, `floor` is what the forecast gained by that; with the
    base value, contributions add up to the forecast. Forecasts without parts (mean levels) have none."""
    parts = F.transform("parts", lambda v, i: F.struct(F.element_at(F.array(*[lit(f) for f in features]), i + 1).alias("feature"), v.alias("contribution")))
    gained = F.greatest(-(F.col("base") + F.aggregate("parts", lit(0.0), lambda s, v: s + v)), lit(0.0))
    rows = forecasts.where("parts is not null").select("property", "stay_date", "lead_days", F.explode(F.concat(parts, F.when(gained > 0, F.array(F.struct(lit("floor").alias("feature"), gained.alias("contribution")))).otherwise(F.array().cast("array<struct<feature: string, contribution: double>>")))).alias("x"))
    return rows.select("property", "stay_date", "lead_days", "x.feature", "x.contribution").withColumn("driver", driver("feature"))


def reconciles(explained: DataFrame, forecasts: DataFrame, base: str = "base_value", value: str = "final_forecast_rn", tolerance: float = 1e-6) -> DataFrame:
    """rows, off: forecasts whose contributions don't add up."""
    sums = explained.groupBy("property", "stay_date").agg(F.sum("contribution").alias("s"))
    both = forecasts.join(sums, ["property", "stay_date"])
    return both.agg(F.count("*").alias("rows"), F.count_if(F.abs(F.col(base) + F.col("s") - F.col(value)) > tolerance).alias("off"))


def global_importance(explained: DataFrame) -> DataFrame:
    """feature, mean_abs, share."""
    g = explained.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))
    total = g.agg(F.sum("mean_abs").alias("_t"))
    return g.crossJoin(F.broadcast(total)).withColumn("share", ratio("mean_abs", "_t")).drop("_t")


def top_drivers(explained: DataFrame, n: int = 5) -> DataFrame:
    """The n largest contributions of each forecast, with rank (ties by name)."""
    w = W.partitionBy("property", "stay_date").orderBy(F.desc(F.abs("contribution")), "feature")
    return explained.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def summary(explained: DataFrame, n: int = 5) -> DataFrame:
    """property, stay_date, text: the top drivers in words."""
    rows = top_drivers(explained, n)
    line = F.format_string("%s: %+.1f", "driver", "contribution")
    return rows.groupBy("property", "stay_date").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda x: x["line"]), "; ").alias("text"))
