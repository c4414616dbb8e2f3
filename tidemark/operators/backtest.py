"""Backtests over frozen snapshots: what would have been forecast for a stay, so many days before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from ..functions.metrics import error_metrics
from ..functions.scalars import lead_band

LEADS = (90, 60, 30, 14, 7, 3, 1)


def sampled_stays(demand: DataFrame, last: int = 56, n: int = 8) -> DataFrame:
    """stay_date: of the last observed days every (last // n)-th, the n latest of those."""
    days = demand.select("stay_date").distinct().withColumn("i", F.row_number().over(W.orderBy(F.desc("stay_date"))))  # a row for each calendar day
    recent = days.where(F.col("i") <= last)
    count = recent.agg(F.count("*").alias("c"))
    stride = F.greatest(F.floor(F.col("c") / n), lit(1))
    return recent.crossJoin(F.broadcast(count)).where(((F.col("c") - F.col("i")) % stride == 0)).withColumn("k", F.row_number().over(W.orderBy(F.desc("stay_date")))).where(F.col("k") <= n).select("stay_date")


def requests(stays: DataFrame, leads: tuple[int, ...] = LEADS) -> DataFrame:
    """stay_date, lead_days, cutoff for each stay and lead."""
    return stays.select("stay_date", F.explode(F.array(*[lit(x) for x in leads])).alias("lead_days")).withColumn("cutoff", F.date_sub("stay_date", F.col("lead_days")))


def snapshot(df: DataFrame, request: DataFrame, date: str) -> DataFrame:
    """df's rows as known at each request's cutoff: (stay_date, lead_days, cutoff) x rows up to it. The requests
    are a handful of dates (stays times leads), so they are broadcast; joined rows are aggregated at once by callers."""
    return df.join(F.broadcast(request.withColumnRenamed("stay_date", "target")), F.col(date) <= F.col("cutoff"))


def revisions(demand: DataFrame, stays: DataFrame, leads: tuple[int, ...] = LEADS, k: int = 4) -> DataFrame:
    """property, stay_date, lead_days, forecast, actual: the seasonal naive forecast (mean of the last k same
    weekdays) as it would have been at each lead; lead 0 is the actual itself."""
    asked = requests(stays, leads)
    seen = demand.join(F.broadcast(asked.select(F.col("stay_date").alias("target"), "lead_days", "cutoff")), (F.col("stay_date") <= F.col("cutoff")) & (F.weekday("stay_date") == F.weekday("target")) & (F.col("stay_date") > F.date_sub("cutoff", 7 * 52)))
    ranked = seen.withColumn("n", F.row_number().over(W.partitionBy("property", "target", "lead_days").orderBy(F.desc("stay_date")))).where(F.col("n") <= k)
    made = ranked.groupBy("property", F.col("target").alias("stay_date"), "lead_days").agg(F.avg("room_nights").alias("forecast"))
    actual = demand.join(F.broadcast(stays), "stay_date").select("property", "stay_date", F.col("room_nights").alias("actual"))
    final = actual.select("property", "stay_date", lit(0).alias("lead_days"), F.col("actual").alias("forecast"), "actual")
    return made.join(actual, ["property", "stay_date"], "left").unionByName(final)


def revision_matrix(rows: DataFrame, leads: tuple[int, ...] = LEADS) -> DataFrame:
    """property, stay_date, t_<lead> ..., actual: one row for each stay."""
    return rows.groupBy("property", "stay_date").agg(*[F.max(F.when(F.col("lead_days") == x, F.col("forecast"))).alias(f"t_{x}") for x in leads], F.max("actual").alias("actual"))


def by_level(rows: DataFrame) -> DataFrame:
    """level, property, lead_band and metrics of graded revisions: all, band, property and cell in one pass."""
    graded = rows.where("lead_days > 0 and actual is not null").withColumn("lead_band", lead_band("lead_days"))
    sets = graded.groupingSets([[], ["lead_band"], ["property"], ["property", "lead_band"]], "property", "lead_band").agg(*error_metrics(), F.grouping_id().alias("g"))
    return sets.withColumn("level", F.element_at(F.array(lit("cell"), lit("property"), lit("band"), lit("all")), F.col("g").cast("int") + 1)).drop("g")


def by_lead(rows: DataFrame) -> DataFrame:
    return rows.where("lead_days > 0 and actual is not null").groupBy("lead_days").agg(*error_metrics())
