"""Queries without an oracle of their own: fitted candidates; and the streaming replay with one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import candidates
from ..streaming import demand as stream
from .facts import CUTOFF, HORIZON
from .forecasts import kept, rounded
from .registry import query


def _one(spark: SparkSession, d: str, model: str) -> DataFrame:
    return rounded(candidates.statistical(kept(spark, d, "demand"), kept(spark, d, "pickup"), CUTOFF, HORIZON, model))


@query()
def ets_forecast(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "ets").drop("low", "high")


@query()
def sarimax_forecast(spark: SparkSession, d: str) -> DataFrame:
    """With the bounds of its 80 % interval."""
    return _one(spark, d, "sarimax")


@query()
def boosted_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Rolled out day by day, each forecast a lag of later ones."""
    return _one(spark, d, "lightgbm").drop("low", "high")


@query("SELECT event_type AS property, CAST(ts AS DATE) AS stay_date, COUNT(*) AS events, round(SUM(value), 4) AS value FROM events GROUP BY 1, 2")
def stream_daily_demand(spark: SparkSession, d: str) -> DataFrame:
    return stream.replay(spark, d)


@query("SELECT event_type AS property, CAST(ts AS DATE) AS stay_date, COUNT(*) AS events, round(SUM(value), 4) AS value FROM events GROUP BY 1, 2")
def batch_daily_demand(spark: SparkSession, d: str) -> DataFrame:
    return stream.daily(spark.read.parquet(f"{d}/events.parquet").select("ts", "event_type", "value")).select("property", "stay_date", "events", F.col("value"))
