"""The canonical facts, from the star-schema tables: demand, bookings by lead time (pickup) and capacity.

A property is a region; room nights are shipped quantities by ship date; a booking is known from its
order date on. All three are plain aggregations that scans, filters and pre-aggregation reach.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..functions.scalars import season

NO_PROPERTY = "__sin_propiedad__"
MAX_LEAD = 365


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Up to so many suppliers (12 bytes each) every executor gets their regions whole; more are joined by a shuffle.
BROADCAST_SUPPLIERS = 1_000_000

_FEW: dict[tuple, bool] = {}


def supplier_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """suppkey, regionkey: each supplier's region, as a number."""
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("suppkey"), "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("regionkey"))
    found = suppliers.join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey")).select("suppkey", "regionkey")
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _FEW:
        _FEW[at] = suppliers.limit(BROADCAST_SUPPLIERS + 1).count() <= BROADCAST_SUPPLIERS
    return F.broadcast(found) if _FEW[at] else found


def named(spark: SparkSession, sf_dir: str, sums: DataFrame, *keys: str) -> DataFrame:
    """property, keys, rn: sums of rn by regionkey and keys, by the regions' names."""
    names = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("regionkey"), F.coalesce("r_name", F.lit(NO_PROPERTY)).alias("property"))
    return sums.join(F.broadcast(names), "regionkey").groupBy("property", *keys).agg(F.sum("rn").alias("rn"))


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """property, stay_date, room_nights. Lines meet their region where they are read and are summed there: a row for each region
    and day is all that a task sends on."""
    lines = table(spark, sf_dir, "lineitem").where("l_shipdate is not null").select(F.col("l_suppkey").alias("suppkey"), F.to_date("l_shipdate").alias("stay_date"), "l_quantity")
    sums = lines.join(supplier_regions(spark, sf_dir), "suppkey").groupBy("regionkey", "stay_date").agg(F.sum("l_quantity").alias("rn"))
    return named(spark, sf_dir, sums, "stay_date").withColumnRenamed("rn", "room_nights")


def pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """property, stay_date, snapshot_date, lead_days, pickup_rn: cumulative bookings as known on snapshot_date. Lines are moved
    once, to their orders, with a region's number for the supplier's; sums by region and days follow in the same tasks."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("snapshot_date"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("suppkey"), F.to_date("l_shipdate").alias("stay_date"), "l_quantity").where("stay_date is not null")
    placed = lines.join(supplier_regions(spark, sf_dir), "suppkey").select("l_orderkey", "regionkey", "stay_date", "l_quantity")
    known = placed.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).where(F.datediff("stay_date", "snapshot_date").between(0, MAX_LEAD))
    sums = known.groupBy("regionkey", "stay_date", "snapshot_date").agg(F.sum("l_quantity").alias("rn"))
    booked = named(spark, sf_dir, sums, "stay_date", "snapshot_date").withColumn("lead_days", F.datediff("stay_date", "snapshot_date"))
    so_far = W.partitionBy("property", "stay_date").orderBy("snapshot_date").rowsBetween(W.unboundedPreceding, 0)
    return booked.select("property", "stay_date", "snapshot_date", "lead_days", F.sum("rn").over(so_far).alias("pickup_rn"))


def capacity(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    """property, stay_date, capacity: the 95th percentile of the property's days, a tenth more in the high
    season, none on 15 September. daily: the demand, if it is at hand."""
    daily = demand(spark, sf_dir) if daily is None else daily
    level = daily.groupBy("property").agg(F.percentile("room_nights", 0.95).alias("p95"))
    lift = F.when(season("stay_date") == "high", 1.1).otherwise(1.0)
    closed = (F.month("stay_date") == 9) & (F.dayofmonth("stay_date") == 15)
    return daily.join(level, "property").select("property", "stay_date", F.when(closed, 0.0).otherwise(F.ceil(F.round(F.col("p95") * lift, 6)).cast("double")).alias("capacity"))
