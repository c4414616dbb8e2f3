"""Running values over groups of any size: a window never holds more than one range of the order, and what the
ranges before it come to is carried over one row for each group and range."""

from __future__ import annotations

from math import inf, isfinite

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

RANGE = "_range"


def in_ranges(df: DataFrame, order: str, ranges: int | None = None, like: DataFrame | None = None) -> DataFrame:
    """df with RANGE, ascending with a numeric, date or time column: about as many rows in each of the `ranges` (as many as there are
    shuffle partitions if none are given). Bounds come from a sketch of the column, so only they reach the driver; equal
    values share a range. Nulls are in the first. like: a frame with the column and
    no more to read, to take the bounds from.

    No lambda counts the bounds: Spark numbers a lambda's variables from 0 when it compares expressions, and takes a column of
    that number, as the first table that a session reads has, for one of them; a union above then fails (key not found)."""
    from pyspark.ml.feature import Bucketizer

    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numeric = F.col(order).cast("double") if dict(df.dtypes)[order] not in ("date", "timestamp", "timestamp_ntz") else F.col(order).cast("timestamp").cast("double")
    bounds = (like or df).agg(F.percentile_approx(numeric, [k / n for k in range(1, n)] or [0.5])).first()[0] or []
    bounds = sorted({b for b in bounds if isfinite(b)})
    if not bounds:
        return df.withColumn(RANGE, lit(0))
    cut = Bucketizer(splits=[-inf, *bounds, inf], inputCol="_at", outputCol=RANGE, handleInvalid="keep")
    return cut.transform(df.withColumn("_at", F.coalesce(numeric, lit(-inf)))).withColumn(RANGE, F.col(RANGE).cast("int")).drop("_at")


def same(keys: list[str], left: str = "l", right: str = "r") -> Column:
    """Equality of keys, nulls equal to one another."""
    out = lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def running_sum(df: DataFrame, keys: list[str], order: str, ties: list[str], value: str) -> DataFrame:
    """df (in_ranges of order) with upto: the sum of value over the group's rows up to and with each one, by order and ties."""
    within = W.partitionBy(*keys, RANGE).orderBy(order, *ties).rowsBetween(W.unboundedPreceding, 0)
    ends = df.groupBy(*keys, RANGE).agg(F.sum(value).alias("_sum"))
    ends = ends.withColumn("_before", F.coalesce(F.sum("_sum").over(W.partitionBy(*keys).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)), lit(0.0))).drop("_sum")
    own = df.withColumn("_own", F.sum(value).over(within))
    joined = own.alias("l").join(ends.alias("r"), same([*keys, RANGE]))
    return joined.select("l.*", (F.col("_own") + F.col("_before")).alias("upto")).drop("_own")


def carried_last(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """df (in_ranges of the first of order) with last: the group's latest value that isn't null, up to and with each row."""
    within = W.partitionBy(*keys, RANGE).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    ends = df.groupBy(*keys, RANGE).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_end"))
    ends = ends.withColumn("_carried", F.last("_end", True).over(W.partitionBy(*keys).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1))).drop("_end")
    own = df.withColumn("_own", F.last(value, True).over(within))
    joined = own.alias("l").join(ends.alias("r"), same([*keys, RANGE]))
    return joined.select("l.*", F.coalesce("_own", "_carried").alias("last")).drop("_own")
