"""What was known at a cutoff: filters, guards, and the as-of join of bookings onto requested stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import lit

from ..functions.scalars import day_number


class FutureDataError(ValueError):
    """Rows from after the cutoff."""


def as_of(df: DataFrame, cutoff: str, date: str = "stay_date") -> DataFrame:
    return df.where(F.col(date) <= lit(cutoff).cast("date"))


def future_rows(df: DataFrame, cutoff: str, date: str = "stay_date") -> DataFrame:
    """rows, dated, future, sample: counts, and up to five of the dates after the cutoff."""
    late = F.col(date) > lit(cutoff).cast("date")
    return df.agg(F.count("*").alias("rows"), F.count(date).alias("dated"), F.count_if(late).alias("future"), F.slice(F.array_sort(F.collect_set(F.when(late, F.col(date)))), 1, 5).alias("sample"))


def enforce_cutoff(df: DataFrame, cutoff: str, date: str = "stay_date") -> DataFrame:
    """df itself; raises if a row is later than the cutoff, or if there are rows but no dates."""
    seen = future_rows(df, cutoff, date).first()
    if seen["future"]:
        raise FutureDataError(f"{seen['future']} rows after {cutoff}: {', '.join(map(str, seen['sample']))}")
    if seen["rows"] and not seen["dated"]:
        raise FutureDataError(f"no readable {date} in {seen['rows']} rows")
    return df


def booked_latest(pickup: DataFrame, cutoff: str) -> DataFrame:
    """property, stay_date, booked: bookings of the last snapshot up to the cutoff."""
    return as_of(pickup, cutoff, "snapshot_date").groupBy("property", "stay_date").agg(F.max_by("pickup_rn", "snapshot_date").alias("booked"))


def request_grid(properties: DataFrame, cutoff: str | Column, horizon: int) -> DataFrame:
    """property, stay_date, lead_days for each day of the horizon."""
    start = lit(cutoff).cast("date") if isinstance(cutoff, str) else cutoff
    return properties.select("property", F.explode(F.sequence(lit(1), lit(horizon))).alias("lead_days"), start.alias("_start")).select("property", F.date_add("_start", F.col("lead_days")).alias("stay_date"), "lead_days")


def booked_on_grid(grid: DataFrame, pickup: DataFrame, cutoff: str) -> DataFrame:
    """grid with booked: of the snapshots known at the cutoff with a lead of at least the one needed (at
    least 1), the first non-null value by lead; null where there is none. An equi-join on property and
    stay, so each stay meets its own snapshots only."""
    known = as_of(pickup, cutoff, "snapshot_date").where("pickup_rn is not null").select("property", "stay_date", F.col("lead_days").alias("_lead"), "pickup_rn")
    keys = ["property", "stay_date", "lead_days"]
    joined = grid.join(known, ["property", "stay_date"], "left")
    fits = F.col("_lead") >= F.greatest(F.col("lead_days"), lit(1))
    return joined.groupBy(*keys).agg(F.min_by(F.when(fits, F.col("pickup_rn")), F.when(fits, F.col("_lead"))).alias("booked"))


def remaining_pickup(pickup: DataFrame, demand: DataFrame, cutoff: str) -> DataFrame:
    """property, stay_date, lead_days, booked, remaining: what was still to come at each snapshot of a past stay."""
    known = as_of(as_of(pickup, cutoff, "snapshot_date"), cutoff).select("property", "stay_date", "lead_days", F.col("pickup_rn").alias("booked"))
    return known.join(as_of(demand, cutoff), ["property", "stay_date"]).select("property", "stay_date", "lead_days", "booked", (F.col("room_nights") - F.col("booked")).alias("remaining"))


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str], ranges: int | None = None) -> DataFrame:
    """left with the values of the last right row of the same keys at or before its time (null if none, or if a key or the
    time is null). Several right rows of one time: any of them.

    Both sides are put in one ordered stream and the last value is carried forward: no pairs. The stream of a key is cut into
    ranges of time (as many as there are shuffle partitions, if none are given), so a key with half of all rows is
    the work of many tasks; one row for each key and range carries the value on."""
    from .ordered import RANGE, carried_last, in_ranges

    value = F.struct(*[F.col(v) for v in values])
    there = F.col(right_time).isNotNull()
    for k in keys:
        there = there & F.col(k).isNotNull()
    l = left.select(*keys, F.col(left_time).alias("_t"), lit(1).alias("_side"), F.struct(*[F.col(c) for c in left.columns]).alias("_l"), lit(None).cast(right.select(value.alias("v")).schema["v"].dataType).alias("_r"))  # noqa: E741
    r = right.where(there).select(*keys, F.col(right_time).alias("_t"), lit(0).alias("_side"), lit(None).cast(l.schema["_l"].dataType).alias("_l"), value.alias("_r"))
    times = left.select(F.col(left_time).alias("_t")).union(right.select(F.col(right_time).alias("_t")))
    stream = in_ranges(l.unionByName(r), "_t", ranges, times)
    found = carried_last(stream, keys, ["_t", "_side"], "_r").where("_side = 1")
    return found.select("_l.*", *[F.when(F.col("_t").isNotNull(), F.col(f"last.{v}")).alias(v) for v in values]).drop(RANGE)


def asof_cutoffs(right: DataFrame, keys: list[str], time: str, values: list[str], cutoffs: DataFrame) -> DataFrame:
    """keys, cutoff, values: the last row of each key known at each of a few cutoffs, all in one aggregation. cutoffs: one column,
    cutoff; its rows are counted and must be 1,000 at most, as each row of right meets those after it."""
    n = cutoffs.limit(1001).count()
    if n > 1000:
        raise ValueError("more than 1,000 cutoffs: join them as rows by asof_join")
    known = right.join(F.broadcast(cutoffs.select("cutoff")), F.col(time) <= F.col("cutoff"))
    last = known.groupBy(*keys, "cutoff").agg(F.max_by(F.struct(*[F.col(v) for v in values]), F.struct(F.col(time), *[F.col(v) for v in values])).alias("_v"))
    return last.select(*keys, "cutoff", *[F.col(f"_v.{v}").alias(v) for v in values])


def range_frame(partition: str, date: str, low: int, high: int):
    """Calendar days low to high around each row, whatever days are missing."""
    from pyspark.sql import Window as W

    return W.partitionBy(partition).orderBy(day_number(date)).rangeBetween(low, high)
