"""Data-quality checks. Each gives one row per kind of issue: check, severity, source, records, properties, dates.

All checks of a source are one pass and one sort over it; gaps are found by exploding only the missing ranges
between neighbouring dates, never a full calendar. Sources are checked as they were read, before what can't be
read is dropped or nulled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from ..functions.scalars import ratio

ISSUE = "check string, severity string, source string, records bigint, properties array<string>, dates array<date>"


class CriticalDataError(ValueError):
    """Raised by the gate: the data can't be trained on."""


def nullish(c: str) -> Column:
    """Null, or one of the words for it."""
    return F.coalesce(F.lower(F.trim(F.col(c).cast("string"))).isin("nan", "none", ""), lit(True))


def empty_rows(df: DataFrame) -> Column:
    return reduce(Column.__and__, [nullish(c) for c in df.columns])


def over_capacity(demand: DataFrame, capacity: DataFrame, error_rate: float = 0.01) -> DataFrame:
    """rn_over_capacity: an error if more than error_rate of the joined days exceed their capacity."""
    both = demand.join(capacity, ["property", "stay_date"]).withColumn("over", F.col("room_nights") > F.col("capacity"))
    return both.agg(
        lit("rn_over_capacity").alias("check"), F.when(F.avg(F.col("over").cast("double")) > error_rate, "error").otherwise("warning").alias("severity"), lit("demand").alias("source"), F.count_if("over").alias("records"),
        F.array_sort(F.collect_set(F.when(F.col("over"), F.col("property")))).alias("properties"), F.array_sort(F.collect_set(F.when(F.col("over"), F.col("stay_date")))).alias("dates"),
    ).where("records > 0")


def found(rows: DataFrame, source: str, tests: list[tuple[str, str, Column]], gaps: Column | None = None, date: str = "stay_date") -> DataFrame:
    """One issue row for each test that some row fails, from one pass: a row carries an array of what it fails
    (and, in gaps, the days missing behind it), which is exploded and grouped once."""
    at = F.col(date).try_cast("date")
    hits = F.array_compact(F.array(*[F.when(F.coalesce(bad, lit(False)), F.struct(lit(name).alias("check"), lit(severity).alias("severity"), at.alias("day"))) for name, severity, bad in tests]))
    if gaps is not None:
        hits = F.concat(hits, F.transform(gaps, lambda d: F.struct(lit("missing_dates").alias("check"), lit("warning").alias("severity"), d.alias("day"))))
    return rows.select("property", F.explode(hits).alias("x")).groupBy("x.check", "x.severity").agg(
        lit(source).alias("source"), F.count("*").alias("records"), F.array_sort(F.collect_set("property")).alias("properties"), F.array_sort(F.collect_set("x.day")).alias("dates")
    )


def empty_source(df: DataFrame, source: str) -> DataFrame:
    """An error row if the source has no row at all."""
    none = F.array().cast("array<string>")
    return df.limit(1).agg(F.count("*").alias("_n")).where("_n = 0").select(lit("empty_source").alias("check"), lit("error").alias("severity"), lit(source).alias("source"), lit(0).cast("long").alias("records"), none.alias("properties"), none.cast("array<date>").alias("dates"))


def in_order(df: DataFrame) -> tuple[DataFrame, Column, Column, Column]:
    """df with its empty rows marked; whether a (property, day) recurs, the days missing behind a row, and the window
    that both share: one sort by property and day."""
    rows = df.withColumn("_empty", empty_rows(df))
    order = W.partitionBy("_empty", "property").orderBy(F.unix_date(F.col("stay_date").try_cast("date")))
    after = F.lead(F.col("stay_date").try_cast("date")).over(order)
    rows = rows.withColumns({"_same": F.count("*").over(order.rangeBetween(0, 0)), "_next": after})
    day = F.col("stay_date").try_cast("date")
    gaps = F.when(~F.col("_empty") & (F.datediff("_next", day) > 1), F.sequence(F.date_add(day, 1), F.date_sub("_next", 1))).otherwise(F.array().cast("array<date>"))
    return rows, F.col("_same") > 1, gaps, order


def demand_issues(demand: DataFrame, unread: Column | None = None) -> DataFrame:
    """demand: property, stay_date, room_nights, also as read (texts). unread: marks rows whose date can't be read."""
    rows, again, gaps, _ = in_order(demand)
    full, rn = ~F.col("_empty"), F.col("room_nights").try_cast("double")
    tests = [("empty_rows", "warning", ~full), ("duplicate_property_date", "error", full & again), ("negative_rn", "error", full & (rn < 0))]
    return found(rows, "demand", tests + ([("missing_dates", "error", full & unread)] if unread is not None else []), gaps).unionByName(empty_source(demand, "demand"))


def capacity_issues(capacity: DataFrame, unread: Column | None = None, limit: float = 0.5) -> DataFrame:
    """As demand_issues, of property, stay_date, capacity: and changes by more than limit times the row before."""
    rows, again, gaps, order = in_order(capacity)
    full, c, prev = ~F.col("_empty"), F.col("capacity").try_cast("double"), F.col("_previous")
    rows = rows.withColumn("_previous", F.lag(c).over(order))
    jump = F.when((prev == 0) & (c > 0), lit(True)).otherwise(ratio(F.abs(c - prev), prev) > limit)
    tests = [
        ("empty_rows", "warning", ~full), ("duplicate_property_date", "error", full & again), ("negative_capacity", "error", full & (c < 0)),
        ("zero_capacity", "warning", full & (c == 0)), ("unexpected_capacity_change", "warning", full & jump),
    ]
    return found(rows, "capacity", tests + ([("missing_dates", "error", full & unread)] if unread is not None else []), gaps).unionByName(empty_source(capacity, "capacity"))


def pickup_issues(pickup: DataFrame, snapshot_declared: bool = True, unread: Column | None = None) -> DataFrame:
    """snapshot_declared: False if snapshots are derived from leads, which are the key then. A stay without a date, or
    with one that can't be read, is an error; leads may be texts, as read."""
    third = "snapshot_date" if snapshot_declared else "lead_days"
    rows = pickup.withColumn("_empty", empty_rows(pickup)).withColumn("_same", F.count("*").over(W.partitionBy("_empty", "property", "stay_date", third)))
    full, lead = ~F.col("_empty"), F.col("lead_days").try_cast("double")
    undated = F.col("stay_date").isNull() if unread is None else F.col("stay_date").isNull() | unread
    tests = [
        ("empty_rows", "warning", ~full), ("negative_rn", "error", full & (F.col("pickup_rn").try_cast("double") < 0)), ("missing_dates", "error", full & undated),
        ("invalid_lead", "error", full & ~nullish("lead_days") & lead.isNull()), ("negative_lead", "error", full & (lead < 0)), ("duplicate_snapshots", "error", full & (F.col("_same") > 1)),
    ]
    if "snapshot_date" in pickup.columns:
        tests.append(("pickup_inconsistent", "error", full & (lead != F.datediff(F.col("stay_date").try_cast("date"), F.col("snapshot_date").try_cast("date")))))
    return found(rows, "pickup", tests).unionByName(empty_source(pickup, "pickup"))


def report(issues: DataFrame) -> DataFrame:
    """status (fail, warnings or pass), errors, warnings, records, properties: one row."""
    errors = F.count_if(F.col("severity") == "error")
    return issues.agg(
        F.when(errors > 0, "fail").when(F.count("*") > 0, "warnings").otherwise("pass").alias("status"), errors.alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"),
        F.coalesce(F.sum("records"), lit(0)).alias("records"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("properties")))).alias("properties"),
    )


def gate(issues: DataFrame) -> None:
    """Raise CriticalDataError if any issue is an error."""
    bad = [r["check"] for r in issues.where("severity = 'error'").select("check").distinct().collect()]
    if bad:
        raise CriticalDataError("checks failed: " + ", ".join(sorted(bad)))


def forecast_table_check(forecast: DataFrame, required: list[str]) -> DataFrame:
    """missing_columns, null_rows, broken_rows (final other than min(max(raw, booked), capacity)): one row."""
    there = [c for c in required if c in forecast.columns]
    nulls = reduce(Column.__or__, [F.col(c).isNull() for c in there], lit(False))
    floored = F.when(F.col("current_booked_rn") > F.col("raw_forecast_rn"), F.col("current_booked_rn")).otherwise(F.col("raw_forecast_rn"))
    want = F.when(floored > F.col("capacity"), F.col("capacity")).otherwise(floored)
    return forecast.agg(lit(",".join(c for c in required if c not in there)).alias("missing_columns"), F.count_if(nulls).alias("null_rows"), F.count_if(F.abs(F.col("final_forecast_rn") - want) > 1e-6).alias("broken_rows"))
