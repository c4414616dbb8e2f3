"""Public holidays of Costa Rica and the United States by rule, their windows, and events.

A calendar is two small frames: days (date, key, public) and windows (date, key, distance, property),
built on the driver from rules for a range of years: a few dozen rows a year, so they may be broadcast."""

from __future__ import annotations

from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..functions.scalars import holiday_key

WINDOW_DAYS = 4
#: Holidays on a fixed day: month, day, name (fixed values).
FIXED = {
    "CR": ((1, 1, "Año Nuevo"), (4, 11, "Día de Juan Santamaría"), (5, 1, "Día Internacional del Trabajo"), (7, 25, "Anexión del Partido de Nicoya a Costa Rica"), (8, 2, "Fiesta de Nuestra Señora de los Ángeles"), (8, 15, "Día de la Madre"), (9, 15, "Día de la Independencia"), (12, 25, "Navidad")),
    "US": ((1, 1, "New Year's Day"), (6, 19, "Juneteenth National Independence Day"), (7, 4, "Independence Day"), (11, 11, "Veterans Day"), (12, 25, "Christmas Day")),
}
#: The n-th (-1: last) weekday (0: Monday) of a month: month, weekday, n, name (fixed values).
WEEKDAYS = {"CR": (), "US": ((1, 0, 3, "Martin Luther King Jr. Day"), (2, 0, 3, "Washington's Birthday"), (5, 0, -1, "Memorial Day"), (9, 0, 1, "Labor Day"), (10, 0, 2, "Columbus Day"), (11, 3, 4, "Thanksgiving Day"))}
#: Days from Easter: offset, name (fixed values).
EASTER = {"CR": ((-3, "Jueves Santo"), (-2, "Viernes Santo")), "US": ()}


def easter(year: int) -> date:
    """Western Easter Sunday, by the Gregorian computus."""
    golden, century = year % 19, year // 100
    epact = (19 * golden + century - century // 4 - (8 * century + 13) // 25 + 15) % 30
    full_moon = epact - (epact // 28) * (1 - (29 // (epact + 1)) * ((21 - golden) // 11))
    sunday = full_moon - (year + year // 4 + full_moon + 2 - century + century // 4) % 7
    month = 3 + (sunday + 40) // 44
    return date(year, month, sunday + 28 - 31 * (month // 4))


def nth_weekday(year: int, month: int, weekday: int, n: int) -> date:
    if n > 0:
        first = date(year, month, 1)
        return first + timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(1)
    return last - timedelta((last.weekday() - weekday) % 7)


def holiday_rows(years: range, countries: tuple[str, ...] = ("CR", "US")) -> list[tuple[date, str, int]]:
    """(date, name, order): of two on one day the one first in order counts."""
    out = []
    for c in countries:
        for y in years:
            out += [(date(y, m, d), name) for m, d, name in FIXED[c]]
            out += [(nth_weekday(y, m, w, n), name) for m, w, n, name in WEEKDAYS[c]]
            out += [(easter(y) + timedelta(k), name) for k, name in EASTER[c]]
    return [(d, name, k) for k, (d, name) in enumerate(out)]


def holidays(spark: SparkSession, years: range, countries: tuple[str, ...] = ("CR", "US")) -> DataFrame:
    """date, name, key, seq: the public holidays."""
    return spark.createDataFrame(holiday_rows(years, countries), "date date, name string, seq int").withColumn("key", holiday_key("name"))


def windows(days: DataFrame, width: int = WINDOW_DAYS) -> DataFrame:
    """date, key, distance: each day within width of a holiday belongs to the nearest one (ties: the first in order)."""
    near = days.select(F.explode(F.sequence(F.lit(-width), F.lit(width))).alias("k"), "date", "key", "seq").select(F.date_add("date", F.col("k")).alias("date"), "key", F.abs("k").alias("distance"), "seq")
    return near.groupBy("date").agg(F.min_by("key", F.struct("distance", "seq")).alias("key"), F.min("distance").alias("distance"))


def with_events(days: DataFrame, events: DataFrame, width: int = WINDOW_DAYS) -> DataFrame:
    """date, key, distance, property: windows in which events compete. Events of the whole portfolio win by a
    smaller distance (a holiday keeps ties); events of a property have windows of their own."""
    spread = F.explode(F.sequence(F.lit(-width), F.lit(width))).alias("k")
    all_days = days.select("date", "key", F.lit(0).alias("rank"), "seq").unionByName(events.where("property is null").select(F.col("event_date").alias("date"), holiday_key("event_name").alias("key"), F.lit(1).alias("rank"), F.lit(0).alias("seq")))
    near = all_days.select("date", "key", "rank", "seq", spread).select(F.date_add("date", F.col("k")).alias("date"), "key", F.abs("k").alias("distance"), "rank", "seq")
    portfolio = near.groupBy("date").agg(F.min_by("key", F.struct("distance", "rank", "seq", "key")).alias("key"), F.min("distance").alias("distance")).withColumn("property", F.lit(None).cast("string"))
    own = events.where("property is not null").select(F.col("event_date").alias("date"), holiday_key("event_name").alias("key"), "property", spread).select(F.date_add("date", F.col("k")).alias("date"), "key", F.abs("k").alias("distance"), "property")
    own = own.groupBy("property", "date").agg(F.min_by("key", F.struct("distance", "key")).alias("key"), F.min("distance").alias("distance"))
    return portfolio.unionByName(own.select("date", "key", "distance", "property"))


class Calendar(NamedTuple):
    """days: date, name, key, seq of public holidays. dates: different days of holidays and of the portfolio's events. windows: as
    `with_events` makes them."""

    days: DataFrame
    dates: DataFrame
    windows: DataFrame
    countries: tuple[str, ...]
    width: int


def from_config(facts: DataFrame, config: dict | None, events: DataFrame | None = None, date_col: str = "stay_date") -> Calendar | None:
    """The calendar that a configuration asks for (countries, window_days), from the year before the facts' first day to that after
    their last, which one job finds. None without countries; no days for facts without dates; an unknown country raises ValueError."""
    config = config or {}
    countries = tuple(config.get("countries") or ())
    if not countries:
        return None
    if unknown := [c for c in countries if c not in FIXED]:
        raise ValueError(f"no holidays are known for {', '.join(map(str, unknown))}")
    width = int(config.get("window_days", WINDOW_DAYS))
    first, last = facts.agg(F.year(F.min(date_col)), F.year(F.max(date_col))).first()
    days = holidays(facts.sparkSession, range(0) if first is None else range(first - 1, last + 2), countries)
    if events is None:
        return Calendar(days, days.select("date").distinct(), windows(days, width).withColumn("property", F.lit(None).cast("string")), countries, width)
    dates = days.select("date").union(events.where("property is null").select("event_date")).where("date is not null").distinct()
    return Calendar(days, dates, with_events(days, events, width), countries, width)


def describe(calendar: Calendar) -> DataFrame:
    """countries, window_days, n_holiday_dates, n_dates (with events), n_window_days (of the portfolio), n_scoped_properties (with
    events of their own), keys (sorted): one row."""
    g = calendar.windows.agg(F.count_if(F.col("property").isNull()).alias("n_window_days"), F.count_distinct("property").alias("n_scoped_properties"), F.array_sort(F.collect_set("key")).alias("keys"))
    counts = calendar.days.agg(F.count_distinct("date").alias("n_holiday_dates")).join(calendar.dates.agg(F.count("*").alias("n_dates"))).join(g)  # a row each
    return counts.select(F.array(*[F.lit(c) for c in calendar.countries]).alias("countries"), F.lit(calendar.width).alias("window_days"), "n_holiday_dates", "n_dates", "n_window_days", "n_scoped_properties", "keys")


def window_key(df: DataFrame, calendar: DataFrame, date_col: str = "stay_date") -> DataFrame:
    """df with holiday_key: the portfolio's window of the date, else the property's own, else null."""
    whole = calendar.where("property is null").select(F.col("date").alias(date_col), F.col("key").alias("_whole"))
    own = calendar.where("property is not null").select(F.col("date").alias(date_col), "property", F.col("key").alias("_own"))
    return df.join(whole, date_col, "left").join(own, [date_col, "property"], "left").withColumn("holiday_key", F.coalesce("_whole", "_own")).drop("_whole", "_own")


def days_to_nearest(df: DataFrame, days: DataFrame, date_col: str = "stay_date") -> DataFrame:
    """df with days_to_holiday: to the nearest holiday on either side. The different dates, not the rows, are
    ordered with the holidays and carry the last and next one along."""
    dates = df.select(F.col(date_col).alias("date")).where("date is not null").distinct().withColumn("holiday", F.lit(None).cast("date"))
    both = dates.unionByName(days.select("date", F.col("date").alias("holiday")).distinct())
    w = W.orderBy("date")  # one row for each calendar day: bounded by the years covered
    near = both.withColumns({"_p": F.last("holiday", True).over(w.rangeBetween(W.unboundedPreceding, 0)), "_n": F.first("holiday", True).over(w.rangeBetween(0, W.unboundedFollowing))})
    found = near.where("holiday is null").select(F.col("date").alias(date_col), F.least(F.datediff("date", "_p"), F.datediff("_n", "date")).alias("days_to_holiday"))
    return df.join(found, date_col, "left")
