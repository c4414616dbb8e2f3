"""Forecast candidates that are relational: the seasonal naive one and the pickup curve; and the weekly profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from ..functions.scalars import ratio, season
from .asof import as_of

NAIVE_K, NAIVE_MIN_ROWS = 4, 60
EDGES = (1, 3, 7, 14, 21, 30, 45, 60, 90)
RECENT_DAYS = 1095
SEASON_MIN_LEAD, MIN_SEASON_STAYS, MIN_HOLIDAY_STAYS = 30, 30, 15
PROFILE_DAYS, PROFILE_ROWS, PROFILE_EACH = 84, 21, 3


def seasonal_naive(demand: DataFrame, cutoff: str, grid: DataFrame, k: int = NAIVE_K) -> DataFrame:
    """grid with forecast, from the demand up to the cutoff."""
    return naive(as_of(demand, cutoff), grid, (), k)


def naive(past: DataFrame, grid: DataFrame, keys: tuple[str, ...] = (), k: int = NAIVE_K) -> DataFrame:
    """grid with forecast: the mean of the last k observations of the weekday; the last observation if the
    weekday has none; the mean level if the property has less than 60 rows. keys: further columns of both that
    tell series apart, such as folds."""
    group = ["property", *keys]
    dow = F.weekday("stay_date")
    ranked = past.select(*group, dow.alias("dow"), "room_nights", F.row_number().over(W.partitionBy(*group, dow).orderBy(F.desc("stay_date"))).alias("n"))
    by_dow = ranked.where(F.col("n") <= k).groupBy(*group, "dow").agg(F.avg("room_nights").alias("by_dow"))
    level = past.groupBy(*group).agg(F.count("*").alias("rows"), F.avg("room_nights").alias("level"), F.max_by("room_nights", "stay_date").alias("last"))
    return (
        grid.withColumn("dow", dow).join(by_dow, [*group, "dow"], "left").join(level, group, "left")
        .withColumn("forecast", F.greatest(F.when(F.col("rows") < NAIVE_MIN_ROWS, F.col("level")).otherwise(F.coalesce("by_dow", "last")), lit(0.0))).select(*grid.columns, "forecast")
    )


def lead_bin(lead) -> F.Column:
    """Index of the lead's bin [edge, next edge); the last is open; null below the first edge."""
    out = F.when(lead < EDGES[0], None)
    for i, top in enumerate(EDGES[1:]):
        out = out.when(lead < top, i)
    return out.when(lead.isNotNull(), len(EDGES) - 1)


def bin_centre(b) -> F.Column:
    """Middle of a bin; null for the open one, which is nearest to nothing."""
    return F.element_at(F.array(*[lit((a + z) / 2) for a, z in zip(EDGES, EDGES[1:])], lit(None).cast("double")), b + 1)


def pickup_curves(remaining: DataFrame, min_season: int = MIN_SEASON_STAYS, min_holiday: int = MIN_HOLIDAY_STAYS, recent_days: int = RECENT_DAYS, keys: tuple[str, ...] = ()) -> DataFrame:
    """level (global, property, season, holiday), property, season, holiday_key, bin, pickup: mean remaining
    pickup by bin, from one pass over grouping sets. Season and holiday curves exist if the property has
    enough different stays of it; remaining may carry a holiday_key."""
    rows = remaining if "holiday_key" in remaining.columns else remaining.withColumn("holiday_key", lit(None).cast("string"))
    last = rows.groupBy(*keys).agg(F.max("stay_date").alias("_last"))  # a row for each of the keys' values
    rows = rows.where("lead_days >= 1")
    rows = (rows.join(F.broadcast(last), list(keys)) if keys else rows.crossJoin(F.broadcast(last))).where(F.datediff("_last", "stay_date") <= recent_days)
    rows = rows.select(*keys, "property", season("stay_date").alias("season"), F.coalesce("holiday_key", lit("")).alias("holiday_key"), lead_bin(F.col("lead_days")).alias("bin"), "stay_date", "remaining")
    sets = rows.groupingSets([[*keys, *g, "bin"] for g in ([], ["property"], ["property", "season"], ["property", "holiday_key"])], *keys, "property", "season", "holiday_key", "bin")
    cells = sets.agg(F.avg("remaining").alias("pickup"), F.grouping("property").alias("gp"), F.grouping("season").alias("gs"), F.grouping("holiday_key").alias("gh"))
    level = F.when(F.col("gp") == 1, "global").when((F.col("gs") == 1) & (F.col("gh") == 1), "property").when(F.col("gs") == 0, "season").otherwise("holiday")
    cells = cells.withColumn("level", level).where("level <> 'holiday' or holiday_key <> ''")
    stays = rows.groupingSets([[*keys, "property", "season"], [*keys, "property", "holiday_key"]], *keys, "property", "season", "holiday_key").agg(F.count_distinct("stay_date").alias("stays"), F.grouping("season").alias("gs"))
    enough = stays.where(((F.col("gs") == 0) & (F.col("stays") >= min_season)) | ((F.col("gs") == 1) & (F.col("stays") >= min_holiday) & (F.col("holiday_key") != "")))
    kept = cells.where("level in ('global', 'property')").select(*keys, "level", "property", "season", "holiday_key", "bin", "pickup")
    same = (F.col("c.property") == F.col("e.property")) & F.col("c.season").eqNullSafe(F.col("e.season")) & F.col("c.holiday_key").eqNullSafe(F.col("e.holiday_key"))
    for k in keys:
        same &= F.col(f"c.{k}") == F.col(f"e.{k}")
    conditional = cells.where("level in ('season', 'holiday')").alias("c").join(enough.alias("e"), same)
    return kept.unionByName(conditional.select(*[f"c.{k}" for k in keys], "c.level", "c.property", "c.season", "c.holiday_key", "c.bin", "c.pickup"))


def curve_pickup(grid: DataFrame, curves: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """grid (property, stay_date, lead_days, booked, perhaps holiday_key) with pickup and forecast: the first
    curve that exists of holiday, season (both from a lead of 30 on), property, global; its bin, else the
    bin of the nearest centre in that curve; not below 0; added to what is booked (none: 0).

    Curves are a few rows for each property, packed in one array per curve: one join per level."""
    packed = curves.groupBy(*keys, "level", "property", "season", "holiday_key").agg(F.collect_list(F.struct("bin", "pickup")).alias("curve"))
    of = lambda name, *on: packed.where(F.col("level") == name).select(*keys, *on, F.col("curve").alias(f"_{name}"))
    rows = grid if "holiday_key" in grid.columns else grid.withColumn("holiday_key", lit(None).cast("string"))
    rows = rows.withColumn("season", season("stay_date"))
    for level, on in (("holiday", ["property", "holiday_key"]), ("season", ["property", "season"]), ("property", ["property"])):
        rows = rows.join(of(level, *on), [*keys, *on], "left")
    rows = rows.join(F.broadcast(of("global")), list(keys), "left") if keys else rows.crossJoin(F.broadcast(of("global").agg(F.first("_global").alias("_global"))))  # a row for each of the keys' values
    far = F.col("lead_days") >= SEASON_MIN_LEAD
    curve = F.coalesce(F.when(far, F.col("_holiday")), F.when(far, F.col("_season")), F.col("_property"), F.col("_global"))
    rows = rows.withColumns({"_curve": curve, "_bin": lead_bin(F.col("lead_days"))})
    exact = F.filter("_curve", lambda x: x["bin"] == F.col("_bin"))
    near = F.array_min(F.transform(F.filter("_curve", lambda x: bin_centre(x["bin"]).isNotNull()), lambda x: F.struct(F.abs(bin_centre(x["bin"]) - F.col("lead_days")).alias("d"), x["bin"].alias("bin"), x["pickup"].alias("pickup"))))
    found = F.coalesce(F.try_element_at(exact, lit(1))["pickup"], near["pickup"], F.try_element_at("_curve", lit(1))["pickup"])
    pickup = F.greatest(found, lit(0.0))
    return rows.withColumn("pickup", pickup).withColumn("forecast", F.coalesce("booked", lit(0.0)) + F.col("pickup")).select(*grid.columns, "pickup", "forecast")


def dow_profile(demand: DataFrame, cutoff: str) -> DataFrame:
    """property, dow, factor: the weekday's mean over the mean of the seven, from the last 84 days;
    only for properties with 21 rows and three of every weekday."""
    return profiles(as_of(demand, cutoff).withColumn("cutoff", lit(cutoff).cast("date")))


def profiles(past: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """dow_profile of past (property, stay_date, room_nights, the cutoff it was known at), for each of the keys' values."""
    rows = past.where(F.datediff("cutoff", "stay_date").between(0, PROFILE_DAYS - 1))
    dows = rows.groupBy("property", *keys, F.weekday("stay_date").alias("dow")).agg(F.count("*").alias("n"), F.avg("room_nights").alias("mean"))
    w = W.partitionBy("property", *keys)
    checked = dows.withColumns({"_days": F.count("*").over(w), "_least": F.min("n").over(w), "_rows": F.sum("n").over(w), "_mean": F.avg("mean").over(w)})
    return checked.where((F.col("_days") == 7) & (F.col("_least") >= PROFILE_EACH) & (F.col("_rows") >= PROFILE_ROWS)).select("property", *keys, "dow", ratio("mean", "_mean").alias("factor"))
