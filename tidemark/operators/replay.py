"""The whole forecasting run as it would have been on earlier days: candidates over folds, champion, choice for each property, long
leads, learnt corrections, bookings as floor and capacity as cap. Every stage is keyed by the day of the run (as_of), so all
days are replayed in one plan, and what a stage learns comes from folds that end at its own as_of."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import lit

from ..sources.tables import settle
from . import backtest, calibrate, candidates, models, publish, selection

KEYS = ("as_of",)
DEFAULT_CAPACITY = 100.0


def choose(graded: DataFrame, incumbents: DataFrame | None = None) -> DataFrame:
    """as_of, property, champion, tie, model, reason, long_model from graded fold predictions (with as_of): the tested champion of
    each as_of, what each property runs, and for boosted trees whose rollout collapses what takes over beyond the split."""
    metrics = settle(selection.fold_metrics(graded, keys=KEYS), "replay-metrics")
    champions = settle(selection.tested_champion(graded, selection.scores(metrics, *KEYS), keys=KEYS), "replay-champions")
    picked = settle(selection.by_property(metrics, champions, incumbents, keys=KEYS), "replay-picked")
    long = selection.long_replacement(graded, metrics, picked, keys=KEYS, only=tuple(candidates.TREES))
    rows = picked.join(F.broadcast(champions.select(*KEYS, F.col("model").alias("champion"), "tie")), list(KEYS))  # a row for each as_of
    return rows.join(long.select(*KEYS, "property", F.col("replacement").alias("long_model")), [*KEYS, "property"], "left")


def operative(made: DataFrame, chosen: DataFrame, profile: DataFrame) -> DataFrame:
    """made (predictions with as_of) reduced to what each property runs, as model_name; a replacement beyond the split follows the
    property's week as known at the fold's cutoff."""
    rows = made.join(chosen.select(*KEYS, "property", F.col("model").alias("_own"), "long_model"), [*KEYS, "property"])
    far = (F.col("lead_days") > selection.LEAD_SPLIT) & F.col("long_model").isNotNull()
    rows = rows.where(F.col("model") == F.when(far, F.col("long_model")).otherwise(F.col("_own"))).withColumn("dow", F.weekday("stay_date"))
    rows = rows.join(profile.select("property", "fold", "dow", F.col("factor").alias("_week")), ["property", "fold", "dow"], "left")
    week = F.when(far, F.coalesce("_week", lit(1.0))).otherwise(1.0)
    return rows.withColumns({"forecast": F.col("forecast") * week, "model_name": F.col("model")}).drop("_own", "long_model", "dow", "_week", "model")


def with_capacity(rows: DataFrame, capacity: DataFrame) -> DataFrame:
    """rows with capacity: the day's largest known one, else the property's median up to the row's as_of, else DEFAULT_CAPACITY."""
    day = capacity.groupBy("property", "stay_date").agg(F.max("capacity").alias("_day"))
    at = F.broadcast(rows.select(*KEYS).distinct())  # the days replayed
    median = capacity.join(at, F.col("stay_date") <= F.col("as_of")).groupBy(*KEYS, "property").agg(F.percentile("capacity", 0.5).alias("_median"))
    return rows.join(day, ["property", "stay_date"], "left").join(median, [*KEYS, "property"], "left").withColumn("capacity", F.coalesce("_day", "_median", lit(DEFAULT_CAPACITY))).drop("_day", "_median")


@dataclass
class Replayed:
    """published: as_of, property, stay_date, lead_days, model_name, current_booked_rn, bias_correction_factor, raw_forecast_rn
    (corrected), capacity, final_forecast_rn and its flags. chosen: that of `choose`. folds: graded predictions of all candidates;
    runs: those of what each property runs; factors: the corrections learnt from them. All have as_of."""

    published: DataFrame
    chosen: DataFrame
    folds: DataFrame
    runs: DataFrame
    factors: DataFrame

    def of(self, as_of: str) -> Replayed:
        """What one as_of has of each."""
        return Replayed(*[df.where(F.col("as_of") == lit(as_of).cast("date")) for df in (self.published, self.chosen, self.folds, self.runs, self.factors)])


def replay(
    demand: DataFrame, pickup: DataFrame, capacity: DataFrame, cutoffs: list[str], names: tuple[str, ...] = candidates.RELATIONAL, n: int = 4, days: int = selection.FOLD_DAYS,
    incumbents: DataFrame | None = None, holidays: DataFrame | None = None, decay: float = 1.0,
) -> Replayed:
    """What each run of `cutoffs` would have published for the days after it, and what it chose and learnt. Nothing after an as_of is read for it but capacities of
    the days asked for, which are planned. Properties with fewer than MIN_OBS days or without three scored folds follow the rules
    of `by_property`; a property that no fold scored isn't published."""
    folds = candidates.folds_of(demand.sparkSession, cutoffs, n, days)
    made = settle(candidates.predictions(demand, pickup, folds, days, names, holidays), "replay-predictions").join(F.broadcast(folds.drop("cutoff")), "fold")
    graded = selection.with_actuals(made.where(F.col("nth") < n), demand)
    chosen = settle(choose(graded, incumbents), "replay-chosen")
    few = F.broadcast(folds.select("fold", "cutoff"))
    profile = models.profiles(demand.join(few, F.col("stay_date") <= F.col("cutoff")), ("fold",))
    runs = operative(made, chosen, profile)
    tested = selection.with_actuals(runs.where(F.col("nth") < n), demand)
    factors = settle(calibrate.bias_cells(tested, decay, keys=KEYS), "replay-factors")
    asked = runs.where(F.col("nth") == n).select(*KEYS, "property", "stay_date", "lead_days", "model_name", F.col("booked").alias("current_booked_rn"), F.col("forecast").alias("raw_forecast_rn"))
    published = publish.floor_and_cap(with_capacity(publish.apply_factors(asked, factors, keys=KEYS), capacity))
    return Replayed(published, chosen, graded, tested, factors)


def graded(published: DataFrame, demand: DataFrame) -> DataFrame:
    """published of the days that have an actual, with it; forecast is what was published."""
    return published.withColumn("forecast", F.col("final_forecast_rn")).join(demand.select("property", "stay_date", F.col("room_nights").alias("actual")), ["property", "stay_date"])


def corrected_run(published: DataFrame, demand: DataFrame, as_of: str, before: str) -> DataFrame:
    """published of one as_of, with the level of each property corrected by what the run of `before` got wrong up to the as_of,
    then floored and capped again; level_correction_factor says by how much."""
    seen = graded(published.where(F.col("as_of") == lit(before).cast("date")), demand.where(F.col("stay_date") <= lit(as_of).cast("date")))
    rows = published.where(F.col("as_of") == lit(as_of).cast("date"))
    return publish.floor_and_cap(publish.apply_levels(rows, calibrate.level_factors(seen)))


def revisions(demand: DataFrame, stays: DataFrame, forecast: Callable[[DataFrame], DataFrame], leads: tuple[int, ...] = backtest.LEADS, keep_days: int = 364) -> DataFrame:
    """property, stay_date, lead_days, cutoff, forecast (and what else the callback returns), actual. For each stay and lead the
    callback is given the demand as frozen lead days before: property, target, lead_days, cutoff, stay_date, room_nights of
    the keep_days up to the cutoff, all stays and leads in one frame; it returns rows by property, target and lead_days with
    forecast. Leads that it leaves out are left out; lead 0 is the actual."""
    frozen = backtest.snapshot(demand.select("property", "stay_date", "room_nights"), backtest.requests(stays, leads), "stay_date").where(F.datediff("cutoff", "stay_date") < keep_days)
    made = forecast(frozen).withColumnRenamed("target", "stay_date").withColumn("cutoff", F.date_sub("stay_date", F.col("lead_days")))
    actual = demand.join(F.broadcast(stays), "stay_date").select("property", "stay_date", F.col("room_nights").alias("actual"))
    final = actual.withColumns({"lead_days": lit(0), "cutoff": F.col("stay_date"), "forecast": F.col("actual").cast("double")})
    return made.join(actual, ["property", "stay_date"], "left").unionByName(final, allowMissingColumns=True)
