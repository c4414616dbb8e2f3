"""The seven forecasting candidates over folds: one grid of fold, property and model in a plan, whatever the number of folds.

The seasonal naive and the pickup curve are joins and aggregates. The other five are fitted to one property's series each, in
a group for every (property, fold, model): TAIL_DAYS days, the snapshots of the last PANEL_STAYS stays and the days asked for. A
fold is a cutoff; nothing after it reaches its groups, and all groups of all folds are fitted side by side."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.functions import lit

from ..functions import boosting, series
from ..functions.scalars import MODELS

TAIL_DAYS, MIN_OBS, PANEL_STAYS = 1095, 60, 365
#: Boosted trees: squared error leaf by leaf, squared error with shrunk leaves, absolute error with median leaves.
TREES = {
    "lightgbm": dict(iterations=60, depth=5, step=0.1),
    "xgboost": dict(iterations=100, depth=4, step=0.07, l2=1.0),
    "catboost": dict(iterations=100, depth=5, step=0.08, absolute=True),
}
RELATIONAL = MODELS[:2]


def fold_cutoffs(cutoff: str, n: int = 4, days: int = 90) -> list[tuple[int, str]]:
    """(fold, cutoff): n folds of `days` days that tile the time up to the cutoff."""
    return [(i, str(date.fromisoformat(cutoff) - timedelta(days * (n - i)))) for i in range(n)]


def folds_of(spark: SparkSession, cutoffs: list[str], n: int = 4, days: int = 90) -> DataFrame:
    """fold, as_of, nth, cutoff: for each as_of its n folds (nth 0 to n - 1) and what is forecast on it (nth = n, its cutoff is
    the as_of itself). fold numbers them all, so that whatever is keyed by fold serves every as_of in one plan."""
    rows = [(i * (n + 1) + nth, at, nth, cut) for i, at in enumerate(cutoffs) for nth, cut in [*fold_cutoffs(at, n, days), (n, at)]]
    return spark.createDataFrame(rows, "fold int, as_of string, nth int, cutoff string").withColumns({"as_of": F.to_date("as_of"), "cutoff": F.to_date("cutoff")})


def asked(demand: DataFrame, pickup: DataFrame, folds: DataFrame, days: int) -> DataFrame:
    """property, fold, cutoff, stay_date, lead_days, booked: the days after each fold's cutoff for each property with MIN_OBS rows up
    to it, with what was booked as known then (null: no snapshot)."""
    few = F.broadcast(folds.select("fold", "cutoff"))  # a row for each fold
    trained = demand.join(few, F.col("stay_date") <= F.col("cutoff")).groupBy("property", "fold", "cutoff").count().where(F.col("count") >= MIN_OBS)
    grid = trained.select("property", "fold", "cutoff", F.explode(F.sequence(lit(1), lit(days))).alias("lead_days")).withColumn("stay_date", F.date_add("cutoff", F.col("lead_days")))
    known = pickup.where("pickup_rn is not null").select("property", "stay_date", "snapshot_date", F.col("lead_days").alias("_lead"), "pickup_rn")
    fits = (F.col("_lead") >= F.col("lead_days")) & (F.col("snapshot_date") <= F.col("cutoff"))
    return grid.join(known, ["property", "stay_date"], "left").groupBy("property", "fold", "cutoff", "stay_date", "lead_days").agg(F.min_by(F.when(fits, F.col("pickup_rn")), F.when(fits, F.col("_lead"))).alias("booked"))


def relational(demand: DataFrame, pickup: DataFrame, folds: DataFrame, days: int) -> DataFrame:
    """property, fold, model, stay_date, lead_days, booked, forecast of the seasonal naive and the pickup curve."""
    from . import models

    few, keys = F.broadcast(folds.select("fold", "cutoff")), ("fold",)
    grid = asked(demand, pickup, folds, days)
    past = demand.join(few, F.col("stay_date") <= F.col("cutoff"))
    realised = pickup.join(demand, ["property", "stay_date"]).join(few, (F.col("stay_date") <= F.col("cutoff")) & (F.col("snapshot_date") <= F.col("cutoff")))
    curves = models.pickup_curves(realised.select("fold", "property", "stay_date", "lead_days", (F.col("room_nights") - F.col("pickup_rn")).alias("remaining")), keys=keys)
    columns = ["property", "fold", "model", "stay_date", "lead_days", "booked", "forecast"]
    naive = models.naive(past, grid, keys).withColumn("model", lit("seasonal_naive")).select(*columns)
    return naive.unionByName(models.curve_pickup(grid, curves, keys).withColumn("model", lit("pickup_curve")).select(*columns))


def dense(days: pd.Series, values: pd.Series, cutoff: pd.Timestamp) -> np.ndarray:
    """Daily values up to the cutoff, gaps carried forward; the last TAIL_DAYS of them."""
    return daily(days, values, cutoff).ffill().to_numpy()


def daily(days: pd.Series, values: pd.Series, cutoff: pd.Timestamp) -> pd.Series:
    """Means by day up to the cutoff, days without a value unknown; the last TAIL_DAYS of them."""
    s = pd.Series(values.to_numpy(float), pd.DatetimeIndex(days)).groupby(level=0).mean()
    return s.reindex(pd.date_range(s.index.min(), cutoff))[-TAIL_DAYS:]


def day_features(values: np.ndarray, t: int, day: pd.Timestamp) -> list[float]:
    """The first twelve of FEATURES for day t of a series: of the days before t alone."""
    with np.errstate(all="ignore"):
        lags = [values[t - k] if t >= k else np.nan for k in (1, 7, 14, 28)]
        back = [(lambda x: x[~np.isnan(x)])(values[max(0, t - w) : t]) for w in (7, 14, 28)]
        means = [x.mean() if len(x) else np.nan for x in back]
        spread = back[-1].std(ddof=1) if len(back[-1]) > 1 else np.nan
    return [*lags, *means, spread, day.dayofweek, day.dayofweek >= 5, day.month, day.quarter]


def rollout(trees: boosting.Trees, values: np.ndarray, first: pd.Timestamp, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts, not below 0, of the days after `values`, and the features each was made of. asks: booked, lead_days,
    days_to_nearest_holiday of each day. A forecast becomes the value of its day, which the lags of later days read."""
    values = np.concatenate([values, np.full(len(asks), np.nan)])
    rows = np.empty((len(asks), len(FEATURES)))
    for j in range(len(asks)):
        t = len(values) - len(asks) + j
        rows[j] = [*day_features(values, t, first + pd.Timedelta(t, "D")), *asks[j]]
        values[t] = max(0.0, boosting.predict(trees, rows[j : j + 1])[0])
    return values[len(values) - len(asks) :], rows


def fit_group(model: str, cutoff: pd.Timestamp, days: pd.DataFrame, panel: pd.DataFrame, asks: pd.DataFrame, explain: bool = False) -> dict:
    """forecast (and low, high; base, parts if asked for) of one model for one property on one cutoff. days: stay_date, value.
    panel: stay_date, lead_days, booked, near. asks: the same for each day to forecast, by lead. Below MIN_OBS observed
    days (or, for trees, snapshots of observed stays): the mean level, 0 if there is none."""
    observed, leads = days["value"].notna().sum(), asks["lead_days"].to_numpy(int)
    level = {"forecast": np.full(len(asks), max(0.0, days["value"].mean()) if observed else 0.0)}
    if observed < MIN_OBS:
        return level
    if model == "ets":
        return {"forecast": np.maximum(series.ets(dense(days["stay_date"], days["value"], cutoff), leads.max())[leads - 1], 0.0)}
    if model == "sarimax":
        made = series.sarima(dense(days["stay_date"], days["value"], cutoff), leads.max())
        return dict(zip(("forecast", "low", "high"), (np.maximum(x[leads - 1], 0.0) for x in made)))
    known = daily(days["stay_date"], days["value"], cutoff)
    values, first = known.to_numpy(), known.index[0]
    t = (pd.DatetimeIndex(panel["stay_date"]) - first).days.to_numpy()
    usable = (t >= 0) & (t < len(values))
    usable[usable] = ~np.isnan(values[t[usable]])
    panel, t = panel[usable], t[usable]
    if len(panel) < MIN_OBS:
        return level
    of_day = {k: day_features(values, k, first + pd.Timedelta(k, "D")) for k in np.unique(t)}
    x = np.concatenate([np.array([of_day[k] for k in t], float), panel[["booked", "lead_days", "near"]].to_numpy(float)], 1)
    trees = boosting.fit(x, values[t], **TREES[model])
    forecast, rows = rollout(trees, values, first, asks[["booked", "lead_days", "near"]].to_numpy(float))
    if not explain:
        return {"forecast": forecast}
    parts, base = boosting.contributions(trees, rows)
    return {"forecast": forecast, "base": np.full(len(asks), base), "parts": list(parts)}


def fitted(demand: DataFrame, pickup: DataFrame, folds: DataFrame, days: int, names: tuple[str, ...] = MODELS[2:], holidays: DataFrame | None = None, explain: bool = False) -> DataFrame:
    """property, fold, model, stay_date, lead_days, booked, forecast, low, high (of sarimax) of the fitted candidates; with
    `explain` also base and parts: what each of FEATURES added to the tree's output. Columns of folds: fold, cutoff."""
    few = F.broadcast(folds.select("fold", "cutoff"))
    grid = asked(demand, pickup, folds, days)
    known = (F.col("stay_date") <= F.col("cutoff")) & (F.datediff("cutoff", "stay_date") < TAIL_DAYS)
    past = demand.select("property", "stay_date", "room_nights").join(few, known)
    blank = lambda c, t: lit(None).cast(t).alias(c)
    day = past.select("property", "fold", "cutoff", lit("day").alias("kind"), "stay_date", blank("lead_days", "int"), blank("booked", "double"), F.col("room_nights").cast("double").alias("value"))
    seen = pickup.join(few, (F.col("snapshot_date") <= F.col("cutoff")) & (F.col("stay_date") <= F.col("cutoff")) & (F.col("lead_days") <= days)).where("pickup_rn is not null")
    last = W.partitionBy("property", "fold").orderBy(F.desc("stay_date"))
    stays = past.where("room_nights is not null").select("property", "fold", "stay_date").distinct()
    stays = seen.select("property", "fold", "stay_date").distinct().join(stays, ["property", "fold", "stay_date"]).withColumn("_n", F.row_number().over(last)).where(F.col("_n") <= PANEL_STAYS).drop("_n")
    panel = seen.join(stays, ["property", "fold", "stay_date"]).groupBy("property", "fold", "cutoff", "stay_date", "lead_days").agg(F.max("pickup_rn").cast("double").alias("booked"))
    columns = ["property", "fold", "cutoff", "kind", "stay_date", "lead_days", "booked", "value"]
    rows = day.unionByName(panel.withColumns({"kind": lit("panel"), "value": lit(None).cast("double")}).select(*columns)).unionByName(grid.withColumns({"kind": lit("ask"), "value": lit(None).cast("double"), "booked": F.col("booked").cast("double")}).select(*columns))
    if holidays is None:
        rows = rows.withColumn("near", lit(None).cast("double"))
    else:
        from .holidays import days_to_nearest

        near = days_to_nearest(rows.where("kind <> 'day'").select("stay_date").distinct(), holidays).select("stay_date", F.col("days_to_holiday").cast("double").alias("near"))
        rows = rows.join(F.broadcast(near), "stay_date", "left")  # a row for each day of the calendar
    trees = [m for m in names if m in TREES]
    rows = rows.withColumn("model", F.explode(F.when(F.col("kind") == "panel", F.array(*[lit(m) for m in trees]).cast("array<string>")).otherwise(F.array(*[lit(m) for m in names]))))
    made = ("forecast", "low", "high", *(("base", "parts") if explain else ()))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        asks = group[group["kind"] == "ask"].sort_values("lead_days")
        out = asks[["property", "fold", "model", "stay_date", "lead_days", "booked"]].reset_index(drop=True)
        if len(asks):
            found = fit_group(key[2], pd.Timestamp(asks["cutoff"].iloc[0]), group[group["kind"] == "day"].sort_values("stay_date"), group[group["kind"] == "panel"].sort_values(["stay_date", "lead_days"]), asks, explain)
        for name in made:
            out[name] = found[name] if len(asks) and name in found else None
        return out

    schema = "property string, fold int, model string, stay_date date, lead_days int, booked double, forecast double, low double, high double" + (", base double, parts array<double>" if explain else "")
    return rows.groupBy("property", "fold", "model").applyInPandas(run, schema)


def statistical(demand: DataFrame, pickup: DataFrame, cutoff: str, horizon: int, model: str) -> DataFrame:
    """property, stay_date, lead_days, forecast, low, high of one fitted candidate on one cutoff."""
    one = demand.sparkSession.range(1).select(lit(0).alias("fold"), lit(cutoff).cast("date").alias("cutoff"))
    return fitted(demand, pickup, one, horizon, (model,)).drop("fold", "model", "booked")


def predictions(demand: DataFrame, pickup: DataFrame, folds: DataFrame, days: int, names: tuple[str, ...] = MODELS, holidays: DataFrame | None = None) -> DataFrame:
    """property, fold, model, stay_date, lead_days, booked, forecast of the named candidates."""
    made = relational(demand, pickup, folds, days).where(F.col("model").isin(*names))
    others = tuple(m for m in names if m not in RELATIONAL)
    return made.unionByName(fitted(demand, pickup, folds, days, others, holidays).select(*made.columns)) if others else made


FEATURES = ("lag_1", "lag_7", "lag_14", "lag_28", "rolling_mean_7", "rolling_mean_14", "rolling_mean_28", "rolling_std_28", "day_of_week", "is_weekend", "month", "quarter", "current_booked_rn", "lead_days", "days_to_nearest_holiday")


def tree_rows(rows: DataFrame, demand: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """rows (property, stay_date, lead_days, booked) with the fifteen FEATURES. Lags and windows are of the days known
    at the row's own snapshot, stay_date - lead_days, and end there: neither the row's target nor a later day is
    in them. Windows run once over the demand by day and are joined by snapshot; a value that isn't known is null."""
    from .asof import range_frame
    from .holidays import days_to_nearest

    back = lambda a, b: range_frame("property", "day", -a, -b)
    v = F.col("room_nights")
    days = demand.select("property", F.col("stay_date").alias("day"), "room_nights")
    asked = rows.select("property", F.date_sub("stay_date", F.col("lead_days")).alias("day")).distinct().withColumn("_asked", lit(True))
    spine = days.join(asked, ["property", "day"], "full_outer")  # a snapshot may fall on a day without demand
    made = spine.withColumns(
        {**{f"lag_{k}": F.max(v).over(back(k - 1, k - 1)) for k in (1, 7, 14, 28)}, **{f"rolling_mean_{w}": F.avg(v).over(back(w - 1, 0)) for w in (7, 14, 28)}, "rolling_std_28": F.stddev_samp(v).over(back(27, 0))}
    ).where("_asked").drop("room_nights", "_asked")
    d = F.col("stay_date")
    out = rows.withColumn("day", F.date_sub("stay_date", F.col("lead_days"))).join(made, ["property", "day"], "left").drop("day")
    out = out.withColumns({"day_of_week": F.weekday(d), "is_weekend": (F.weekday(d) >= 5).cast("int"), "month": F.month(d), "quarter": F.quarter(d), "current_booked_rn": F.col("booked")})
    if holidays is None:
        return out.withColumn("days_to_nearest_holiday", lit(None).cast("int"))
    near = days_to_nearest(rows.select("stay_date").distinct(), holidays)
    return out.join(near.withColumnRenamed("days_to_holiday", "days_to_nearest_holiday"), "stay_date", "left")
