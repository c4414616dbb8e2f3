"""Fitted candidates over the folds, the recursive rollout, and the tie rule of the champion."""

from datetime import date, timedelta

import numpy as np
import pandas as pd

from tidemark.functions import boosting, series
from tidemark.operators import candidates, evaluate, selection

START, CUT = date(2024, 1, 1), date(2025, 3, 1)
WEEK = [50, 52, 55, 60, 80, 90, 70]


def demand(spark, days=500):
    """A weekly pattern with a slow rise for property a; b is too short to be fitted."""
    rows = [("a", START + timedelta(k), float(WEEK[k % 7] + k / 50)) for k in range(days)]
    return spark.createDataFrame(rows + [("b", CUT - timedelta(k), 5.0) for k in range(20)], "property string, stay_date date, room_nights double")


def pickup(spark, days=500):
    """Half of the demand is booked 20 days ahead, four fifths 5 days ahead."""
    rows = [("a", START + timedelta(k), START + timedelta(k - lead), lead, float(share * (WEEK[k % 7] + k / 50))) for k in range(days) for lead, share in ((20, 0.5), (5, 0.8))]
    return spark.createDataFrame(rows, "property string, stay_date date, snapshot_date date, lead_days int, pickup_rn double")


def folds(spark, *cuts):
    return spark.createDataFrame(list(enumerate(cuts)), "fold int, cutoff date")


def test_folds_equal_single_fits(spark):
    rows = demand(spark)
    cuts = (CUT - timedelta(60), CUT)
    known = {r.stay_date: r.room_nights for r in rows.where("property = 'a'").collect()}
    found = {(r.property, r.fold, r.model, r.stay_date): r for r in candidates.fitted(rows, pickup(spark), folds(spark, *cuts), 14, ("ets", "sarimax")).collect()}
    assert len(found) == 2 * 28 and {k[0] for k in found} == {"a"}
    for model, fit in (("ets", series.ets), ("sarimax", lambda y, h: series.sarima(y, h)[0])):
        for fold, cut in enumerate(cuts):  # only days up to the fold's own cutoff are read
            plain = np.maximum(fit(np.array([known[d] for d in sorted(known) if d <= cut]), 14), 0)
            for h in range(14):
                got = found["a", fold, model, cut + timedelta(h + 1)]
                assert abs(got.forecast - plain[h]) < 1e-9 and got.lead_days == h + 1
                assert abs(got.forecast - known[got.stay_date]) < 2  # the season is followed
                assert (got.low is not None) == (model == "sarimax")


def test_rollout_equals_a_plain_loop(spark):
    rows, booked = demand(spark), pickup(spark)
    found = {r.lead_days: r for r in candidates.fitted(rows, booked, folds(spark, CUT), 30, ("lightgbm",), explain=True).collect()}
    known = [r.room_nights for r in rows.where(f"property = 'a' and stay_date <= '{CUT}'").orderBy("stay_date").collect()]
    panel = booked.where(f"snapshot_date <= '{CUT}' and stay_date <= '{CUT}'").orderBy("stay_date", "lead_days").toPandas()
    panel = panel[panel["stay_date"].isin(sorted(panel["stay_date"].unique())[-365:])]

    def features(values, t, lead, rn):
        day = pd.Timestamp(START) + pd.Timedelta(t, "D")
        lags = [values[t - k] if t >= k else np.nan for k in (1, 7, 14, 28)]
        means = [np.mean(values[max(0, t - w) : t]) if t else np.nan for w in (7, 14, 28)]
        spread = np.std(values[max(0, t - 28) : t], ddof=1) if t > 1 else np.nan
        return [*lags, *means, spread, day.dayofweek, day.dayofweek >= 5, day.month, day.quarter, rn, lead, np.nan]

    at = [(d - START).days for d in panel["stay_date"]]
    x = np.array([features(known, t, lead, rn) for t, lead, rn in zip(at, panel["lead_days"], panel["pickup_rn"])], float)
    trees = boosting.fit(x, np.array([known[t] for t in at]), **candidates.TREES["lightgbm"])
    on_books = {r.stay_date: r.pickup_rn for r in booked.where(f"snapshot_date <= '{CUT}' and stay_date > '{CUT}'").orderBy(selection.F.desc("lead_days")).collect()}
    values = list(known)
    for lead in range(1, 31):
        day = CUT + timedelta(lead)
        fits = [r for r in (20, 5) if r >= lead]  # snapshots that the request may use
        rn = on_books[day] if fits and day in on_books else np.nan
        if fits and day in on_books and lead <= 5:
            rn = 0.8 * (WEEK[(day - START).days % 7] + (day - START).days / 50)
        row = features(values, len(values), lead, rn)
        values.append(max(0.0, boosting.predict(trees, np.array([row], float))[0]))
        assert abs(found[lead].forecast - values[-1]) < 1e-9
        assert abs(found[lead].base + sum(found[lead].parts) - found[lead].forecast) < 1e-6


def test_short_series_get_their_level():
    days = pd.DataFrame({"stay_date": pd.date_range("2025-01-01", periods=20), "value": 5.0})
    asks = pd.DataFrame({"stay_date": pd.date_range("2025-01-21", periods=3), "lead_days": [1, 2, 3], "booked": [1.0, None, 2.0], "near": None})
    none = pd.DataFrame({"stay_date": [], "lead_days": [], "booked": [], "near": []})
    for model in candidates.MODELS[2:]:
        assert list(candidates.fit_group(model, pd.Timestamp("2025-01-20"), days, none, asks)["forecast"]) == [5.0] * 3
        assert list(candidates.fit_group(model, pd.Timestamp("2025-01-20"), days[:0], none, asks)["forecast"]) == [0.0] * 3
    long = pd.DataFrame({"stay_date": pd.date_range("2024-01-01", periods=385), "value": 8.0})  # days enough, but no snapshots
    assert list(candidates.fit_group("xgboost", pd.Timestamp("2025-01-20"), long, none, asks)["forecast"]) == [8.0] * 3


def test_later_rows_change_nothing(spark):
    rows, booked = demand(spark), pickup(spark)
    changed = rows.withColumn("room_nights", selection.F.when(selection.F.col("stay_date") > str(CUT), 999.0).otherwise(selection.F.col("room_nights")))
    late = booked.withColumn("pickup_rn", selection.F.when(selection.F.col("snapshot_date") > str(CUT), 999.0).otherwise(selection.F.col("pickup_rn")))
    made = lambda x, y: {(r.model, r.lead_days): round(r.forecast, 6) for r in candidates.predictions(x, y, folds(spark, CUT), 10).collect()}
    a = made(rows, booked)
    assert a == made(changed, late) and {m for m, _ in a} == set(candidates.MODELS) and len(a) == 70


def panel(spark):
    g = np.random.default_rng(5)
    noise = g.normal(0, 1, (40, 2))
    made = []
    for k in range(40):
        day, actual = START + timedelta(k), 100.0
        made += [("a", k // 20, m, day, k % 20 + 1, actual + float(e), actual) for m, e in (("ets", noise[k, 0]), ("seasonal_naive", noise[k, 1] * 1.05), ("sarimax", 30 + noise[k, 0]))]
    return spark.createDataFrame(made, "property string, fold int, model string, stay_date date, lead_days int, forecast double, actual double")


def test_tie_goes_to_the_simpler_one(spark):
    rows = panel(spark)
    even = selection.tested_champion(rows, selection.scores(selection.fold_metrics(rows))).first()
    assert even.tie and even.model == "seasonal_naive" and even.runner_up == "ets" and even.n == 40 and even.p >= 0.05
    two = rows.where("model <> 'seasonal_naive'")
    clear = selection.tested_champion(two, selection.scores(selection.fold_metrics(two))).first()
    assert clear.model == "ets" and clear.runner_up == "sarimax"
    one = rows.where("model = 'sarimax'")
    alone = selection.tested_champion(one, selection.scores(selection.fold_metrics(one))).first()
    assert alone.model == "sarimax" and not alone.tie and alone.runner_up is None
    none = rows.where("false")
    assert selection.tested_champion(none, selection.scores(selection.fold_metrics(none))).collect() == []


def test_the_test_as_a_plan_equals_the_plain_one(spark):
    rows = selection.portfolio_days(panel(spark))
    for a, b in (("ets", "seasonal_naive"), ("ets", "sarimax"), ("ets", "ets")):
        plain = evaluate.diebold_mariano(rows, a, b, evaluate.dm_horizon(rows.where(f"model in ('{a}', '{b}')")))
        d = evaluate.loss_differences(rows, a, b) if a != b else rows.where("model = 'ets'").select("fold", "stay_date", selection.lit(0.0).alias("d"))
        made = evaluate.dm_test(d).first()
        if a == b:
            assert made.statistic is None and made.p is None
        else:
            assert abs(made.statistic - plain["statistic"]) < 1e-9 and abs(made.p - plain["p"]) < 1e-6 and made.n == plain["n"]
