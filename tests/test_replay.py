"""The run replayed on earlier days: what it may read, what it remembers, what it learns."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from tidemark.operators import backtest, calibrate, candidates, replay, selection

START, DAYS = date(2023, 1, 1), 700
RUNS = ["2024-09-01", "2024-11-01"]
WEEK = [50, 52, 55, 60, 80, 90, 70]


def truth(p, k):
    return float(WEEK[(k + (p == "b")) % 7] * (1.5 if p == "b" else 1.0))


def facts(spark, last=START + timedelta(DAYS)):
    """Two properties with a week that repeats, half of it booked 40 days ahead; a third with too few days."""
    days = [(p, START + timedelta(k), truth(p, k)) for p in "ab" for k in range(DAYS)] + [("c", date(2024, 10, 20) + timedelta(k), 3.0) for k in range(20)]
    demand = spark.createDataFrame([r for r in days if r[1] <= last], "property string, stay_date date, room_nights double")
    books = [(p, START + timedelta(k), START + timedelta(k - lead), lead, truth(p, k) * share) for p in "ab" for k in range(DAYS + 60) for lead, share in ((40, 0.5), (10, 0.75), (2, 0.9))]
    pickup = spark.createDataFrame([r for r in books if r[2] <= last], "property string, stay_date date, snapshot_date date, lead_days int, pickup_rn double")
    capacity = demand.where("property <> 'c'").select("property", "stay_date", F.lit(120.0).alias("capacity"))
    return demand, pickup, capacity


def test_a_replayed_run_reads_nothing_later(spark):
    made = replay.replay(*facts(spark)[:2], facts(spark)[2], RUNS, days=30)
    whole, chosen = made.published, made.chosen
    cut = replay.replay(*facts(spark, date(2024, 9, 1))[:2], facts(spark)[2], RUNS[:1], days=30).published
    key = lambda df: {(str(r.as_of), r.property, r.stay_date): (r.model_name, round(r.final_forecast_rn, 6), round(r.capacity, 6)) for r in df.collect()}
    a, b = key(whole), key(cut)
    assert b and {k: v for k, v in a.items() if k[0] == RUNS[0]} == b
    assert {k[:2] for k in a} == {(r, p) for r in RUNS for p in "ab"} and len(a) == 2 * 2 * 30
    rows = {(str(r.as_of), r.property): r for r in chosen.collect()}
    assert all(r.model == "seasonal_naive" for r in rows.values())  # the week repeats, so the naive one is exact
    for r in replay.graded(whole, facts(spark)[0]).collect():
        assert r.forecast == min(truth(r.property, (r.stay_date - START).days), 120.0)
        assert r.current_booked_rn is None or r.forecast >= min(r.current_booked_rn, 120.0)


def metrics(spark, rows):
    return spark.createDataFrame([(p, m, f, w, w, w, 0.0, w, w, w, 5) for p, m, ws in rows for f, w in enumerate(ws)], "property string, model string, fold int, mape double, wmape double, mae double, bias double, rmse double, wmape_short double, wmape_long double, n_obs long")


def test_incumbents_stay_unless_beaten_by_the_margin(spark):
    rows = metrics(spark, [("a", "ets", [0.20] * 4), ("a", "sarimax", [0.195] * 4), ("a", "pickup_curve", [0.3] * 4), ("b", "ets", [0.2] * 4), ("b", "sarimax", [0.1] * 4), ("b", "pickup_curve", [0.3] * 4), ("c", "ets", [0.1] * 2), ("d", "ets", [0.29] * 4), ("d", "pickup_curve", [0.3] * 4)])
    registry = spark.createDataFrame(
        [("r1", "future", "2024-01-01", {"a": "sarimax"}), ("r2", "future", "2024-02-01", {"a": "ets", "b": "ets", "c": "ets"}), ("r3", "real", "2024-03-01", {"a": "catboost"}), ("r4", "future", "2024-04-01", {"a": "xgboost"})],
        "run_id string, mode string, timestamp string, model_by_property map<string,string>",
    )
    held = selection.incumbents(registry, "future", before="2024-03-15")
    assert {r.property: r.incumbent for r in held.collect()} == {"a": "ets", "b": "ets", "c": "ets"}
    assert selection.incumbents(registry, "none").collect() == [] and selection.incumbents(registry.where("false"), "future").collect() == []
    got = {r.property: (r.model, r.reason) for r in selection.by_property(rows, "pickup_curve", held).collect()}
    assert got == {"a": ("ets", "incumbent"), "b": ("sarimax", "own champion"), "c": ("pickup_curve", "too few folds"), "d": ("pickup_curve", "within the margin")}
    free = {r.property: r.model for r in selection.by_property(rows, "pickup_curve").collect()}
    assert free["a"] == "sarimax"
    keyed = rows.withColumn("as_of", F.lit("x")).unionByName(rows.where("model <> 'sarimax'").withColumn("as_of", F.lit("y")))
    champions = spark.createDataFrame([("x", "pickup_curve"), ("y", "ets")], "as_of string, model string")
    both = {(r.as_of, r.property): (r.model, r.reason) for r in selection.by_property(keyed, champions, held, keys=("as_of",)).collect()}
    assert {k[1]: v for k, v in both.items() if k[0] == "x"} == got and both["y", "a"] == ("ets", "global champion")


def test_collapsed_trees_are_replaced_beyond_the_split(spark):
    days = [(p, m, 0, date(2024, 1, 1) + timedelta(k), k + 1, f(k), 10.0) for p in "ab" for m, f in (("xgboost", lambda k: 10.0 if k < 30 else 4.0), ("ets", lambda k: 11.0)) for k in range(60)]
    rows = spark.createDataFrame(days, "property string, model string, fold int, stay_date date, lead_days int, forecast double, actual double").withColumn("as_of", F.lit("2024-01-01"))
    champions = spark.createDataFrame([("2024-01-01", "a", "xgboost"), ("2024-01-01", "b", "ets")], "as_of string, property string, model string")
    found = selection.long_replacement(rows, selection.fold_metrics(rows, keys=("as_of",)), champions, keys=("as_of",), only=tuple(candidates.TREES)).collect()
    assert [(r.property, r.collapsed, r.replacement) for r in found] == [("a", True, "ets")]
    chosen = champions.withColumn("long_model", F.when(F.col("property") == "a", F.lit("ets")))
    week = spark.createDataFrame([("a", 0, d, 1.0 + d / 10) for d in range(7)], "property string, fold int, dow int, factor double")
    got = {(r.property, r.lead_days): (r.model_name, r.forecast) for r in replay.operative(rows, chosen, week).collect()}
    assert got["a", 30] == ("xgboost", 10.0) and got["b", 31] == ("ets", 11.0)
    assert got["a", 31][0] == "ets" and abs(got["a", 31][1] - 11.0 * (1 + date(2024, 1, 31).weekday() / 10)) < 1e-9 and len(got) == 120


def test_the_level_follows_what_was_published(spark):
    demand = spark.createDataFrame([("a", date(2024, 1, 1) + timedelta(k), 100.0) for k in range(120)], "property string, stay_date date, room_nights double")
    made = spark.createDataFrame([(date(2024, 1, 1) + timedelta(30 * r), "a", date(2024, 1, 2) + timedelta(30 * r + k), None, 120.0, 300.0, 120.0) for r in (0, 1) for k in range(30)], "as_of date, property string, stay_date date, current_booked_rn double, raw_forecast_rn double, capacity double, final_forecast_rn double")
    rows = replay.corrected_run(made, demand, "2024-01-31", "2024-01-01").collect()
    factor = calibrate.level_factors(replay.graded(made.where("as_of = '2024-01-01'"), demand)).first()["factor"]
    assert len(rows) == 30 and 0.8 < factor < 0.9 and all(abs(r.final_forecast_rn - 120 * factor) < 1e-9 and r.level_correction_factor == factor for r in rows)
    unknown = replay.corrected_run(made, demand.where("stay_date < '2024-01-02'"), "2024-01-31", "2024-01-01").collect()
    assert all(r.level_correction_factor == 1.0 and r.final_forecast_rn == 120.0 for r in unknown)


def test_callbacks_see_frozen_days_only(spark):
    demand = spark.createDataFrame([("a", date(2024, 1, 1) + timedelta(k), float(k)) for k in range(200)], "property string, stay_date date, room_nights double")
    stays = spark.createDataFrame([(date(2024, 6, 1),), (date(2024, 7, 1),)], "stay_date date")
    latest = lambda frozen: frozen.groupBy("property", "target", "lead_days").agg(F.max("room_nights").alias("forecast"))
    for r in replay.revisions(demand, stays, latest, leads=(30, 7)).collect():
        assert r.forecast == r.actual - r.lead_days == (r.cutoff - date(2024, 1, 1)).days
    assert replay.revisions(demand, stays, latest).where(f"lead_days in {backtest.LEADS}").count() == 2 * len(backtest.LEADS)
