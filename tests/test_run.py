"""Two runs in sequence, what they leave behind, and what happens if one dies on the way."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluate, leakage, monitor, run
from tidemark.sources import store

from .test_replay import facts


def test_two_runs_in_sequence(spark, tmp_path):
    demand, pickup, capacity = facts(spark)
    demand, capacity = demand.where("property <> 'c'"), capacity.withColumn("capacity", F.lit(140.0))
    registry = str(tmp_path / "runs" / "registry.json")
    made = {}
    for cutoff, now in (("2024-09-01", "2024-09-02"), ("2024-10-15", "2024-10-16")):
        until = lambda df, c="stay_date": df.where(F.col(c) <= cutoff)
        made[cutoff] = run.run(until(demand), until(pickup, "snapshot_date"), capacity, cutoff, str(tmp_path / "runs" / cutoff), registry, horizon=30, now=now)
        assert all(made[cutoff].checks.values()), made[cutoff].checks
    first, second = made["2024-09-01"], made["2024-10-15"]
    assert first.monitoring["retraining"] | {"reason": ""} == {"days_since_last": 0, "new_records": 2 * 610, "history_days": 610, "has_previous_run": False, "previous_run_id": None, "retrain": False, "reason": ""}
    again = second.monitoring["retraining"]
    assert again["new_records"] == 2 * 44 and again["days_since_last"] == 44 and again["retrain"] and again["previous_run_id"] == first.record["run_id"]
    assert second.monitoring["compared_with"] == first.record["run_id"] and first.monitoring["compared_with"] is None
    assert [r["vintage"] for r in store.load_registry(spark, registry)] == ["futuro:2024-09-02", "futuro:2024-10-16"]
    rows = second.forecast.collect()
    assert len(rows) == 60 and all(r.p10_forecast <= r.p50_forecast == r.final_forecast_rn <= r.p90_forecast <= 140 for r in rows)
    assert second.record["model_by_property"] == {"a": "seasonal_naive", "b": "seasonal_naive"}
    page = store.read_text(spark, run.rebuild_report(spark, str(tmp_path / "runs" / "2024-10-15"), registry))
    assert "Track record" in page and "futuro:2024-09-02" in page and "seasonal_naive" in page
    repeated = store.load_registry(spark, registry) + [first.record | {"timestamp": "2024-09-05", "metrics": {"wmape": 0.5, "bias": 0.0}}]
    track = run.track_table(spark, repeated, "futuro").collect()
    assert [(r.vintage, r.timestamp, r.verdict) for r in track] == [("futuro:2024-09-02", "2024-09-05", "poor"), ("futuro:2024-10-16", "2024-10-16", "good")] and track[1].wmape_change < 0


def deliverables(spark, value):
    one = spark.createDataFrame([(value,)], "x int")
    made = dict.fromkeys(store.DELIVERABLES, one) | {"technical_documentation": f"text {value}", "eda_report": {"rows": value, ("a", 1): float("nan")}}
    return made | {"powerbi_dataset": dict.fromkeys(store.AREAS, one)}


MANIFEST = dict.fromkeys(store.MANIFEST, "x")


def test_a_run_that_dies_leaves_the_old_one_whole(spark, tmp_path):
    where = str(tmp_path / "run")
    assert len(store.write_deliverables(where, deliverables(spark, 1), MANIFEST, spark)) == 10
    dies = spark.createDataFrame([(1,)], "x int").select(F.raise_error(F.lit("gone")).alias("x"))
    with pytest.raises(Exception, match="gone"):
        store.write_deliverables(where, deliverables(spark, 2) | {"model_explainability_report": dies}, MANIFEST, spark)
    back = store.read_deliverables(spark, where)
    assert back["forecast_accuracy_report"].first().x == 1 and back["technical_documentation"] == "text 1" and back["eda_report"] == {"rows": 1, "a|1": None}
    assert [p.name for p in tmp_path.iterdir()] == ["run"]
    store.write_deliverables(where, deliverables(spark, 3), MANIFEST, spark)
    assert store.read_published(spark, where).first().x == 3 and [p.name for p in tmp_path.iterdir()] == ["run"]
    assert store.read_published(spark, str(tmp_path / "none")) is None
    for broken in ({"eda_report": None}, {"powerbi_dataset": {}}):
        with pytest.raises(store.StoreError):
            store.write_deliverables(where, deliverables(spark, 4) | broken, MANIFEST, spark)
    store.delete(spark, f"{where}/eda_report.json")
    with pytest.raises(store.StoreError, match="eda_report"):
        store.read_deliverables(spark, where)


def test_manifest_is_checked_when_read(spark, tmp_path):
    where = str(tmp_path / "run")
    with pytest.raises(store.StoreError, match="seed"):
        store.write_deliverables(where, deliverables(spark, 1), {k: v for k, v in MANIFEST.items() if k != "seed"}, spark)
    with pytest.raises(store.StoreError):
        store.read_manifest(spark, where)
    store.write_deliverables(where, deliverables(spark, 1), MANIFEST, spark)
    made = store.read_manifest(spark, where)
    assert store.same_configuration(made, MANIFEST | {"metrics": 1, "timestamp": 2}) and not store.same_configuration(made, MANIFEST | {"seed": 1})
    text = store.read_text(spark, f"{where}/run_manifest.json")
    for other, why in ((text.replace('"seed": "x"', '"seed": "y"'), "changed"), (text.replace('"seed": "x",', ""), "seed"), ("{", "no readable")):
        store.write_text(spark, f"{where}/run_manifest.json", other)
        with pytest.raises(store.StoreError, match=why):
            store.read_manifest(spark, where)


def test_registry(spark, tmp_path):
    path = str(tmp_path / "a" / "registry.json")
    assert store.load_registry(spark, path) == []
    store.append_record(spark, path, {"run_id": "1", "mode": "futuro", "metrics": {("a", 1): float("nan")}, "at": date(2026, 1, 1)})
    store.append_record(spark, path, {"run_id": "2", "mode": "real", "timestamp": "2026-01-02", "model_by_property": {"a": "ets"}, "metrics": {"wmape": 0.1}})
    assert [r["run_id"] for r in store.load_registry(spark, path)] == ["1", "2"] and store.load_registry(spark, path)[0]["metrics"] == {"a|1": None}
    rows = store.registry_frame(spark, store.load_registry(spark, path)).collect()
    assert rows[1].model_by_property == {"a": "ets"} and rows[1].metrics == {"wmape": 0.1} and rows[0].timestamp is None
    store.write_text(spark, path, "{")
    assert store.load_registry(spark, path) == [] and store.read_text(spark, str(tmp_path / "none")) is None


def test_alerts_and_acceptance(spark):
    graded = spark.createDataFrame([(p, k, 10.0, 5.0, 15.0 if k < share else 9.0, 1) for p, share in (("under", 20), ("over", 40), ("right", 32)) for k in range(40)] + [("few", k, 10.0, 5.0, 9.0, 1) for k in range(20)], "property string, k int, actual double, p10 double, p90 double, lead_days int")
    got = {r.property: (r.direction, r.coverage, r.n) for r in monitor.coverage_alerts(evaluate.coverage(graded)).collect()}
    assert got == {"under": ("under", 0.5, 40), "over": ("over", 1.0, 40)}
    table = spark.createDataFrame([(5.0, 4.0)], "final_forecast_rn double, capacity double")
    areas = dict.fromkeys(store.AREAS, table)
    good = monitor.acceptance([], table.where("false"), {"wmape": 0.1}, {"a": table}, areas, MANIFEST | {"fingerprint": store.fingerprint(MANIFEST)})
    assert monitor.acceptance_failures(good) == []
    bad = monitor.acceptance(["leak"], table, {}, {}, {}, MANIFEST)
    assert monitor.acceptance_failures(bad) == list(monitor.ACCEPTANCE)


def test_the_suite_covers_order_and_features_of_the_whole(spark):
    rows = spark.createDataFrame([("a", date(2024, 1, d), float(d)) for d in range(1, 31)], "property string, stay_date date, room_nights double")
    mean = lambda df: df.crossJoin(df.agg(F.avg("room_nights").alias("level")))
    found = leakage.findings(mean(rows).where("stay_date <= '2024-01-20'"), "2024-01-20", {"strategy": "temporal"}, train=rows, validation=rows, whole={"level": (mean(rows), lambda df: mean(df.drop("level")), ["property", "stay_date"])})
    assert found == ["validation days aren't after training days", "level knows rows after 2024-01-20"]
    centred = rows.withColumn("rolling_mean_3", F.avg("room_nights").over(leakage.range_frame("property", "stay_date", -1, 1)))
    with pytest.raises(leakage.LeakageError, match="centred"):
        leakage.suite(centred, "2024-02-01", {}, windows=(("rolling_mean_3", 3, "mean"),))


def test_horizons():
    assert run.horizon_until(date(2024, 12, 1)) == 30 and run.horizon_until(date(2024, 12, 31), "2025-01-31") == 31
    with pytest.raises(ValueError):
        run.horizon_until(date(2024, 12, 31))


def test_a_run_names_who_takes_no_part(spark, tmp_path):
    demand, pickup, capacity = facts(spark)
    made = run.run(demand, pickup, capacity.withColumn("capacity", F.lit(140.0)), "2024-09-01", str(tmp_path / "run"), str(tmp_path / "registry.json"), horizon=30, now="2024-09-02", closed=("c",), holidays={"countries": ["US"]}, gate=False)
    assert {r["property"]: r["reason"] for r in made.record["evaluation_coverage"]} == {"a": None, "b": None, "c": "closed"}
    assert made.record["holidays"]["countries"] == ["US"] and {r.property for r in made.forecast.select("property").distinct().collect()} == {"a", "b"}
    assert store.load_registry(spark, str(tmp_path / "registry.json"))[0]["evaluation_coverage"][2] == {"property": "c", "evaluated": False, "n_obs": 0, "reason": "closed"}
