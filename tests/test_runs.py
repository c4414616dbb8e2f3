"""Sources as read, leakage of the trees' features, decisions without a query."""

from datetime import date, datetime, timedelta

import pytest

from tidemark.operators import candidates, evaluate, leakage, monitor, quality, report
from tidemark.sources import files


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    at = tmp_path_factory.mktemp("sources")
    (at / "demand.csv").write_text("Propiedad,fecha,rn\n" + "".join(f"{p},{d:02d}/01/2026,{d}\n" for p in ("North", "South") for d in range(1, 21)))
    (at / "pickup.csv").write_text("hotel,stay,lead,otb\n" + "".join(f"North,2026-01-{d:02d},{k},{d - k / 10}\n" for d in range(1, 21) for k in (1, 7)))
    (at / "capacity.csv").write_text("hotel_code,business_date,oficial_inventory,notes\n" + "".join(f"North,2026-01-{d:02d},30,x\n" for d in range(1, 21)))
    return {k: str(at / f"{k}.csv") for k in ("demand", "pickup", "capacity")}


def test_ingestion(spark, paths, tmp_path):
    made = files.ingest(spark, paths, {"North": "Upper"}, ["South"])
    assert {r.property for r in made.demand.collect()} == {"Upper"} and made.demand.count() == 20
    assert made.pickup.first().snapshot_date == made.pickup.first().stay_date - timedelta(made.pickup.first().lead_days)
    assert made.issues.collect() == [] and made.schemas["capacity"].unmapped == ["notes"]
    bad = tmp_path / "pickup.csv"
    bad.write_text("hotel,stay,lead,otb\nNorth,2026-01-01,x,1\nNorth,soon,3,1\nNorth,2026-01-05,-2,-1\n,,,\n" + "".join(f"North,2026-02-{d:02d},1,1\n" for d in range(1, 25)))
    found = files.ingest(spark, paths | {"pickup": str(bad)}, gate=False).issues.collect()
    assert {r["check"]: r.records for r in found} == {"invalid_lead": 1, "missing_dates": 1, "negative_lead": 1, "negative_rn": 1, "empty_rows": 1}
    with pytest.raises(quality.CriticalDataError):
        files.ingest(spark, paths | {"pickup": str(bad)})


def test_gaps_and_repeats_in_one_pass(spark):
    rows = [("a", date(2026, 1, d), float(v)) for d, v in ((1, 5), (2, 0), (2, 0), (5, 9), (6, -1))]
    got = {r["check"]: (r.severity, r.records, len(r.dates)) for r in quality.capacity_issues(spark.createDataFrame(rows, "property string, stay_date date, capacity double")).collect()}
    assert got == {"duplicate_property_date": ("error", 2, 1), "zero_capacity": ("warning", 2, 1), "missing_dates": ("warning", 2, 2), "unexpected_capacity_change": ("warning", 3, 3), "negative_capacity": ("error", 1, 1)}


def test_events(spark, tmp_path):
    assert files.load_events(spark, str(tmp_path / "none.csv")) is None
    (tmp_path / "e.csv").write_text("evento,fecha,hotel\nFair,2026-01-05,\nGala,2026-02-01,North\n")
    assert sorted((r.event_name, r.event_date, r.property) for r in files.load_events(spark, str(tmp_path / "e.csv")).collect()) == [("Fair", date(2026, 1, 5), None), ("Gala", date(2026, 2, 1), "North")]
    (tmp_path / "bad.csv").write_text("event,date\nFair,never\n")
    with pytest.raises(ValueError):
        files.load_events(spark, str(tmp_path / "bad.csv"))
    one = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        files.merge_checked(one, one.union(one), ["x"])


def test_tree_features_know_nothing_after_their_snapshot(spark):
    """The features of a row don't change when demand after its snapshot does, its own target included."""
    days = [("a", date(2026, 1, 1) + timedelta(k), float(k * k % 11)) for k in range(60)]
    schema = "property string, stay_date date, room_nights double"
    asked = spark.createDataFrame([("a", date(2026, 2, 10), lead, 1.0) for lead in (1, 7, 20)], "property string, stay_date date, lead_days int, booked double")
    row = lambda values: {r.lead_days: r for r in candidates.tree_rows(asked, spark.createDataFrame(values, schema)).select("lead_days", *[c for c in candidates.FEATURES if c != "lead_days"]).collect()}
    before = row(days)
    for lead, r in before.items():
        snap = date(2026, 2, 10) - timedelta(lead)
        assert row([(p, d, v if d <= snap else v + 100) for p, d, v in days])[lead] == r
        known = [v for _, d, v in days if snap - timedelta(6) <= d <= snap]
        assert r.lag_1 == known[-1] and r.rolling_mean_7 == pytest.approx(sum(known) / 7)


def test_decisions():
    assert leakage.split_problems({"strategy": "temporal", "random_state": 1}) == [] and len(leakage.split_problems({"strategy": "KFold", "shuffle": True, "random_state": 3})) == 3
    assert monitor.should_retrain("monthly", 50, 31, 60, 90)[0] and not monitor.should_retrain("monthly", 50, 3, 60, 90)[0] and not monitor.should_retrain("never", 9, 9, 1, 9)[0]
    records = [{"mode": "futuro", "timestamp": str(k), "run": k} for k in range(8)] + [{"mode": "other", "timestamp": "9"}]
    assert monitor.most_recent_gradable(records, lambda r: r["run"], lambda x: x if x <= 5 else None)[1] == 5
    assert monitor.most_recent_gradable(records, lambda r: r["run"], lambda x: x if x < 2 else None) is None
    assert monitor.acceptance_failures(dict.fromkeys(monitor.ACCEPTANCE, True)) == [] and monitor.acceptance_failures({}) == list(monitor.ACCEPTANCE)


def test_diebold_mariano(spark):
    rows = [(k // 30, date(2026, 1, 1) + timedelta(k), m, 10.0 + (k % 7) * (1.0 if m == "a" else 0.2), 10.0) for k in range(90) for m in "ab"]
    panel = spark.createDataFrame(rows, "fold int, stay_date date, model string, forecast double, actual double")
    made = evaluate.diebold_mariano(panel, "a", "b", 7)
    assert made["n"] == 90 and made["statistic"] > 2 and made["p"] < 0.05 and evaluate.dm_horizon(panel) == 30
    assert evaluate.diebold_mariano(panel.where("stay_date < '2026-01-04'"), "a", "b", 7)["p"] is None


def test_markdown(spark):
    table = spark.createDataFrame([("a", 1.0, True, 0), ("b", None, False, 1)], "model string, wmape double, is_champion boolean, parsimony int")
    text = report.benchmark_markdown(table, {"statistic": 1.0, "p": 0.3, "n": 5})
    assert text.splitlines()[2] == "| a | 1.0000 | True |" and "Champion: a" in text and "p 0.3000" in text


def test_a_publication_time(spark):
    rows = spark.createDataFrame([("v", 1, datetime(2026, 1, 1)), ("v", 2, datetime(2026, 1, 2))], "vintage string, seq int, timestamp timestamp")
    assert monitor.track_record(rows).first().seq == 2 and monitor.track_record(rows, "2026-01-01").first().seq == 1
