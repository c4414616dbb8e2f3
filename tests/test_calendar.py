"""The calendar of a configuration, who is evaluated and why, and the gates between two runs."""

from datetime import date

import pytest

from tidemark.operators import evaluate, holidays, report


def test_calendar_from_configuration(spark):
    facts = spark.createDataFrame([("a", date(2023, 3, 1)), ("a", date(2024, 7, 1)), (None, None)], "property string, stay_date date")
    assert holidays.from_config(facts, None) is None and holidays.from_config(facts, {"countries": []}) is None
    with pytest.raises(ValueError, match="FR"):
        holidays.from_config(facts, {"countries": ["US", "FR"]})
    made = holidays.from_config(facts, {"countries": ["US"], "window_days": 2})
    assert {r.date.year for r in made.days.collect()} == {2022, 2023, 2024, 2025}
    found = holidays.describe(made).first()
    # eleven holidays a year; 25 December and 1 January lie seven days apart, so no two windows of two days meet
    assert (found.n_holiday_dates, found.n_dates, found.n_window_days, found.n_scoped_properties, found.window_days, found.countries) == (44, 44, 44 * 5, 0, 2, ["US"])
    assert found["keys"] == sorted(found["keys"]) and "thanksgiving" in found["keys"]
    events = spark.createDataFrame([("Fair", date(2023, 7, 4), None), ("Fair", date(2023, 8, 20), None), ("Own day", date(2023, 8, 20), "a"), ("Lost", None, None)], "event_name string, event_date date, property string")
    with_them = holidays.describe(holidays.from_config(facts, {"countries": ["US"]}, events)).first()
    assert (with_them.n_dates, with_them.n_scoped_properties, with_them.window_days) == (45, 1, 4) and {"fair", "own_day"} <= set(with_them["keys"])
    none = holidays.describe(holidays.from_config(facts.limit(0), {"countries": ["US", "CR"]})).first()
    assert (none.n_holiday_dates, none.n_window_days, none["keys"]) == (0, 0, [])


def test_who_is_evaluated_and_why_not(spark):
    known = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "property string")
    graded = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("c", 2.0), (None, 1.0)], "property string, actual double")
    got = {r.property: (r.evaluated, r.n_obs, r.reason) for r in evaluate.evaluated(known, graded, ("c", "d")).collect()}
    assert got == {"a": (True, 1, None), "b": (False, 0, "no_actuals"), "c": (False, 0, "closed"), "d": (False, 0, "closed")}
    assert {r.property: r.evaluated for r in evaluate.evaluated(known, graded).collect()} == {"a": True, "b": False, "c": True}
    assert evaluate.evaluated(known.limit(0), graded).collect() == []


def test_gates_between_runs(spark):
    runs = lambda rows: spark.createDataFrame(rows, "property string, wmape double, bias double, coverage double")
    first = runs([("a", 0.2, 0.1, 0.7), ("b", 0.3, -0.1, 0.9)])

    def gates(second, slack=0.0):
        return report.run_gates(report.compare_runs(first, second), report.compare_coverage(first, second), slack).first().asDict()

    better = gates(runs([("a", 0.1, -0.05, 0.75), ("b", 0.3, 0.1, 0.8)]))
    assert better == {"properties": 2, "improved": 1, "wmape_holds": True, "bias_holds": True, "coverage_holds": True, "passes": True}
    assert not gates(first)["passes"] and gates(first)["wmape_holds"]
    worse = runs([("a", 0.1, 0.1, 0.7), ("b", 0.31, -0.1, 0.9)])
    assert not gates(worse)["wmape_holds"] and gates(worse, 0.02)["passes"]
    assert not gates(runs([("a", 0.1, 0.0, 0.8)]))["passes"] and not gates(runs([("a", 0.1, 0.0, 0.8), ("b", 0.1, 0.0, None)]))["coverage_holds"]
    empty = first.limit(0)
    assert report.run_gates(report.compare_runs(empty, empty), report.compare_coverage(empty, empty)).first().asDict() == {"properties": 0, "improved": 0, "wmape_holds": False, "bias_holds": False, "coverage_holds": False, "passes": False}
