"""A whole run: from the three facts to a committed folder of deliverables and a registry record that the next run reads."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from ..sources import store
from ..sources.files import exclude_properties, latest_record
from ..sources.tables import settle
from . import asof, calibrate, candidates, evaluate, explain, features, holidays as calendars, leakage, monitor, publish, quality, replay, report, selection

MODEL_VERSION, SEED = "tidemark-3", 42
#: What an evaluation is made of: the run before, replayed, against what has come since.
SOURCE = "injected_backtest"
DECAY = 0.7


@dataclass
class RunResult:
    record: dict
    checks: dict[str, bool]
    paths: list[str]
    forecast: DataFrame
    monitoring: dict


def horizon_until(last: date, until: str | None = None) -> int:
    """Days from the last actual to `until` (the end of its year if none is given); raises if there are none."""
    end = date.fromisoformat(until) if until else date(last.year, 12, 31)
    if end <= last:
        raise ValueError(f"the last actual, {last}, is not before {end}: give a later end")
    return (end - last).days


def verification_cutoff(demand: DataFrame, horizon: int) -> str:
    """The cutoff of a run in mode `real`: the horizon before the last actual, so that all of it can be graded."""
    return str(demand.agg(F.max("stay_date")).first()[0] - timedelta(horizon))


def banded(published: DataFrame, made: replay.Replayed) -> DataFrame:
    """published of one as_of with p10, p50, p90 from the weighted residuals of its own corrected folds."""
    cells = settle(publish.weighted_cells(calibrate.residuals(made.runs.drop("as_of"), made.factors.drop("as_of"), DECAY)), "run-cells")
    return publish.intervals(published, cells)


def model_benchmark(made: replay.Replayed) -> tuple[DataFrame, dict]:
    """The benchmark table of one as_of, and the tested champion as a dict."""
    rows = made.folds.drop("as_of")
    scored = selection.scores(selection.fold_metrics(rows))
    found = selection.tested_champion(rows, scored).first()
    test = found.asDict() if found else {"model": None, "p": None}
    return selection.benchmark_table(scored, test["model"]), test


def eda(demand: DataFrame, pickup: DataFrame, capacity: DataFrame) -> DataFrame:
    """source, rows, properties, first_day, last_day, days, missing_days (calendar days of a property without a row): one row each."""

    def of(df: DataFrame, name: str) -> DataFrame:
        each = df.groupBy("property").agg(F.count("*").alias("n"), F.min("stay_date").alias("a"), F.max("stay_date").alias("z"), F.count_distinct("stay_date").alias("d"))
        g = each.agg(F.sum("n").alias("rows"), F.count("*").alias("properties"), F.min("a").alias("first_day"), F.max("z").alias("last_day"), F.sum("d").alias("days"), F.sum(F.datediff("z", "a") + 1 - F.col("d")).alias("missing_days"))
        return g.select(lit(name).alias("source"), F.coalesce("rows", lit(0)).alias("rows"), "properties", "first_day", "last_day", F.coalesce("days", lit(0)).alias("days"), F.coalesce("missing_days", lit(0)).alias("missing_days"))

    return of(demand, "demand").unionByName(of(pickup, "pickup")).unionByName(of(capacity, "capacity"))


def run(
    demand: DataFrame, pickup: DataFrame, capacity: DataFrame, cutoff: str, run_dir: str, registry_path: str, mode: str = "futuro", horizon: int = 90, names: tuple[str, ...] = candidates.RELATIONAL,
    n: int = 4, holidays: DataFrame | dict | None = None, closed: tuple[str, ...] = (), now: str | None = None, frequency: str = "monthly", min_history: int = 365, gate: bool = True,
) -> RunResult:
    """Check the sources, replay the run before, choose with the registry's memory, publish, monitor, and leave it all behind.

    The run of `horizon` days earlier is replayed beside this one: what it got wrong since is the evaluation, and corrects the level. The
    ten deliverables and the manifest appear in run_dir together or not at all; the registry gets its record after that.
    Errors in the sources stop the run if the gate is on; leaks do not, they fail an acceptance check. holidays: a frame of days, or
    a configuration (countries, window_days) from which the calendar is made. closed: properties that take no part; the
    record says who was evaluated and why others weren't."""
    if closed:
        demand, pickup, capacity = (exclude_properties(df, list(closed)) for df in (demand, pickup, capacity))
    calendar = calendars.from_config(demand, holidays) if isinstance(holidays, dict) else None
    holidays = (calendar and calendar.days) if isinstance(holidays, dict) else holidays
    spark = demand.sparkSession
    now = now or f"{date.today()}"
    records = store.load_registry(spark, registry_path)
    previous = latest_record(records, mode)
    issues = settle(reduce(DataFrame.unionByName, [quality.demand_issues(demand), quality.capacity_issues(capacity), quality.pickup_issues(pickup), quality.over_capacity(demand, capacity)]), "run-issues")
    if gate:
        quality.gate(issues)
    history = asof.as_of(demand, cutoff)
    asof.enforce_cutoff(history, cutoff)
    made_features = settle(features.demand_features(history), "run-features")
    leaks = leakage.findings(
        made_features, cutoff, {"strategy": "temporal", "train_end": cutoff}, train=history, validation=demand.where(F.col("stay_date") > lit(cutoff).cast("date")),
        whole={"rolling_mean_7": (features.demand_features(demand), features.demand_features, ["property", "stay_date"])}, windows=(("rolling_mean_7", 7, "mean"),),
    )

    before = str(date.fromisoformat(cutoff) - timedelta(horizon))
    held = selection.incumbents(store.registry_frame(spark, records), mode)
    replayed = replay.replay(demand, pickup, capacity, [before, cutoff], names, n, horizon, held, holidays, DECAY)
    past, this = replayed.of(before), replayed.of(cutoff)
    backtest = settle(banded(replay.graded(past.published, history), past), "run-backtest")
    final = banded(replay.corrected_run(replayed.published, demand, cutoff, before), this).withColumn("expected_pickup_rn", F.greatest(F.col("final_forecast_rn") - F.coalesce("current_booked_rn", lit(0.0)), lit(0.0)))
    final = settle(final.withColumns({"forecast_date": lit(cutoff).cast("date"), "model_version": lit(MODEL_VERSION), "forecast_run_timestamp": lit(now)}).withColumnsRenamed({"p10": "p10_forecast", "p50": "p50_forecast", "p90": "p90_forecast"}), "run-published")
    table = publish.forecast_table(publish.occupancy(final)).drop("missing_required")

    metrics = evaluate.by(backtest.withColumn("all", lit("all")), "all").drop("all").first().asDict() if not backtest.isEmpty() else {}
    breakdowns = {"by_property": evaluate.by(backtest, "property"), "by_lead_band": evaluate.by_lead_band(backtest), "weekly": evaluate.weekly(backtest, "property")}
    coverage = evaluate.coverage(backtest)
    benchmark, test = model_benchmark(this)
    chosen = this.chosen.select("property", "model", "reason", "long_model").orderBy("property").collect()  # a row for each property
    taken = evaluate.evaluated(demand, backtest, closed).orderBy("property").collect()  # a row for each property
    monitoring = monitor.monitoring_block(history, metrics, cutoff, now, SOURCE, previous, coverage, frequency, min_history)
    verdicts = breakdowns["by_property"].withColumns({"wmape_verdict": report.verdict(F.col("wmape"), 0.15, 0.30), "bias_verdict": report.verdict(F.col("bias"), 0.05, 0.10)})
    explained = explain.contributions(final.withColumn("base_value", lit(0.0)), ["current_booked_rn", "expected_pickup_rn"], {"current_booked_rn": 1.0, "expected_pickup_rn": 1.0})
    explained = explained.join(explain.summary(explained, 2), ["property", "stay_date"], "left")
    known = final.join(demand.select("property", "stay_date", F.col("room_nights").alias("actual_rn")), ["property", "stay_date"], "left")
    areas = {"forecast": report.area(known, "forecast"), "accuracy": report.area(breakdowns["by_property"], "accuracy"), "pickup": report.area(final, "pickup"), "model": report.area(benchmark, "model")}
    period = lambda df: {k: str(v) for k, v in df.agg(F.min("stay_date").alias("start"), F.max("stay_date").alias("end")).first().asDict().items()}
    manifest = {
        "dataset_version": store.fingerprint({r["source"]: [r["rows"], str(r["first_day"]), str(r["last_day"])] for r in eda(demand, pickup, capacity).collect()}),
        "model_version": MODEL_VERSION, "training_period": period(history), "validation_period": period(backtest), "feature_config": {"features": list(candidates.FEATURES)},
        "hyperparameters": {"trees": candidates.TREES, "folds": n, "fold_days": horizon, "decay": DECAY, "candidates": list(names), "cutoff": cutoff, "mode": mode}, "metrics": metrics, "seed": SEED, "timestamp": now,
    }
    document = "\n\n".join([f"# Run of {cutoff}", report.benchmark_markdown(benchmark, test), *[f"- {r['property']}: {r['model']} ({r['reason']})" + (f", beyond {selection.LEAD_SPLIT} days {r['long_model']}" if r["long_model"] else "") for r in chosen]])
    paths = store.write_deliverables(
        run_dir,
        {
            "data_quality_report": issues, "eda_report": eda(demand, pickup, capacity), "feature_engineering_report": {"rows": made_features.count(), "columns": made_features.columns, "leaks": leaks},
            "model_benchmark": benchmark, "backtesting_report": backtest, "forecast_accuracy_report": verdicts.join(coverage.where("level = 'property'").select("property", "coverage"), "property", "left"),
            "future_forecast_dataset": table, "model_explainability_report": explained, "powerbi_dataset": areas, "technical_documentation": document,
        },
        manifest, spark,
    )
    back = store.read_deliverables(spark, run_dir)
    checks = monitor.acceptance(leaks, back["future_forecast_dataset"], metrics, breakdowns, back["powerbi_dataset"], store.read_manifest(spark, run_dir))
    first_day = str(date.fromisoformat(cutoff) + timedelta(1))
    record = {
        "run_id": f"{mode}-{cutoff}-{now}", "mode": mode, "timestamp": now, "cutoff": cutoff, "run_dir": run_dir, "training_end": manifest["training_period"]["end"], "champion": test["model"], "metrics": metrics, "metrics_source": SOURCE,
        "model_by_property": {r["property"]: r["model"] for r in chosen}, "vintage": monitor.vintage_identity(first_day, mode), "checks": checks, "monitoring": monitoring,
        "evaluation_coverage": [r.asDict() for r in taken], "holidays": calendars.describe(calendar).first().asDict() if calendar else None,
    }
    store.append_record(spark, registry_path, record)
    return RunResult(record, checks, paths, back["future_forecast_dataset"], monitoring)


def rebuild_report(spark, run_dir: str, registry_path: str | None = None, rows: int = 200) -> str:
    """report.html of a run, made again from its deliverables alone; with a registry also the track record of its mode. Returns its path."""
    found, manifest = store.read_deliverables(spark, run_dir), store.read_manifest(spark, run_dir)
    forecast = found["future_forecast_dataset"]
    tables = {
        "Published days": forecast.groupBy("property").agg(F.count("*").alias("days"), F.round(F.sum("final_forecast_rn"), 1).alias("room_nights"), F.round(F.avg("forecast_occupancy"), 3).alias("occupancy")).orderBy("property"),
        "Accuracy": found["forecast_accuracy_report"].orderBy("property"), "Benchmark": found["model_benchmark"], "Sources": found["eda_report"], "Issues": found["data_quality_report"],
        "Forecast": forecast.select("property", "stay_date", "lead_days", "current_booked_rn", "final_forecast_rn", "p10_forecast", "p90_forecast", "model_name").orderBy("property", "stay_date"),
    }
    if registry_path:
        tables["Track record"] = track_table(spark, store.load_registry(spark, registry_path), manifest["hyperparameters"]["mode"])
    path = f"{run_dir}/report.html"
    store.write_text(spark, path, report.html_page(f"Run of {manifest['hyperparameters']['cutoff']}", tables, rows))
    return path


def track_table(spark, records: list[dict], mode: str) -> DataFrame:
    """vintage, run_id, timestamp, champion, wmape, bias, verdict, wmape_change of each vintage's latest record of a mode, oldest first."""
    rows = [(i, r.get("vintage"), r.get("run_id"), r.get("timestamp"), r.get("champion"), (r.get("metrics") or {}).get("wmape"), (r.get("metrics") or {}).get("bias")) for i, r in enumerate(records) if r.get("mode") == mode]
    made = spark.createDataFrame(rows, "seq int, vintage string, run_id string, timestamp string, champion string, wmape double, bias double")
    last = made.withColumn("_n", F.row_number().over(W.partitionBy("vintage").orderBy(F.desc("timestamp"), F.desc("seq")))).where("_n = 1")
    in_order = W.partitionBy(lit(0)).orderBy("vintage")  # a row for each vintage
    return last.select("vintage", "run_id", "timestamp", "champion", "wmape", "bias", report.verdict(F.col("wmape"), 0.15, 0.30).alias("verdict"), (F.col("wmape") - F.lag("wmape").over(in_order)).alias("wmape_change")).orderBy("vintage")
