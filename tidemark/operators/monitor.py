"""Monitoring of what was published: vintages, tracking signals, drift, outliers, retraining."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from ..functions.metrics import error_metrics
from ..functions.scalars import day_number, lead_band, ratio

#: Metric -> (relative, warning, alert).
THRESHOLDS = {"mape": (True, 0.10, 0.25), "wmape": (True, 0.10, 0.25), "bias": (False, 0.05, 0.10)}
RETRAIN_DAYS = {"daily": 1, "weekly": 7, "monthly": 30, "quarterly": 90, "yearly": 365}


def severity(change: Column, warning: float, alert: float) -> Column:
    return F.when(change >= alert, "alert").when(change >= warning, "warning").otherwise("info")


def materialised(published: DataFrame, actuals: DataFrame, through: str) -> DataFrame:
    """Published rows (forecast_date before the stay) with the actuals known by `through`; lead 30 if unknown."""
    rows = published.where((F.col("stay_date") <= lit(through).cast("date")) & (F.col("forecast_date") < F.col("stay_date")))
    return rows.join(actuals.select("property", "stay_date", F.col("room_nights").alias("actual")), ["property", "stay_date"]).withColumn("lead_days", F.coalesce("lead_days", lit(30)))


def vintage_detail(rows: DataFrame) -> DataFrame:
    """Each graded stay: error, error_pct (null for an actual of 0), in_band, lead_band."""
    e = F.col("final_forecast_rn") - F.col("actual")
    return rows.withColumns({"error": e, "abs_error": F.abs(e), "error_pct": ratio(e, "actual"), "in_band": F.col("actual").between(F.col("p10_forecast"), F.col("p90_forecast")), "lead_band": lead_band("lead_days")})


def vintage_score(detail: DataFrame) -> DataFrame:
    """level (global, property, band), name, metrics, tracking_signal (sum of errors over mean absolute one), coverage."""
    sets = detail.groupingSets([[], ["property"], ["lead_band"]], "property", "lead_band").agg(
        *error_metrics("actual", "final_forecast_rn"), ratio(F.sum("error"), F.avg("abs_error")).alias("tracking_signal"), F.avg(F.col("in_band").cast("double")).alias("coverage"), F.grouping("property").alias("gp"), F.grouping("lead_band").alias("gb")
    )
    level = F.when((F.col("gp") == 1) & (F.col("gb") == 1), "global").when(F.col("gp") == 0, "property").otherwise("band")
    return sets.withColumns({"level": level, "name": F.coalesce("property", "lead_band", lit("all"))}).drop("property", "lead_band", "gp", "gb")


def tracking_signals(detail: DataFrame) -> DataFrame:
    return detail.groupBy("property").agg(F.count("error").alias("n"), ratio(F.sum("error"), F.avg("abs_error")).alias("tracking_signal"))


def track_record(records: DataFrame, until: str | None = None) -> DataFrame:
    """One row for each vintage: its latest grading (seq: order of appending; of equal times the earlier stays)."""
    rows = records if until is None else records.where(F.col("timestamp") <= lit(until).cast("timestamp"))
    w = W.partitionBy("vintage").orderBy(F.desc("timestamp"), "seq")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def revision(new: DataFrame, old: DataFrame) -> DataFrame:
    """property, new_total, old_total, delta, delta_pct on the stays both have; delta_pct null for totals up to 0."""
    both = new.select("property", "stay_date", F.col("final_forecast_rn").alias("n")).join(old.select("property", "stay_date", F.col("final_forecast_rn").alias("o")), ["property", "stay_date"])
    g = both.groupBy("property").agg(F.sum("n").alias("new_total"), F.sum("o").alias("old_total"))
    return g.withColumns({"delta": F.col("new_total") - F.col("old_total"), "delta_pct": F.when(F.col("old_total") > 0, ratio(F.col("new_total") - F.col("old_total"), "old_total"))})


def metric_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """metric, reference, current, change, severity of two one-row metric frames."""
    parts = [F.struct(lit(m).alias("metric"), F.col(f"r.{m}").alias("reference"), F.col(f"c.{m}").alias("current"), lit(rel).alias("relative"), lit(w).alias("w"), lit(a).alias("a")) for m, (rel, w, a) in THRESHOLDS.items()]
    rows = reference.alias("r").crossJoin(current.alias("c")).select(F.explode(F.array(*parts)).alias("x")).select("x.*")
    moved = F.when(F.col("relative"), ratio(F.col("current") - F.col("reference"), F.abs("reference"))).otherwise(F.abs(F.col("current")) - F.abs(F.col("reference")))
    return rows.withColumn("change", moved).withColumn("severity", F.when(F.col("change") >= F.col("a"), "alert").when(F.col("change") >= F.col("w"), "warning").otherwise("info")).select("metric", "reference", "current", "change", "severity")


def mean_shift(reference: DataFrame, current: DataFrame, value: str) -> DataFrame:
    """shift of the mean in reference deviations, severity: one row."""
    r = reference.agg(F.avg(value).alias("rm"), F.stddev_samp(value).alias("rs"))
    c = current.agg(F.avg(value).alias("cm"))
    s = F.abs(ratio(F.col("cm") - F.col("rm"), "rs"))
    return r.crossJoin(c).select(lit(value).alias("feature"), s.alias("shift"), severity(s, 0.10, 0.25).alias("severity"))


def psi(reference: DataFrame, current: DataFrame, keys: list[str], value: str, bins: int = 5) -> DataFrame:
    """keys, n_reference, n_current, psi: by quantile bins of the reference (right-closed, equal edges
    merged, empty bins counted as half a row). Fewer than three edges: null."""
    cuts = reference.groupBy(*keys).agg(F.array_distinct(F.percentile(value, [k / bins for k in range(bins + 1)])).alias("edges"), F.count(value).alias("n_reference"))
    edges = cuts.where(F.size("edges") >= 3).select(*keys, F.expr("slice(edges, 2, size(edges) - 2)").alias("inner"))
    both = reference.select(*keys, F.col(value).alias("v"), lit(1).alias("ref")).unionByName(current.select(*keys, F.col(value).alias("v"), lit(0).alias("ref"))).where("v is not null")
    binned = both.join(edges, keys).select(*keys, "ref", F.size(F.filter("inner", lambda e: e < F.col("v"))).alias("bin"))
    counts = binned.groupBy(*keys, "bin").agg(F.count_if(F.col("ref") == 1).alias("r"), F.count_if(F.col("ref") == 0).alias("c"))
    spine = edges.select(*keys, F.explode(F.sequence(lit(0), F.size("inner"))).alias("bin"))
    now = current.groupBy(*keys).agg(F.count(value).alias("n_current"))
    rows = spine.join(counts, [*keys, "bin"], "left").join(cuts, keys).join(now, keys)
    r, c = (F.greatest(F.coalesce(x, lit(0)).cast("double"), lit(0.5)) / n for x, n in (("r", F.col("n_reference")), ("c", F.col("n_current"))))
    return rows.groupBy(*keys, "n_reference", "n_current").agg(F.sum((c - r) * F.ln(c / r)).alias("psi"))


def demand_drift(demand: DataFrame, cutoff: str, days: int = 90, min_days: int = 14) -> DataFrame:
    """property, n_reference, n_current, psi, severity: the last days against the same ones a year before."""
    daily = demand.groupBy("property", "stay_date").agg(F.sum("room_nights").alias("room_nights"))
    at = lit(cutoff).cast("date")
    window = lambda back: daily.where((F.col("stay_date") > F.date_sub(at, back + days)) & (F.col("stay_date") <= F.date_sub(at, back)))
    out = psi(window(365), window(0), ["property"], "room_nights").where(F.col("n_current") >= min_days)
    return out.withColumn("severity", severity(F.col("psi"), 0.30, 0.50))


def curve_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """leads, shift (mean relative change of mean pickup over the leads both have), severity: one row."""
    mean = lambda df, name: df.groupBy("lead_days").agg(F.avg("pickup_rn").alias(name))
    both = mean(reference, "r").join(mean(current, "c"), "lead_days")
    g = both.agg(F.count("*").alias("leads"), F.avg(F.abs(ratio(F.col("c") - F.col("r"), "r"))).alias("shift"))
    return g.withColumn("severity", severity(F.col("shift"), 0.15, 0.35))


def outliers(demand: DataFrame, capacity: DataFrame | None = None, threshold: float = 3.0, half: int = 28) -> DataFrame:
    """property, stay_date, room_nights, zscore, category: days far from the median of the 57 around them, in
    deviations of those (of all days where that is 0 or unknown). None is removed."""
    rows = demand if capacity is None else demand.join(capacity, ["property", "stay_date"], "left")
    if capacity is None:
        rows = rows.withColumn("capacity", lit(None).cast("double"))
    every, day = W.partitionBy("property"), day_number("stay_date")
    order = every.orderBy(day)
    around = order.rangeBetween(-half, half)
    n = F.count("room_nights").over(every)
    least = F.greatest(lit(3), F.least(lit(14), n))
    enough = F.count("room_nights").over(around) >= least
    median, spread = F.when(enough, F.percentile("room_nights", 0.5).over(around)), F.when(enough, F.stddev_samp("room_nights").over(around))
    ahead = every.orderBy("stay_date").rowsBetween(1, 7)
    made = rows.withColumns({"_m": median, "_s": spread, "_all": F.stddev_samp("room_nights").over(every), "_mean": F.avg("room_nights").over(every), "_cap": F.avg("capacity").over(every), "_next": F.avg("room_nights").over(ahead), "_after": F.count("room_nights").over(ahead)})
    sigma = F.when(F.coalesce(F.col("_s") > 0, lit(False)), F.col("_s")).otherwise(F.col("_all"))
    z = F.col("zscore")
    category = (
        F.when(F.col("room_nights") > 1.05 * F.col("capacity"), "data_error").when(F.col("capacity") < 0.7 * F.col("_cap"), "structural")
        .when((F.weekday("stay_date") >= 5) & (z > 0), "seasonality").when(F.month("stay_date").isin(12, 1, 2) & (z > 0), "seasonality")
        .when((F.col("_after") >= 3) & (z > 0) & (F.col("_next") > 1.15 * F.col("_mean")), "structural").otherwise("event")
    )
    return made.withColumn("zscore", ratio(F.col("room_nights") - F.col("_m"), sigma)).where(F.abs("zscore") >= threshold).select("property", "stay_date", "room_nights", "zscore", category.alias("category"))


def should_retrain(frequency: str, new_records: int, days_since: int, min_history: int, history: int, min_new: int = 1) -> tuple[bool, str]:
    """(decision, reason)."""
    f = frequency.lower()
    if f == "never":
        return False, "retraining is switched off"
    if f not in RETRAIN_DAYS:
        return False, f"unknown frequency {frequency}"
    if history < min_history:
        return False, f"history of {history} days is below {min_history}"
    if days_since < RETRAIN_DAYS[f]:
        return False, f"{days_since} of {RETRAIN_DAYS[f]} days have passed"
    if new_records < min_new:
        return False, f"{new_records} new records are below {min_new}"
    return True, f"{f} retraining is due after {days_since} days with {new_records} new records"


def memory_rule(records: DataFrame, per_mode: bool) -> DataFrame:
    """records with previous: the last champion before each record, of its mode or of any. A window holds
    one range of seq; what the ranges before it end with is carried over one row for each range."""
    keys = ["mode"] if per_mode else []
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = records.agg(F.percentile_approx("seq", [k / n for k in range(1, n)] or [0.5])).first()[0] or []
    reached = F.size(F.filter(F.array(*map(lit, sorted(set(bounds)))), lambda x: x <= F.col("seq"))) if bounds else lit(0)
    rows = records.withColumn("_range", reached)
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    ends = rows.groupBy(*keys, "_range").agg(F.max_by("champion", F.when(F.col("champion").isNotNull(), F.col("seq"))).alias("_end"))
    carried = ends.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_range").alias("_at"), F.last("_end", True).over(before(W.partitionBy(*keys or [lit(0)]).orderBy("_range"))).alias("_carried"))
    own = rows.withColumn("_own", F.last("champion", True).over(before(W.partitionBy(*keys, "_range").orderBy("seq"))))
    same = F.col("_range") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return own.join(carried, same, "left").select(*records.columns, F.coalesce("_own", "_carried").alias("previous"))


def drift_suite(before: DataFrame, now: DataFrame, pickups: tuple[DataFrame, DataFrame] | None = None, features: tuple[DataFrame, DataFrame] | None = None, columns: list[str] | None = None) -> DataFrame:
    """kind, change, severity of all drift checks: each metric, the pickup curve, each numeric feature."""
    parts = [metric_drift(before, now).select(F.concat(lit("metric:"), "metric").alias("kind"), "change", "severity")]
    if pickups:
        parts.append(curve_drift(*pickups).select(lit("pickup_curve").alias("kind"), F.col("shift").alias("change"), "severity"))
    for c in columns or []:
        parts.append(mean_shift(*features, c).select(F.concat(lit("feature:"), "feature").alias("kind"), F.col("shift").alias("change"), "severity"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def most_recent_gradable(records: list[dict], read, score, mode: str = "futuro", lookback: int = 5):
    """(record, score) of the newest publication of this mode, of the last `lookback` ones, whose stays have actuals by now.
    read(record): its forecast or None; score(forecast): its grading or None. None if there is none."""
    mine = sorted((r for r in records if r.get("mode") == mode), key=lambda r: str(r.get("timestamp") or ""), reverse=True)
    for r in mine[: max(1, lookback)]:
        found = read(r)
        graded = None if found is None else score(found)
        if graded is not None:
            return r, graded
    return None


def coverage_alerts(coverage: DataFrame, nominal: float = 0.80, slack: float = 0.075, min_obs: int = 30) -> DataFrame:
    """property, n, coverage, nominal, direction (under or over) of properties whose band holds too few or too many actuals; coverage: that
    of `evaluate.coverage`. Fewer than min_obs graded days raise no alert."""
    rows = coverage.where((F.col("level") == "property") & (F.col("n") >= min_obs) & (F.abs(F.col("coverage") - nominal) > slack))
    return rows.select("property", "n", "coverage", lit(nominal).alias("nominal"), F.when(F.col("coverage") < nominal, "under").otherwise("over").alias("direction"))


def retraining_state(history: DataFrame, previous: dict | None, today: str, frequency: str = "monthly", min_history: int = 365) -> dict:
    """What is new since the last training that the registry knows (its training_end is the high-water mark), and whether to train
    again: days_since_last, new_records, history_days, has_previous_run, previous_run_id, retrain, reason."""
    from datetime import date

    from ..sources.store import new_since

    previous = previous or {}
    seen = new_since(history, previous.get("training_end")).first()
    days = 0
    if previous.get("timestamp"):
        days = max(0, (date.fromisoformat(today[:10]) - date.fromisoformat(str(previous["timestamp"])[:10])).days)
    due, reason = should_retrain(frequency, seen["new_records"], days, min_history, seen["span_days"])
    return {"days_since_last": days, "new_records": seen["new_records"], "history_days": seen["span_days"], "has_previous_run": bool(previous.get("timestamp")), "previous_run_id": previous.get("run_id"), "retrain": due, "reason": reason}


def monitoring_block(history: DataFrame, metrics: dict, cutoff: str, today: str, metrics_source: str, previous: dict | None = None, coverage: DataFrame | None = None, frequency: str = "monthly", min_history: int = 365, shown: int = 50) -> dict:
    """The monitoring part of a run: outliers (all counted, the largest `shown` listed), alerts of demand drift by property, of
    metric drift against the previous run (only if its metrics come from the same kind of evaluation) and of bands that
    cover too little or too much, and the state of retraining. history: demand up to the cutoff."""
    found = outliers(history)
    block: dict = {"n_outliers": found.count(), "outliers": [r.asDict() for r in found.orderBy(F.desc(F.abs("zscore")), "property", "stay_date").limit(shown).collect()]}
    notable = F.col("severity").isin("warning", "alert")
    alerts = [{"metric": f"demand_psi:{r['property']}", "severity": r["severity"], "current": r["psi"]} for r in demand_drift(history, cutoff).where(notable).collect()]  # a row for each property
    same = bool(previous) and previous.get("metrics_source") == metrics_source
    if same:
        one = lambda m: history.sparkSession.createDataFrame([tuple(float(m[k]) if m.get(k) is not None else None for k in THRESHOLDS)], ", ".join(f"{k} double" for k in THRESHOLDS))
        alerts += [{"metric": r["metric"], "severity": r["severity"], "reference": r["reference"], "current": r["current"]} for r in metric_drift(one(previous.get("metrics") or {}), one(metrics)).where(notable).collect()]
    if coverage is not None:
        alerts += [{"metric": f"interval_coverage:{r['property']}", "severity": "warning", "reference": r["nominal"], "current": r["coverage"]} for r in coverage_alerts(coverage).collect()]
    return block | {"compared_with": previous.get("run_id") if same else None, "n_drift_alerts": len(alerts), "drift_alerts": alerts, "retraining": retraining_state(history, previous, today, frequency, min_history)}


def vintage_identity(window_start: str, mode: str) -> str:
    """A vintage is told by its mode and the first day that it publishes, so a run repeated on one cutoff is one vintage."""
    return f"{mode}:{window_start}"


#: What a run must fulfil (fixed values).
ACCEPTANCE = ("leakage_clean", "capacity_respected", "metrics_and_breakdowns", "powerbi_present", "manifest_reproducible")


def acceptance_failures(checks: dict[str, bool]) -> list[str]:
    """The acceptance checks that a run doesn't pass; one that wasn't made counts as failed."""
    return [c for c in ACCEPTANCE if not checks.get(c, False)]


def acceptance(leaks: list[str], published: DataFrame, metrics: dict, breakdowns: dict[str, DataFrame], areas: dict[str, DataFrame], manifest: dict | None) -> dict[str, bool]:
    """The five checks of a run, from what it made: leaks is what `leakage.findings` found; no published day is above its capacity; metrics
    have a wmape and every breakdown has rows; the four flat tables have rows; the manifest, read back, matches its fingerprint."""
    from ..sources.store import AREAS, fingerprint

    over = published.where(F.col("final_forecast_rn") > F.col("capacity") + 1e-9).isEmpty()
    return {
        "leakage_clean": not leaks,
        "capacity_respected": over,
        "metrics_and_breakdowns": metrics.get("wmape") is not None and bool(breakdowns) and not any(df.isEmpty() for df in breakdowns.values()),
        "powerbi_present": all(a in areas and not areas[a].isEmpty() for a in AREAS),
        "manifest_reproducible": manifest is not None and manifest.get("fingerprint") == fingerprint(manifest),
    }
