"""Aggregates behind the reports: key figures, daily series, flat BI tables, pooled errors, monthly vintages, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import lit

from ..functions.metrics import error_metrics
from ..functions.scalars import band_order, lead_band, ratio

#: Share of actuals that intervals are meant to hold.
NOMINAL = 0.8
#: Columns of the four flat tables (fixed values).
AREAS = {
    "forecast": ("property", "stay_date", "final_forecast_rn", "capacity", "actual_rn", "variance", "variance_pct"),
    "accuracy": ("property", "mape", "wmape", "bias"),
    "pickup": ("property", "stay_date", "lead_days", "current_booked_rn", "expected_pickup_rn", "pickup_pct"),
    "model": ("model", "wmape", "composite", "is_champion"),
}
GROUPS = {"1-2": "short", "3-6": "short", "7-13": "mid", "14-29": "mid", "30-59": "long", "60-89": "long", "90+": "long"}


def key_figures(forecast: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """One row: forecast, occupancy, accuracy, bias, expected pickup, and the change against the previous forecast."""
    f = F.col("final_forecast_rn")
    metrics = error_metrics("actual", "final_forecast_rn") if "actual" in forecast.columns else []
    row = forecast.agg(
        F.sum(f).alias("forecast_room_nights"), ratio(F.sum(f), F.sum("capacity")).alias("forecast_occupancy"), F.sum(F.greatest(f - F.coalesce("current_booked_rn", lit(0.0)), lit(0.0))).alias("expected_pickup"), *metrics
    )
    if previous is None:
        return row.withColumns({"vs_previous": lit(None).cast("double"), "vs_previous_pct": lit(None).cast("double")})
    before = previous.agg(F.sum("final_forecast_rn").alias("_before"))
    change = F.col("forecast_room_nights") - F.col("_before")
    return row.crossJoin(before).withColumns({"vs_previous": change, "vs_previous_pct": ratio(change, "_before")}).drop("_before")


def portfolio_daily(forecast: DataFrame) -> DataFrame:
    """stay_date and sums of forecast, capacity, bookings, p10 and p90 where there are such columns."""
    names = {"final_forecast_rn": "forecast", "capacity": "capacity", "current_booked_rn": "booked", "p10": "p10", "p90": "p90", "actual": "actual"}
    return forecast.groupBy("stay_date").agg(*[F.sum(c).alias(n) for c, n in names.items() if c in forecast.columns])


def booked_by_band(forecast: DataFrame) -> DataFrame:
    rows = forecast.groupBy(lead_band("lead_days").alias("lead_band")).agg(F.avg("current_booked_rn").alias("mean_booked"), F.count("*").alias("n"))
    return rows.withColumn("band_order", band_order("lead_band"))


def property_bands(metrics: DataFrame, value: str = "wmape") -> DataFrame:
    """property x lead bands of a metric, from (property, lead_band) rows."""
    from ..functions.scalars import BANDS, LAST_BAND

    return metrics.groupBy("property").pivot("lead_band", [*[b for b, _ in BANDS], LAST_BAND]).agg(F.first(value))


def pooled(metrics: DataFrame, min_obs: int = 10) -> DataFrame:
    """lead_group, n, wmape pooled over its bands: sum of mae * n over sum of mae * n / wmape."""
    group = F.element_at(F.create_map(*[lit(x) for kv in GROUPS.items() for x in kv]), F.col("lead_band"))
    error, actual = F.sum(F.col("mae") * F.col("n_obs")), F.sum(F.col("mae") * F.col("n_obs") / F.greatest(F.col("wmape"), lit(1e-9)))
    return metrics.groupBy(group.alias("lead_group")).agg(F.sum("n_obs").alias("n"), ratio(error, actual).alias("wmape")).where(F.col("n") >= min_obs)


def verdict(value: Column, good: float, fair: float) -> Column:
    v = F.abs(value)
    return F.when(v.isNull(), "no data").when(v <= good, "good").when(v <= fair, "fair").otherwise("poor")


def area(df: DataFrame, name: str) -> DataFrame:
    """One of the flat tables: its columns in order, dates as text, missing ones null."""
    rows = df
    if name == "forecast" and "actual_rn" in df.columns:
        v = F.col("final_forecast_rn") - F.col("actual_rn")
        rows = rows.withColumns({"variance": v, "variance_pct": ratio(v, "actual_rn")})
    if name == "pickup" and {"current_booked_rn", "expected_pickup_rn"} <= set(df.columns):
        rows = rows.withColumn("pickup_pct", ratio("expected_pickup_rn", F.col("current_booked_rn") + F.col("expected_pickup_rn")))
    if "stay_date" in rows.columns:
        rows = rows.withColumn("stay_date", F.date_format("stay_date", "yyyy-MM-dd"))
    return rows.select(*[F.col(c) if c in rows.columns else lit(None).cast("double").alias(c) for c in AREAS[name]])


def monthly_vintage(forecast: DataFrame, actual: DataFrame, cutoff: str) -> DataFrame:
    """property, month, projection, actual, error_pct of a mid-month cutoff: actuals up to it and forecast for the
    rest of the month, then the forecast of the next two months."""
    at = lit(cutoff).cast("date")
    month = F.trunc("stay_date", "month")
    window = (month >= F.trunc(at, "month")) & (month <= F.add_months(F.trunc(at, "month"), 2))
    known = actual.where(window & (F.col("stay_date") <= at)).select("property", "stay_date", F.col("room_nights").alias("v"))
    ahead = forecast.where(window & (F.col("stay_date") > at)).select("property", "stay_date", F.col("final_forecast_rn").alias("v"))
    made = known.unionByName(ahead).groupBy("property", month.alias("month")).agg(F.sum("v").alias("projection"))
    real = actual.where(window).groupBy("property", month.alias("month")).agg(F.sum("room_nights").alias("actual"))
    return made.join(real, ["property", "month"], "left").withColumn("error_pct", ratio(F.col("projection") - F.col("actual"), "actual"))


def compare_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """property, wmape and bias of two runs, their changes, better: whether |bias| and wmape of the second are no worse."""
    both = a.select("property", F.col("wmape").alias("wmape_a"), F.col("bias").alias("bias_a")).join(b.select("property", F.col("wmape").alias("wmape_b"), F.col("bias").alias("bias_b")), "property", "full_outer")
    return both.withColumns({"wmape_change": F.col("wmape_b") - F.col("wmape_a"), "bias_change": F.abs("bias_b") - F.abs("bias_a"), "better": F.coalesce((F.col("wmape_b") <= F.col("wmape_a")) & (F.abs("bias_b") <= F.abs("bias_a")), lit(False))})


def compare_coverage(a: DataFrame, b: DataFrame, nominal: float = NOMINAL) -> DataFrame:
    """property, coverage_a, coverage_b, distance_change: how much farther from nominal the second run's coverage lies."""
    both = a.select("property", F.col("coverage").alias("coverage_a")).join(b.select("property", F.col("coverage").alias("coverage_b")), "property", "full_outer")
    return both.withColumn("distance_change", F.abs(F.col("coverage_b") - nominal) - F.abs(F.col("coverage_a") - nominal))


def run_gates(compared: DataFrame, coverage: DataFrame, slack: float = 0.0) -> DataFrame:
    """properties, improved, wmape_holds, bias_holds, coverage_holds, passes: one row over `compare_runs` and `compare_coverage`. A
    criterion holds if no property is worse by more than slack; one that only one run has, or without a value, fails it. The
    second run passes if all hold and a property improves by wmape. Without properties nothing passes."""
    both = compared.join(coverage, "property", "full_outer")
    holds = {f"{c}_holds": F.coalesce(F.bool_and(F.coalesce(F.col(of) <= slack, lit(False))), lit(False)) for c, of in (("wmape", "wmape_change"), ("bias", "bias_change"), ("coverage", "distance_change"))}
    g = both.agg(F.count("*").alias("properties"), F.count_if(F.col("wmape_change") < 0).alias("improved"), *[v.alias(k) for k, v in holds.items()])
    return g.withColumn("passes", F.col("wmape_holds") & F.col("bias_holds") & F.col("coverage_holds") & (F.col("improved") > 0))


def html_page(title: str, tables: dict[str, DataFrame], rows: int = 200) -> str:
    """A plain page of tables (the first rows of each: a view, not data)."""
    from html import escape

    parts = [f"<html><head><meta charset='utf-8'><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1>"]
    for name, df in tables.items():
        parts.append(f"<h2>{escape(name)}</h2><table><tr>" + "".join(f"<th>{escape(c)}</th>" for c in df.columns) + "</tr>")
        parts += ["<tr>" + "".join(f"<td>{escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in df.limit(rows).collect()]
        parts.append("</table>")
    return "".join([*parts, "</body></html>"])


def property_series(forecast: DataFrame) -> DataFrame:
    """property, stay_date, forecast, p10, p90, booked, actual, capacity: what a property's chart shows."""
    return forecast.select("property", "stay_date", F.col("final_forecast_rn").alias("forecast"), "p10", "p90", F.col("current_booked_rn").alias("booked"), "actual", "capacity")


def accuracy_table(graded: DataFrame, cold_start: DataFrame, few: float = 10.0) -> DataFrame:
    """property, the metrics, wmape_weekly, coverage of the band, provisional (a cold start), few_nights (the lowest
    tenth of actuals is below `few`, so the daily MAPE says little)."""
    from . import evaluate

    hit = F.avg(F.when(F.col("p10").isNotNull() & F.col("p90").isNotNull(), F.col("actual").between(F.col("p10"), F.col("p90")).cast("double")))
    extra = graded.groupBy("property").agg(hit.alias("coverage"), (F.percentile("actual", 0.1) < few).alias("few_nights"))
    rows = evaluate.by(graded.withColumn("forecast", F.col("final_forecast_rn")), "property").join(extra, "property")
    weekly = evaluate.weekly(graded.withColumn("forecast", F.col("final_forecast_rn")), "property").select("property", F.col("wmape").alias("wmape_weekly"))
    new = cold_start.select("property").distinct().withColumn("provisional", lit(True))
    return rows.join(weekly, "property", "left").join(new, "property", "left").na.fill(False, ["provisional"])


def benchmark_markdown(table: DataFrame, test: dict | None = None) -> str:
    """The benchmark table (a row for each candidate) and the test of the champion against the second, as Markdown."""
    names = ("model", "mape", "wmape", "mae", "rmse", "bias", "stability", "is_champion")
    names = [c for c in names if c in table.columns]
    show = lambda v: "–" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v)
    rows = table.orderBy("parsimony").select(*names, "is_champion").collect() if "parsimony" in table.columns else table.select(*names).collect()
    lines = ["| " + " | ".join(names) + " |", "|" + "---|" * len(names)] + ["| " + " | ".join(show(r[c]) for c in names) + " |" for r in rows]
    best = next((r["model"] for r in rows if r["is_champion"]), None)
    lines += ["", f"Champion: {best}"]
    if test and test.get("p") is not None:
        lines.append(f"Diebold-Mariano against the second: {test['statistic']:.3f}, p {test['p']:.4f}, n {test['n']}")
    return "\n".join(lines)
