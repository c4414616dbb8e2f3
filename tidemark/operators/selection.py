"""Fold predictions, scores and the champion, as a whole and for each property."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from ..functions.metrics import error_metrics
from ..functions.scalars import MODELS, accuracy_band, parsimony
from . import candidates, evaluate
from .candidates import fold_cutoffs

BIAS_WEIGHT, STABILITY_WEIGHT, LEAD_ALPHA, LEAD_SPLIT = 0.5, 0.25, 0.65, 30
MIN_FOLDS, OVERRIDE_MARGIN, FOLD_DAYS, MIN_TRAIN = 3, 0.05, 90, candidates.MIN_OBS
#: Level of the Diebold-Mariano test below which the best two candidates differ.
TIE_LEVEL = 0.05
PORTFOLIO = "PORTFOLIO"


def with_actuals(predictions: DataFrame, demand: DataFrame) -> DataFrame:
    """predictions of the days that have an actual, with it."""
    return predictions.join(demand.select("property", "stay_date", F.col("room_nights").alias("actual")), ["property", "stay_date"])


def fold_predictions(demand: DataFrame, pickup: DataFrame, cutoff: str, n: int = 4, days: int = FOLD_DAYS, names: tuple[str, ...] = candidates.RELATIONAL, holidays: DataFrame | None = None) -> DataFrame:
    """property, fold, model, stay_date, lead_days, forecast, actual of the named candidates. Properties with
    less than 60 training rows in a fold or without actuals are left out of it. Folds are a key of one plan, not
    a loop: all of them are computed together."""
    folds = demand.sparkSession.createDataFrame(fold_cutoffs(cutoff, n, days), "fold int, cutoff string").withColumn("cutoff", F.to_date("cutoff"))
    return with_actuals(candidates.predictions(demand, pickup, folds, days, names, holidays).drop("booked"), demand)


def fold_metrics(predictions: DataFrame, split: int = LEAD_SPLIT, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, model, fold, property, the metrics, wmape_short and wmape_long (leads up to and beyond the split)."""
    short, long = (error_metrics(F.when(c, F.col("actual")), "forecast")[3] for c in (F.col("lead_days") <= split, F.col("lead_days") > split))
    return predictions.groupBy(*keys, "model", "fold", "property").agg(*error_metrics(), short.alias("wmape_short"), long.alias("wmape_long")).where("n_obs > 0")


def portfolio_days(predictions: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, model, fold, stay_date, forecast, actual: sums over properties, on the days that all of them have."""
    w = W.partitionBy(*keys, "model", "fold")
    days = predictions.groupBy(*keys, "model", "fold", "stay_date").agg(F.sum("forecast").alias("forecast"), F.sum("actual").alias("actual"), F.count_distinct("property").alias("n"))
    return days.withColumn("_all", F.max("n").over(w)).where("n = _all").drop("n", "_all")


def portfolio_rows(predictions: DataFrame) -> DataFrame:
    """model, fold, property (PORTFOLIO), metrics of portfolio_days."""
    return portfolio_days(predictions).groupBy("model", "fold").agg(*error_metrics()).withColumn("property", lit(PORTFOLIO))


def scores(metrics: DataFrame, *keys: str) -> DataFrame:
    """keys, model, means over the folds, stability (deviation of wmape) and composite (lower is better):
    (0.65 short + 0.35 long wmape, or wmape) + 0.5 |bias| + 0.25 stability."""
    rows = metrics.where(F.col("property") != PORTFOLIO).groupBy(*keys, "model").agg(
        *[F.avg(c).alias(c) for c in ("mape", "wmape", "mae", "rmse", "bias", "wmape_short", "wmape_long")], F.coalesce(F.stddev_samp("wmape"), lit(0.0)).alias("stability"), F.count_distinct("fold").alias("folds"),
        (F.max("wmape") - F.min("wmape")).alias("stability_range"),
    )
    error = F.coalesce(LEAD_ALPHA * F.col("wmape_short") + (1 - LEAD_ALPHA) * F.col("wmape_long"), F.col("wmape"))
    return rows.withColumn("composite", error + BIAS_WEIGHT * F.abs("bias") + STABILITY_WEIGHT * F.col("stability"))


def ranked(scored: DataFrame, *keys: str) -> DataFrame:
    """scored with rank; ties go to the simpler model, then by name."""
    order = [F.asc_nulls_last("composite"), parsimony("model"), "model"]
    return scored.withColumn("rank", F.row_number().over(W.partitionBy(*[F.col(k) for k in keys] or [lit(0)]).orderBy(*order)))


def champion(scored: DataFrame, tie: bool) -> DataFrame:
    """The best model; of a tie with the second (no significant difference) the simpler one. One row."""
    top = ranked(scored).where("rank <= 2")
    key = F.when(lit(tie), F.struct(parsimony("model").alias("a"), F.col("rank").alias("b"))).otherwise(F.struct(F.col("rank").alias("a"), F.col("rank").alias("b")))
    return top.agg(F.min_by("model", key).alias("model"), lit(tie).alias("tie"))


def tested_champion(predictions: DataFrame, scored: DataFrame, level: float = TIE_LEVEL, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, model (the champion), tie, runner_up, n, statistic, p: with the tie rule of the Diebold-Mariano test between the best two on
    the days of the portfolio. A difference that isn't significant is a tie, and the simpler one wins. Fewer than five common
    days, or one candidate alone: no test, so the best stays. One plan; nothing is computed before an action."""
    at = [F.col("rank") == k for k in (1, 2)]
    top = ranked(scored, *keys).where("rank <= 2").groupBy(*keys).agg(*[F.max(F.when(c, F.col("model"))).alias(n) for c, n in zip(at, ("_a", "_b"))])
    two = F.broadcast(top)  # a row for each of the keys' values
    panel = portfolio_days(predictions, keys)
    panel = (panel.join(two, list(keys)) if keys else panel.crossJoin(two)).where("model in (_a, _b)")
    gap = [F.max(F.when(F.col("model") == F.col(c), F.abs(F.col("forecast") - F.col("actual")))) for c in ("_a", "_b")]
    differences = panel.groupBy(*keys, "fold", "stay_date").agg((gap[0] - gap[1]).alias("d")).where("d is not null")
    tested = evaluate.dm_test(differences, keys)
    rows = (top.join(tested, list(keys), "left") if keys else top.join(tested, lit(True), "left")).where("_a is not null")
    tie = F.coalesce((F.col("n") >= 5) & F.coalesce(F.col("p") >= level, lit(True)), lit(False))
    simpler = tie & (parsimony("_b") < parsimony("_a"))
    return rows.select(*keys, F.when(simpler, F.col("_b")).otherwise(F.col("_a")).alias("model"), tie.alias("tie"), F.when(simpler, F.col("_a")).otherwise(F.col("_b")).alias("runner_up"), F.coalesce("n", lit(0)).cast("long").alias("n"), "statistic", "p")


def by_property(metrics: DataFrame, global_champion: str | DataFrame, incumbents: DataFrame | None = None, margin: float = OVERRIDE_MARGIN, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, property, model, reason. Of the models with three folds: the winner, if there are two at least and it
    beats the global champion by the margin; an incumbent stays unless beaten by the margin; else the global one.
    global_champion: a name, or keys and model. incumbents: property (and keys, if it has them), incumbent. The metrics are scored once
    and every choice is an aggregate over a property's models."""
    scored = scores(metrics, *keys, "property")
    if isinstance(global_champion, str):
        scored = scored.withColumn("_global", lit(global_champion))
    else:
        scored = scored.join(F.broadcast(global_champion.select(*keys, F.col("model").alias("_global"))), list(keys))  # a row for each of the keys' values
    if incumbents is None:
        scored = scored.withColumn("incumbent", lit(None).cast("string"))
    else:
        on = [*[k for k in keys if k in incumbents.columns], "property"]
        scored = scored.join(incumbents.select(*on, "incumbent"), on, "left")
    valid = F.col("folds") >= MIN_FOLDS
    of = lambda c, v: F.when(valid & c, v)
    order = F.struct(F.coalesce("composite", lit(float("inf"))), parsimony("model"), F.col("model"))
    rows = scored.groupBy(*keys, "property").agg(
        F.count_if(valid).alias("models"), F.min_by(F.when(valid, F.col("model")), F.when(valid, order)).alias("winner"), F.min(F.when(valid, F.col("composite"))).alias("best"),
        F.max(of(F.col("model") == F.col("_global"), F.col("composite"))).alias("of_global"), F.max(of(F.col("model") == F.col("incumbent"), F.col("composite"))).alias("of_incumbent"),
        F.max("incumbent").alias("incumbent"), F.max("_global").alias("_global"),
    )
    few, default = F.col("models") < 2, F.col("_global")
    keeps = F.coalesce((F.col("incumbent") != F.col("winner")) & (F.col("best") >= (1 - margin) * F.col("of_incumbent")), lit(False))
    chosen = F.when(few, default).when(keeps, F.col("incumbent")).otherwise(F.col("winner"))
    score = F.when(keeps, F.col("of_incumbent")).otherwise(F.col("best"))
    clear = F.coalesce(score < (1 - margin) * F.col("of_global"), lit(True))
    reason = F.when(few, "too few folds").when(chosen == default, "global champion").when(~clear, "within the margin").when(keeps, "incumbent").otherwise("own champion")
    return rows.select(*keys, "property", F.when(clear, chosen).otherwise(default).alias("model"), reason.alias("reason"))


def incumbents(registry: DataFrame, mode: str, before: str | None = None) -> DataFrame:
    """property, incumbent: which model each property ran with in the latest record of a mode (run_id, mode, timestamp,
    model_by_property), of those before a time if one is given. No record, or one without models: no rows."""
    rows = registry.where((F.col("mode") == mode) & (F.col("timestamp") < before if before else lit(True)))
    last = rows.groupBy("mode").agg(F.max_by("model_by_property", F.struct("timestamp", "run_id")).alias("m"))
    return last.select(F.explode("m").alias("property", "incumbent"))


def benchmark_table(scored: DataFrame, champion_model: str) -> DataFrame:
    """A row for each of the seven candidates, run or not."""
    names = scored.sparkSession.createDataFrame([(m,) for m in MODELS], "model string")
    return names.join(scored, "model", "left").withColumns({"accuracy_band": accuracy_band("mape"), "is_champion": F.col("model") == champion_model, "parsimony": parsimony("model")})


def long_replacement(predictions: DataFrame, metrics: DataFrame, champion: str | DataFrame, ratio: float = 0.85, margin: float = 0.95, split: int = LEAD_SPLIT, keys: tuple[str, ...] = (), only: tuple[str, ...] | None = None) -> DataFrame:
    """keys, property, collapsed, replacement: where the champion's long leads collapse (25th percentile beyond the
    split below ratio times that within it), the model of the least wmape_long if it is better by the margin. champion: a name, or
    keys, property and model; only: champions that can collapse."""
    on = [*keys, "property"]
    named = (lambda df: df.withColumn("_own", lit(champion))) if isinstance(champion, str) else (lambda df: df.join(champion.select(*on, F.col("model").alias("_own")), on))
    mine = named(predictions).where(F.col("model") == F.col("_own"))
    if only is not None:
        mine = mine.where(F.col("model").isin(*only))
    mine = mine.groupBy(*on, "_own").agg(F.percentile(F.when(F.col("lead_days") <= split, F.col("forecast")), 0.25).alias("near"), F.percentile(F.when(F.col("lead_days") > split, F.col("forecast")), 0.25).alias("far"))
    long = metrics.where(F.col("property") != PORTFOLIO).groupBy(*on, "model").agg(F.avg("wmape_long").alias("wl")).where("wl is not null")
    best = named(long).groupBy(*on).agg(F.min_by("model", F.struct("wl", "model")).alias("other"), F.min("wl").alias("least"), F.max(F.when(F.col("model") == F.col("_own"), F.col("wl"))).alias("own"))
    rows = mine.join(best, on, "left").withColumn("collapsed", F.coalesce(F.col("far") < ratio * F.col("near"), lit(False)))
    return rows.select(*on, "collapsed", F.when(F.col("collapsed") & (F.col("other") != F.col("_own")) & (F.col("least") < margin * F.col("own")), F.col("other")).alias("replacement"))
