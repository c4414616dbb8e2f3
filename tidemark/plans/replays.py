"""The whole run replayed on earlier days, the tested champion, choices that remember earlier runs, and the seven candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import lit

from ..functions.metrics import NAMES
from ..functions.scalars import MODELS
from ..operators import backtest, candidates, evaluate, explain, holidays, replay, selection
from .facts import CUTOFF, HORIZON
from .forecasts import MADE, _STAYS, fold_predictions, kept, rounded
from .registry import query
from .sql import CAPACITY, DEMAND, FOLDS, PICKUP, band, metrics, predictions, season, with_

#: Days of the replayed runs: the second one's is that of the other queries, the first one's 90 days earlier.
RUNS = ("2001-04-01", CUTOFF)
_FOLDS = ", ".join(f"({5 * i + k}, CAST(DATE '{at}' - {90 * (4 - k)} AS DATE))" for i, at in enumerate(RUNS) for k in range(5))
_SCORE = "COALESCE(0.65 * AVG(wmape_short) + 0.35 * AVG(wmape_long), AVG(wmape)) + 0.5 * abs(AVG(bias)) + 0.25 * COALESCE(stddev_samp(wmape), 0)"


def _choices(incumbent: str = "NULL") -> str:
    """CTEs from preds to `ch` (the tested champion) and `pick` (what each property runs) for each run a; incumbent: a SQL expression over a and property."""
    return f"""pm AS (SELECT *, fold // 5 AS a, fold % 5 AS nth FROM preds),
fm AS (SELECT a, model, fold, property, SUM(abs(forecast - actual)) / nullif(SUM(abs(actual)), 0) AS wmape, SUM(forecast - actual) / nullif(SUM(abs(actual)), 0) AS bias,
  SUM(abs(forecast - actual)) FILTER (WHERE lead_days <= 30) / nullif(SUM(abs(actual)) FILTER (WHERE lead_days <= 30), 0) AS wmape_short, SUM(abs(forecast - actual)) FILTER (WHERE lead_days > 30) / nullif(SUM(abs(actual)) FILTER (WHERE lead_days > 30), 0) AS wmape_long FROM pm WHERE nth < 4 GROUP BY ALL),
sc AS (SELECT a, model, {_SCORE} AS composite FROM fm GROUP BY ALL),
scp AS (SELECT a, property, model, COUNT(DISTINCT fold) AS folds, {_SCORE} AS composite FROM fm GROUP BY ALL),
top AS (SELECT a, arg_min(model, composite) AS m1, arg_max(model, composite) AS m2 FROM sc GROUP BY a),
port AS (SELECT a, model, fold, stay_date, SUM(forecast) AS f, SUM(actual) AS y, COUNT(DISTINCT property) AS n FROM pm WHERE nth < 4 GROUP BY ALL),
whole AS (SELECT * FROM port QUALIFY n = MAX(n) OVER (PARTITION BY a, model, fold)),
gaps AS (SELECT a, fold, stay_date, MAX(abs(f - y)) FILTER (WHERE model = m1) - MAX(abs(f - y)) FILTER (WHERE model = m2) AS d FROM whole JOIN top USING (a) GROUP BY ALL HAVING d IS NOT NULL),
x AS (SELECT a, row_number() OVER (PARTITION BY a ORDER BY fold, stay_date) AS i, d - AVG(d) OVER (PARTITION BY a) AS x, COUNT(*) OVER (PARTITION BY a) AS n, AVG(d) OVER (PARTITION BY a) AS mean FROM gaps),
hz AS (SELECT a, least(CAST(floor(median(c)) AS INTEGER), SUM(c)) AS h FROM (SELECT a, fold, COUNT(DISTINCT stay_date) AS c FROM gaps GROUP BY ALL) GROUP BY a),
cov AS (SELECT p.a, q.i - p.i AS k, SUM(p.x * q.x) / MIN(p.n) AS c, MIN(h) AS h, MIN(p.n) AS n, MIN(p.mean) AS mean FROM x p JOIN x q ON p.a = q.a AND q.i >= p.i JOIN hz ON hz.a = p.a AND q.i - p.i < h GROUP BY ALL),
dm AS (SELECT a, MIN(n) AS n, MIN(mean) AS mean, MIN(h) AS h, SUM(CASE WHEN k = 0 THEN c ELSE 2 * (1 - k / CAST(h AS DOUBLE)) * c END) AS v FROM cov GROUP BY a),
test AS (SELECT a, n, CASE WHEN n >= 5 AND v > 0 THEN mean / sqrt(v / n) * sqrt(greatest((n + 1 - 2 * h + h * (h - 1) / CAST(n AS DOUBLE)) / n, 0)) END AS statistic FROM dm),
tied AS (SELECT *, n >= 5 AND COALESCE(abs(statistic) < 1.959963984540054, TRUE) AS tie FROM top JOIN test USING (a)),
ch AS (SELECT a, n, statistic, tie, CASE WHEN tie AND m2 = 'seasonal_naive' THEN m2 ELSE m1 END AS champion, CASE WHEN tie AND m2 = 'seasonal_naive' THEN m1 ELSE m2 END AS runner_up FROM tied),
sci AS (SELECT *, {incumbent} AS incumbent FROM scp JOIN ch USING (a)),
best AS (SELECT a, property, champion, tie, MAX(incumbent) AS incumbent, COUNT(*) FILTER (WHERE folds >= 3) AS models, arg_min(model, composite) FILTER (WHERE folds >= 3) AS winner, MIN(composite) FILTER (WHERE folds >= 3) AS best,
  MAX(composite) FILTER (WHERE folds >= 3 AND model = champion) AS og, MAX(composite) FILTER (WHERE folds >= 3 AND model = incumbent) AS oi FROM sci GROUP BY ALL),
kept AS (SELECT *, COALESCE(incumbent <> winner AND best >= 0.95 * oi, FALSE) AS keeps FROM best),
own AS (SELECT *, CASE WHEN models < 2 THEN champion WHEN keeps THEN incumbent ELSE winner END AS chosen, COALESCE(CASE WHEN keeps THEN oi ELSE best END < 0.95 * og, TRUE) AS clear FROM kept),
pick AS (SELECT a, property, champion, tie, CASE WHEN clear THEN chosen ELSE champion END AS own_model,
  CASE WHEN models < 2 THEN 'too few folds' WHEN chosen = champion THEN 'global champion' WHEN NOT clear THEN 'within the margin' WHEN keeps THEN 'incumbent' ELSE 'own champion' END AS reason FROM own)"""


_RUNS = f"runs AS (SELECT * FROM (VALUES {', '.join(f'''({i}, DATE '{at}')''' for i, at in enumerate(RUNS))}) t(a, as_of))"
_PUBLISH = f"""b AS (SELECT a, pm.property, {band('lead_days')} AS lead_band, {season('stay_date')} AS season, fold, forecast - actual AS e, abs(actual) AS y FROM pm JOIN pick USING (a, property) WHERE nth < 4 AND model = own_model),
s AS (SELECT a, property, lead_band, season, fold, COUNT(*) AS n, SUM(e) AS we, SUM(y) AS wa FROM b GROUP BY GROUPING SETS ((a, property, lead_band, fold), (a, property, lead_band, season, fold))),
t AS (SELECT a, property, lead_band, season, SUM(n) AS n, SUM(we) / nullif(SUM(wa), 0) AS rel, COUNT(*) AS aw, COUNT(*) FILTER (WHERE we > 0) AS uw FROM s GROUP BY ALL),
f AS (SELECT *, CASE WHEN rel > 0 THEN uw ELSE aw - uw END / CAST(aw AS DOUBLE) AS consistency, 1 + (least(greatest(1 - rel, 0.7), 1.3) - 1) * n / (n + 30.0) AS raw FROM t),
o AS (SELECT *, CASE WHEN n >= 20 AND consistency >= 0.75 AND abs(raw - 1) >= 0.005 THEN raw ELSE 1 END AS own FROM f),
fine AS (SELECT x.a, x.property, x.lead_band, x.season, CASE WHEN x.own <> 1 THEN x.own ELSE y.own END AS factor FROM o x JOIN o y ON x.a = y.a AND x.property = y.property AND x.lead_band = y.lead_band AND y.season IS NULL WHERE x.season IS NOT NULL),
asked AS (SELECT m.fold // 5 AS a, m.property, m.stay_date, m.lead_days, m.model AS model_name, k.booked, m.forecast, {band('m.lead_days')} AS lead_band, {season('m.stay_date')} AS season
  FROM made m JOIN pick p ON p.a = m.fold // 5 AND p.property = m.property AND p.own_model = m.model LEFT JOIN booked k ON k.property = m.property AND k.fold = m.fold AND k.stay_date = m.stay_date WHERE m.fold % 5 = 4),
capped AS (SELECT q.*, as_of, COALESCE(fine.factor, o.own, 1) AS factor, q.forecast * COALESCE(fine.factor, o.own, 1) AS raw, COALESCE(c.capacity, d.median, 100.0) AS capacity FROM asked q JOIN runs USING (a)
  LEFT JOIN fine USING (a, property, lead_band, season) LEFT JOIN o ON o.a = q.a AND o.property = q.property AND o.lead_band = q.lead_band AND o.season IS NULL
  LEFT JOIN (SELECT property, stay_date, MAX(capacity) AS capacity FROM capacity GROUP BY ALL) c ON c.property = q.property AND c.stay_date = q.stay_date
  LEFT JOIN (SELECT a, property, quantile_cont(capacity, 0.5) AS median FROM capacity JOIN runs ON stay_date <= as_of GROUP BY ALL) d ON d.a = q.a AND d.property = q.property),
pub AS (SELECT *, least(CASE WHEN raw < booked THEN booked ELSE raw END, capacity) AS final FROM capped),
graded AS (SELECT pub.*, room_nights AS actual FROM pub JOIN demand USING (property, stay_date))"""
_REPLAY = with_(DEMAND, CAPACITY, PICKUP, predictions(_FOLDS), _choices(), _RUNS, _PUBLISH)


def _replayed(spark: SparkSession, d: str) -> DataFrame:
    """What the runs published, with what they chose for the property (champion, tie, reason)."""
    made = replay.replay(kept(spark, d, "demand"), kept(spark, d, "pickup"), kept(spark, d, "capacity"), list(RUNS))
    return made.published.join(made.chosen.select("as_of", "property", "champion", "tie", "model", "reason"), ["as_of", "property"])


MADE["replayed"] = _replayed
MADE["replay_chosen"] = lambda spark, d: kept(spark, d, "replayed").select("as_of", "property", "champion", "tie", "model", "reason").distinct()


@query(_REPLAY + """SELECT as_of, property, stay_date, lead_days, model_name, booked AS current_booked_rn, round(factor, 6) AS bias_correction_factor, round(raw, 6) AS raw_forecast_rn, round(capacity, 6) AS capacity, round(final, 6) AS forecast, actual FROM graded""")
def replay_published(spark: SparkSession, d: str) -> DataFrame:
    rows = replay.graded(kept(spark, d, "replayed"), kept(spark, d, "demand"))
    return rounded(rows.select("as_of", "property", "stay_date", "lead_days", "model_name", "current_booked_rn", "bias_correction_factor", "raw_forecast_rn", "capacity", "forecast", "actual"), "bias_correction_factor", "raw_forecast_rn", "capacity", "forecast")


@query(_REPLAY + f"SELECT as_of, property, {metrics('actual', 'final')} FROM graded GROUP BY 1, 2")
def replay_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = replay.graded(kept(spark, d, "replayed"), kept(spark, d, "demand")).withColumn("as_of", F.col("as_of").cast("string"))
    made = evaluate.by(rows, "as_of", "property").withColumn("as_of", F.to_date("as_of"))
    return rounded(made.select("as_of", "property", *NAMES))


@query(with_(DEMAND, PICKUP, predictions(_FOLDS), _choices(), _RUNS) + "SELECT as_of, property, champion, tie, own_model AS model, reason FROM pick JOIN runs USING (a)")
def replay_choices(spark: SparkSession, d: str) -> DataFrame:
    return kept(spark, d, "replay_chosen").select("as_of", "property", "champion", "tie", "model", "reason")


_LEVELS = """g AS (SELECT property, COUNT(*) AS n, SUM(final - actual) / nullif(SUM(abs(actual)), 0) AS rel, SUM(final - actual) / nullif(AVG(abs(final - actual)), 0) AS ts FROM graded WHERE a = 0 AND (SELECT MAX(stay_date) FROM graded WHERE a = 0) - stay_date < 60 GROUP BY 1),
lv AS (SELECT property, CASE WHEN n >= 10 AND ts IS NOT NULL THEN 1 + least(greatest(-rel, -0.2), 0.2) * least(abs(ts) / 4, 1) * n / (n + 10.0) ELSE 1 END AS level FROM g),
cor AS (SELECT p.*, COALESCE(level, 1) AS level, raw * COALESCE(level, 1) AS levelled FROM pub p LEFT JOIN lv USING (property) WHERE a = 1)"""


@query(
    _REPLAY.rstrip() + ", " + _LEVELS + """ SELECT property, stay_date, lead_days, round(level, 6) AS level_correction_factor, round(factor, 6) AS bias_correction_factor, round(least(CASE WHEN levelled < booked THEN booked ELSE levelled END, capacity), 6) AS final_forecast_rn FROM cor"""
)
def run_corrected(spark: SparkSession, d: str) -> DataFrame:
    """The run of CUTOFF, its levels corrected by what the run before it got wrong."""
    made = replay.corrected_run(kept(spark, d, "replayed"), kept(spark, d, "demand"), RUNS[1], RUNS[0])
    return rounded(made.select("property", "stay_date", "lead_days", "level_correction_factor", "bias_correction_factor", "final_forecast_rn"))


@query(with_(DEMAND, PICKUP, predictions(_FOLDS), _choices()) + "SELECT champion AS model, tie, runner_up, n, round(statistic, 6) AS statistic FROM ch WHERE a = 1")
def dm_champion(spark: SparkSession, d: str) -> DataFrame:
    rows = fold_predictions(spark, d)
    return rounded(selection.tested_champion(rows, selection.scores(selection.fold_metrics(rows))).drop("p"))


def _registry(spark: SparkSession, d: str) -> DataFrame:
    """A record of each replayed run: run_id, mode, timestamp, model_by_property."""
    rows = kept(spark, d, "replay_chosen").groupBy("as_of").agg(F.map_from_entries(F.collect_list(F.struct("property", "model"))).alias("model_by_property"))
    return rows.select(F.concat(lit("run-"), F.col("as_of").cast("string")).alias("run_id"), lit("future").alias("mode"), F.col("as_of").cast("string").alias("timestamp"), "model_by_property")


@query(
    with_(DEMAND, PICKUP, f"first AS (WITH {predictions(_FOLDS)}, {_choices()} SELECT property, own_model AS held FROM pick WHERE a = 0)", predictions(_FOLDS), _choices("(SELECT held FROM first h WHERE h.property = scp.property)"))
    + "SELECT property, (SELECT held FROM first h WHERE h.property = pick.property) AS incumbent, own_model AS model, reason FROM pick WHERE a = 1"
)
def selection_with_incumbents(spark: SparkSession, d: str) -> DataFrame:
    """What each property runs on CUTOFF when the registry remembers the run before."""
    rows = fold_predictions(spark, d)
    scored = selection.fold_metrics(rows)
    held = selection.incumbents(_registry(spark, d), "future", before=CUTOFF)
    champion = selection.tested_champion(rows, selection.scores(scored)).first()["model"]
    return selection.by_property(scored, champion, held).join(held, "property", "left").select("property", "incumbent", "model", "reason")


@query(
    with_(DEMAND, _STAYS)
    + """, m AS (SELECT property, target AS stay_date, lead_days, COUNT(*) AS n_days, AVG(room_nights) AS forecast FROM demand JOIN asked ON stay_date <= cutoff AND stay_date > cutoff - 28 GROUP BY ALL)
SELECT property, stay_date, lead_days, n_days, round(forecast, 6) AS forecast, actual FROM m LEFT JOIN act USING (property, stay_date) UNION ALL SELECT property, stay_date, 0, 0, actual, actual FROM act"""
)
def backtest_callback(spark: SparkSession, d: str) -> DataFrame:
    """Frozen snapshots of all stays and leads, given to a callback as one frame."""
    demand = kept(spark, d, "demand")

    def level(frozen: DataFrame) -> DataFrame:
        recent = frozen.where(F.datediff("cutoff", "stay_date") < 28)
        return recent.groupBy("property", "target", "lead_days").agg(F.count("*").alias("n_days"), F.avg("room_nights").alias("forecast"))

    made = replay.revisions(demand, backtest.sampled_stays(demand), level)
    return rounded(made.select("property", "stay_date", "lead_days", F.coalesce("n_days", lit(0)).alias("n_days"), "forecast", "actual"), "forecast")


# The seven candidates, five of them fitted.


def _holidays(spark: SparkSession) -> DataFrame:
    return holidays.holidays(spark, range(1995, 2003))


MADE["seven"] = lambda spark, d: selection.fold_predictions(kept(spark, d, "demand"), kept(spark, d, "pickup"), CUTOFF, names=MODELS, holidays=_holidays(spark))


@query()
def benchmark_table(spark: SparkSession, d: str) -> DataFrame:
    """All seven over four folds, with the tested champion."""
    rows = kept(spark, d, "seven")
    scored = selection.scores(selection.fold_metrics(rows))
    champion = selection.tested_champion(rows, scored).first()["model"]
    return rounded(selection.benchmark_table(scored, champion).select("model", "parsimony", "wmape", "bias", "composite", "stability_range", "is_champion", "accuracy_band"))


@query()
def selection_of_seven(spark: SparkSession, d: str) -> DataFrame:
    rows = kept(spark, d, "seven")
    scored = selection.fold_metrics(rows)
    champion = selection.tested_champion(rows, selection.scores(scored)).first()["model"]
    return selection.by_property(scored, champion, selection.incumbents(_registry(spark, d), "future", before=CUTOFF))


@query()
def tree_contributions(spark: SparkSession, d: str) -> DataFrame:
    """Shapley values of the boosted trees' forecasts, by feature."""
    one = spark.range(1).select(lit(0).alias("fold"), lit(CUTOFF).cast("date").alias("cutoff"))
    made = candidates.fitted(kept(spark, d, "demand"), kept(spark, d, "pickup"), one, HORIZON, ("lightgbm",), _holidays(spark), explain=True)
    return rounded(explain.tree_contributions(made, candidates.FEATURES))
