"""Hot keys in as-of joins, and the ladder of weighted residuals, against plain versions."""

import random
from datetime import date, datetime, timedelta

import numpy as np

from tidemark.operators import asof, ordered, publish

START = datetime(2024, 1, 1)


def test_asof_join_of_a_user_with_half_of_all_rows(spark):
    g = random.Random(1)
    at = lambda: START + timedelta(minutes=g.randint(0, 20_000))
    user = lambda: g.choice(["hot", "hot", "hot", "a", "b", "c", None])
    left = [(k, user(), at() if k % 50 else None) for k in range(3000)]
    right = [(user(), t, float(k)) for k, t in enumerate(sorted({at() for _ in range(800)}))] + [("late", START + timedelta(days=99), 1.0), ("hot", None, -1.0)]
    a = spark.createDataFrame(left, "id int, user string, ts timestamp")
    b = spark.createDataFrame(right, "user string, seen timestamp, value double")
    for ranges in (None, 1, 16):
        found = {r.id: r.value for r in asof.asof_join(a, b, ["user"], "ts", "seen", ["value"], ranges).collect()}
        for k, u, t in left:
            known = [(s, v) for w, s, v in right if u is not None and w == u and t is not None and s is not None and s <= t]
            assert found[k] == (max(known)[1] if known else None)
    pieces = ordered.in_ranges(a.where("user = 'hot'"), "ts", 16).groupBy("user", "_range").count()
    assert pieces.count() >= 12 and pieces.agg({"count": "max"}).first()[0] < 400  # no task holds the whole key
    assert asof.asof_join(a.where("false"), b, ["user"], "ts", "seen", ["value"]).collect() == []
    assert {r.value for r in asof.asof_join(a, b.where("false"), ["user"], "ts", "seen", ["value"]).collect()} == {None}


def test_last_known_at_several_cutoffs(spark):
    rows = spark.createDataFrame([("a", date(2024, 1, d), d * 1.0) for d in (1, 5, 9)] + [("b", date(2024, 1, 7), 7.0)], "k string, day date, v double")
    cuts = spark.createDataFrame([(date(2024, 1, d),) for d in (4, 5, 20)], "cutoff date")
    got = {(r.k, r.cutoff.day): r.v for r in asof.asof_cutoffs(rows, ["k"], "day", ["v"], cuts).collect()}
    assert got == {("a", 4): 1.0, ("a", 5): 5.0, ("a", 20): 9.0, ("b", 20): 7.0}


def plain(values, weights, q):
    values, weights = np.array(values), np.array(weights)
    if (weights == weights[0]).all():
        return np.quantile(values, q)
    order = np.lexsort((weights, values))
    middle = np.cumsum(weights[order]) - weights[order] / 2
    return np.interp(q, middle / middle[-1], values[order])


def test_weighted_cells(spark):
    g = random.Random(2)
    rows = [(p, b, s, round(g.gauss(0, 10) + 5 * (p == "a"), 2), 0.7 ** g.randint(0, 3) if b != "1-2" else 0.5) for p in "ab" for b in ("1-2", "3-6") for s in ("high", "low") for _ in range(60)]
    rows += [("a", "7-13", "low", 1.0, 1.0), ("a", "7-13", "low", None, 1.0), ("a", "7-13", "low", 99.0, 0.0)]
    df = spark.createDataFrame(rows, "property string, lead_band string, season string, residual double, weight double").repartition(3)
    for ranges in (1, 9):
        found = publish.weighted_cells(df, ranges).collect()
        assert len(found) == 1 + 2 + 3 + 5 + 9
        for r in found:
            cell = [(v, w) for p, b, s, v, w in rows if v is not None and w > 0 and r.property in (None, p) and r.lead_band in (None, b) and r.season in (None, s)]
            assert r.n == len(cell)
            for got, q in ((r.q10, 0.1), (r.q90, 0.9)):
                assert abs(got - plain(*zip(*cell), q)) < 1e-9
    assert publish.weighted_cells(df.where("false")).collect() == []


def test_recent_folds_move_the_band(spark):
    rows = [("a", "1-2", "low", float(v + 20 * (fold == 3)), 0.3 ** (3 - fold)) for fold in range(4) for v in range(40)]
    df = spark.createDataFrame(rows, "property string, lead_band string, season string, residual double, weight double")
    decayed = publish.weighted_cells(df).where("level = 0").first()
    even = publish.weighted_cells(df.selectExpr("property", "lead_band", "season", "residual", "1.0D as weight")).where("level = 0").first()
    assert decayed.q10 > even.q10 + 2 and decayed.q90 > even.q90 + 2
    classic = publish.residual_cells(df).where("level = 0").first()
    assert abs(classic.q10 - even.q10) < 1e-9 and abs(classic.q90 - even.q90) < 1e-9
