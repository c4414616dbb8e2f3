"""Near copies by the Jaccard index of their shingle sets, against comparing everything with everything."""

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import near_dedup, set_join


def plain_sets(text, n=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def plain_groups(texts):
    """The least index of each text's group."""
    sets, label = [plain_sets(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) * 5 >= len(sets[i] | sets[j]) * 4:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


@pytest.fixture(scope="module")
def texts():
    """Copies with up to a few words changed, so that many pairs lie just above or below 0.8; all hold one common line."""
    g = np.random.default_rng(11)
    out = ["", None, "few words", "Few  words", "only five words are here"]
    for k in range(12):
        base = [f"w{g.integers(0, 3000)}" for _ in range(int(g.integers(20, 150)))]
        for _ in range(12):
            copy = list(base)
            for at in g.choice(len(base), g.integers(0, 2 + len(base) // 30), replace=False):
                copy[at] = f"x{g.integers(0, 3000)}"
            out.append(" ".join([*copy, "all rights reserved by the owners of this site"]))
    return out


def test_near_copies_by_jaccard(spark, texts, monkeypatch):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    want = plain_groups(texts)
    assert 12 < len(set(want)) < len(texts) - 12
    kept = corpus_pipeline.near_dedup_stage(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want))
    monkeypatch.setattr(set_join, "FREQUENT", 2)
    monkeypatch.setattr(set_join, "SAMPLE", 1)
    roots = {r.doc_id: r.root for r in set_join.similar_groups(docs).collect()}
    assert len({(roots[i], w) for i, w in enumerate(want)}) == len(set(want)) == len(set(roots.values()))


def test_repeated_ids_of_different_texts(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six seven", "red orange yellow green blue violet")
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (1, b, "de", "s", 1), (2, b.upper(), "en", "s", 1), (3, a, "en", "s", 1), (3, c, "en", "s", 1), (None, a, "en", "s", 1)]
    for part in (rows, rows[::-1]):
        docs = spark.createDataFrame(part, "doc_id long, text string, lang string, source string, n_chars long")
        kept = {(r.doc_id, r.text, r.lang) for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()}
        assert kept == {(1, a, "en"), (1, b, "de"), (3, c, "en")}


def test_rows_without_an_id_are_judged_last(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    rows = [(None, a, "en", "s", 1), (None, a, "de", "s", 1), (None, b, "en", "s", 1), (7, b, "en", "s", 1), (None, None, "en", "s", 1), (None, "", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text, r.lang) for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()]
    assert sorted(kept, key=str) == sorted([(None, a, "de"), (7, b, "en"), min((None, None, "en"), (None, "", "en"), key=lambda r: hash_of(spark, r[1]))], key=str)


def hash_of(spark, text):
    return spark.createDataFrame([(text,)], "t string").selectExpr("xxhash64(t) as h").first().h


def test_a_template_group_grows_in_proportion(spark):
    """Texts of one template with a block of their own that is too long for 4/5: they share nearly all, and yet don't meet."""
    counts = []
    for many in (200, 800):
        g = np.random.default_rng(many)
        frame = [f"t{k}" for k in range(85)]
        texts = [" ".join(frame[:40] + [f"own{g.integers(0, 10**9)}" for _ in range(15)] + frame[40:]) for _ in range(many)]
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        rows = set_join.prefixes(docs, 5)
        classes = rows.groupBy("class").agg(set_join.F.min("size").alias("size"), set_join.F.first("prefix").alias("prefix"))
        named = set_join.apart(classes.select(set_join.F.posexplode("prefix").alias("place", "s"), "class", "size"), "class").withColumn("root", set_join.F.col("class"))
        counts.append(set_join.meetings(named, 0, None).count())
        assert len({r.root for r in set_join.similar_groups(docs).collect()}) == many
    assert counts[1] <= 5 * max(counts[0], 40)


def test_parities_never_exceed_the_difference():
    g = np.random.default_rng(3)
    for m in (1, 5, 60, 500, 3000):
        a = np.unique(g.integers(0, 1 << 63, m).astype(np.uint64))
        for keep in (0.0, 0.5, 0.8, 0.9, 1.0):
            b = np.unique(np.concatenate([a[: int(keep * len(a))], g.integers(0, 1 << 63, int(m * 0.15) + 1).astype(np.uint64)]))
            differ = len(np.setxor1d(a, b))
            gap = set_join.parity_gap(set_join.parity(a), set_join.parity(b))
            assert gap <= differ and (gap - differ) % 2 == 0
            assert keep < 0.5 or differ < 20 or gap > differ * 0.6
    assert set_join.parity_gap(set_join.parity(np.zeros(0, np.uint64)), set_join.parity(a)) <= len(a)


def test_no_step_plans_many_others(spark, texts, monkeypatch):
    """The driver's memory follows the largest plan that it holds: none reads more than ten tables, however often they recur."""
    largest, settle = {}, set_join.settle

    def seen(df, name):
        largest[name] = max(largest.get(name, 0), df._jdf.queryExecution().analyzed().collectLeaves().size())
        return settle(df, name)

    monkeypatch.setattr(set_join, "settle", seen)
    monkeypatch.setattr(near_dedup, "settle", seen)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = plain_groups(texts)
    roots = {r.doc_id: r.root for r in set_join.similar_groups(docs).collect()}
    assert len({(roots[i], w) for i, w in enumerate(want)}) == len(set(want)) == len(set(roots.values()))
    assert max(largest.values()) <= 10, largest
