"""The audit against every term of every pair, on rows that are odd in one way or another."""

import random
import re
from collections import Counter
from itertools import groupby

from tidemark.llm import divergence, queries


def plain(rows, min_docs=3, top=200):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for lang, source, text in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = [(a, b, [t.translate(lower) for t in terms]) for a, b, terms in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        df = Counter(t for _, _, terms in mine for t in set(terms))
        kept = {t for t, n in df.items() if n >= min_docs}
        counts = {s: Counter(t for _, x, terms in mine if x == s for t in terms if t in kept) for s in {r[1] for r in mine}}
        whole = sum(counts.values(), Counter())
        p = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        f = lambda a, b: (a - b) ** 2 // b
        for s, c in counts.items():
            pairs = [(x, sum(f(p(c, t), p(d, t)) for t in kept)) for x, d in counts.items() if x != s]
            terms = [(t, f(p(c, t), p(whole, t))) for t in c if c[t] > 0 and p(c, t) > p(whole, t)]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, t, v, k) for k, (t, v) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode())), 1)][:most]
    return sorted(out)


def corpus():
    g = random.Random(4)
    words = [f"{a}{b}" for a in ("wort", "MOT", "É", "日本", "x") for b in "abcdefgh"]
    rows = [(g.choice(["en", "en", "fr", None]), g.choice(["hot", "hot", "hot", "b", "c", None]), " ".join(g.choices(words, k=g.randint(0, 60)))) for _ in range(150)]
    return rows + [("one", "s", "only one group here only one group"), ("bare", "s", "unique"), ("bare", "t", "other"), ("en", "empty", None), ("", "", ""), ("en", "b", "tab\tx-y 1 2\x00z KK " + "lang " * 30_000)] + [("fr", "copies", "mota motb mota")] * 40


def test_query_on_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 20)
    rows = corpus()
    spark.createDataFrame([(None if k % 9 == 0 else k, t, a, b, "x", 1) for k, (a, b, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, term string, n int").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in queries.op13_source_divergence(spark, str(tmp_path)).collect()]
    assert sorted(found) == plain(rows)
    assert any(v > 0 for *_, v, _ in found)


def test_short_list_is_the_head_of_the_long_one(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    found = sorted(tuple(r) for r in divergence.audit(docs, 2, 3).collect())
    assert found == plain(rows, 2, 3)
    for _, group in groupby([r for r in found if r[2] == "term"], key=lambda r: r[:2]):
        assert len(list(group)) <= 3


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).collect() == []
