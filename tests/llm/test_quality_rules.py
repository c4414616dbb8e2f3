"""The cascade against a plain judgement of every rule, and the order of its rules."""

import re
from collections import Counter

from tidemark.llm import queries, quality_rules as q

PROSE = " ".join(f"word{k} of prose" for k in range(60))
ROWS = [
    (1, PROSE), (2, None), (3, ""), (4, " \t\n\x0b\r"), (5, "few words here"), (6, "same three words " * 40), (7, PROSE.replace(" ", "&&& ")), (8, PROSE.upper()),
    (9, "\n".join(["a line of text that stands alone"] * 3 + [PROSE])), (10, "\n".join([f"kind {k % 4} of line {k % 4}" for k in range(40)])), (11, " ".join(["x" * 60 + str(k) for k in range(80)])),
    (12, PROSE + "   zwei wörter\x85ende"), (13, "lang " * 200_000), (14, " ".join(str(k) for k in range(120_000))), (1, PROSE), (None, PROSE), (15, "a b a b a b a " + PROSE),
]


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    n, chars, symbols, dup, upper = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(re.findall("[A-Z]", text or ""))
    base = n < 50 or 100 * len(hit) > 50 * n
    kept = not (base or 100 * symbols > 30 * n or not 2 * n <= chars <= 20 * n or 100 * dup > 60 * len(lines) or 100 * upper > 50 * chars)
    return n, chars, symbols, dup, len(hit), base, kept


def test_query_on_odd_rows(spark, tmp_path):
    spark.createDataFrame([(*r, 1, "c") for r in ROWS], "doc_id long, text string, n_words int, quality string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_quality_rules(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == sorted(((i, *plain(t)) for i, t in ROWS), key=repr)
    assert {r.doc_id for r in found if r.kept} >= {None, 1, 9, 12, 14, 15} and not {7, 8, 10, 11, 13} & {r.doc_id for r in found if r.kept}
    assert q.cascade(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_order_takes_what_rejects_most_for_its_cost():
    cheap, dear, same = (q.Rule(n, needs, lambda f: False) for n, needs in (("cheap", ("n_symbols",)), ("dear", ("n_repeat_words",)), ("same", ("n_symbols",))))
    cost = {"n_symbols": 10.0, "words": 500.0, "n_repeat_words": 500.0}
    # the dear rule rejects twice as much at a hundred times the cost; what `same` rejects, `cheap` has rejected already
    assert [r.name for r in q.order((dear, same, cheap), cost, {0b001: 200, 0b110: 90, 0b100: 10, 0: 700})] == ["cheap", "dear", "same"]
    assert [r.name for r in q.order((dear, same, cheap), {**cost, "n_repeat_words": 0.0, "words": 0.0}, {0b001: 200, 0b110: 90, 0: 700})] == ["dear", "same", "cheap"]


def test_nothing_is_computed_after_a_failure():
    seen = {}
    assert q.judge("short", (q.RULES[0], *q.RULES[1:]), seen) == "few_words"
    assert set(seen) == {"words", "n_words"}


def test_estimates_cover_the_sample_and_verdicts_do_not_depend_on_it(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    cost, failed = q.estimate(docs, q.RULES, 1000)
    assert sum(failed.values()) == len(ROWS) and set(cost) == {n for r in q.RULES for n in q.closure(r.needs)} and all(v > 0 for v in cost.values())
    for rows in (1, 1000):
        assert sorted(r.quality.kept for r in q.cascade(docs, rows=rows).collect()) == sorted(plain(t)[-1] for _, t in ROWS)
