"""Recall of op6 on edited copies: every pair of a small set is aligned by a plain loop."""

import numpy as np

from tidemark.llm import decontaminate


def score(a, b):
    """Best local score of two word lists, row by row."""
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(max(0, last[j] + (2 if x == y else -1), last[j + 1] - 1, row[j] - 1))
        best = max(best, *row)
    return best


def edited(g, words, share, other):
    """Words changed, dropped or added, each with a third of the share."""
    out = []
    for w in words:
        u = g.random()
        if u < share / 3:
            out.append(str(g.choice(other)))
        elif u < 2 * share / 3:
            continue
        elif u < share:
            out += [w, str(g.choice(other))]
        else:
            out.append(w)
    return out


def test_recall_on_edited_copies(spark, small):
    g = np.random.default_rng(11)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").orderBy("item_id").collect()]
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").limit(120).collect()]
    other = np.array(sorted({w for t in texts for w in (t or "").split()[:200]}))
    docs = []
    for k in range(60):
        words = items[k % len(items)][1].split()
        around = [str(x) for x in g.choice(other, 30)]
        docs.append((k, " ".join([*around[:15], *edited(g, words, (0.1, 0.25, 0.4)[k % 3], other), *around[15:]])))
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    plain = lambda t: decontaminate.normal(t)
    sides = [(i, plain(t)) for i, t in items]
    want = {(d, i) for d, t in docs for i, w in sides if w and score(w, plain(t)) >= 0.5 * 2 * len(w)}
    assert found <= want  # alignment decides, so nothing else is reported
    recall = len(found & want) / len(want)
    print(f"recall {recall:.3f} of {len(want)} pairs")
    assert len(want) >= 40 and recall >= 0.9, (recall, len(want), sorted(want - found)[:10])
