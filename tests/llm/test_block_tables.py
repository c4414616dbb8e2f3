"""op7's block tables against comparing every pair, on dense groups that are dealt over salts too."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import fingerprint, queries

BITS, RADIUS = 256, 7


def plain_counts(fps, asked, radius):
    """fingerprint -> (others within radius bits, least distance among them), by comparing everything."""
    whole = {f: int(f, 16) for f in set(fps)}
    out = {}
    for f in set(asked):
        near = [d for g, x in whole.items() if g != f and (d := (x ^ whole[f]).bit_count()) <= radius]
        out[f] = (len(near), min(near, default=None))
    return out


def made(seed, dense):
    """Unrelated fingerprints, near ones of them at distances around the radius, and a dense group around one."""
    g = np.random.default_rng(seed)
    base = [int.from_bytes(g.bytes(32)) for _ in range(40)]
    out = list(base)
    for x in base:
        for n in (1, 6, 7, 8):
            out.append(x ^ sum(1 << int(b) for b in g.choice(BITS, n, replace=False)))
    out += [base[0] ^ (1 << int(a)) ^ (1 << int(b)) for a, b in g.integers(0, BITS, (dense, 2))]
    out += [0, (1 << BITS) - 1]
    return sorted({f"{x:064x}" for x in out})


def test_close_counts(spark):
    fps = made(3, 300)
    frame = spark.createDataFrame([(f,) for f in [*fps, None]], "fingerprint string")
    asked = fps[::3]
    want = plain_counts(fps, asked, RADIUS)
    assert max(n for n, _ in want.values()) > 200
    for salt_rows in (20, 10_000):  # dealt over salts, and not
        rows = fingerprint.close_counts(frame, spark.createDataFrame([(f,) for f in asked + asked[:5]], "fingerprint string"), RADIUS, BITS, salt_rows).collect()
        assert len(rows) == len(want) and {r.fingerprint: (r.n_close, r.nearest) for r in rows} == want
    assert fingerprint.close_counts(frame.limit(0), frame.limit(0)).collect() == []


def test_with_close_keeps_every_row(spark):
    fps = made(4, 30)
    rows = [(k, fps[k % len(fps)], k) for k in range(400)] + [(None, fps[0], 1), (800, None, 1)] + [(850, fps[1], 1)] * 60
    frame = spark.createDataFrame(rows, "doc_id long, fingerprint string, key int")
    asks = F.col("doc_id") % 50 == 0
    found = fingerprint.with_close(frame, asks).collect()
    assert sorted((r.doc_id or -1, r.fingerprint or "", r.key) for r in found) == sorted((i or -1, f or "", k) for i, f, k in rows)
    want = plain_counts(fps, fps, RADIUS)
    for r in found:
        searched = r.doc_id is not None and r.doc_id % 50 == 0 and r.fingerprint is not None
        assert (r.n_close, r.nearest) == (want[r.fingerprint] if searched else (None, None))
    assert fingerprint.with_close(frame.limit(0), asks).collect() == []


def test_query_searches_its_rows(spark, small):
    rows = queries.op7_document_fingerprints(spark, small).collect()
    assert len(rows) == spark.read.parquet(f"{small}/documents.parquet").count()
    want = plain_counts([r.fingerprint for r in rows], [r.fingerprint for r in rows], RADIUS)
    for r in rows:
        assert (r.n_close, r.nearest) == (want[r.fingerprint] if r.doc_id % 50 == 0 else (None, None))
