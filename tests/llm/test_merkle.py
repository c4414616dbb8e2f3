"""The manifest against a plain tree, with blocks and a driver's share so small that every round is taken."""

import zlib
from hashlib import sha256

import pytest

from tidemark.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, node int, pos string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    values = [r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, arity):
    """The root of nodes and the siblings of each."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = k // arity * arity
            paths[i].append(("".join(nodes[run:k]), "".join(nodes[k + 1 : run + arity])))
            at[i] = k // arity
        nodes = [h(*nodes[k : k + arity]) for k in range(0, len(nodes), arity)]
    return nodes[0], paths


def plain(rows, arity=2):
    trees = {}
    for r in rows:
        trees.setdefault("" if r[2] is None else "=" + r[2], []).append(r)
    names = sorted(trees, key=str.encode)
    ordered = {t: sorted(trees[t], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for t in names}
    made = {t: climb([leaf(r) for r in ordered[t]], arity) for t in names}
    root, upper = climb([made[t][0] for t in names], arity)
    return root, sorted(((r[0], leaf(r), k, made[t][0], made[t][1][k] + up) for t, up in zip(names, upper) for k, r in enumerate(ordered[t])), key=repr)


def rows_of(n, langs):
    odd = [(None, "no id", "de", "a", 5), (None, "no id", "de", "a", 5), (3, None, "de", None, None), (4, "", None, "b", 0), (5, "x" * 200_000, "", "b", 200_000), (6, "ü: -", "é", "b", 4)]
    return [(*r, "t", 1, "p") for r in odd + [(100 + k, f"text {k} é", f"l{k % langs}" if k % 3 else "hot", f"s{k % 4}", k) for k in range(n)]]


@pytest.mark.parametrize("n, langs, arity, depth, top", [(90, 3, 2, 12, 4096), (90, 3, 2, 2, 4), (60, 40, 2, 1, 3), (80, 5, 3, 2, 5), (0, 1, 2, 3, 1)])
def test_manifest(spark, n, langs, arity, depth, top):
    rows = rows_of(n, langs)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    from pyspark.sql import functions as F

    made = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], carry={"doc_id": F.col("doc_id")}, arity=arity, depth=depth, top=top)
    made = made.withColumn("folded", merkle.fold(F.col("leaf"), F.col("before"), F.col("after"))).collect()
    root, expected = plain(rows, arity)
    assert {r.root for r in made} == {root} == {r.folded for r in made}
    assert sorted(((r.doc_id, r.leaf, r.pos, r.subroot, list(zip(r.before, r.after))) for r in made), key=repr) == expected


def test_query(spark, tmp_path):
    rows = rows_of(200, 3)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_merkle_manifest(spark, str(tmp_path)).collect()
    root, expected = plain(rows)
    proofs = sorted(((i, leaf_, subroot, h(*[s for pair in path for s in pair])) for i, leaf_, _, subroot, path in expected), key=repr)
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.proof_sha256) for r in found), key=repr) == proofs and {r.root for r in found} == {root}
    by_id = {r[0]: r for r in rows}
    for r in found:
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and by_id[r.doc_id][4] is not None
        assert r.verified == (not hit) == (r.folded_root == root)
    assert any(not r.verified for r in found)


def test_empty_table_and_lone_row(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1, "t", 1, "p")], SCHEMA)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    assert merkle.manifest(docs.where("false"), fields).collect() == []
    only = merkle.manifest(docs, fields).first()
    assert only.leaf == only.subroot == only.root and only.before == []
