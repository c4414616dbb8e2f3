"""The vantage-point partition of fingerprints: that every close pair meets, and that shards and boundaries do the work."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import near_dedup


def close_pairs(fps: np.ndarray, radius: int) -> set:
    i, j = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius, 1))
    return {tuple(sorted((int(fps[a]), int(fps[b])))) for a, b in zip(i, j)}


@pytest.mark.parametrize("rows,piece_rows,shard_rows", [(2000, 20_000, 4096), (2000, 60, 4096), (2000, 20_000, 100)])
def test_close_pairs_meet(spark, monkeypatch, rows, piece_rows, shard_rows):
    monkeypatch.setattr(near_dedup, "SHARD_ROWS", shard_rows)
    g = np.random.default_rng(5)
    fps = g.integers(0, 1 << 62, rows // 2)
    flips = np.array([sum(1 << int(b) for b in g.choice(62, 4, replace=False)) for _ in fps])
    fps = np.unique(np.concatenate([fps, fps ^ flips]))
    found = near_dedup.pieces(spark.createDataFrame([(int(x),) for x in fps], "fp long"), 4, piece_rows).toPandas()
    met, crossing = set(), 0
    for _, p in found.groupby(["shard", "band", "a", "b"]):
        index, query = p.fp[p["index"]].to_numpy(), p.fp[p["query"]].to_numpy()
        i, j = np.nonzero(np.bitwise_count(index[:, None] ^ query[None, :]) <= 4)
        met |= {tuple(sorted((int(index[a]), int(query[b])))) for a, b in zip(i, j) if index[a] != query[b]}
        crossing += len(p) - int(p["index"].sum())
    assert met == close_pairs(fps, 4) and len(met) >= rows // 2
    assert found.groupby(["shard", "band", "a", "b"]).ngroups >= 8 and crossing > 0
    if piece_rows == 60:
        assert found.groupby(["shard", "band", "a", "b"]).size().max() <= 4 * piece_rows


def test_given_table_is_cut_by_vantage_points(spark):
    """On the given documents the filter is off: shards, boundaries and trees hold all pairs, fewer than all with all."""
    fps = near_dedup.fingerprints(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).select("fp").distinct()
    n = fps.count()
    assert near_dedup.filter_width(n, 4) == (0, 0)
    sizes = near_dedup.pieces(fps, 4, 20_000).groupBy("shard").agg(F.count_if("index").alias("index"), F.count_if("query").alias("query")).collect()
    assert len(sizes) == 8 and sum(r["index"] for r in sizes) == n and max(r["query"] for r in sizes) > near_dedup.SMALL
    assert sum(r["query"] for r in sizes) > n and sum(r["index"] * r["query"] for r in sizes) < n * n / 2


def test_filter_follows_the_table():
    assert near_dedup.filter_width(0, 4) == (0, 0) and near_dedup.filter_width(4 * near_dedup.SHARD_ROWS, 4) == (0, 0)
    for n in (50_000, 1_000_000, 10**8, 10**10):
        agree, width = near_dedup.filter_width(n, 4)
        assert agree * width >= 3 and n >> agree * width <= near_dedup.SHARD_ROWS
