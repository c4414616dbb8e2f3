"""Near-duplicate removal: SimHash fingerprints searched through vantage-point partitions.

Plan. Equal fingerprints collapse first (a partial aggregation, so a text copied into a third
of all rows is one row afterwards). Vantage points are fingerprints of the table itself. Each
fingerprint's distances to them, held against their medians, name the shard in which it can be found (the
index side). By the triangle bound |d(x,v) - d(y,v)| <= d(x,y) it asks its own shard and those across every
median that it lies within `radius` of (the query side); of two shards only the one of the greater number asks.
A shard of more than `piece_rows` fingerprints is cut again by the distance to a vantage point of its
own: rings of radius + 1 distances, where a fingerprint near a ring's lower edge is also in the
ring below. A ring that is still too large is dealt over pairs of salts, so every pair meets in a piece of
bounded size. Inside a large piece a vantage-point tree goes on by medians and the same bound; every surviving
pair is compared exactly.

Distances of unrelated fingerprints lie within a few bits of their mean, so each vantage point spares only a
part of the pairs. Tables of more than SHARD_ROWS << MIN_WIDTH - 1 fingerprints are therefore filtered first: of radius + agree
blocks of bits two partners agree on `agree` at least, so the partition is built for each value of the first bits
of each choice of blocks, as many of them as leave about SHARD_ROWS unrelated fingerprints to each. Work for a
fingerprint doesn't grow with the table then.

Pieces return a spanning forest instead of all pairs, so a dense group costs rows
in proportion to its members. Components are then joined across pieces with alternating large-star
and small-star rounds, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, settle, small_batches
from .simhash import fingerprint64

#: Comparisons that a leaf of the tree makes at once.
LEAF = 1 << 16
#: A node is split while its two sides keep less than this share of the queries, on average.
PRUNED = 0.9
#: Fingerprints that one value of the filter leaves to a vantage-point partition on average, at most, if they are unrelated.
SHARD_ROWS = 4096
#: Bits of a block from which the filter spares more than its tables cost.
MIN_WIDTH = 3
#: Vantage points whose distances name a shard.
POINTS = 3
#: Pieces up to this many rows are compared side by side, without a tree.
SMALL = 64
#: Nodes with more links than this, and than this share of all links, have their rows dealt over so many tasks: 200,000 of them at most.
HEAVY, HEAVY_SHARE, SALTS = 256, 1e-5, 32


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, fp (64 bits in a long) of each row's whole text. Null and wordless texts: 0.
    Other columns are neither read nor returned, so they can't clash."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint64(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


class Forest:
    """Labels of a piece's fingerprints; the smallest index reached so far."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.label[i], self.label[j]
            if not (apart := a != b).any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while (self.label != (up := self.label[self.label])).any():
                self.label = up


def tree_links(fps: np.ndarray, index: np.ndarray, query: np.ndarray, radius: int, forest: Forest) -> None:
    """Join every (index, query) pair within radius bits: a vantage-point tree over `index`, in
    which `query` goes to each side that the triangle bound leaves possible."""
    stack = [(index, query)]
    while stack:
        index, query = stack.pop()
        if not len(index) or not len(query):
            continue
        one = forest.label[index[0]]
        if (forest.label[index] == one).all() and (forest.label[query] == one).all():
            continue  # all connected already
        if len(index) * len(query) > LEAF and len(index) > 1:
            point = fps[index[len(index) // 2]]
            near, far = np.bitwise_count(fps[index] ^ point), np.bitwise_count(fps[query] ^ point)
            ball = far <= radius
            if ball.any():  # within radius of the vantage point: linked to it
                hit = query[ball]
                forest.join(hit, np.full(len(hit), index[len(index) // 2]))
            middle = int(np.median(near))
            if (inside := near <= middle).all():
                middle -= 1
                inside = near <= middle
            if inside.any() and not inside.all():
                below, above = query[far <= middle + radius], query[far >= middle + 1 - radius]
                if len(below) + len(above) < PRUNED * 2 * len(query):  # else the bounds save less than they cost
                    stack += [(index[inside], below), (index[~inside], above)]
                    continue
        step = max(1, LEAF // len(index))
        for k in range(0, len(query), step):
            part = query[k : k + step]
            i, j = np.nonzero(np.bitwise_count(fps[part][:, None] ^ fps[index][None, :]) <= radius)
            forest.join(part[i], index[j])


def piece_links(fps: np.ndarray, index: np.ndarray, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The spanning forest of one piece: fingerprints of the index are compared with those of the query."""
    forest, order = Forest(len(fps)), np.arange(len(fps))
    tree_links(fps, order[index], order[query], radius, forest)
    linked = forest.label != order
    return fps[linked], fps[forest.label[linked]]


def neighbour_links(fps: np.ndarray, piece: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within small pieces, many pieces at once: each row with the one k places on, while that is of its piece."""
    u, v, at = [], [], np.arange(len(fps))
    for k in range(1, SMALL):
        at = at[at + k < len(fps)]
        at = at[piece[at] == piece[at + k]]
        if not len(at):
            break
        near = at[np.bitwise_count(fps[at] ^ fps[at + k]) <= radius]
        u.append(fps[near]), v.append(fps[near + k])
    return (np.concatenate(u), np.concatenate(v)) if u else (fps[:0], fps[:0])


def vantage(nodes: DataFrame, count: int = POINTS) -> tuple[list[tuple[int, int]], int]:
    """(vantage point, median of all distances to it), and the number of nodes. The points are fingerprints of the table,
    those of the least hashes; two jobs, of which the driver gets `count` numbers each."""
    points = [r.fp for r in nodes.orderBy(F.xxhash64("fp"), "fp").limit(count).collect()]
    far = [F.percentile_approx(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))), 0.5, 1000) for p in points]
    n, *medians = nodes.agg(F.count("*"), *far).first()
    return list(zip(points, medians)), n


def filter_width(n: int, radius: int) -> tuple[int, int]:
    """(blocks that must agree, first bits of each that are looked at) for about SHARD_ROWS of n unrelated fingerprints; (0, 0) for small tables."""
    wanted = max(0, (max(n, 1) - 1) // SHARD_ROWS).bit_length()
    if wanted < MIN_WIDTH:
        return 0, 0
    agree = next((k for k in range(1, 4) if k * (64 // (radius + k)) >= wanted), 4)
    return agree, min(-(-wanted // agree), 64 // (radius + agree))


def shards(nodes: DataFrame, radius: int, agree: int, width: int, points: list[tuple[int, int]]) -> DataFrame:
    """shard, index, fp: each fingerprint in its own shard (index), and in those that it must ask as well."""
    blocks = radius + agree
    begins = [round(64 * b / blocks) for b in range(blocks)]
    mask = lambda t: sum(((1 << width) - 1) << begins[b] for b in t)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    tables = [F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(signed(mask(t))))) for n, t in enumerate(combinations(range(blocks), agree))]
    far = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))) - F.lit(m) for p, m in points]  # above zero: the outer side
    own = sum((F.when(d > 0, F.lit(1 << k)).otherwise(0) for k, d in enumerate(far)), F.lit(0))
    near = sum((F.when((d <= radius) & (d > -radius), F.lit(1 << k)).otherwise(0) for k, d in enumerate(far)), F.lit(0))
    asked = F.filter(F.sequence(F.lit(0), F.lit((1 << len(points)) - 1)), lambda c: (c <= F.col("own")) & (c.bitwiseXOR(F.col("own")).bitwiseAND(F.bitwise_not(F.col("near"))) == 0))
    placed = nodes.select("fp", own.alias("own"), near.alias("near")).select("fp", "own", F.explode(asked).alias("cell"))
    return placed.select("fp", "own", "cell", F.explode(F.array(*tables)).alias("value")).select(F.xxhash64("value", "cell").alias("shard"), (F.col("cell") == F.col("own")).alias("index"), "fp")


def pieces(nodes: DataFrame, radius: int, piece_rows: int, agree: int | None = None) -> DataFrame:
    """shard, band, a, b, index, query, fp: the pieces in which the distinct fingerprints (nodes.fp) are compared,
    those of the index with those of the query. agree sets the filter's blocks, compared whole (0: no filter)."""
    points, n = vantage(nodes)
    agree, bits = filter_width(n, radius) if agree is None else (agree, 64 // (radius + agree))
    spread = shards(nodes, radius, agree, bits, points)
    crowded = spread.groupBy("shard").agg(F.count("*").alias("rows"), F.min("fp").alias("point")).where(F.col("rows") > piece_rows)
    ring, width = F.bit_count(F.col("fp").bitwiseXOR(F.col("point"))), radius + 1
    band = F.floor(ring / width).cast("int")
    bands = F.when(F.col("point").isNull(), F.array(F.lit(-1))).when((band > 0) & (ring - band * width < radius), F.array(band, band - 1)).otherwise(F.array(band))
    cut = spread.join(crowded, "shard", "left").select("shard", "index", "fp", F.explode(bands).alias("band"))
    sizes = cut.groupBy("shard", "band").count().where(F.col("count") > piece_rows)
    salts = F.coalesce(F.ceil(F.col("count") / piece_rows), F.lit(1)).cast("int")
    dealt = cut.join(sizes, ["shard", "band"], "left").withColumn("salts", salts).withColumn("salt", F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("salts") - 1)
    found = F.transform(F.when(F.col("index"), every).otherwise(F.array("salt")), lambda j: F.struct(F.col("salt").alias("a"), j.alias("b"), F.col("index").alias("index"), (j == F.col("salt")).alias("query")))
    asks = F.transform(F.filter(every, lambda j: j != F.col("salt")), lambda j: F.struct(j.alias("a"), F.col("salt").alias("b"), F.lit(False).alias("index"), F.lit(True).alias("query")))
    return dealt.select("shard", "band", "fp", F.explode(F.concat(found, asks)).alias("p")).select("shard", "band", "p.*", "fp")


def links(nodes: DataFrame, radius: int = 4, piece_rows: int = 20_000, agree: int | None = None) -> DataFrame:
    """u, v: links that connect all distinct fingerprints (nodes.fp) exactly as all pairs within
    radius bits would. An empty frame gives none. Two jobs choose the vantage points."""
    spark = nodes.sparkSession
    found = pieces(nodes, radius, piece_rows, agree)
    key = ["shard", "band", "a", "b"]
    dealt = found.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *key).sortWithinPartitions(*key)
    kind = np.dtype([("shard", np.int64), ("band", np.int32), ("a", np.int32), ("b", np.int32), ("index", bool), ("query", bool), ("fp", np.int64)])

    def compared(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Links of whole pieces that lie side by side in rows."""
        new = np.ones(len(rows), bool)
        new[1:] = np.logical_or.reduce([rows[k][1:] != rows[k][:-1] for k in key])
        begins = np.flatnonzero(new)
        sizes, piece, fps = np.diff(np.append(begins, len(rows))), np.cumsum(new) - 1, rows["fp"].view(np.uint64)
        small = (sizes <= SMALL)[piece]
        out = [neighbour_links(fps[small], piece[small], radius)]
        for k in np.flatnonzero(sizes > SMALL):
            part = slice(begins[k], begins[k] + sizes[k])
            out.append(piece_links(fps[part], rows["index"][part], rows["query"][part], radius))
        u, v = (np.concatenate(x).view(np.int64) for x in zip(*out))
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for b in batches:
            rows = np.empty(b.num_rows, kind)
            for k, name in enumerate(kind.names):
                rows[name] = b.column(k).to_numpy(zero_copy_only=False)
            held.append(rows)
            count += len(rows)
            if count < piece_rows:
                continue
            whole = np.concatenate(held)  # all but the last piece, which may go on
            last = len(whole) - 1
            apart = np.flatnonzero(np.logical_or.reduce([whole[k] != whole[k][last] for k in key]))
            cut = apart[-1] + 1 if len(apart) else 0
            if cut:
                yield from compared(whole[:cut])
            held, count = [whole[cut:]], len(whole) - cut
        if held and count:
            yield from compared(np.concatenate(held))

    return dealt.mapInArrow(run, "u long, v long")


def lowest(rows: DataFrame, count: int, keep: str) -> DataFrame:
    """rows (u, v) with m, the least of u's v (keep "own": and u itself). Nodes of many links, such as a group's root,
    are few (at most 1 / HEAVY_SHARE of them for each end of a link): their names are broadcast, and their rows
    are dealt over SALTS tasks each by v."""
    low = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    if keep == "own":
        low = low.withColumn("m", F.least("u", "m"))
    heavy = F.col("n") > max(HEAVY, int(count * HEAVY_SHARE))
    many = F.broadcast(low.where(heavy).select("u", F.lit(True).alias("heavy")))
    salted = rows.join(many, "u", "left").withColumn("salt", F.when(F.col("heavy"), F.pmod(F.xxhash64("v"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")).drop("heavy")
    copies = low.select("u", "m", F.explode(F.when(heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    return salted.join(copies, ["u", "salt"]).drop("salt")


def ways(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """u, v: these pairs of columns of each row, in one pass over rows."""
    return rows.select(F.explode(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])).alias("p")).select("p.*")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) of every node of edges (u, v), by large-star
    and small-star rounds until nothing changes. Nodes without links aren't in it. Each star is written by itself: a plan
    of both reads the links dozens of times, and the driver holds and plans all that anew after each of its stages."""
    spark = edges.sparkSession
    now, path = settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    count = now.count()
    while True:
        large = lowest(ways(now, ("u", "v"), ("v", "u")), 2 * count, "own").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, between = settle(large.distinct(), "large")
        star = lowest(large, 2 * count, "least")  # each row points down now
        after, newer = settle(ways(star, ("v", "m"), ("u", "m")).where("u <> v").distinct(), "links")
        discard(spark, path), discard(spark, between)
        now, path = after, newer
        # done if each node has one link and it leads to a node without any
        ends = now.select(F.explode(F.array(F.struct("u", F.lit(1).alias("out")), F.struct(F.col("v").alias("u"), F.lit(0).alias("out")))).alias("p")).select("p.*")
        ends = ends.groupBy("u").agg(F.sum("out").alias("out"), F.min("out").alias("least"))
        open_ends, count = ends.agg(F.count_if((F.col("out") > 1) | (F.col("out") > F.col("least"))), F.sum("out")).first()
        if not open_ends:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that links of at most radius differing
    bits reach, the row's own included. One row per row of docs: a repeated row comes back
    as often; a null doc_id keeps its component's id (null if the component has no other); an
    empty table gives no rows. Texts without words share fingerprint zero and link like any."""
    return cluster(settle(fingerprints(docs, shingle), "fingerprints")[0], radius)


def cluster(fps: DataFrame, radius: int) -> DataFrame:
    """near_duplicates of given doc_id, fp."""
    nodes, _ = settle(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(links(nodes.select("fp"), radius))
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    lowest_id = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = named.join(lowest_id, "root").select("fp", "component_id")
    return fps.join(known, "fp").select("doc_id", "fp", "component_id")
