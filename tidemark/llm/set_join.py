"""Near copies by SimHash and, beyond its reach, by the shingles themselves.

Plan. Texts of equal shingle sets collapse into one class first. The classes' SimHash fingerprints are
searched through vantage-point partitions as near_dedup does, and what lies within `radius` bits is
verified on the whole sets. But of texts that share four fifths of their shingles, 64-bit
fingerprints differ in 9.7 bits on average and in 17 for one of a hundred: a radius that no
partition can prune. What is left is therefore found exactly by prefixes. Sets of sizes m >= n that reach a Jaccard
index of 4/5 have 4 (m + n) / 9 shingles in common at least. In any one order of shingles the first common one, at
places i and j (from 0), has m - i and n - j of them from there on: so n <= 9 (m - i) / 4 - m, and j <= n / 9.
The larger set asks with its first floor(m / 5) + 1 shingles, each for the sizes that its place still allows; the smaller one answers
with its first floor(n / 9) + 1. Sizes are part of the key, in steps, so texts of one template that differ too much don't even
meet. How many shingles they meet in bounds what they can share. The order puts
frequent shingles last, so that a line on many pages brings few texts together; frequencies are
estimated from a sample, which changes the cost but not the result.

Classes that meet are first compared with some others of their shingle, chosen by hash in rounds, which joins a dense group
in rows proportional to its members; then with all that they meet of other groups, which finds what is
left. A pair is first held against the parities of both sets: as many bits as four times the set's size, each told by how many
shingles fall on it. Sets differ in no fewer shingles than their parities in bits, so what differs in more than a ninth of both sizes
is no link. The others are verified on the whole sets. Texts are only moved for that, and only those that a bitmap of
fixed size lets by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import discard, settle, small_batches
from .near_dedup import components, links
from .simhash import of_hashes, shingle_hashes, words

#: One of so many texts is sampled for the order; shingles on so many sampled texts go last, at most so many of them.
SAMPLE, FREQUENT, FREQUENT_ROWS = 16, 8, 200_000
#: Classes of a shingle that are compared in the rounds before the last one, about: those of one hash.
ROUNDS = (8, 128)
#: Steps of size that the larger set's sizes of partners, 0.8 to 1 of its own, span: about this many.
STEPS = 6
#: Bits of the bitmap that keeps rows from being moved: 2 MB as a table, whatever the number of rows wanted.
BITS = 1 << 23


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Distinct hashes of the n-word shingles, ascending; none of a text without words."""
    return np.unique(shingle_hashes(words(text), n))


def parity(s: np.ndarray) -> bytes:
    """Which of about four bits for each shingle (a power of two, 64 at least) an odd number of them falls on."""
    width = 1 << max(6, int(4 * len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def parity_gap(a: bytes, b: bytes) -> int:
    """In how many bits two parities differ, the wider one folded to the width of the other: never more than the sets do."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        if len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def frequent(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, ascending, and their rank by estimated frequency (from 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingle_set(t, n) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64))], ["s"])

    text = F.col("text").cast("string")
    sampled = docs.select(text.alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).distinct()
    seen = sampled.mapInArrow(run, "s long").groupBy("s").count().where(F.col("count") >= FREQUENT)
    rows = seen.orderBy(F.desc("count"), "s").limit(FREQUENT_ROWS).collect()
    s = np.array([r["s"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(s)
    return s[order], np.arange(len(s), 0, -1)[order]


def prefixes(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text_hash, class (of equal shingle sets), size of the set, its fingerprint, parity and prefix in order, for each row."""
    spark = docs.sparkSession
    small_batches(spark)
    known = spark.sparkContext.broadcast(frequent(docs, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ranks = known.value
        for b in batches:
            kinds, sizes, fps, firsts, bits = [], [], [], [], []
            for t in b.column(2).to_pylist():
                s = shingle_set(t, n)
                rank = np.zeros(len(s), np.int64)
                if len(last):
                    at = np.minimum(np.searchsorted(last, s), len(last) - 1)
                    rank = np.where(last[at] == s, ranks[at], 0)
                first = s[np.lexsort((s, rank))[: len(s) // 5 + 1]]
                kinds.append(xxhash.xxh64_intdigest(s.tobytes())), sizes.append(len(s)), fps.append(of_hashes(s)), firsts.append(first.view(np.int64)), bits.append(parity(s))
            made = [pa.array(np.array(kinds, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(firsts, pa.list_(pa.int64())), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made], ["doc_id", "text_hash", "class", "size", "fp", "prefix", "parity"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, class long, size int, fp long, prefix array<long>, parity binary")


def bitmap(hashes: DataFrame) -> DataFrame:
    """word, bits: a bitmap of the hashes (one column of longs), BITS / 64 rows at most."""
    at = F.pmod(F.col(hashes.columns[0]), F.lit(BITS))
    return hashes.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))


def maybe_in(df: DataFrame, column: str, bits: DataFrame) -> DataFrame:
    """df with maybe: false if the column's hash is surely none of those in the bitmap."""
    at = F.pmod(F.col(column), F.lit(BITS))
    named = df.withColumn("_at", at).withColumn("_word", F.shiftright("_at", 6))
    there = named.join(F.broadcast(bits.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))), "_word", "left")
    return there.withColumn("maybe", F.coalesce(F.expr("(shiftrightunsigned(_bits, cast(_at % 64 as int)) & 1) = 1"), F.lit(False))).drop("_at", "_word", "_bits")


def whole_sets(docs: DataFrame, chosen: DataFrame, n: int) -> DataFrame:
    """class, shingles of the texts of chosen (text_hash, class; one for each class)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([shingle_set(t, n).view(np.int64) for t in b.column(1).to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), found], ["class", "shingles"])

    texts = docs.select(F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    some = maybe_in(texts, "text_hash", bitmap(chosen.select("text_hash"))).where("maybe").groupBy("text_hash").agg(F.min("text").alias("text"))
    return some.join(chosen, "text_hash").select("class", "text").mapInArrow(run, "class long, shingles array<long>")


def likely(met: DataFrame) -> DataFrame:
    """u, v of meetings (u, v, u_size, v_size, i, j; one row for each shingle that they meet in) that can reach 4/5. Whatever
    they share up to the last place where they met is among those, so the whole sets share no more than these and what is behind it."""
    m, n = F.col("u_size"), F.col("v_size")
    counted = met.groupBy("u", "v", "u_size", "v_size").agg(F.count("*").alias("c"), F.max("i").alias("i"), F.max("j").alias("j"))
    return counted.where((F.col("c") + F.least(m - F.col("i") - 1, n - F.col("j") - 1)) * 9 >= (m + n) * 4).select("u", "v")


def possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (u, v) of classes whose parities allow a Jaccard index of 4/5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, _, m, n, x, y = (c.to_pylist() for c in b.columns)
            near = [9 * parity_gap(x[k], y[k]) <= m[k] + n[k] for k in range(b.num_rows)]
            yield b.select([0, 1]).filter(pa.array(near, pa.bool_()))

    side = lambda k: classes.select(F.col("class").alias(k), F.col("size").alias(f"{k}_size"), F.col("parity").alias(f"{k}_parity"))
    both = pairs.join(side("u"), "u").join(side("v"), "v").where("9 * abs(u_size - v_size) <= u_size + v_size")
    return both.select("u", "v", "u_size", "v_size", "u_parity", "v_parity").mapInArrow(run, "u long, v long")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """The pairs (u, v) of classes whose sets have a Jaccard index of at least 4/5, settled. So is each step: the driver's memory
    follows the largest plan, which it plans anew after each of its stages."""
    met, zero = settle(pairs, "likely")
    pairs, one = settle(possible(met, classes), "pairs")
    wanted = pairs.select(F.col("u").alias("class")).union(pairs.select("v")).distinct()
    chosen, two = settle(classes.join(wanted, "class", "left_semi").select("class", "text_hash"), "chosen")
    sets, three = settle(whole_sets(docs, chosen, n), "sets")
    side = lambda k: sets.select(F.col("class").alias(k), F.col("shingles").alias(f"{k}_set"))
    both = F.size(F.array_intersect("u_set", "v_set"))
    near = pairs.join(side("u"), "u").join(side("v"), "v").where(both * 9 >= (F.size("u_set") + F.size("v_set")) * 4)
    found, _ = settle(near.select("u", "v"), "near")
    for path in (zero, one, two, three):
        discard(docs.sparkSession, path)
    return found  # the links: few rows, which the caller's plan reads again


def fingerprint_pairs(classes: DataFrame, radius: int) -> DataFrame:
    """u, v of classes (class, size, fp) whose fingerprints links within radius bits join: a forest, not all pairs; settled,
    as are the fingerprints and their links, so no plan holds the search and what surrounds it."""
    spark = classes.sparkSession
    first, one = settle(classes.groupBy("fp").agg(F.min("class").alias("first")), "first")
    found, two = settle(links(first.select("fp"), radius), "close")
    equal = classes.join(first, "fp").where("class <> first").select(F.col("class").alias("u"), F.col("first").alias("v"))
    end = lambda k: first.select(F.col("fp").alias(k), F.col("first").alias(f"{k}_class"))
    close = found.join(end("u"), "u").join(end("v"), "v")
    pairs, _ = settle(equal.union(close.select(F.col("u_class").alias("u"), F.col("v_class").alias("v"))), "forest")
    discard(spark, one), discard(spark, two)
    return pairs


def apart(met: DataFrame, column: str) -> DataFrame:
    """The rows of met whose shingle has more than one value of the column and a class to answer: told by partial aggregation, then joined."""
    sums = met.groupBy("s").agg(F.min(column).alias("low"), F.max(column).alias("high"), F.min(F.col("place") * 9 - F.col("size")).alias("first"))
    more = sums.where("low <> high and first <= 0").select("s")
    return met.join(more, "s", "left_semi")


def with_roots(met: DataFrame, roots: DataFrame) -> DataFrame:
    """met (s, class, size, place) with the root of each class so far, of the shingles in which different roots meet."""
    named = met.join(roots, met["class"] == roots.node, "left").select("s", "class", "size", "place", F.coalesce("root", "class").alias("root"))
    return apart(named, "root")


def step(size: F.Column) -> F.Column:
    """Which step of size it is: four fifths span STEPS of them."""
    return F.floor(F.log(size.cast("double")) * (STEPS / float(-np.log(0.8)))).cast("int")


def meetings(named: DataFrame, turn: int, about: int | None) -> DataFrame:
    """u, v, u_size, v_size, i, j: classes of different roots that meet in a shingle at places that leave 4/5 possible, u the larger
    (of equal sizes the greater). about: only those whose hashes agree in as many bits as leave about so many classes of the
    shingle; the hash changes with each turn but is one for all shingles, so two classes that agree in it meet in nearly
    all that they share."""
    if about is None:
        named = named.withColumn("part", F.lit(0).cast("long"))
    else:
        many = named.groupBy("s").agg(F.count("*").alias("many"))
        bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("many") / about)))
        named = named.join(many, "s").withColumn("part", F.xxhash64("class", F.lit(turn)).bitwiseAND((F.pow(F.lit(2.0), bits) - 1).cast("long"))).drop("many")
    m, i = F.col("size"), F.col("place")
    most = F.least(m, F.floor((9 * (m - i) - 4 * m) / 4)).cast("int")
    asks = named.withColumn("most", most).where(F.col("most") * 5 >= m * 4)
    steps = F.sequence(step(F.greatest(F.ceil(m * 0.8 - 0.001), F.lit(1))), step(F.col("most")))
    asks = asks.select("s", "part", F.explode(steps).alias("step"), F.col("class").alias("u"), F.col("size").alias("u_size"), F.col("place").alias("i"), F.col("root").alias("u_root"), "most")
    answers = named.where(i * 9 <= m).select("s", "part", step(m).alias("step"), F.col("class").alias("v"), F.col("size").alias("v_size"), F.col("place").alias("j"), F.col("root").alias("v_root"))
    fits = "u_root <> v_root and v_size <= most and v_size * 5 >= u_size * 4 and 4 * (u_size + v_size) <= 9 * (v_size - j) and (u_size > v_size or u > v)"
    return asks.join(answers, ["s", "part", "step"]).where(fits).select("u", "v", "u_size", "v_size", "i", "j")


def similar_groups(docs: DataFrame, n: int = 5, radius: int = 4) -> DataFrame:
    """doc_id, text_hash, root of each row of docs: rows share a root if links of a Jaccard index of at
    least 4/5 between their sets of n-word shingles join them. Texts without words form one group."""
    spark, used = docs.sparkSession, []

    def keep(df: DataFrame, name: str) -> DataFrame:
        made, path = settle(df, name)
        used.append(path)
        return made

    small_batches(spark)
    rows = keep(prefixes(docs, n), "prefixes")
    classes = keep(rows.groupBy("class").agg(F.min("size").alias("size"), F.min("fp").alias("fp"), F.min("text_hash").alias("text_hash"), F.first("prefix").alias("prefix"), F.first("parity").alias("parity")), "classes")
    spread = classes.select(F.posexplode("prefix").alias("place", "s"), "class", "size")
    named, stars = keep(apart(spread, "class").withColumn("root", F.col("class")), "met"), None
    for turn, about in enumerate((*ROUNDS, None)):
        pairs = likely(meetings(named, turn, about))
        found = verified(pairs if stars is not None else pairs.union(fingerprint_pairs(classes, radius)).distinct(), classes, docs, n)
        roots = components(found if stars is None else stars.union(found))
        stars = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
        if about is not None:
            named = keep(with_roots(named.drop("root"), roots), "named")
            if named.isEmpty():
                break
    found = roots
    out = keep(rows.join(found, rows["class"] == found.node, "left").select("doc_id", "text_hash", F.coalesce("root", "class").alias("root")), "groups")
    for path in used[:-1]:
        discard(spark, path)
    return out
