"""Document fingerprints: weighted SimHash, and permuted block tables that find all close ones.

A term is a pair of adjacent words (the word itself in a text of one); its weight is the damped
count of it in the text, log2(1 + n), and its hash votes with that weight on each of `bits` signed bits. Wide
fingerprints (256 bits) keep texts that share two thirds of their words well apart from
unrelated ones in the same language.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import lit

from .common import settle, small_batches
from .simhash import votes, words

BITS = 256
#: Characters of text that a range of neighbouring documents holds, about.
RANGE_CHARS = 1_000_000
#: Characters that a task gets, about, where the session's shuffle partitions would leave it more.
TASK_CHARS = 64_000_000
#: Bits in which close fingerprints differ at most: eight block tables of 32 bits each.
RADIUS = 7
#: Fingerprints of one block value that a task compares with a query's, about.
SALT_ROWS = 5_000
#: Share of all rows from which a fingerprint's counts are broadcast.
HEAVY_SHARE = 1e-4


def mixed(z: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64: spreads the bits of each number."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(text: str | None, bits: int = BITS) -> np.ndarray:
    """bits / 64 words of 64 bits; all zero for a text without words."""
    tokens = words(text)
    if not tokens:
        return np.zeros(bits // 64, np.uint64)
    one = np.frombuffer(b"".join(map(xxhash.xxh64_digest, tokens)), ">u8").astype(np.uint64)
    two = mixed(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]) if len(one) > 1 else one
    h, counts = np.unique(two, return_counts=True)
    w = np.log2(1 + counts)
    lanes = [h]
    for k in range(1, bits // 64):
        lanes.append(mixed(h + np.uint64(0x9E3779B97F4A7C15 * k % (1 << 64))))
    set_bits = (votes(np.stack(lanes, 1), w) * 2 > w.sum()).astype(np.uint8)
    return np.packbits(set_bits, bitorder="little").view(np.uint64)


def hexed(fp: np.ndarray) -> str:
    return "".join(f"{int(x):016x}" for x in fp)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bits."""
    return 1 - int(np.bitwise_count(a ^ b).sum()) / (64 * len(a))


def fingerprints(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint (hexadecimal, bits / 4 digits) of each row's whole text; equal texts have
    equal ones, null and wordless ones zeros. Other columns aren't read."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([hexed(fingerprint(t, bits)) for t in b.column(1).to_pylist()], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fingerprint string")


def within(fps: DataFrame, radius: int, spare: int = 2, bits: int = BITS) -> DataFrame:
    """a, b, distance: all pairs of different fingerprints (column fingerprint of fps) within radius bits, a < b.

    Permuted block tables: the bits are cut in radius + spare blocks, of which `spare` at least
    agree in such a pair; each choice of `spare` blocks is a table, joined on those blocks. A
    pair is kept in the first table that can find it, so none comes twice. Equal fingerprints are one."""
    blocks = radius + spare
    cuts = [round(bits * k / blocks) for k in range(blocks + 1)]
    nodes = fps.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct()

    def binary(fp: Column) -> list[Column]:
        whole = F.concat(*[F.lpad(F.conv(F.substring(fp, k * 8 + 1, 8), 16, 2), 32, "0") for k in range(bits // 32)])
        return [F.substring(whole, cuts[k] + 1, cuts[k + 1] - cuts[k]) for k in range(blocks)]

    tables = list(combinations(range(blocks), spare))
    cut = nodes.select("fingerprint", F.array(*binary(F.col("fingerprint"))).alias("parts"))
    keyed = cut.select("fingerprint", "parts", F.explode(F.array(*[F.struct(lit(n).alias("n"), F.concat(*[F.col("parts")[k] for k in t]).alias("key")) for n, t in enumerate(tables)])).alias("t")).select("fingerprint", "parts", "t.n", "t.key")
    left, right = keyed.alias("l"), keyed.alias("r")
    pairs = left.join(right, (F.col("l.n") == F.col("r.n")) & (F.col("l.key") == F.col("r.key")) & (F.col("l.fingerprint") < F.col("r.fingerprint")))
    equal = [F.col("l.parts")[k] == F.col("r.parts")[k] for k in range(blocks)]
    first = lit(None).cast("int")
    for n, t in reversed(list(enumerate(tables))):
        agree = equal[t[0]]
        for k in t[1:]:
            agree &= equal[k]
        first = F.when(agree, lit(n)).otherwise(first)
    word = lambda side, k: F.conv(F.substring(F.col(f"{side}.fingerprint"), k * 8 + 1, 8), 16, 10).cast("long")
    distance = sum((F.bit_count(word("l", k).bitwiseXOR(word("r", k))) for k in range(bits // 32)), lit(0))
    return pairs.where(F.col("l.n") == first).select(F.col("l.fingerprint").alias("a"), F.col("r.fingerprint").alias("b"), distance.alias("distance")).where(F.col("distance") <= radius)


def close_counts(classes: DataFrame, queries: DataFrame, radius: int = RADIUS, bits: int = BITS, salt_rows: int = SALT_ROWS) -> DataFrame:
    """fingerprint, n_close, nearest of each different query fingerprint: how many other ones of classes lie within
    radius bits of it, and the least distance among them (null if none). Both frames have a column fingerprint, which
    classes hold once each; nulls take no part.

    Permuted block tables: the bits are cut in radius + 1 blocks, of which one at least agrees in such a pair. A table
    is keyed by one block; a pair counts in the first table that can find it. A block's value that more than salt_rows
    of the classes share (a dense group) is dealt over salts and each query asks all of them. Pairs are counted where
    they meet: they are never written, and a query's counts are added up before they are shuffled."""
    blocks = radius + 1
    cuts = [round(bits / 4 * k / blocks) * 4 for k in range(blocks + 1)]  # whole hexadecimal digits

    def tables(df: DataFrame) -> DataFrame:
        keys = [F.substring("fingerprint", a // 4 + 1, (b - a) // 4) for a, b in zip(cuts, cuts[1:])]
        exploded = F.explode(F.array(*[F.xxhash64(lit(n), k).alias("key") for n, k in enumerate(keys)]))
        return df.where(F.col("fingerprint").isNotNull()).select(F.unhex("fingerprint").alias("fp"), exploded.alias("key"))

    index = tables(classes.select("fingerprint"))
    asked = tables(queries.select("fingerprint").distinct())
    crowded = index.groupBy("key").count().where(F.col("count") > salt_rows).select("key", F.ceil(F.col("count") / salt_rows).cast("int").alias("salts"))
    dealt = index.join(crowded, "key", "left").withColumn("salt", F.when(F.col("salts").isNull(), lit(0)).otherwise(F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int"))).drop("salts")
    asking = asked.join(crowded, "key", "left").select("key", "fp", F.explode(F.sequence(lit(0), F.coalesce("salts", lit(1)) - 1)).alias("salt"))
    l, r = asking.alias("l"), dealt.alias("r")  # noqa: E741
    digits = lambda side, a, b: F.substring(F.hex(F.col(f"{side}.fp")), a // 4 + 1, (b - a) // 4)
    first = F.coalesce(*[F.when(digits("l", a, b) == digits("r", a, b), F.xxhash64(lit(n), F.lower(digits("l", a, b)))) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))])
    word = lambda side, k: F.conv(digits(side, 32 * k, 32 * k + 32), 16, 10).cast("long")
    distance = sum((F.bit_count(word("l", k).bitwiseXOR(word("r", k))) for k in range(bits // 32)), lit(0))
    pairs = l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.salt") == F.col("r.salt")) & (F.col("l.fp") != F.col("r.fp")) & (distance <= radius) & (F.col("l.key") == first))
    counted = pairs.groupBy(F.col("l.fp").alias("fp")).agg(F.count("*").alias("n_close"), F.min(distance).alias("nearest"))
    known = asked.select("fp").distinct().join(counted, "fp", "left")
    return known.select(F.lower(F.hex("fp")).alias("fingerprint"), F.coalesce("n_close", lit(0)).cast("long").alias("n_close"), F.col("nearest").cast("int").alias("nearest"))


def with_close(rows: DataFrame, asks: Column, radius: int = RADIUS, bits: int = BITS) -> DataFrame:
    """rows (doc_id, fingerprint and others) with n_close and nearest of close_counts where the condition asks holds, null
    elsewhere, against the fingerprints of all rows. Fingerprints that more than HEAVY_SHARE of the rows carry are few
    (1 / HEAVY_SHARE at most): their counts reach the rows by broadcast, all others' by a shuffle."""
    classes = rows.groupBy("fingerprint").agg(F.count("*").alias("copies"), F.max(F.coalesce(asks, lit(False))).alias("asked"))
    classes, _ = settle(classes, "fingerprint-classes")
    total = classes.agg(F.sum("copies")).first()[0] or 0
    wanted = classes.where("asked")
    found, _ = settle(close_counts(classes, wanted, radius, bits).join(wanted.select("fingerprint", "copies"), "fingerprint"), "fingerprint-counts")
    heavy = F.col("copies") > max(1, int(total * HEAVY_SHARE))
    # names of its own, so that no further column of rows can clash
    hit, miss = (found.where(c).select(F.col("fingerprint").alias(f"_{n}_fp"), F.col("n_close").alias(f"_{n}_close"), F.col("nearest").alias(f"_{n}_nearest")) for n, c in (("often", heavy), ("rare", ~heavy)))
    asked = F.coalesce(asks, lit(False))
    one = rows.join(F.broadcast(hit), F.col("fingerprint") == F.col("_often_fp"), "left")
    key = F.when(asked & F.col("_often_fp").isNull(), F.col("fingerprint")).otherwise(F.concat(lit("-"), F.xxhash64("doc_id", "fingerprint").cast("string")))
    both = one.withColumn("_asked_fp", key).join(miss, F.col("_asked_fp") == F.col("_rare_fp"), "left")
    pick = lambda name: F.when(asked, F.coalesce(f"_often_{name}", f"_rare_{name}"))
    return both.select(*rows.columns, pick("close").alias("n_close"), pick("nearest").alias("nearest"))


def edited(text: str, follower: str) -> str:
    """The last third of the code points replaced by as many (or all) first ones of the follower."""
    n = len(text) // 3
    return text[: len(text) - n] + follower[:n]


def beside_next(docs: DataFrame, bits: int = BITS, range_chars: int = RANGE_CHARS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: each
    text against itself with an edit, and against the next document's in descending order of doc_id
    (after the last: the first). Null texts are empty; null ids come last; rows of one doc_id are
    ordered by text; an only document is its own next.

    The ids are cut into ranges of about range_chars characters at quantiles, and the first
    rows of each range are dealt to the range before as well: one shuffle, and no task holds more
    than a batch of its ranges."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), lit("")).alias("text"))
    stats = rows.agg(F.sum(F.length("text").cast("long")).alias("chars"), F.max("doc_id").alias("top")).first()
    ranges = max(1, min(100_000, (stats["chars"] or 0) // range_chars + 1))
    # Upper ends of the ranges, in descending order: the ids at which a range begins.
    shares = [k / ranges for k in range(1, ranges)]
    ends = docs.select(F.col("doc_id").cast("long")).agg(F.percentile_approx("doc_id", shares, 10 * ranges).alias("ends")).first()["ends"] if shares else []
    heads = sorted({*(ends or []), *([stats["top"]] if stats["top"] is not None else [])}, reverse=True)  # heads[k]: largest id of range k
    if not heads:
        heads = [0]
    last, ends_of = len(heads) - 1, spark.sparkContext.broadcast(np.array(heads[::-1], np.int64))
    no_ids = stats["top"] is None

    @F.pandas_udf("long")
    def place(ids: pd.Series) -> pd.Series:
        """2 * range of the id, plus 1 for a first id of a range; nulls belong to the last range."""
        up = ends_of.value
        known = ids.notna().to_numpy()
        at = np.searchsorted(up, ids.fillna(0).to_numpy(np.int64))  # the smallest head that is at least the id
        at = np.minimum(at, len(up) - 1)
        head = known & (up[at] == ids.fillna(0).to_numpy(np.int64))
        return pd.Series(np.where(known, 2 * (last - at) + head, 2 * last + no_ids))

    # A range's first id goes to the range before too; the first of all goes to the last one.
    slot, is_head = F.floor(F.col("place") / 2).cast("int"), F.col("place") % 2 == 1
    own = F.struct(slot.alias("part"), lit(0).alias("ahead"))
    extra = F.struct(F.when(slot == 0, lit(last)).otherwise(slot - 1).alias("part"), lit(1).alias("ahead"))
    placed = rows.withColumn("place", place("doc_id")).select("doc_id", "text", F.explode(F.when(is_head, F.array(own, extra)).otherwise(F.array(own))).alias("p"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (stats["chars"] or 0) // TASK_CHARS)
    dealt = placed.select("p.part", "p.ahead", "doc_id", "text").repartition(int(tasks), "part").sortWithinPartitions("part", "ahead", F.desc_nulls_last("doc_id"), "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        held, out = None, []

        def row(this, follower):
            part, _, doc_id, text, fp = this
            changed = edited(text, follower[3])
            fp2 = fingerprint(changed, bits) if changed != text else fp
            return doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), hexed(fp), hexed(fp2), likeness(fp, fp2), likeness(fp, follower[4])

        for b in batches:
            for part, ahead, doc_id, text in zip(*[c.to_pylist() for c in b.columns]):
                if held is not None and held[1] and held[0] == part:
                    continue  # one row ahead is enough
                this = (part, ahead, doc_id, text, fingerprint(text, bits))
                if held is not None and not held[1]:
                    if held[0] != part:
                        raise RuntimeError("a range of documents came without its next document")
                    out.append(row(held, this))
                held = this
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 7, kinds)], names)
            out = []

    return dealt.mapInArrow(run, schema)
