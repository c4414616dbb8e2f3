"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

Seeds are the n-grams of test items that few items share (an item's rarest ones always stay, so
no item is without seeds, however often its words recur). The items come in blocks of at most
`block_words` words; each block is small enough to broadcast and is joined with every document,
so a larger benchmark costs more passes, never more memory. Where a document has a seed, the
surrounding passage and the item are aligned word by word, which finds
copies with words changed, dropped or added.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import small_batches

SEED_WORDS = 3
#: An n-gram is rare if at most this share of a block's different items has it.
RARE_SHARE = 0.02
#: Rarest n-grams that an item keeps in any case.
KEEP = 8
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the best possible alignment score from which a passage counts as a copy.
MIN_SCORE = 0.5
BLOCK_WORDS = 2_000_000


#: ASCII punctuation parts words; capitals are lower-cased.
FOLD = bytes(32 if chr(c) in """!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~""" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def normal(text: str | None) -> list[bytes]:
    """Words without the marks in and around them, so that changed punctuation changes no word."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


class Items:
    """The seeds of a block of test items, over integer word ids."""

    def __init__(self, rows: list[tuple[int, str]], n: int = SEED_WORDS):
        self.n, self.vocabulary = n, {}
        self.groups: dict[tuple, list[int]] = defaultdict(list)  # items of the same words share a class
        for item_id, text in rows:
            if ids := tuple(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in normal(text)):
                self.groups[ids].append(item_id)
        self.items = [np.array(x, np.int64) for x in self.groups]
        self.ids = list(self.groups.values())
        self.lengths = {len(x) for x in self.items}
        self.counts = [np.unique(x, return_counts=True) for x in self.items]
        grams = [self.grams(x) for x in self.items]
        shared = Counter(g for x in grams for g in set(x.tolist()))
        limit = max(1, int(RARE_SHARE * len(self.items)))
        seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, x in enumerate(grams):
            order = sorted(range(len(x)), key=lambda i: (shared[int(x[i])], i))
            for rank, i in enumerate(order):
                if rank < KEEP or shared[int(x[i])] <= limit:
                    seeds[int(x[i])].append((k, i))
        self.seeds = dict(seeds)
        self.sorted = np.array(sorted(self.seeds), np.int64)

    def grams(self, ids: np.ndarray) -> np.ndarray:
        """A number for each n-gram; below zero if a word isn't in the vocabulary. An item of fewer words is one gram."""
        base = len(self.vocabulary) + 2
        n = min(self.n, len(ids)) if len(ids) else 0
        if not n:
            return np.zeros(0, np.int64)
        out, known = np.zeros(len(ids) - n + 1, np.uint64), np.ones(len(ids) - n + 1, bool)
        for k in range(n):
            part = ids[k : len(ids) - n + 1 + k]
            out = out * np.uint64(base) + (part + 2).astype(np.uint64)
            known &= part >= 0
        out = (out * np.uint64(8) + np.uint64(n)) & np.uint64((1 << 63) - 1)
        return np.where(known, out.view(np.int64), -1)

    def shared_words(self, k: int, passage: np.ndarray) -> int:
        """Words that item class k and the passage have in common, repeats included: no alignment has more matches."""
        words, counts = self.counts[k]
        return int(np.minimum(np.bincount(passage[passage >= 0], minlength=len(self.vocabulary))[words], counts).sum())

    def hits(self, ids: np.ndarray) -> dict[int, list[int]]:
        """Item class -> where in the document the class's text would begin, for each seed hit."""
        found: dict[int, list[int]] = defaultdict(list)
        if not len(self.sorted):
            return found
        for n in range(1, self.n + 1):
            if n > len(ids):
                break
            if n < self.n and n not in self.lengths:
                continue
            grams = Items.grams(_Length(self, n), ids)
            known = np.flatnonzero(grams >= 0)
            at = np.searchsorted(self.sorted, grams[known])
            at[at == len(self.sorted)] = 0
            for i in known[self.sorted[at] == grams[known]]:
                for item, k in self.seeds[int(grams[i])]:
                    found[item].append(int(i) - k)
        return found


class _Length:
    """Items with another gram length, for items shorter than that of the seeds."""

    def __init__(self, items: Items, n: int):
        self.vocabulary, self.n = items.vocabulary, n


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman with linear gaps: best local score, and the passage's words [start, end) in it.
    Rows are computed at once; a gap along a row is a running maximum."""
    n = len(passage)
    drop = np.arange(n + 1, dtype=np.int64) * GAP
    score, origin = np.zeros(n + 1, np.int64), np.arange(n + 1, dtype=np.int64)
    best = (0, 0, 0)
    for word in item:
        diagonal = score[:-1] + np.where(passage == word, MATCH, MISMATCH)
        up = score[1:] + GAP
        made = np.concatenate([[0], np.maximum(np.maximum(diagonal, up), 0)])
        begun = np.concatenate([[0], np.where(diagonal >= up, origin[:-1], origin[1:])])
        begun = np.where(made > 0, begun, np.arange(n + 1))
        lifted = made - drop  # best of made[j] + (k - j) * GAP over j <= k
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(n + 1), 0))
        score, origin = top + drop, begun[source]
        k = int(score.argmax())
        if score[k] > best[0]:
            best = (int(score[k]), int(origin[k]), k)
    return best


def matches(items: Items, text: str | None, min_score: float) -> list[tuple[int, float, int, int]]:
    """(item_id, score, first word, end word) of each item found in the text, at its best place."""
    tokens = normal(text)
    ids = np.fromiter(map(items.vocabulary.get, tokens, repeat(-1)), np.int64, len(tokens))
    found = []
    for k, starts in items.hits(ids).items():
        item = items.items[k]
        slack = len(item) // 2 + 2
        best, done = (0, 0, 0), -1
        goal = MATCH * len(item)
        for start in sorted(set(starts)):
            low, high = max(0, start - slack), min(len(ids), start + len(item) + slack)
            if start <= done:  # the window before covers this diagonal
                continue
            done = start + slack // 2
            high = min(len(ids), done + len(item) + slack)
            if MATCH * items.shared_words(k, ids[low:high]) < max(min_score * goal, best[0] + 1):
                continue  # no alignment here can score enough
            made = align(item, ids[low:high])
            if made[0] > best[0]:
                best = (made[0], low + made[1], low + made[2])
            if best[0] == goal:
                break
        if best[0] >= min_score * goal:
            found += [(x, best[0] / goal, best[1], best[2]) for x in items.ids[k]]
    return found


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, str]]]:
    """The items as lists of bounded size, one after another."""
    part, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null").orderBy("item_id", "text").toLocalIterator():
        if part and size + len(r["text"]) // 4 > block_words:
            yield part
            part, size = [], 0
        part.append((r["item_id"], r["text"]))
        size += len(r["text"]) // 4
    if part:
        yield part


SCHEMA = "doc_id long, item_id long, score double, first_word long, end_word long"


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, score (share of the item's best possible alignment), first_word, end_word
    (of the passage, counted between spaces and punctuation): one row for each document row and item it holds
    a copy of. Null, empty and wordless texts match nothing; items of the same words get a row each."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def one(block: list[tuple[int, str]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(Items(block))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out = [(d, *m) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for m in matches(sent.value, t, min_score)]
                columns = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))], ["doc_id", "item_id", "score", "first_word", "end_word"])

        return rows.mapInArrow(run, SCHEMA)

    parts = [one(x) for x in item_blocks(benchmark, block_words)]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs without the rows whose text holds a copy of an item; all columns stay. Each block of items
    filters what the one before has left."""
    spark = docs.sparkSession
    small_batches(spark)
    at, left = docs.columns.index("text"), docs
    for block in item_blocks(benchmark, block_words):
        sent = spark.sparkContext.broadcast(Items(block))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array([not matches(sent.value, t, min_score) for t in b.column(at).to_pylist()], pa.bool_()))

        left = left.mapInArrow(run, docs.schema)
    return left
