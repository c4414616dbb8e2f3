"""Byte-level BPE: encoding by ranked pair merges of pre-tokenised slices, and decoding.

The vocabulary's file is a parameter: it is read once on the driver and broadcast (a vocabulary
of more than MAX_VOCAB entries is refused). Merged slices are cached in each worker, in two
generations of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import small_batches
from .pretokens import slices

MAX_VOCAB = 2_000_000
CACHE = 100_000
#: Bytes up to which a slice is merged by searching all its pairs.
SHORT = 64
NO_RANK = 1 << 62
#: Characters whose classes are scanned together.
CHUNK = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
    if len(ranks) > MAX_VOCAB:
        raise ValueError(f"{len(ranks)} ranks; {MAX_VOCAB} at most are broadcast")
    return ranks


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """merge by searching all pairs for the lowest rank each time: quadratic, and faster for a word."""
    cuts = list(range(len(piece) + 1))
    pairs = [ranks.get(piece[i : i + 2], NO_RANK) for i in range(len(piece) - 1)]
    while pairs and (low := min(pairs)) != NO_RANK:
        i = pairs.index(low)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(piece[cuts[i] : cuts[i + 2]], NO_RANK)
        if i:
            pairs[i - 1] = ranks.get(piece[cuts[i - 1] : cuts[i + 1]], NO_RANK)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the adjacent pair of lowest rank, leftmost first, is merged until none has
    a rank. A heap of pairs over a linked list: n log n for a slice of n bytes."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    if n <= SHORT:
        return merge_short(piece, ranks)
    start, after, before = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1))
    stop = list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or stop[j] != end:
            continue
        alive[j] = False
        stop[i], after[i] = end, after[j]
        if after[j] < n:
            before[after[j]] = i
            k = after[i]
            if (r := ranks.get(piece[start[i] : stop[k]])) is not None:
                heapq.heappush(heap, (r, i, stop[k]))
        if (k := before[i]) >= 0 and (r := ranks.get(piece[start[k] : end])) is not None:
            heapq.heappush(heap, (r, k, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[start[i] : stop[i]]])
        i = after[i]
    return out


class Encoder:
    def __init__(self, ranks: dict[bytes, int], cache: int = CACHE):
        self.ranks, self.limit, self.new, self.old = ranks, cache, {}, {}

    def merged(self, piece: str) -> list[int]:
        if (ids := self.old.get(piece)) is None:
            ids = merge(piece.encode("utf-8", "surrogatepass"), self.ranks)
        if len(piece) <= 64:
            if len(self.new) >= self.limit:
                self.old, self.new = self.new, {}
            self.new[piece] = ids = tuple(ids)
        return ids

    def encode(self, texts: list[str | None]) -> Iterator[array]:
        """Ids of each whole text; none for null and empty ones."""
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end] or "") <= CHUNK):
                size += len(texts[end] or "")
                end += 1
            for pieces in slices([t or "" for t in texts[at:end]]):
                ids, known = array("I"), self.new.get
                for piece in pieces:
                    found = known(piece)
                    if found is None:
                        found = self.merged(piece)
                        known = self.new.get
                    ids.extend(found)
                yield ids
            at = end


class Decoder:
    """The bytes of all tokens side by side, and where each begins in them."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        token: list[bytes] = [b""] * size
        for piece, rank in ranks.items():
            token[rank] = piece
        self.length = np.array([len(t) for t in token], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(token), np.uint8)

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte at which each token starts in the text."""
        sizes = self.length[ids]
        return np.cumsum(sizes) - sizes

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The text's bytes: byte b of it lies in its token as far behind the token's start as b is behind the offset."""
        if not len(ids):
            return b""
        sizes = np.diff(np.append(offsets, offsets[-1] + self.length[ids[-1]]))
        if (sizes != self.length[ids]).any():
            raise ValueError("offsets that aren't those of the ids")
        return self.data[np.repeat(self.start[ids] - offsets, sizes) + np.arange(offsets[-1] + sizes[-1])].tobytes()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int>, offsets array<long> (the byte at which each token starts). Null and
    empty texts: empty arrays. Repeated rows come back as often; other columns aren't read."""
    small_batches(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(ranks.value), Decoder(ranks.value)
        for b in batches:
            ids = [np.frombuffer(x, np.uint32).astype(np.int32) for x in encoder.encode(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([decoder.offsets(x) for x in ids], pa.list_(pa.int64()))], ["doc_id", "ids", "offsets"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>, offsets array<long>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, data: the bytes that the ids stand for, laid out by their offsets (null: empty). encoded: doc_id, ids, offsets."""
    small_batches(encoded.sparkSession)
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(ranks.value)
        for b in batches:
            made = [decoder.decode(np.array(x or [], np.int64), np.array(o or [], np.int64)) for x, o in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], ["doc_id", "data"])

    return encoded.select(F.col("doc_id").cast("long"), "ids", "offsets").mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256:
    encodes, decodes the ids by their offsets and digests both in one pass, so the ids never leave the task."""
    small_batches(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(ranks.value), Decoder(ranks.value)
        for b in batches:
            n, of_ids, of_text = [], [], []
            for ids in encoder.encode(b.column(1).to_pylist()):
                n.append(len(ids))
                numbers = np.frombuffer(ids, np.uint32).astype(np.int64)
                of_ids.append(hashlib.sha256(numbers.astype("<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(decoder.decode(numbers, decoder.offsets(numbers))).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
