"""SimHash fingerprints: the hashes of a text's terms vote on each bit.

`shingle_fingerprints` is the 64-bit form over word shingles that near-duplicate removal
uses; `weighted_fingerprints` is the wider form over weighted terms. Both are pure functions of
one text, called on Arrow batches inside Spark tasks.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import xxhash

#: Row b holds the eight bits of byte b, lowest first.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)
SEED = 42


def words(text: str | None) -> list[bytes]:
    """Maximal runs of anything but ASCII white space, A-Z lower-cased; [] for null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_hashes(tokens: list[bytes], n: int) -> np.ndarray:
    """XXH64 (seed 42) of each n-word shingle, repeats included; of the whole sequence if shorter; none if empty."""
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= n:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    stops = list(accumulate(len(t) + 1 for t in tokens))
    starts = [0, *stops[: len(tokens) - n]]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, stops[n - 1 :])], np.uint64)


def votes(hashes: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """The weight of the hashes in which each bit is set. hashes: (terms,) or (terms, lanes) of 64 bits."""
    as_bytes = np.ascontiguousarray(hashes).view(np.uint8).reshape(len(hashes), -1)
    lanes = as_bytes.shape[1]
    cells = (as_bytes + (np.arange(lanes) << 8)).ravel()
    counts = np.bincount(cells, None if weights is None else np.repeat(weights, lanes), lanes << 8)
    return (counts.reshape(lanes, 256) @ BYTE_BITS).ravel()


def of_hashes(hashes: np.ndarray) -> int:
    """A bit is set if more than half of the hashes have it; zero if there are none."""
    if not len(hashes):
        return 0
    bits = (votes(hashes) * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint64(text: str | None, n: int) -> int:
    """The fingerprint of a text's n-word shingles, repeats included; zero if there are no words."""
    return of_hashes(shingle_hashes(words(text), n))
