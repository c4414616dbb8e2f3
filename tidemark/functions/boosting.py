"""Boosted regression trees over binned features for the rows of one group, and exact contributions of each feature to a prediction."""

from __future__ import annotations

from dataclasses import dataclass
from math import factorial

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Trees of one depth, complete: node k has the children 2k + 1 and 2k + 2. A row goes right if its bin is above cut."""

    edges: list[np.ndarray]
    base: float
    feature: np.ndarray  # (tree, inner node)
    cut: np.ndarray
    leaf: np.ndarray  # (tree, leaf)
    cover: np.ndarray  # (tree, node): training rows that come by


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of each value, 0 for an unknown one."""
    return np.stack([np.where(np.isnan(x[:, f]), 0, 1 + np.searchsorted(e, x[:, f], side="right")) for f, e in enumerate(edges)], 1)


def fit(x: np.ndarray, y: np.ndarray, iterations: int, depth: int, step: float, absolute: bool = False, l2: float = 0.0, least: int = 5) -> Trees:
    """Trees that follow the squared (or absolute) error one after another; splits leave `least` rows on each side."""
    edges = []
    for f in range(x.shape[1]):
        known = x[~np.isnan(x[:, f]), f]
        edges.append(np.unique(np.quantile(known, np.linspace(0, 1, BINS - 1)[1:-1])) if len(known) else np.empty(0))
    codes, n = binned(x, edges), len(y)
    inner, leaves = 2**depth - 1, 2**depth
    feature, cut = np.zeros((iterations, inner), int), np.full((iterations, inner), BINS)
    leaf, cover = np.zeros((iterations, leaves)), np.zeros((iterations, inner + leaves))
    base = float(np.median(y) if absolute else y.mean())
    made = np.full(n, base)
    for t in range(iterations):
        rest = y - made
        g, node = np.sign(rest) if absolute else rest, np.zeros(n, int)
        for d in range(depth):
            nodes, first = 2**d, 2**d - 1
            cover[t, first : first + nodes] = np.bincount(node, minlength=nodes)
            gains = []
            for f in range(x.shape[1]):
                at = node * BINS + codes[:, f]
                count = np.bincount(at, minlength=nodes * BINS).reshape(nodes, BINS).cumsum(1)
                total = np.bincount(at, g, nodes * BINS).reshape(nodes, BINS).cumsum(1)
                right, more = total[:, -1:] - total, count[:, -1:] - count
                gain = total**2 / (count + l2 + 1e-9) + right**2 / (more + l2 + 1e-9)
                gains.append(np.where((count >= least) & (more >= least), gain, -1.0))
            gains = np.stack(gains, 1).reshape(nodes, -1)
            best = gains.argmax(1)
            splits = gains[np.arange(nodes), best] >= 0
            feature[t, first : first + nodes] = best // BINS
            cut[t, first : first + nodes] = np.where(splits, best % BINS, BINS)  # no split: all rows go left
            node = 2 * node + (codes[np.arange(n), feature[t, first + node]] > cut[t, first + node])
        cover[t, inner:] = np.bincount(node, minlength=leaves)
        if absolute:
            for k in np.unique(node):
                leaf[t, k] = step * np.median(rest[node == k])
        else:
            leaf[t] = step * np.bincount(node, g, leaves) / (cover[t, inner:] + l2 + 1e-9)
        made += leaf[t, node]
    return Trees(edges, base, feature, cut, leaf, cover)


def predict(trees: Trees, x: np.ndarray) -> np.ndarray:
    codes, (count, inner) = binned(x, trees.edges), trees.feature.shape
    each, node = np.arange(count)[None, :], np.zeros((len(x), count), int)
    while (node[:1] < inner).all():
        above = codes[np.arange(len(x))[:, None], trees.feature[each, node]] > trees.cut[each, node]
        node = 2 * node + 1 + above
    return trees.base + trees.leaf[each, node - inner].sum(1)


def contributions(trees: Trees, x: np.ndarray) -> tuple[np.ndarray, float]:
    """Shapley values (row, feature) of the path-dependent expectation, and that expectation with nothing known: together the
    prediction. A leaf's share is a product over the features on its path, of whether the row fits (known) or of how many training
    rows went that way (not known), so all subsets are summed by one polynomial for each leaf. A feature met again on a path is
    merged into where it stood first, and its later place counts as known and unknown alike, which changes no one's value."""
    codes, (count, inner) = binned(x, trees.edges), trees.feature.shape
    leaves, rows = trees.leaf.shape[1], len(x)
    depth = leaves.bit_length() - 1
    fits, share = np.ones((depth, count, leaves, rows)), np.ones((depth, count, leaves, 1))
    who = np.zeros((depth, count, leaves), int)
    each = np.arange(count)[:, None]
    for d in range(depth):
        node = (np.arange(leaves) + leaves >> (depth - d)) - 1
        right = (np.arange(leaves) >> (depth - d - 1)) & 1
        who[d] = trees.feature[:, node]
        above = codes.T[who[d]] > trees.cut[:, node][:, :, None]
        fits[d] = above == right[None, :, None].astype(bool)
        parent = trees.cover[:, node]
        share[d, :, :, 0] = np.where(parent > 0, trees.cover[:, 2 * node + 1 + right] / np.maximum(parent, 1), 0.0)
    for d in range(1, depth):
        for b in range(d):
            again = who[d] == who[b]
            first = again & ~np.any([who[b] == who[c] for c in range(b)], axis=0) if b else again
            fits[b] *= np.where(first[:, :, None], fits[d], 1.0)
            share[b] *= np.where(first[:, :, None], share[d], 1.0)
        again = np.any([who[d] == who[b] for b in range(d)], axis=0)[:, :, None]
        fits[d], share[d] = np.where(again, 1.0, fits[d]), np.where(again, 1.0, share[d])
    out = np.zeros((rows, len(trees.edges)))
    weights = [factorial(k) * factorial(depth - 1 - k) / factorial(depth) for k in range(depth)]
    for j in range(depth):
        sums = [np.ones((count, leaves, rows))]  # of the products over the other places, by how many are known
        for d in range(depth):
            if d != j:
                sums = [(sums[k] * share[d] if k < len(sums) else 0) + (sums[k - 1] * fits[d] if k else 0) for k in range(len(sums) + 1)]
        value = trees.leaf[:, :, None] * (fits[j] - share[j]) * sum(w * s for w, s in zip(weights, sums))
        np.add.at(out.T, who[j][each, np.arange(leaves)[None, :]].ravel(), value.reshape(-1, rows))
    return out, trees.base + float((trees.leaf * share.prod(0)[:, :, 0]).sum())
