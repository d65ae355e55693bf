"""Gradient-boosted trees in numpy: histogram splits, monotonic constraints, flat node arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Trees(NamedTuple):
    """Complete binary trees as arrays of (tree, node); the children of node i are 2i+1 and 2i+2.

    A row goes right where its feature is above the threshold. A node that ends early has
    an infinite threshold and its value on all leaves below it.
    """

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of ``x``."""
        raw = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            raw += value[node]
        return 1 / (1 + np.exp(-raw))


def fit(
    x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 4, rate: float = 0.15,
    bins: int = 48, l2: float = 1.0, least_weight: float = 3.0,
) -> Trees:
    """Boosted trees for a 0/1 outcome. ``monotone``: 1, -1 or 0 for each feature.

    Without rows, or with one class only, there are no trees and the score is the
    (smoothed) share of class 1.
    """
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 1 - 1e-6
    base = float(np.log(share / (1 - share)))
    nodes = 2 ** (depth + 1) - 1
    if not len(y) or y.min() == y.max():
        return Trees(base, depth, *(np.zeros((0, nodes), dtype=t) for t in (np.int64, np.float64, np.float64)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    raw, grown = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        feature, threshold, value, where = _grow(codes, cuts, p - y, p * (1 - p), monotone, depth, rate, l2, least_weight)
        raw += value[where]
        grown.append((feature, threshold, value))
    return Trees(base, depth, *(np.stack(a) for a in zip(*grown, strict=True)))


def _grow(codes, cuts, g, h, monotone, depth, rate, l2, least_weight):
    """One tree, level by level; also the leaf of each training row."""
    nodes = 2 ** (depth + 1) - 1
    feature, threshold, value = np.zeros(nodes, dtype=np.int64), np.full(nodes, np.inf), np.zeros(nodes)
    weight = lambda gs, hs, low, high: np.clip(-gs / (hs + l2), low, high)
    loss = lambda gs, hs, w: gs * w + 0.5 * (hs + l2) * w * w
    where = np.zeros(len(g), dtype=np.int64)
    bounds = {0: (-np.inf, np.inf)}
    for node in range(nodes):
        if node not in bounds:
            continue
        low, high = bounds[node]
        rows = np.flatnonzero(where == node)
        gs, hs = g[rows].sum(), h[rows].sum()
        own = weight(gs, hs, low, high)
        value[node] = rate * own
        if 2 * node + 2 >= nodes:
            continue
        best = (1e-6, None)
        for j, cut in enumerate(cuts):
            if not len(cut):
                continue
            left_g = np.cumsum(np.bincount(codes[rows, j], g[rows], len(cut) + 1))[:-1]
            left_h = np.cumsum(np.bincount(codes[rows, j], h[rows], len(cut) + 1))[:-1]
            lw, rw = weight(left_g, left_h, low, high), weight(gs - left_g, hs - left_h, low, high)
            gain = loss(gs, hs, own) - loss(left_g, left_h, lw) - loss(gs - left_g, hs - left_h, rw)
            fits = (left_h >= least_weight) & (hs - left_h >= least_weight) & (monotone[j] * (rw - lw) >= 0)
            gain = np.where(fits, gain, -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (j, k, (lw[k] + rw[k]) / 2))
        if best[1] is None:
            # The rest of this branch carries the node's value down to its leftmost leaf.
            stay = node
            while 2 * stay + 2 < nodes:
                stay = 2 * stay + 1
                value[stay] = value[node]
            where[rows] = stay
            continue
        j, k, middle = best[1]
        feature[node], threshold[node] = j, cuts[j][k]
        where[rows] = 2 * node + 1 + (codes[rows, j] > k)
        sides = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}
        bounds[2 * node + 1], bounds[2 * node + 2] = sides[monotone[j]]
    return feature, threshold, value, where
