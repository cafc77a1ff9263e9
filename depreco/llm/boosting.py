"""Gradient-boosted trees with monotonic constraints, flattened into numpy node arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Trees(NamedTuple):
    """Nodes of all trees; a leaf is its own left and right child. Scores add up in log-odds."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int


def predict(trees: Trees, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each row: all rows step down one tree at a time, level by level."""
    total = np.full(len(x), trees.base)
    row = np.arange(len(x))
    for root in trees.roots:
        node = np.full(len(x), root)
        for _ in range(trees.depth):
            low = x[row, trees.feature[node]] <= trees.threshold[node]
            node = np.where(low, trees.left[node], trees.right[node])
        total += trees.value[node]
    return 1.0 / (1.0 + np.exp(-np.clip(total, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trend: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss.

    ``trend`` holds -1, 0 or 1 for each feature: the score may only fall, may move freely, or may only
    rise with it. A split on such a feature is taken only if its sides' values are in that order, and
    the midpoint between them bounds all values below either side, so the order holds for the tree."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)] if n else [np.zeros(0)] * width
    code = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], axis=1) if n else np.zeros((0, width), int)
    share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    total = np.full(n, base)

    def leaf(v: float) -> int:
        i = len(value)
        feature.append(0), threshold.append(np.inf), left.append(i), right.append(i), value.append(v)
        return i

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, lo: float, hi: float, levels: int) -> int:
        def best_value(gs, hs):
            return np.clip(-gs / (hs + ridge), lo, hi)

        def gain(gs, hs, v):
            return -(gs * v + 0.5 * (hs + ridge) * v * v)

        gs, hs = g[rows].sum(), h[rows].sum()
        own = best_value(gs, hs)
        node = leaf(rate * own)
        if not levels or len(rows) < 20:
            return node
        best, pick = 1e-3, None
        for f in range(width):
            if not len(edges[f]):
                continue
            slots = len(edges[f]) + 1
            lg = np.cumsum(np.bincount(code[rows, f], g[rows], slots))[:-1]
            lh = np.cumsum(np.bincount(code[rows, f], h[rows], slots))[:-1]
            lv, rv = best_value(lg, lh), best_value(gs - lg, hs - lh)
            better = gain(lg, lh, lv) + gain(gs - lg, hs - lh, rv) - gain(gs, hs, own)
            better = np.where((lh > 0.5) & (hs - lh > 0.5) & (trend[f] * (rv - lv) >= 0), better, -np.inf)
            k = int(np.argmax(better))
            if better[k] > best:
                best, pick = better[k], (f, k, lv[k], rv[k])
        if pick is None:
            return node
        f, k, lv, rv = pick
        low = code[rows, f] <= k
        middle = (lv + rv) / 2
        bounds = {0: ((lo, hi), (lo, hi)), 1: ((lo, middle), (middle, hi)), -1: ((middle, hi), (lo, middle))}[int(trend[f])]
        feature[node], threshold[node] = f, edges[f][k]
        left[node] = grow(rows[low], g, h, *bounds[0], levels - 1)
        right[node] = grow(rows[~low], g, h, *bounds[1], levels - 1)
        return node

    for _ in range(rounds if n and 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(n), p - y, p * (1 - p), -4.0, 4.0, depth))
        now = Trees(0.0, np.array(roots[-1:]), *map(np.array, (feature, threshold, left, right, value)), depth)
        q = predict(now, x)
        total += np.log(q / (1 - q))
    return Trees(base, np.array(roots, int), np.array(feature, int), np.array(threshold, float), np.array(left, int), np.array(right, int), np.array(value, float), depth)
