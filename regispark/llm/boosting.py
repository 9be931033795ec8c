"""Gradient-boosted trees for a yes-or-no target, over a bounded training sample."""

from __future__ import annotations

import numpy as np

TREES, DEPTH, RATE, BINS, LEAST, SMOOTH = 40, 4, 0.3, 32, 8, 1.0


class BoostedTrees:
    """Complete binary trees of one depth: a row goes left where its value is at most the cut."""

    def __init__(self, start: float, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray):
        self.start, self.feature, self.cut, self.leaf = start, feature, cut, leaf

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        row = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.intp)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return total


def fit(x: np.ndarray, y: np.ndarray, numeric: int | None = None) -> BoostedTrees:
    """Trees fitted by second-order steps of the logistic loss; equal data give equal trees.

    Columns from ``numeric`` on hold 0 or 1 only, mostly 0: their sums are taken over the ones.
    """
    rows, width = x.shape
    numeric = width if numeric is None else numeric
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for k in range(numeric)]
    binned = [np.searchsorted(cuts[k], x[:, k]) for k in range(numeric)]
    one_row, one_column = np.nonzero(x[:, numeric:])
    share = np.clip(y.mean() if rows else 0.5, 0.01, 0.99)
    start = float(np.log(share / (1 - share)))
    score = np.full(rows, start)
    features, thresholds, leaves = [], [], []
    inner = 2**DEPTH - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        parts = (y - p, p * (1 - p), np.ones(rows))
        feature, cut = np.zeros(inner, np.intp), np.full(inner, np.inf)
        node = np.zeros(rows, np.intp)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            own = node - first
            totals = [np.bincount(own, v, count)[:, None] for v in parts]
            # Gain of every cut of every column, columns side by side.
            gains, columns, values = [], [], []
            for k in range(numeric):
                size = len(cuts[k]) + 1
                at = own * size + binned[k]
                left = [np.cumsum(np.bincount(at, v, count * size).reshape(count, size), 1)[:, :-1] for v in parts]
                gains.append(_gain(left, totals))
                columns += [k] * len(cuts[k])
                values += cuts[k].tolist()
            if width > numeric:
                at = own[one_row] * (width - numeric) + one_column
                ones = [np.bincount(at, v[one_row], count * (width - numeric)).reshape(count, -1) for v in parts]
                gains.append(_gain([t - o for t, o in zip(totals, ones)], totals))
                columns += range(numeric, width)
                values += [0.5] * (width - numeric)
            gain = np.concatenate(gains, 1)
            best = gain.argmax(1)
            for j in np.nonzero(gain[np.arange(count), best] > 1e-6)[0]:
                feature[first + j], cut[first + j] = columns[best[j]], values[best[j]]
            node = 2 * node + 1 + (x[np.arange(rows), feature[node]] > cut[node])
        leaf = node - inner
        g, h = (np.bincount(leaf, v, 2**DEPTH) for v in parts[:2])
        value = RATE * g / (h + SMOOTH)
        score += value[leaf]
        features.append(feature), thresholds.append(cut), leaves.append(value)
    return BoostedTrees(start, np.array(features), np.array(thresholds), np.array(leaves))


def _gain(left: list[np.ndarray], total: list[np.ndarray]) -> np.ndarray:
    (gl, hl, nl), (gt, ht, nt) = left, total
    gain = gl**2 / (hl + SMOOTH) + (gt - gl) ** 2 / (ht - hl + SMOOTH) - gt**2 / (ht + SMOOTH)
    return np.where((nl >= LEAST) & (nt - nl >= LEAST), gain, -1)
