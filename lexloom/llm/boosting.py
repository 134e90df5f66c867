"""Gradient-boosted regression trees for two classes, and isotonic regression, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, RATE, BINS = 80, 3, 0.15, 48
LEAST_LEAF = 10
RIDGE = 1.0


@dataclass
class BoostedTrees:
    """Complete trees of equal depth: features and cuts of the inner nodes level by level, values of the leaves."""

    start: float
    feature: np.ndarray  # trees x (2^depth - 1)
    cut: np.ndarray
    leaf: np.ndarray  # trees x 2^depth

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return total

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        share = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
        start = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(c[c != c.min()] if (c != c.min()).any() else c, np.linspace(0, 1, BINS))) for c in x.T]
        # A bin is how many edges lie below the value, so "bin > b" is "value > edge b".
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
        width = BINS + 1
        features, cuts, leaves, raw = [], [], [], np.full(len(x), start)
        offset = np.arange(x.shape[1]) * width
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-raw))
            g, h = y - p, p * (1 - p)
            node = np.zeros(len(x), int)
            feature, cut = np.zeros(2**DEPTH - 1, int), np.full(2**DEPTH - 1, np.inf)
            for level in range(DEPTH):
                first, count = 2**level - 1, 2**level
                slots = ((node - first) * x.shape[1] * width)[:, None] + offset + binned
                shape = (count, x.shape[1], width)
                flat = slots.reshape(-1)
                sums = [
                    np.bincount(flat, np.repeat(v, x.shape[1]), count * x.shape[1] * width).reshape(shape).cumsum(axis=2)
                    for v in (g, h, np.ones(len(x)))
                ]
                gl, hl, nl = sums
                gt, ht, nt = (s[:, :, -1:] for s in sums)
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(nl < LEAST_LEAF) | (nt - nl < LEAST_LEAF)] = 0
                for k in range(count):
                    f, b = np.unravel_index(int(np.argmax(gain[k])), gain[k].shape)
                    if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                        feature[first + k], cut[first + k] = f, edges[f][b]
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            slot = node - (2**DEPTH - 1)
            leaf = RATE * np.bincount(slot, g, 2**DEPTH) / (np.bincount(slot, h, 2**DEPTH) + RIDGE)
            raw += leaf[slot]
            features.append(feature)
            cuts.append(cut)
            leaves.append(leaf)
        return cls(start, np.array(features), np.array(cuts), np.array(leaves))


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores and the rising shares of ones that fit them best, by pooling adjacent violators.

    A text of each class is added at either end, so no share is exactly 0 or 1 for lack of examples.
    """
    if not len(raw):
        return np.array([-1.0, 1.0]), np.array([1 / (1 + np.e), np.e / (1 + np.e)])
    order = np.argsort(raw, kind="stable")
    points = np.concatenate([[raw.min()], raw[order], [raw.max()]])
    values = np.concatenate([[0.5], y[order].astype(float), [0.5]])
    pools: list[list[float]] = []  # sum, count, sum of raw scores
    for value, point in zip(values, points):
        pools.append([value, 1.0, point])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools])
