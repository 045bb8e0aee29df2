"""Small gradient-boosted trees for binary labels on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth: feature and threshold per inner node, value per leaf."""

    edges: list[np.ndarray]
    features: np.ndarray
    bins: np.ndarray
    values: np.ndarray
    start: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], 1)
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.features.shape[1]
        for f, b, v in zip(self.features, self.bins, self.values, strict=True):
            at = np.zeros(len(x), np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (binned[rows, f[at]] > b[at])
            total += v[at - inner]
        return total


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, ridge: float = 2.0) -> Trees:
    """Newton boosting of the logistic loss, level by level over histograms of at most 32 bins a feature."""
    edges = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        if len(values) > 32:
            values = np.unique(np.quantile(x[:, f], np.linspace(0, 1, 33)))
        edges.append((values[1:] + values[:-1]) / 2)
    binned = np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)], 1)
    rate_of_ones = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    total = np.full(len(x), start)
    inner = 2**depth - 1
    out: tuple[list, list, list] = ([], [], [])
    rows = np.arange(len(x))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, 1 << 20)
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            best = np.full(n, 1e-6)
            for f in range(x.shape[1]):
                width = len(edges[f]) + 1
                if width == 1:
                    continue
                slot = (at - first) * width + binned[:, f]
                g = np.bincount(slot, grad, n * width).reshape(n, width).cumsum(1)
                h = np.bincount(slot, hess, n * width).reshape(n, width).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
                gain[:, -1] = 0
                at_best = gain.argmax(1)
                value = gain[np.arange(n), at_best]
                better = np.flatnonzero(value > best)
                best[better] = value[better]
                feature[first + better] = f
                cut[first + better] = at_best[better]
            at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
        leaf = at - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        value = rate * g / (h + ridge)
        total += value[leaf]
        out[0].append(feature)
        out[1].append(cut)
        out[2].append(value)
    return Trees(edges, np.array(out[0]), np.array(out[1]), np.array(out[2]), start)
