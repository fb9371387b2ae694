"""Gradient-boosted trees for two classes, on binned features; fitted on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES = 40
DEPTH = 4
BINS = 32
RATE = 0.25
LEAST = 20.0
SMOOTH = 1.0


@dataclass(frozen=True)
class Trees:
    """Full binary trees as heaps: ``feature`` and ``cut`` by tree and inner node, ``value`` by leaf."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        at = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[at, feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out


def _best_cut(binned: np.ndarray, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[float, int, int]:
    """Gain, feature and last bin on the left of the best split of ``rows``."""
    best = (0.0, 0, BINS)
    g_all, h_all = grad[rows].sum(), hess[rows].sum()
    for f in range(binned.shape[1]):
        b = binned[rows, f]
        g = np.cumsum(np.bincount(b, grad[rows], BINS))[:-1]
        h = np.cumsum(np.bincount(b, hess[rows], BINS))[:-1]
        n = np.cumsum(np.bincount(b, minlength=BINS))[:-1]
        ok = (n >= LEAST) & (len(rows) - n >= LEAST)
        gain = g**2 / (h + SMOOTH) + (g_all - g) ** 2 / (h_all - h + SMOOTH) - g_all**2 / (h_all + SMOOTH)
        gain = np.where(ok, gain, 0)
        i = int(gain.argmax())
        if gain[i] > best[0] + 1e-9:
            best = (float(gain[i]), f, i)
    return best


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Logistic loss, second-order steps. Bins are quantiles of each feature."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = float(np.average(y, weights=weight)) if len(y) else 0.5
    share = min(max(share, 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    features = np.zeros((TREES, inner), dtype=np.int64)
    cuts = np.full((TREES, inner), np.inf)
    values = np.zeros((TREES, leaves))
    score = np.full(len(y), base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-score))
        grad, hess = weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            for n in range((1 << level) - 1, (2 << level) - 1):
                rows = np.flatnonzero(node == n)
                if len(rows) >= 2 * LEAST:
                    gain, f, last = _best_cut(binned, rows, grad, hess)
                    if gain > 0:
                        # Bin b holds values up to edge b.
                        features[t, n], cuts[t, n] = f, edges[f][last] if last < len(edges[f]) else np.inf
            node = 2 * node + 1 + (x[np.arange(len(y)), features[t, node]] > cuts[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
        values[t] = RATE * g / (h + SMOOTH)
        score += values[t][leaf]
    return Trees(base, features, cuts, values)
