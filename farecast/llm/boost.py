"""Histogram gradient-boosted trees for a yes/no label, in numpy.

Training bins every feature at quantiles, then grows each tree level by
level: one ``bincount`` per feature and level gives the gradient sums of all
(node, bin) pairs, and the split with the largest gain wins (ties: the first
feature, the lowest bin). A model is five flat arrays over all trees; scoring
walks all rows down a tree at once. No rows, or rows of one label, give the base
rate and no split; repeated rows count once each; features are finite numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Nodes of all trees side by side: feature (-1 for a leaf), threshold, left child (right is next), value."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                right = x[rows, np.maximum(f, 0)] > self.threshold[node]
                node = np.where(inner, self.left[node] + right, node)
            out += self.value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    least: float = 4.0,
    ridge: float = 1.0,
) -> Trees:
    """Logistic loss; a leaf needs ``least`` of second-derivative mass / 0.25. No or one class gives the base rate."""
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    n, d = x.shape
    p = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(p / (1 - p)))
    if n == 0 or y.min() == y.max():
        leaf = np.zeros(1)
        return Trees(np.zeros(1, np.int64), np.full(1, -1), leaf, np.zeros(1, np.int64), leaf, base, 0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    f = np.full(n, base)
    roots, feature, threshold, left, value = [], [], [], [], []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-f))
        g, h = q - y, q * (1 - q)
        at = np.zeros(n, np.int64)  # node number within the level
        live = np.arange(n)
        start = len(feature)
        roots.append(start)
        level = [start]
        feature.append(-1), threshold.append(0.0), left.append(0), value.append(0.0)
        for step in range(depth + 1):
            k = len(level)
            gs, hs = np.bincount(at, g[live], k), np.bincount(at, h[live], k)
            for i, node in enumerate(level):
                value[node] = float(-rate * gs[i] / (hs[i] + ridge))
            if step == depth:
                break
            best = np.zeros(k), np.full(k, -1), np.zeros(k, np.int64)
            for j in range(d):
                width = len(edges[j]) + 1
                cell = at * width + binned[live, j]
                gl = np.cumsum(np.bincount(cell, g[live], k * width).reshape(k, width), 1)[:, :-1]
                hl = np.cumsum(np.bincount(cell, h[live], k * width).reshape(k, width), 1)[:, :-1]
                if not gl.shape[1]:
                    continue
                gr, hr = gs[:, None] - gl, hs[:, None] - hl
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (gs**2 / (hs + ridge))[:, None]
                gain[(hl < least * 0.25) | (hr < least * 0.25)] = 0
                cut = gain.argmax(1)
                top = gain[np.arange(k), cut]
                better = top > best[0] + 1e-9
                best[0][better], best[1][better], best[2][better] = top[better], j, cut[better]
            child = np.full(k, -1)
            following = []
            for i, node in enumerate(level):
                if best[1][i] < 0:
                    continue
                j, cut = int(best[1][i]), int(best[2][i])
                feature[node], threshold[node], left[node] = j, float(edges[j][cut]), len(feature)
                child[i] = len(following)
                for _ in range(2):
                    following.append(len(feature))
                    feature.append(-1), threshold.append(0.0), left.append(0), value.append(0.0)
            if not following:
                break
            keep = child[at] >= 0
            live, at = live[keep], at[keep]
            right = binned[live, best[1][at]] > best[2][at]
            at = child[at] + right
            level = following
        model = Trees(
            np.array([start]), np.array(feature), np.array(threshold), np.array(left), np.array(value), 0.0, depth
        )
        f += model.raw(x)
    return Trees(np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(value), base, depth)
