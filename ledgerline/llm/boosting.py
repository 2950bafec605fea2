"""Gradient-boosted regression trees with logistic loss, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """A complete binary tree as arrays: node k has children 2k + 1 and 2k + 2; feature -1 marks a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return self.value[at]
            r = rows[inner]
            at[r] = 2 * at[r] + 1 + (x[r, f[inner]] > self.threshold[at[r]])


@dataclass
class BoostedTrees:
    """Sum of shrunk trees; ``probability`` is its logistic function."""

    base: float
    trees: list[Tree]

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for t in self.trees:
            score += t.predict(x)
        return 1 / (1 + np.exp(-score))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins)))
    return (values[:-1] + values[1:]) / 2


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 5, rate: float = 0.3, bins: int = 32,
        least: float = 1.0, ridge: float = 1.0) -> BoostedTrees:
    """Fit by Newton steps; splits are the best over the bin edges of every feature."""
    if not len(y) or y.min() == y.max():
        return BoostedTrees(4.0 if len(y) and y[0] else -4.0, [])
    edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    score = np.full(len(y), base)
    out = []
    size = (1 << (depth + 1)) - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        tree = Tree(np.full(size, -1, np.int64), np.zeros(size), np.zeros(size))
        at = np.zeros(len(y), np.int64)
        for node in range(size):
            rows = np.flatnonzero(at == node)
            if not len(rows):
                continue
            gs, hs = g[rows].sum(), h[rows].sum()
            tree.value[node] = rate * gs / (hs + ridge)
            if node >= size // 2 or hs < 2 * least:
                continue
            best = (1e-6, -1, 0)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                gl = np.cumsum(np.bincount(binned[rows, j], g[rows], len(e) + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, j], h[rows], len(e) + 1))[:-1]
                gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                gain[(hl < least) | (hs - hl < least)] = 0
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, k)
            if best[1] >= 0:
                _, j, k = best
                tree.feature[node], tree.threshold[node] = j, edges[j][k]
                at[rows] = 2 * node + 1 + (binned[rows, j] > k)
        out.append(tree)
        score += tree.predict(x)
    return BoostedTrees(base, out)
