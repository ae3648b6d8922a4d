"""A small gradient-boosted classifier: shallow trees on binned features, logistic loss, numpy only."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of ``depth`` levels, each a complete binary tree kept as arrays, so prediction is vectorised."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = -20.0  # untrained, it calls nothing class 1

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        x, y = np.asarray(x, np.float32), np.asarray(y, np.float64)
        if not len(y) or y.min() == y.max():  # nothing to tell apart
            self.base = 20.0 if len(y) and y.min() > 0 else -20.0
            return self
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, self.bins + 1)[1:-1])) for column in x.T]
        coded = np.stack([np.searchsorted(e, column, "right") for e, column in zip(edges, x.T, strict=True)], axis=1)
        score = np.full(len(y), self.base)
        inner = (1 << self.depth) - 1
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            gradient, weight = y - p, np.maximum(p * (1 - p), 1e-9)
            feature, cut = np.zeros(inner, np.int32), np.full(inner, np.inf, np.float32)
            node = np.zeros(len(y), np.int64)
            for at in range(inner):
                here = np.flatnonzero(node == at)
                left = np.zeros(len(here), bool) if not len(here) else None
                if len(here) > 1:
                    best = (1e-6, None, None)
                    g, h = gradient[here], weight[here]
                    whole = g.sum() ** 2 / (h.sum() + self.ridge)
                    for f in range(x.shape[1]):
                        n = len(edges[f]) + 1
                        gs = np.cumsum(np.bincount(coded[here, f], g, n))[:-1]
                        hs = np.cumsum(np.bincount(coded[here, f], h, n))[:-1]
                        if not len(gs):
                            continue
                        gain = gs**2 / (hs + self.ridge) + (g.sum() - gs) ** 2 / (h.sum() - hs + self.ridge) - whole
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (gain[k], f, k)
                    if best[1] is not None:
                        feature[at], cut[at] = best[1], edges[best[1]][best[2]]
                        left = coded[here, best[1]] <= best[2]
                if left is None:
                    left = np.ones(len(here), bool)
                node[here] = np.where(left, 2 * at + 1, 2 * at + 2)
            leaf = node - inner
            g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, weight, inner + 1)
            value = self.rate * g / (h + self.ridge)
            self.trees.append((feature, cut, value))
            score += value[leaf]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of class 1."""
        x = np.asarray(x, np.float32)
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = (1 << self.depth) - 1
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] >= cut[node])
            score += value[node - inner]
        return 1 / (1 + np.exp(-score))
