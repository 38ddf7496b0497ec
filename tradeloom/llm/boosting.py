"""Gradient-boosted trees for small tables of numbers."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Trees of equal depth; node i has children 2i + 1 and 2i + 2."""

    base: float
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -50, 50)))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.2,
          bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Logistic boosting with Newton steps on histograms of the features."""
    share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    inner = (1 << depth) - 1
    margin = np.full(n, model.base)
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(margin, -50, 50)))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            best = np.full(many, 1e-9)
            split = np.full(many, bins + 1)
            for j in range(k):
                cell = (node - first) * (bins + 1) + binned[:, j]
                g = np.bincount(cell, grad, many * (bins + 1)).reshape(many, -1).cumsum(axis=1)
                h = np.bincount(cell, hess, many * (bins + 1)).reshape(many, -1).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
                gain = gain[:, : len(cuts[j])]
                if not gain.shape[1]:
                    continue
                top = gain.argmax(axis=1)
                better = gain[np.arange(many), top] > best
                best = np.where(better, gain[np.arange(many), top], best)
                split = np.where(better, top, split)
                feature[first : first + many] = np.where(better, j, feature[first : first + many])
            here = np.flatnonzero(split <= bins)
            cut[first + here] = [cuts[feature[first + i]][split[i]] for i in here]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        value = -rate * g / (h + ridge)
        margin += value[leaf]
        model.feature.append(feature)
        model.cut.append(cut)
        model.value.append(value)
    return model


def precise_threshold(score: np.ndarray, y: np.ndarray, precision: float, least: int = 20) -> float:
    """Least score from which on the given precision holds on these rows; above 1 if none does."""
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(np.diff(score[order]) != 0, True) if len(y) else np.zeros(0, bool)
    good = np.flatnonzero(last & (right >= precision) & (np.arange(len(y)) + 1 >= least))
    return float(score[order][good[-1]]) if len(good) else 1.1
