"""Small gradient-boosted trees in numpy: logistic loss, binned features, trees of fixed depth."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class BoostedTrees:
    """``trees`` holds (features, thresholds, leaf values) of complete binary trees."""

    depth: int = 3
    rate: float = 0.2
    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for features, thresholds, leaves in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, features[node]] > thresholds[node])
            total += leaves[node - len(features)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x))


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 24
) -> BoostedTrees:
    """Newton steps on the logistic loss; every split takes the best of all features and cuts."""
    model = BoostedTrees(depth, rate)
    if len(y) == 0:
        return model
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model.base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], axis=1)
    width = max(len(c) for c in cuts) + 1
    margin = np.full(len(y), model.base)
    for _ in range(rounds):
        p = _sigmoid(margin)
        slope, curve = y - p, np.maximum(p * (1 - p), 1e-6)
        features = np.zeros(2**depth - 1, np.int64)
        thresholds = np.full(2**depth - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for place in range(2**depth - 1):
            rows = np.flatnonzero(node == place)
            best = 1e-6
            if len(rows):
                whole = slope[rows].sum() ** 2 / (curve[rows].sum() + 1)
                for k, cut in enumerate(cuts):
                    g = np.bincount(binned[rows, k], slope[rows], width)[: len(cut)].cumsum()
                    h = np.bincount(binned[rows, k], curve[rows], width)[: len(cut)].cumsum()
                    gain = g**2 / (h + 1) + (slope[rows].sum() - g) ** 2 / (curve[rows].sum() - h + 1)
                    if len(cut) and gain.max() - whole > best:
                        best = gain.max() - whole
                        features[place], thresholds[place] = k, cut[int(gain.argmax())]
            node[rows] = 2 * place + 1 + (x[rows, features[place]] > thresholds[place])
        leaf = node - len(features)
        top = np.bincount(leaf, slope, 2**depth)
        bottom = np.bincount(leaf, curve, 2**depth)
        leaves = rate * top / (bottom + 1)
        margin += leaves[leaf]
        model.trees.append((features, thresholds, leaves))
    return model
