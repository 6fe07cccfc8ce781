"""Gradient-boosted trees for small tables of features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from fleetpulse.llm.shared import by_value

by_value(__name__)

TREES = 40
DEPTH = 3
RATE = 0.3
LEAST_LEAF = 5
BINS = 32


@dataclass(frozen=True)
class BoostedTrees:
    """Each tree is a complete one of ``DEPTH`` levels: features, cuts and leaf values."""

    offset: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.offset)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def best_cut(x: np.ndarray, gradient: np.ndarray, curve: np.ndarray) -> tuple[int, float]:
    """The feature and cut with the largest gain; an infinite cut if there is none."""
    g, h = gradient.sum(), curve.sum()
    best, found = 1e-6 + g * g / (h + 1), (0, np.inf)
    for feature in range(x.shape[1]):
        values = x[:, feature]
        cuts = np.unique(np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
        for cut in cuts:
            left = values <= cut
            if min(left.sum(), len(left) - left.sum()) < LEAST_LEAF:
                continue
            gl, hl = gradient[left].sum(), curve[left].sum()
            gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1)
            if gain > best:
                best, found = gain, (feature, float(cut))
    return found


def fit_trees(x: np.ndarray, y: np.ndarray) -> BoostedTrees:
    """Logistic boosting with second-order leaf values."""
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    offset = float(np.log(share / (1 - share)))
    inner, features, cuts, leaves = 2**DEPTH - 1, [], [], []
    total = np.full(len(x), offset)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, curve = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(x), np.int64)
        for at in range(inner):
            rows = np.flatnonzero(node == at)
            if len(rows):
                feature[at], cut[at] = best_cut(x[rows], gradient[rows], curve[rows])
                node[rows] = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
        own = node - inner
        top = np.bincount(own, gradient, 2**DEPTH)
        leaf = RATE * top / (np.bincount(own, curve, 2**DEPTH) + 1)
        total = total + leaf[own]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return BoostedTrees(offset, np.array(features), np.array(cuts), np.array(leaves))
