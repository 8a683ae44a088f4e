"""Gradient-boosted trees for two classes on binned features, for training sets that fit one process."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BINS = 32
_MIN_WEIGHT = 2.0  # least sum of second derivatives in a leaf
_RIDGE = 1.0


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth: a feature and a threshold per inner node, a value per leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of the rows of ``x``."""
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - inner]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2) -> Trees:
    """Boosted trees for labels 0 and 1. Each level splits all its nodes on their own best feature."""
    n, features = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, _BINS + 1)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    score = np.full(n, start)
    inner = 2**depth - 1
    all_features, all_thresholds, all_values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            place = at - first
            best = np.zeros(width)
            for f in range(features):
                key = place * _BINS + binned[:, f]
                g = np.bincount(key, gradient, width * _BINS).reshape(width, _BINS).cumsum(axis=1)
                h = np.bincount(key, weight, width * _BINS).reshape(width, _BINS).cumsum(axis=1)
                right_g, right_h = g[:, -1:] - g, h[:, -1:] - h
                gain = g**2 / (h + _RIDGE) + right_g**2 / (right_h + _RIDGE) - g[:, -1:] ** 2 / (h[:, -1:] + _RIDGE)
                gain[(h < _MIN_WEIGHT) | (right_h < _MIN_WEIGHT)] = 0
                cut = gain[:, : len(edges[f])].argmax(axis=1) if len(edges[f]) else np.zeros(width, np.int64)
                value = gain[np.arange(width), cut]
                for k in np.flatnonzero(value > best + 1e-9) if len(edges[f]) else ():
                    best[k], feature[first + k], threshold[first + k] = value[k], f, edges[f][cut[k]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf = at - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, weight, inner + 1)
        value = rate * g / (h + _RIDGE)
        score += value[leaf]
        all_features.append(feature)
        all_thresholds.append(threshold)
        all_values.append(value)
    return Trees(np.array(all_features), np.array(all_thresholds), np.array(all_values), start)
