"""Gradient-boosted trees over a bounded sample of rows, and calibrated thresholds of their scores.

The fit runs on the driver over at most a few thousand rows, which its caller bounds; scoring is NumPy inside tasks.  Trees are
full binary trees of one depth, grown level by level from histograms of binned features by second-order gains of the
logistic loss.  All is deterministic: ties go to the smaller feature, then the smaller cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Trees, their depth, bins of a feature, the step, the weight of the penalty, and rows' weight (second order) in a leaf at least.
TREES, DEPTH, BINS, STEP, PENALTY, LEAF = 60, 3, 32, 0.3, 1.0, 0.5


@dataclass(frozen=True)
class Trees:
    """Of each tree: the feature and cut of each inner node (rows above the cut go right), and the value of each leaf."""

    start: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out


def _cuts(x: np.ndarray) -> np.ndarray:
    """At most BINS - 1 values between which a feature's rows are about equally many."""
    return np.unique(np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for rows of features and labels 0 and 1, of which both have to be there."""
    n, width = x.shape
    cuts = [_cuts(x[:, f]) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    share = y.mean()
    start, inner = float(np.log(share / (1 - share))), (1 << DEPTH) - 1
    margin, trees = np.full(n, start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        feature, at = np.zeros(inner, np.int64), np.full(inner, BINS)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, many = (1 << level) - 1, 1 << level
            slot = ((node - first)[:, None] * width + np.arange(width)) * BINS + binned
            sums = [np.bincount(slot.ravel(), np.repeat(w, width), many * width * BINS).reshape(many, width, BINS).cumsum(axis=2) for w in (grad, hess)]
            left, total = np.stack(sums), np.stack([s[:, :, -1:] for s in sums])
            right = total - left
            gain = left[0] ** 2 / (left[1] + PENALTY) + right[0] ** 2 / (right[1] + PENALTY) - total[0] ** 2 / (total[1] + PENALTY)
            gain[(left[1] < LEAF) | (right[1] < LEAF)] = 0
            best = gain.reshape(many, -1).argmax(axis=1)
            splits = gain.reshape(many, -1)[np.arange(many), best] > 1e-9
            feature[first : first + many] = np.where(splits, best // BINS, 0)
            at[first : first + many] = np.where(splits, best % BINS, BINS)  # without a gain all rows go left
            node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > at[node])
        own = node - inner
        leaf = -STEP * np.bincount(own, grad, inner + 1) / (np.bincount(own, hess, inner + 1) + PENALTY)
        margin += leaf[own]
        value = np.array([cuts[f][a] if a < len(cuts[f]) else np.inf for f, a in zip(feature, at)])
        trees.append((feature, value, leaf))
    return Trees(start, *(np.stack(part) for part in zip(*trees)))


def calibrated(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, shares of label 1 from each score on), ascending: the isotonic fit to rows kept out of the fit of the trees."""
    blocks: list[list[float]] = []  # score from which it holds, rows of label 1, rows
    values, place = np.unique(score, return_inverse=True)
    for v, ones, rows in zip(values.tolist(), np.bincount(place, y).tolist(), np.bincount(place).tolist()):
        blocks.append([v, ones, rows])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, ones, rows = blocks.pop()
            blocks[-1][1] += ones
            blocks[-1][2] += rows
    # a block of few rows is not certain: one row of label 0 more
    return np.array([b[0] for b in blocks]), np.array([b[1] / (b[2] + 1) for b in blocks])


def threshold(score: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The smallest score whose calibrated share of label 1 is ``precision``; infinite if there is none."""
    if not len(score):
        return float("inf")
    scores, shares = calibrated(score, y)
    fine = np.flatnonzero(shares >= precision)
    return float(scores[fine[0]]) if len(fine) else float("inf")
