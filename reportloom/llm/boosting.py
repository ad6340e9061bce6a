"""Gradient boosted trees for two classes in numpy, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32
ROUNDS = 60
DEPTH = 3
RATE = 0.2
PENALTY = 1.0  # added to the weight of a leaf
LEAST_WEIGHT = 1.0  # of either side of a split


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Number of the bin of each value, feature by feature."""
    return np.stack([np.searchsorted(e, values[:, f]) for f, e in enumerate(edges)], axis=1) if len(edges) else values.astype(np.int64)


@dataclass
class BoostedTrees:
    """Full binary trees of one depth: per inner node a feature and the last bin that goes left."""

    edges: list[np.ndarray]
    start: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        bins = binned(values, self.edges)
        rows = np.arange(len(bins))
        total = np.full(len(bins), self.start)
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(bins), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def best_splits(bins: np.ndarray, node: np.ndarray, slope: np.ndarray, weight: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature and cut of each node with the largest gain; nodes that gain nothing send all to the left."""
    width = bins.shape[1]
    cell = ((node[:, None] * width + np.arange(width)) * BINS + bins).ravel()
    sums = []
    for values in (slope, weight):
        counts = np.bincount(cell, np.repeat(values, width), nodes * width * BINS)
        sums.append(np.cumsum(counts.reshape(nodes, width, BINS), axis=2))
    left, left_weight = sums
    right, right_weight = left[:, :, -1:] - left, left_weight[:, :, -1:] - left_weight
    value = lambda s, w: s**2 / (w + PENALTY)
    gain = value(left, left_weight) + value(right, right_weight) - value(left[:, :, -1:], left_weight[:, :, -1:])
    gain[(left_weight < LEAST_WEIGHT) | (right_weight < LEAST_WEIGHT)] = 0
    flat = gain.reshape(nodes, -1)
    best = flat.argmax(axis=1)
    cuts = np.where(flat[np.arange(nodes), best] > 1e-9, best % BINS, BINS)
    return best // BINS, cuts


def fit(values: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, rate: float = RATE) -> BoostedTrees:
    """Boost ``rounds`` trees on the logistic loss; one class only, or no rows, gives a constant."""
    share = np.clip(labels.mean() if len(labels) else 0.0, 1e-4, 1 - 1e-4)
    start = float(np.log(share / (1 - share)))
    inner = 2**DEPTH - 1
    features, cuts, leaves = [], [], []
    edges = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(values.shape[1])] if len(values) else []
    if len(labels) and labels.min() != labels.max():
        bins = binned(values, edges)
        total = np.full(len(labels), start)
        for _ in range(rounds):
            chance = 1 / (1 + np.exp(-total))
            slope, weight = labels - chance, chance * (1 - chance)
            feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
            node = np.zeros(len(labels), np.int64)
            for level in range(DEPTH):
                first = 2**level - 1
                own = slice(first, first + 2**level)
                feature[own], cut[own] = best_splits(bins, node - first, slope, weight, 2**level)
                node = 2 * node + 1 + (bins[np.arange(len(bins)), feature[node]] > cut[node])
            at = node - inner
            leaf = rate * np.bincount(at, slope, inner + 1) / (np.bincount(at, weight, inner + 1) + PENALTY)
            total += leaf[at]
            features.append(feature)
            cuts.append(cut)
            leaves.append(leaf)
    shape = (len(features), inner)
    return BoostedTrees(edges, start, np.array(features, np.int64).reshape(shape), np.array(cuts, np.int64).reshape(shape), np.array(leaves).reshape(len(leaves), inner + 1))


def calibrated(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending scores and, for each, the share of class 1 that isotonic regression gives it."""
    points, at = np.unique(scores, return_inverse=True)
    hits, counts = np.bincount(at, labels), np.bincount(at).astype(np.float64)
    blocks: list[list[float]] = []  # share, rows, points
    for hit, count in zip(hits, counts, strict=True):
        blocks.append([hit / count, count, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            share, rows, n = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + share * rows) / (last[1] + rows)
            last[1] += rows
            last[2] += n
    return points, np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def threshold(scores: np.ndarray, labels: np.ndarray, share: float, least: int) -> float:
    """The lowest score with a calibrated share of class 1 of ``share`` or more; infinite with fewer than ``least`` rows of class 1."""
    if labels.sum() < least:
        return float("inf")
    points, shares = calibrated(scores, labels)
    good = np.flatnonzero(shares >= share)
    return float(points[good[0]]) if len(good) else float("inf")
