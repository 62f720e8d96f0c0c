"""Regression trees of one series, for use inside grouped tasks: at most one training row per calendar day.

Thousands of small fits (series x fold x candidate) are the job here, so Spark spreads the fits and
each one is numpy; a distributed tree learner would schedule several jobs per tree.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Nodes of all trees side by side: ``feature`` is -1 in leaves, ``child`` the left one (right: + 1)."""

    intercept: float
    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray
    root: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        rows = np.arange(len(x))[:, None]
        # Trees in blocks, so that the table of positions stays small.
        for begin in range(0, len(self.root), 64):
            at = np.broadcast_to(self.root[begin:begin + 64], (len(x), len(self.root[begin:begin + 64]))).copy()
            while True:
                split = self.feature[at]
                if (split < 0).all():
                    break
                right = x[rows, np.maximum(split, 0)] > self.threshold[at]
                at = np.where(split < 0, at, self.child[at] + right)
            total += self.value[at].sum(axis=1)
        return total


class _Grower:
    """Adds trees over one table of features, sorted once."""

    def __init__(self, x: np.ndarray):
        self.x, self.order = x, np.argsort(x, axis=0, kind="stable").T.copy()
        changes = np.diff(np.take_along_axis(x.T, self.order, axis=1), axis=1) != 0
        steps = np.cumsum(np.pad(changes, ((0, 0), (1, 0))), axis=1, dtype=np.int32)
        self.rank = np.empty_like(steps)
        np.put_along_axis(self.rank, self.order, steps, axis=1)
        self.feature, self.threshold, self.child, self.value, self.root = [], [], [], [], []

    def _node(self, value: float) -> int:
        self.feature.append(-1)
        self.threshold.append(0.0)
        self.child.append(-1)
        self.value.append(value)
        return len(self.feature) - 1

    def _best(self, order, weight, target, least):
        """(gain, feature, left size) of the best exact split of the rows in ``order``, or None."""
        m = order.shape[1]
        if m < 2 * least or m < 2:
            return None
        # Around the mean, the gain of a split is the squared left sum over the product of both weights.
        cut = slice(least - 1, m - least)
        centred = target - np.average(target[order[0]], weights=None if weight is None else weight[order[0]])
        gain = np.cumsum((centred if weight is None else weight * centred)[order], axis=1)[:, cut]
        gain *= gain
        left = np.arange(1.0, m + 1) if weight is None else np.cumsum(weight[order], axis=1)
        whole = left[..., -1:]
        gain *= (whole / (left * (whole - left) + (left == whole)))[..., cut]
        ranks = np.take_along_axis(self.rank, order, axis=1)
        gain[ranks[:, least - 1:m - least] == ranks[:, least:m - least + 1]] = -1.0
        f, k = divmod(int(np.argmax(gain)), gain.shape[1])
        spread = float(np.dot(centred[order[0]], centred[order[0]]))
        return (float(gain[f, k]), f, k + least) if gain[f, k] > 1e-9 * spread else None

    def grow(self, target, weight=None, scale=1.0, depth=None, leaves=None, least=1) -> np.ndarray:
        """One tree, best split first; returns its value for every training row it was grown on."""
        fitted = np.zeros(len(target))
        order = self.order if weight is None else self.order[(weight > 0)[self.order]].reshape(len(self.order), -1)
        heap, count = [], 1

        def settle(rows, level) -> int:
            inside = rows[0]
            value = scale * float(np.average(target[inside], weights=None if weight is None else weight[inside]))
            fitted[inside] = value
            node = self._node(value)
            found = None if depth is not None and level >= depth else self._best(rows, weight, target, least)
            if found is not None:
                heapq.heappush(heap, (-found[0], node, level, rows, found))
            return node

        self.root.append(settle(order, 0))
        while heap and (leaves is None or count < leaves):
            _, node, level, rows, (_, f, size) = heapq.heappop(heap)
            low, high = self.x[rows[f, size - 1], f], self.x[rows[f, size], f]
            goes_left = np.zeros(len(target), dtype=bool)
            goes_left[rows[f, :size]] = True
            left = goes_left[rows]
            # The middle may round up to the higher value, which must stay right of it.
            middle = low + (high - low) / 2
            self.feature[node], self.threshold[node] = f, low if middle >= high else middle
            self.child[node] = settle(rows[left].reshape(len(rows), -1), level + 1)
            settle(rows[~left].reshape(len(rows), -1), level + 1)
            count += 1
        return fitted

    def trees(self, intercept: float) -> Trees:
        return Trees(
            intercept, np.array(self.feature, dtype=np.int32), np.array(self.threshold), np.array(self.child, dtype=np.int32),
            np.array(self.value), np.array(self.root, dtype=np.int32),
        )


def fit_forest(x, y, n_trees: int, depth: int | None, least: int, seed: int) -> Trees:
    """Mean of trees grown on bootstrap samples, all features at each split."""
    grower, random = _Grower(x), np.random.default_rng(seed)
    for _ in range(n_trees):
        drawn = np.bincount(random.integers(0, len(y), len(y)), minlength=len(y)).astype(float)
        grower.grow(y, drawn, 1.0 / n_trees, depth, None, least)
    return grower.trees(0.0)


def fit_boosted(x, y, n_trees: int, rate: float, depth: int | None, leaves: int | None, least: int) -> Trees:
    """Least-squares boosting from the mean; stops early only when a tree finds nothing to split."""
    grower = _Grower(x)
    start = float(y.mean())
    current = np.full(len(y), start)
    for _ in range(n_trees):
        before = len(grower.feature)
        current += grower.grow(y - current, None, rate, depth, leaves, least)
        if len(grower.feature) == before + 1:
            break
    return grower.trees(start)
