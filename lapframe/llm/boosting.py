"""Gradient boosting on counted feature bins, compiled to a Spark expression.

The learner sees one row per combination of bins with its numbers of positive and negative cases, as
a grouped aggregate gives it. Its input is bounded by the product of the bin counts, whatever the
table's size; no row is sampled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    """Goes left where the feature's bin is at most ``bin`` (``equal``: equal to it)."""

    feature: int
    bin: int
    equal: bool
    left: Split | Leaf
    right: Split | Leaf


@dataclass(frozen=True)
class Trees:
    bias: float
    trees: tuple[Split | Leaf, ...]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.bias + sum((_values(t, x) for t in self.trees), np.zeros(len(x)))

    def column(self, features: Sequence[Column]) -> Column:
        """The margin as nested conditionals."""
        total = F.lit(self.bias)
        for tree in self.trees:
            total = total + _expression(tree, features)
        return total


def _side(split: Split, x: np.ndarray) -> np.ndarray:
    column = x[:, split.feature]
    return column == split.bin if split.equal else column <= split.bin


def _values(node: Split | Leaf, x: np.ndarray) -> np.ndarray:
    if isinstance(node, Leaf):
        return np.full(len(x), node.value)
    return np.where(_side(node, x), _values(node.left, x), _values(node.right, x))


def _expression(node: Split | Leaf, features: Sequence[Column]) -> Column:
    if isinstance(node, Leaf):
        return F.lit(node.value)
    column = features[node.feature]
    test = column == node.bin if node.equal else column <= node.bin
    return F.when(test, _expression(node.left, features)).otherwise(_expression(node.right, features))


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, unordered: frozenset[int], depth: int, penalty: float, rate: float) -> Split | Leaf:
    g, h = grad.sum(), hess.sum()
    leaf = Leaf(float(-rate * g / (h + penalty)))
    if depth == 0:
        return leaf
    best: tuple[float, int, int] | None = None
    for f in range(x.shape[1]):
        bins = int(x[:, f].max()) + 1 if len(x) else 0
        gs, hs = np.bincount(x[:, f], grad, bins), np.bincount(x[:, f], hess, bins)
        if f not in unordered:
            gs, hs = np.cumsum(gs), np.cumsum(hs)
        gain = gs**2 / (hs + penalty) + (g - gs) ** 2 / (h - hs + penalty) - g**2 / (h + penalty)
        gain[(hs <= 1e-9) | (h - hs <= 1e-9)] = 0
        k = int(gain.argmax()) if bins else 0
        if bins and gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (float(gain[k]), f, k)
    if best is None:
        return leaf
    _, f, k = best
    split = Split(f, k, f in unordered, leaf, leaf)
    side = _side(split, x)
    halves = [_grow(x[s], grad[s], hess[s], unordered, depth - 1, penalty, rate) for s in (side, ~side)]
    return Split(f, k, f in unordered, *halves)


def boost(
    x: np.ndarray, positive: np.ndarray, negative: np.ndarray, unordered: frozenset[int] = frozenset(), rounds: int = 24, depth: int = 3, rate: float = 0.4, penalty: float = 1.0
) -> Trees:
    """Fit by second-order boosting of the logistic loss; features in ``unordered`` split by equality."""
    total, pos = positive + negative, float(positive.sum())
    bias = float(np.log((pos + 0.5) / (float(negative.sum()) + 0.5)))
    margin, trees = np.full(len(x), bias), []
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, p * total - positive, p * (1 - p) * total, unordered, depth, penalty, rate)
        if isinstance(tree, Leaf):
            break
        trees.append(tree)
        margin = margin + _values(tree, x)
    return Trees(bias, tuple(trees))
