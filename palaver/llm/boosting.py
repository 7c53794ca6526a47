"""Gradient-boosted trees for two classes on a small table in memory, which become a Spark expression."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 24
DEPTH = 3
RATE = 0.4
SMOOTHING = 1.0


@dataclass(frozen=True)
class Node:
    """A leaf with ``value``, or a split: ``feature`` at most ``limit`` goes ``left``."""

    value: float = 0.0
    feature: str = ""
    limit: float = 0.0
    left: "Node | None" = None
    right: "Node | None" = None

    def column(self, row: Column) -> Column:
        if self.left is None:
            return F.lit(float(self.value))
        return F.when(row[self.feature] <= self.limit, self.left.column(row)).otherwise(self.right.column(row))

    def values(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        if self.left is None:
            return np.full(len(x), self.value)
        goes_left = x[:, names.index(self.feature)] <= self.limit
        return np.where(goes_left, self.left.values(x, names), self.right.values(x, names))


def grow(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, names: list[str], depth: int = DEPTH) -> Node:
    """A tree for the gradient of the logistic loss, by the gain of each possible split."""
    total, weights = gradient.sum(), weight.sum()
    leaf = Node(value=RATE * total / (weights + SMOOTHING))
    if not depth or len(x) < 4:
        return leaf
    best, gain = None, 1e-6
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        values, g, w = x[order, j], np.cumsum(gradient[order]), np.cumsum(weight[order])
        cut = np.flatnonzero(values[1:] > values[:-1])
        if not len(cut):
            continue
        gains = g[cut] ** 2 / (w[cut] + SMOOTHING) + (total - g[cut]) ** 2 / (weights - w[cut] + SMOOTHING) - total**2 / (weights + SMOOTHING)
        k = int(np.argmax(gains))
        if gains[k] > gain:
            best, gain = (j, name, float(values[cut[k]] + values[cut[k] + 1]) / 2), gains[k]
    if best is None:
        return leaf
    j, name, limit = best
    left = x[:, j] <= limit
    return Node(0.0, name, limit, grow(x[left], gradient[left], weight[left], names, depth - 1), grow(x[~left], gradient[~left], weight[~left], names, depth - 1))


def boost(x: np.ndarray, y: np.ndarray, names: list[str], rounds: int = ROUNDS) -> list[Node]:
    """Trees whose values add up to the log odds of label 1."""
    odds, trees = np.zeros(len(x)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        trees.append(grow(x, y - p, p * (1 - p), names))
        odds += trees[-1].values(x, names)
    return trees


def log_odds(trees: list[Node], row: Column) -> Column:
    found = F.lit(0.0)
    for tree in trees:
        found = found + tree.column(row)
    return found
