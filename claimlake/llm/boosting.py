"""Gradient-boosted trees for two classes: fitted with numpy on a bounded table of rows, applied
as a column expression."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Node:
    value: float
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


@dataclass
class Boosted:
    names: list[str]
    base: float
    trees: list[Node]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((_apply(t, x) for t in self.trees), np.zeros(len(x)))

    def probability(self, features: Mapping[str, Column]) -> Column:
        """The probability as an expression over feature columns."""
        total = F.lit(float(self.base))
        for tree in self.trees:
            total = total + _expression(tree, [features[n] for n in self.names])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _apply(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.value)
    return np.where(x[:, node.feature] <= node.cut, _apply(node.low, x), _apply(node.high, x))


def _expression(node: Node, features: list[Column]) -> Column:
    if node.feature < 0:
        return F.lit(float(node.value))
    return F.when(features[node.feature] <= float(node.cut), _expression(node.low, features)).otherwise(_expression(node.high, features))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(names: list[str], x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3, least: int = 5) -> Boosted:
    """Newton boosting of the logistic loss; without rows of both classes, the model is constant."""
    share = np.clip(y.mean() if len(y) else 0.0, 1e-4, 1 - 1e-4)
    model = Boosted(names, float(np.log(share / (1 - share))), [])
    if len(np.unique(y)) < 2:
        return model
    margin = np.full(len(y), model.base)
    for _ in range(trees):
        p = sigmoid(margin)
        tree = _grow(x, p - y, np.maximum(p * (1 - p), 1e-6), depth, rate, least)
        if tree.feature < 0 and abs(tree.value) < 1e-6:
            break
        model.trees.append(tree)
        margin += _apply(tree, x)
    return model


def _grow(x: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int, rate: float, least: int) -> Node:
    g, h = slope.sum(), curve.sum()
    node = Node(float(-rate * g / (h + 1)))
    if depth == 0 or len(x) < 2 * least:
        return node
    best = 1e-3
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, gl, hl = x[order, f], np.cumsum(slope[order])[:-1], np.cumsum(curve[order])[:-1]
        gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
        allowed = (v[1:] > v[:-1]) & (np.arange(1, len(v)) >= least) & (np.arange(1, len(v)) <= len(v) - least)
        gain = np.where(allowed, gain, -1)
        k = int(np.argmax(gain)) if len(gain) else 0
        if len(gain) and gain[k] > best:
            best, node.feature, node.cut = float(gain[k]), f, float((v[k] + v[k + 1]) / 2)
    if node.feature < 0:
        return node
    low = x[:, node.feature] <= node.cut
    node.low = _grow(x[low], slope[low], curve[low], depth - 1, rate, least)
    node.high = _grow(x[~low], slope[~low], curve[~low], depth - 1, rate, least)
    return node
