"""Boosted trees and random forests over binned features, fitted on a count table and applied as Spark expressions.

The features have few values each, so all candidates of any corpus make a count table whose size the bins bound; Spark
counts it, the fit sees only the table, and the fitted trees are CASE expressions that stay inside the JVM.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A tree: a leaf value, or (feature, threshold, tree at or below it, tree above it).
Tree = float | tuple


def _grow(x, grad, hess, depth, draw, least):
    total_g, total_h = grad.sum(), hess.sum()
    leaf = float(total_g / (total_h + 1.0))
    if depth == 0 or total_h <= least:
        return leaf
    best, gain = None, 1e-9
    base = total_g**2 / (total_h + 1.0)
    for f in draw():
        for cut in np.unique(x[:, f])[:-1]:
            low = x[:, f] <= cut
            g, h = grad[low].sum(), hess[low].sum()
            if min(h, total_h - h) < least:
                continue
            now = g**2 / (h + 1.0) + (total_g - g) ** 2 / (total_h - h + 1.0) - base
            if now > gain:
                best, gain = (f, int(cut), low), now
    if best is None:
        return leaf
    f, cut, low = best
    return (f, cut, _grow(x[low], grad[low], hess[low], depth - 1, draw, least), _grow(x[~low], grad[~low], hess[~low], depth - 1, draw, least))


def value(tree: Tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, low, high = tree
    return np.where(x[:, f] <= cut, value(low, x), value(high, x))


def boost(x: np.ndarray, pos: np.ndarray, neg: np.ndarray, rounds: int = 12, depth: int = 3, rate: float = 0.5) -> list[Tree]:
    """Gradient boosting of the log loss: pos and neg are how many candidates of each row are labelled so."""
    trees, score = [], np.zeros(len(x))
    weight = pos + neg
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, pos - weight * p, np.maximum(weight * p * (1 - p), 1e-6), depth, lambda: range(x.shape[1]), 1e-3)
        trees.append(_scaled(tree, rate))
        score += value(trees[-1], x)
    return trees


def _scaled(tree: Tree, by: float) -> Tree:
    return (tree[0], tree[1], _scaled(tree[2], by), _scaled(tree[3], by)) if isinstance(tree, tuple) else tree * by


def forest(x: np.ndarray, pos: np.ndarray, neg: np.ndarray, trees: int = 15, depth: int = 5, seed: int = 11) -> list[Tree]:
    """A random forest: each tree sees a bootstrap of the counts, each split a random half of the features; a leaf is a share of 1s."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        p, n = rng.poisson(pos).astype(float), rng.poisson(neg).astype(float)
        out.append(_grow(x, p, np.maximum(p + n, 1e-6), depth, lambda: sorted(rng.choice(x.shape[1], -(-x.shape[1] // 2), replace=False)), 1.0))
    return out


def expression(trees: list[Tree], feature: list[Column], mean: bool = False) -> Column:
    """The sum (or mean) of the trees as one expression of the feature columns."""

    def of(tree: Tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        f, cut, low, high = tree
        return F.when(feature[f] <= cut, of(low)).otherwise(of(high))

    total = F.lit(0.0)
    for t in trees:
        total = total + of(t)
    return total / max(1, len(trees)) if mean else total
