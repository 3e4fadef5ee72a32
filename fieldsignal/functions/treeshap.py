"""Path-dependent Shapley contributions of a boosted tree model, for a batch of rows.

A leaf's weight in the expectation over a feature subset is a product over the features
on its path: 1 or 0 for a known feature, the share of training rows for an unknown one.
The Shapley average over all subsets of such a product is an integral over t in (0, 1)
of prod(z (1 - t) + o t); Gauss-Legendre nodes give it exactly, for all rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Leaf:
    """Value of a leaf, and per path feature the interval it admits and its cover share."""

    value: float
    cover: float
    features: tuple[int, ...]
    lower: tuple[float, ...]
    upper: tuple[float, ...]
    share: tuple[float, ...]


def leaves_of(nodes: dict[int, tuple], weight: float) -> list[Leaf]:
    """Leaves of one tree given as id -> (prediction, left, right, feature, threshold, rows); the least id is the root."""
    found: list[Leaf] = []
    root = min(nodes)
    total = nodes[root][5]

    def walk(node: int, path: dict[int, tuple[float, float, float]]) -> None:
        prediction, left, right, feature, threshold, rows = nodes[node]
        if left < 0:
            names = tuple(path)
            parts = list(zip(*path.values())) or [(), (), ()]
            found.append(Leaf(weight * prediction, rows / total, names, *map(tuple, parts)))
            return
        low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
        for child, bounds in ((left, (low, min(high, threshold))), (right, (max(low, threshold), high))):
            walk(child, path | {feature: (*bounds, share * nodes[child][5] / rows)})

    walk(root, {})
    return found


def base_value(leaves: list[Leaf]) -> float:
    return sum(leaf.value * leaf.cover for leaf in leaves)


def contributions(x: np.ndarray, leaves: list[Leaf]) -> np.ndarray:
    """Contribution per row and feature; with the base value they add up to the prediction."""
    out = np.zeros_like(x, dtype=float)
    rules: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for leaf in leaves:
        d = len(leaf.features)
        if d == 0:
            continue
        if d not in rules:
            nodes, weights = np.polynomial.legendre.leggauss(d // 2 + 1)
            rules[d] = (nodes + 1) / 2, weights / 2
        t, w = rules[d]
        known = [
            ((x[:, f] > low) & (x[:, f] <= high)).astype(float)
            for f, low, high in zip(leaf.features, leaf.lower, leaf.upper)
        ]
        factors = [z * (1 - t) + o[:, None] * t for z, o in zip(leaf.share, known)]
        product = np.prod(factors, axis=0)
        for f, z, o, factor in zip(leaf.features, leaf.share, known, factors):
            out[:, f] += leaf.value * (o - z) * ((product / factor) @ w)
    return out
