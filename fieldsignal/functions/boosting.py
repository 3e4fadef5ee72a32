"""Regression trees over binned columns: histograms, split search and application, for one block of rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 256


@dataclass
class Tree:
    """Nodes by number: 1 is the root, the children of k are 2k (up to the threshold) and 2k + 1."""

    feature: dict[int, int] = field(default_factory=dict)
    cut: dict[int, int] = field(default_factory=dict)
    threshold: dict[int, float] = field(default_factory=dict)
    value: dict[int, float] = field(default_factory=dict)
    rows: dict[int, int] = field(default_factory=dict)
    gain: dict[int, float] = field(default_factory=dict)

    def arrays(self, bound: dict[int, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature (-1 for a leaf), bound and value by node number."""
        size = 2 * max(self.value, default=1) + 2
        feature, limit, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        for node, f in self.feature.items():
            feature[node], limit[node] = f, bound[node]
        for node, v in self.value.items():
            value[node] = v
        return feature, limit, value


def leaves(columns: np.ndarray, feature: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """The leaf of each row, for columns as [feature, row]: one step for each inner node, parents first."""
    inner = np.flatnonzero(feature >= 0)
    number = np.min_scalar_type(2 * int(inner[-1]) + 1 if len(inner) else 1)
    node = np.ones(columns.shape[1], dtype=number)
    for k in inner:
        bound = columns.dtype.type(limit[k])
        step = (columns[feature[k]] > bound).astype(number)
        step += number.type(k)
        step *= node == k
        node += step
    return node


def histograms(bins: np.ndarray, node: np.ndarray, nodes: np.ndarray, residual: np.ndarray):
    """Sums of residuals and counts as [node, feature, bin], of the rows that are in one of the sorted ``nodes``."""
    place = np.full(max(int(nodes[-1]), int(node.max(initial=0))) + 1, -1, dtype=np.int64)
    place[nodes] = np.arange(len(nodes))
    base, size = BINS * place[node], len(nodes) * BINS
    if (base < 0).any():
        mine = np.flatnonzero(base >= 0)
        base, bins, residual = base[mine], bins[:, mine], residual[mine]
    residual = residual.astype(np.float64)
    sums = np.zeros((len(bins), size), dtype=np.int64)
    counts = np.zeros((len(bins), size), dtype=np.int64)
    for f, column in enumerate(bins):
        cell = base + column
        # Residuals are whole numbers below 2^24, so the sums of up to 2^29 rows are exact.
        sums[f] = np.bincount(cell, residual, size)
        counts[f] = np.bincount(cell, minlength=size)
    shape = len(bins), len(nodes), BINS
    return sums.reshape(shape).swapaxes(0, 1), counts.reshape(shape).swapaxes(0, 1)


def best_cut(sums: np.ndarray, counts: np.ndarray, least_rows: int):
    """(gain, cut, left rows, left sum) of the best bin to part a histogram at, the first of equals; None without any.

    Sums are whole numbers, hence the same in any order of summation.
    """
    left_n, left_s = np.cumsum(counts), np.cumsum(sums)
    n, s = int(left_n[-1]), int(left_s[-1])
    right_n, right_s = n - left_n, s - left_s
    allowed = np.flatnonzero((left_n >= least_rows) & (right_n >= least_rows))
    if not len(allowed):
        return None
    ln, ls, rn, rs = (x[allowed].astype(np.float64) for x in (left_n, left_s, right_n, right_s))
    gain = ls * ls / ln + rs * rs / rn - float(s) * float(s) / n
    k = int(np.argmax(gain))
    at = int(allowed[k])
    return float(gain[k]), at, int(left_n[at]), int(left_s[at])


def best_first(gains: dict[int, float], leaf_count: int) -> list[int]:
    """The nodes that are parted when always the open node of largest gain is, until there are ``leaf_count`` leaves."""
    parted: list[int] = []
    open_ = [1] if 1 in gains else []
    while open_ and len(parted) < leaf_count - 1:
        node = max(open_, key=lambda k: (gains[k], -k))
        open_.remove(node)
        parted.append(node)
        open_ += [k for k in (2 * node, 2 * node + 1) if k in gains]
    return parted
