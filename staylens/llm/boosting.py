"""Gradient-boosted trees for two classes, on a sample that fits one process."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Boosted:
    """Second-order boosting over binned features; ``nodes`` holds per tree the
    arrays feature (-1: leaf), cut, left, right and value."""

    trees: int = 60
    depth: int = 4
    rate: float = 0.2
    bins: int = 32
    least: float = 1.0
    penalty: float = 1.0
    base: float = 0.0
    nodes: list[tuple[np.ndarray, ...]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(k, c, side="left") for k, c in zip(cuts, x.T)], axis=1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = sigmoid(margin)
            tree = self._grow(binned, cuts, p - y, p * (1 - p) + 1e-6)
            self.nodes.append(tree)
            margin += self._tree(tree, x)
        return self

    def _grow(self, binned: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        feature, cut, left, right, value = [], [], [], [], []

        def node(rows: np.ndarray, depth: int) -> int:
            at = len(feature)
            total_g, total_h = g[rows].sum(), h[rows].sum()
            for column, empty in ((feature, -1), (cut, 0.0), (left, -1), (right, -1), (value, -self.rate * total_g / (total_h + self.penalty))):
                column.append(empty)
            best = (1e-6, -1, 0)
            for f in range(binned.shape[1] if depth < self.depth else 0):
                if not len(cuts[f]):
                    continue
                sums = [np.cumsum(np.bincount(binned[rows, f], weights=w[rows], minlength=len(cuts[f]) + 1))[:-1] for w in (g, h)]
                rest = total_g - sums[0], total_h - sums[1]
                gain = sums[0] ** 2 / (sums[1] + self.penalty) + rest[0] ** 2 / (rest[1] + self.penalty) - total_g**2 / (total_h + self.penalty)
                gain[(sums[1] < self.least) | (rest[1] < self.least)] = 0
                if gain.max() > best[0]:
                    best = (gain.max(), f, int(gain.argmax()))
            if best[1] >= 0:
                low = binned[rows, best[1]] <= best[2]
                feature[at], cut[at] = best[1], float(cuts[best[1]][best[2]])
                left[at] = node(rows[low], depth + 1)
                right[at] = node(rows[~low], depth + 1)
            return at

        node(np.arange(len(g)), 0)
        return np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(value)

    @staticmethod
    def _tree(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
        feature, cut, left, right, value = tree
        at = np.zeros(len(x), dtype=int)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return value[at]
            low = x[np.arange(len(x)), np.maximum(f, 0)] <= cut[at]
            at = np.where(inner, np.where(low, left[at], right[at]), at)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((self._tree(t, x) for t in self.nodes), np.zeros(len(x)))


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset that calibrate margins to probabilities, by Newton steps on
    targets drawn a little away from 0 and 1."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * margin + b)
        w = p * (1 - p) + 1e-9
        grad = np.array([((p - target) * margin).sum() + 1e-3 * (a - 1), (p - target).sum()])
        hess = np.array([[(w * margin * margin).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    return a, b
