"""Gradient-boosted trees for the logistic loss, on binned features.  For samples that fit one machine."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Trees:
    cuts: list[np.ndarray]
    base: float = 0.0
    rate: float = 0.2
    #: per tree: rows of (feature, bin, left child, right child, value); a leaf has feature -1
    trees: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)], 1) if len(x) else np.zeros(x.shape, int)

    def logit(self, x: np.ndarray) -> np.ndarray:
        b, out = self.bins(x), np.full(len(x), self.base)
        for t in self.trees:
            node = np.zeros(len(x), int)
            while True:
                at = np.flatnonzero(t[node, 0] >= 0)
                if not len(at):
                    break
                rows = t[node[at]]
                right = b[at, rows[:, 0].astype(int)] > rows[:, 1]
                node[at] = np.where(right, rows[:, 3], rows[:, 2]).astype(int)
            out += self.rate * t[node, 4]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logit(x), -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Newton boosting: each tree splits where the gain in the second-order loss is largest."""
    cuts = []
    for j in range(x.shape[1]):
        v = np.unique(x[:, j])
        mid = (v[1:] + v[:-1]) / 2
        cuts.append(mid[np.unique(np.linspace(0, len(mid) - 1, min(len(mid), BINS - 1)).astype(int))] if len(mid) else mid)
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model = Trees(cuts, float(np.log(mean / (1 - mean))), rate)
    b, z = model.bins(x), np.full(len(y), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        rows: list[list[float]] = [[-1, 0, 0, 0, 0]]
        todo = [(0, np.arange(len(y)), 0)]
        while todo:
            node, at, level = todo.pop()
            sg, sh = g[at].sum(), h[at].sum()
            rows[node][4] = -sg / (sh + ridge)
            z[at] += rate * rows[node][4]
            if level == depth:
                continue
            best = (1e-6, -1, -1)
            for j in range(x.shape[1]):
                n = len(cuts[j]) + 1
                if n == 1:
                    continue
                lg, lh = np.cumsum(np.bincount(b[at, j], g[at], n))[:-1], np.cumsum(np.bincount(b[at, j], h[at], n))[:-1]
                gain = lg**2 / (lh + ridge) + (sg - lg) ** 2 / (sh - lh + ridge) - sg**2 / (sh + ridge)
                gain[(lh < least) | (sh - lh < least)] = -1
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, k)
            if best[1] >= 0:
                z[at] -= rate * rows[node][4]
                right = b[at, best[1]] > best[2]
                rows[node][:4] = [best[1], best[2], len(rows), len(rows) + 1]
                rows += [[-1, 0, 0, 0, 0], [-1, 0, 0, 0, 0]]
                todo += [(len(rows) - 2, at[~right], level + 1), (len(rows) - 1, at[right], level + 1)]
        model.trees.append(np.array(rows, float))
    return model
