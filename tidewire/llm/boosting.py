"""Histogram gradient-boosted trees for two classes, in numpy.

Features are cut into at most 255 bins at quantiles of the training rows. Trees grow level by level; a level's
gradient and Hessian histograms come from one bincount for each feature. The fitted trees are flattened into arrays
(feature, threshold, left child, value) that score all rows of a batch at once: a step moves every row one level down.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Trees of equal depth as flat arrays; node i's children are left[i] and left[i] + 1; leaves point to themselves."""

    bias: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    leaf: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                down = self.left[at] + (x[rows, self.feature[at]] > self.threshold[at])
                at = np.where(self.leaf[at], at, down)
            out += self.value[at]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of class 1."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(np.nan_to_num(x)), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 5, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 5.0) -> Forest:
    """Fits to rows x (float) with labels y (0 or 1). Without rows, or with one class, the trees only hold the bias."""
    x = np.nan_to_num(np.asarray(x, np.float64))
    y = np.asarray(y, np.float64)
    n = len(y)
    mean = (y.sum() + 1.0) / (n + 2.0)
    bias = float(np.log(mean / (1 - mean)))
    cols: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "leaf", "value")}
    roots: list[int] = []

    def node(value: float) -> int:
        for k, v in zip(cols, (0, 0.0, 0, True, value)):
            cols[k].append(v)
        return len(cols["leaf"]) - 1

    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])  # bin b: values up to edges[b]
        margin = np.full(n, bias)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            roots.append(node(-rate * g.sum() / (h.sum() + l2)))
            at = np.full(n, roots[-1])
            level = [roots[-1]]
            for _ in range(depth):
                slot = np.full(len(cols["leaf"]), -1)
                slot[level] = np.arange(len(level))
                mine = slot[at]
                live = mine >= 0
                best = np.full(len(level), 1e-6)
                pick = np.full((len(level), 2), -1)
                gs, hs = (np.bincount(mine[live], v[live], minlength=len(level)) for v in (g, h))
                whole = gs**2 / (hs + l2)
                for f in range(x.shape[1]):
                    if not len(edges[f]):
                        continue
                    key = mine[live] * (bins + 1) + binned[f][live]
                    gl, hl = (np.cumsum(np.bincount(key, v[live], minlength=len(level) * (bins + 1)).reshape(len(level), -1), axis=1)[:, : len(edges[f])] for v in (g, h))
                    gr, hr = gs[:, None] - gl, hs[:, None] - hl
                    gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - whole[:, None]
                    gain[(hl < least / 10) | (hr < least / 10)] = -1
                    top = gain.argmax(axis=1)
                    better = gain[np.arange(len(level)), top] > best
                    best[better] = gain[np.arange(len(level)), top][better]
                    pick[better] = np.stack([np.full(len(level), f), top], axis=1)[better]
                after = []
                for i, nd in enumerate(level):
                    f, b = pick[i]
                    if f < 0:
                        continue
                    rows = np.flatnonzero(at == nd)
                    right = binned[f][rows] > b
                    kids = []
                    for part in (rows[~right], rows[right]):
                        kids.append(node(-rate * g[part].sum() / (h[part].sum() + l2)))
                        at[part] = kids[-1]
                    cols["feature"][nd], cols["threshold"][nd], cols["left"][nd], cols["leaf"][nd] = int(f), float(edges[f][b]), kids[0], False
                    after += kids
                if not after:
                    break
                level = after
            margin += np.array(cols["value"])[at]
    return Forest(bias, depth, np.array(roots, np.int64), np.array(cols["feature"], np.int64), np.array(cols["threshold"], np.float64), np.array(cols["left"], np.int64), np.array(cols["leaf"], bool), np.array(cols["value"], np.float64))
