"""Gradient-boosted trees in numpy: logistic loss, histogram splits, monotonic constraints, and scoring
over flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """All nodes of all trees. A leaf points to itself, so every row takes ``depth`` steps from each root."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, monotone: dict[int, int] | None = None, trees: int = 80, depth: int = 4, rate: float = 0.15,
        bins: int = 64, l2: float = 1.0, min_weight: float = 2.0) -> Trees:
    """``monotone``: feature -> +1 (the score never falls as it grows) or -1. A split on such a feature
    must order its leaves, and its middle value bounds both sides below. With one class, or no rows, the
    model is that class's smoothed share."""
    monotone = monotone or {}
    n, width = x.shape
    prior = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(prior / (1 - prior)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots = []

    def add(value):
        k = len(nodes["feature"])
        for name, v in (("feature", 0), ("threshold", 0.0), ("left", k), ("right", k), ("value", value)):
            nodes[name].append(v)
        return k

    if n and 0 < y.sum() < n:
        cuts = []
        for f in range(width):
            values = np.unique(x[:, f])
            mid = (values[1:] + values[:-1]) / 2
            cuts.append(mid if len(mid) < bins else np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])))
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
        margin = np.full(n, base)

        def weight(g, h, lo, hi):
            return np.clip(-g / (h + l2), lo, hi)

        def gain(g, h, w):
            return -(g * w + 0.5 * (h + l2) * w * w)

        def grow(rows, level, lo, hi):
            g, h = grad[rows].sum(), hess[rows].sum()
            value = float(weight(g, h, lo, hi))
            best = (1e-6, None)
            if level < depth:
                for f in range(width):
                    k = len(cuts[f])
                    if not k:
                        continue
                    b = binned[rows, f]
                    gl = np.cumsum(np.bincount(b, grad[rows], k + 1))[:k]
                    hl = np.cumsum(np.bincount(b, hess[rows], k + 1))[:k]
                    wl, wr = weight(gl, hl, lo, hi), weight(g - gl, h - hl, lo, hi)
                    ok = (hl >= min_weight) & (h - hl >= min_weight)
                    if f in monotone:
                        ok &= (wr - wl) * monotone[f] >= 0
                    score = np.where(ok, gain(gl, hl, wl) + gain(g - gl, h - hl, wr) - gain(g, h, value), 0)
                    j = int(np.argmax(score))
                    if score[j] > best[0]:
                        best = (score[j], (f, j, float(wl[j] + wr[j]) / 2))
            if best[1] is None:
                margin[rows] += rate * value
                return add(rate * value)
            f, j, middle = best[1]
            goes = binned[rows, f] <= j
            down, up = ((lo, middle), (middle, hi)) if monotone.get(f, 0) > 0 else ((middle, hi), (lo, middle)) if f in monotone else ((lo, hi), (lo, hi))
            k = add(0.0)
            nodes["feature"][k], nodes["threshold"][k] = f, float(cuts[f][j])
            nodes["left"][k] = grow(rows[goes], level + 1, *down)
            nodes["right"][k] = grow(rows[~goes], level + 1, *up)
            return k

        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
    if not roots:
        roots = [add(0.0)]
    return Trees(np.array(nodes["feature"]), np.array(nodes["threshold"]), np.array(nodes["left"]), np.array(nodes["right"]),
                 np.array(nodes["value"]), np.array(roots), base, depth)
