"""Gradient boosted trees for a yes/no label, in numpy: depth-limited trees over binned features,
logistic loss, second-order leaf values, and a logistic calibration of the margins."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_tree(bins, edges, grad, hess, depth, reg):
    """One complete tree: per inner node a feature and a threshold, per leaf a value."""
    inner = 2 ** depth - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(bins), np.int64)
    for level in range(depth):
        first = 2 ** level - 1
        width = 2 ** level
        at = node - first
        best, where = np.full(width, 1e-9), np.full((width, 2), -1)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            k = len(e) + 1
            key = at * k + bins[:, f]
            g = np.bincount(key, grad, width * k).reshape(width, k).cumsum(1)
            h = np.bincount(key, hess, width * k).reshape(width, k).cumsum(1)
            gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
            gain = gl ** 2 / (hl + reg) + (gt - gl) ** 2 / (ht - hl + reg) - gt ** 2 / (ht + reg)
            top = gain.argmax(1)
            value = gain[np.arange(width), top]
            better = value > best
            best[better] = value[better]
            where[better, 0], where[better, 1] = f, top[better]
        split = np.zeros(len(bins), bool)
        for i in range(width):
            f, b = where[i]
            if f >= 0:
                feature[first + i], cut[first + i] = f, edges[f][b]
                mine = at == i
                split[mine] = bins[mine, f] > b
        node = 2 * node + 1 + split
    leaf = node - inner
    g = np.bincount(leaf, grad, inner + 1)
    h = np.bincount(leaf, hess, inner + 1)
    return feature, cut, -g / (h + reg), leaf


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 3, rate: float = 0.2, reg: float = 1.0,
        max_bins: int = 32) -> dict:
    """Boosted trees for labels ``y`` (0 or 1). Same rows, same model: nothing is random."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, max_bins + 1)[1:-1], method="lower")) for c in x.T]
    edges = [e[e < c.max()] if len(c) else e for e, c in zip(edges, x.T)]
    bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(p / (1 - p)))
    margin = np.full(len(y), start)
    feature, cut, leaf = [], [], []
    for _ in range(trees):
        s = sigmoid(margin)
        f, c, v, at = fit_tree(bins, edges, s - y, np.maximum(s * (1 - s), 1e-6), depth, reg)
        feature.append(f), cut.append(c), leaf.append(rate * v)
        margin += rate * v[at]
    return {"start": start, "depth": depth, "feature": np.array(feature), "cut": np.array(cut), "leaf": np.array(leaf),
            "scale": 1.0, "shift": 0.0}


def margins(model: dict, x: np.ndarray) -> np.ndarray:
    out = np.full(len(x), model["start"])
    rows = np.arange(len(x))
    for f, c, v in zip(model["feature"], model["cut"], model["leaf"]):
        node = np.zeros(len(x), np.int64)
        for _ in range(model["depth"]):
            node = 2 * node + 1 + (x[rows, f[node]] > c[node])
        out += v[node - len(f)]
    return out


def calibrate(model: dict, x: np.ndarray, y: np.ndarray) -> dict:
    """Logistic calibration on rows the trees did not see."""
    return calibrate_margins(model, margins(model, x), y, np.ones(len(y)))


def calibrate_margins(model: dict, m: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Logistic calibration by margins, labels and weights (Newton steps on scale and shift)."""
    a, b = 1.0, 0.0
    for _ in range(25):
        p = sigmoid(a * m + b)
        g = np.array([(weight * (p - y) * m).sum() + 1e-3 * (a - 1), (weight * (p - y)).sum() + 1e-3 * b])
        w = weight * np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * m * m).sum() + 1e-3, (w * m).sum()], [(w * m).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return model | {"scale": float(max(a, 1e-3)), "shift": float(b)}


def probability(model: dict, x: np.ndarray) -> np.ndarray:
    return sigmoid(model["scale"] * margins(model, x) + model["shift"])
