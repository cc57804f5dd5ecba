"""A generalised additive model with pairwise interactions, learned by cyclic boosting.

Each feature is binned. Round-robin, a tree of up to three leaves on one feature's bins is
fitted to the logistic gradient and added to that feature's lookup table; then the pairs that
explain most of what is left get tables of their own, from trees with one cut on the first
feature and one on the second on either side. A score is a sum of table entries.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def edges_of(column: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between distinct quantiles; values up to a cut go below it."""
    q = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
    return q[q < column.max()] if len(column) else q


def best_cut(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins; place -1 if none is allowed."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain[(hl < least) | (hr < least)] = -1
    if not len(gain) or gain.max() <= 0:
        return 0.0, -1
    return float(gain.max()), int(gain.argmax())


def shallow(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> np.ndarray:
    """Leaf values, by bin, of a tree of up to three leaves."""
    spans, cut = [(0, len(g))], best_cut(g, h, ridge, least)[1]
    if cut >= 0:
        spans = [(0, cut + 1), (cut + 1, len(g))]
        found = [best_cut(g[a:b], h[a:b], ridge, least) for a, b in spans]
        k = int(found[1][0] > found[0][0])
        if found[k][1] >= 0:
            a, b = spans[k]
            spans[k : k + 1] = [(a, a + found[k][1] + 1), (a + found[k][1] + 1, b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def crossed(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree with a cut on the rows and one on the columns either side."""
    out, cut = np.zeros_like(g), best_cut(g.sum(1), h.sum(1), ridge, least)[1]
    halves = [slice(0, len(g))] if cut < 0 else [slice(0, cut + 1), slice(cut + 1, len(g))]
    for rows in halves:
        gs, hs = g[rows].sum(0), h[rows].sum(0)
        c = best_cut(gs, hs, ridge, least)[1]
        for cols in [slice(0, len(gs))] if c < 0 else [slice(0, c + 1), slice(c + 1, len(gs))]:
            out[rows, cols] = gs[cols].sum() / (hs[cols].sum() + ridge)
    return float((out * g - 0.5 * out**2 * h).sum()), out


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += t[np.searchsorted(e, x[:, f])]
        small = [np.searchsorted(e, x[:, f]) for f, e in enumerate(self.coarse)] if self.pairs else []
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[small[a], small[b]]
        return sigmoid(total)


def fit(x: np.ndarray, y: np.ndarray, bins: int = 64, rounds: int = 120, pairs: int = 10, rate: float = 0.1,
        ridge: float = 1.0, least: float = 1.0) -> Model:
    """Learn from rows of features and labels 0 or 1; without both labels, a constant model."""
    features = x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(share / (1 - share))), [], [], [], [], [])
    model.edges = [edges_of(x[:, f], bins) for f in range(features)] if len(x) else [np.zeros(0)] * features
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if len(np.unique(y)) < 2:
        return model
    where = [np.searchsorted(e, x[:, f]) for f, e in enumerate(model.edges)]
    total = np.full(len(y), model.intercept)
    for _ in range(rounds):
        for f in range(features):
            p = sigmoid(total)
            size = len(model.tables[f])
            step = rate * shallow(np.bincount(where[f], y - p, size), np.bincount(where[f], p * (1 - p), size), ridge, least)
            model.tables[f] += step
            total += step[where[f]]
    model.coarse = [e[np.unique(np.linspace(0, len(e) - 1, 7).astype(int))] if len(e) else e for e in model.edges]
    small = [np.searchsorted(e, x[:, f]) for f, e in enumerate(model.coarse)]
    sizes = [len(e) + 1 for e in model.coarse]

    def grid(a: int, b: int) -> tuple[float, np.ndarray]:
        p, n = sigmoid(total), sizes[a] * sizes[b]
        key = small[a] * sizes[b] + small[b]
        g, h = np.bincount(key, y - p, n), np.bincount(key, p * (1 - p), n)
        return crossed(g.reshape(sizes[a], sizes[b]), h.reshape(sizes[a], sizes[b]), ridge, least)

    gains = sorted(((grid(a, b)[0], a, b) for a in range(features) for b in range(a + 1, features)), reverse=True)
    model.pairs = [(a, b) for gain, a, b in gains[:pairs] if gain > 0]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(rounds // 2):
        for k, (a, b) in enumerate(model.pairs):
            step = rate * grid(a, b)[1]
            model.pair_tables[k] += step
            total += step[small[a], small[b]]
    return model
