"""Gradient-boosted trees over binned features, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from pigeonhole.llm.gam import edges_of, sigmoid


@dataclass
class Forest:
    """Complete trees of one depth: a feature and a cut a node, a value a leaf."""

    intercept: float
    depth: int
    features: list[np.ndarray]
    cuts: list[np.ndarray]
    leaves: list[np.ndarray]

    def raw(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.intercept), np.arange(len(x))
        for f, c, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            total += leaf[node - (2**self.depth - 1)]
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48,
        ridge: float = 1.0, least: float = 1.0) -> Forest:
    share = (y.sum() + 1) / (len(y) + 2)
    out = Forest(float(np.log(share / (1 - share))), depth, [], [], [])
    if len(np.unique(y)) < 2:
        return out
    features = x.shape[1]
    edges = [edges_of(x[:, f], bins) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], 1)
    total = np.full(len(y), out.intercept)
    for _ in range(trees):
        p = sigmoid(total)
        g, h = y - p, p * (1 - p)
        inner = 2**depth - 1
        feature, cut, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            place = node - first
            best = np.zeros(width)
            chosen = np.full((width, 2), -1)
            for f in range(features):
                size = len(edges[f]) + 1
                if size < 2:
                    continue
                key = place * size + binned[:, f]
                gs = np.bincount(key, g, width * size).reshape(width, size).cumsum(1)
                hs = np.bincount(key, h, width * size).reshape(width, size).cumsum(1)
                gl, hl, ga, ha = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                gain[(hl < least) | (ha - hl < least)] = 0
                at = gain.argmax(1)
                better = gain[np.arange(width), at] > best + 1e-9
                best[better] = gain[np.arange(width), at][better]
                chosen[better] = np.stack([np.full(width, f), at], 1)[better]
            right = np.zeros(len(y), bool)
            for k in range(width):
                f, b = chosen[k]
                if f >= 0:
                    feature[first + k], cut[first + k] = f, edges[f][b]
                    mine = place == k
                    right[mine] = binned[mine, f] > b
            node = 2 * node + 1 + right
        leaf = node - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        out.features.append(feature)
        out.cuts.append(cut)
        out.leaves.append(value)
        total += value[leaf]
    return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing function of the score that is nearest to the labels."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # sum, weight, first and last score
    for s, v in zip(score[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([v, 1.0, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            v2, w2, _, b2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + v2, blocks[-1][1] + w2, blocks[-1][2], b2]
    if not blocks:
        return np.array([0.0]), np.array([0.5])
    xs = np.array([x for b in blocks for x in (b[2], b[3])])
    ys = np.array([b[0] / b[1] for b in blocks for _ in range(2)])
    return xs, ys
